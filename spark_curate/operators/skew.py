"""Joins that hold when one key owns a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spark_curate.functions.session import materialize

HOT_KEYS = 1000
SALTS = 32
SMALL_ROWS = 100_000


def hot_keys(counts: DataFrame, keys: Sequence[str], n: str = "n", most: int = HOT_KEYS) -> DataFrame:
    """Keys owning more than 1/``most`` of the rows: fewer than ``most`` by count."""
    total = counts.agg(F.sum(n)).first()[0] or 0
    return counts.where(F.col(n) * most > total).select(*keys)


def join_unique(
    left: DataFrame, right: DataFrame, key: str | list[str], n: str = "n", rows: int | None = None
) -> DataFrame:
    """Inner join with a side holding one row per key and the key's row count ``n``.

    A side of up to ``SMALL_ROWS`` known ``rows`` is broadcast. Otherwise rows of
    hot keys meet a broadcast of at most ``HOT_KEYS`` rows and stay where they are;
    only the others are shuffled. A side of more than ``SMALL_ROWS`` is sorted, never
    broadcast: its file may be small enough for the planner and its rows not for the driver.
    """
    if rows is not None and rows <= SMALL_ROWS:
        return left.join(F.broadcast(right.drop(n)), key)
    right = materialize(right)
    total, keys = right.agg(F.sum(n), F.count("*")).first()
    is_hot = F.col(n) * HOT_KEYS > (total or 0)
    hot = F.broadcast(right.where(is_hot).drop(n))
    cold = left.join(F.broadcast(right.where(is_hot).select(key)), key, "left_anti")
    others = right.where(~is_hot).drop(n)
    return left.join(hot, key).unionByName(cold.join(others.hint("merge") if keys > SMALL_ROWS else others, key))


def salted_join(
    many: DataFrame, few: DataFrame, keys: Sequence[str], spread: str, hot: DataFrame
) -> DataFrame:
    """Inner join in which the rows of ``many`` under hot keys are spread.

    ``hot`` is bounded by :func:`hot_keys`. Rows of ``many`` get a salt from the
    column ``spread``; rows of ``few`` under a hot key are repeated per salt.
    """
    marks = F.broadcast(hot.withColumn("_hot", F.lit(True)))
    left = many.join(marks, list(keys), "left").withColumn(
        "_salt",
        F.when(F.col("_hot"), F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int")).otherwise(0),
    )
    every = F.array(*[F.lit(i) for i in range(SALTS)])
    right = few.join(marks, list(keys), "left").withColumn(
        "_salt", F.explode(F.when(F.col("_hot"), every).otherwise(F.array(F.lit(0))))
    )
    joined = left.drop("_hot").join(right.drop("_hot"), [*keys, "_salt"])
    return joined.drop("_salt")
