"""Global row numbers, ranks, paging and exact quantiles without a single task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spark_curate.functions import columns as C
from spark_curate.functions.session import materialize
from spark_curate.operators.skew import join_unique

_ROW_BITS = 33  # low bits of monotonically_increasing_id: row within partition


def global_sequence(df: DataFrame, order: Sequence[Column | str], name: str = "seq") -> DataFrame:
    """Number all rows 1..n in the given order.

    The rows are range-sorted and written once; only one count per partition is
    gathered and turned into an offset. End ``order`` with a unique column, so
    that a hot value still splits over partitions.
    """
    placed = materialize(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", _ROW_BITS)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    # One row per sort partition: bounded by the partition count, not the data.
    numbered = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    row = F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return numbered.select(*df.columns, (F.col("_before") + row + 1).cast("bigint").alias(name))


def page(df: DataFrame, order: Sequence[Column | str], number: int, size: int) -> DataFrame:
    """One page in the given order; pages start at 1."""
    return df.orderBy(*order).offset((number - 1) * size).limit(size)


def page_info(df: DataFrame, number: int, size: int, clamp: bool = False) -> DataFrame:
    """total, page, per_page and pages in one row; ``clamp`` limits page to the last."""
    counted = df.agg(F.count("*").alias("total"))
    pages = F.greatest(F.lit(1).cast("bigint"), C.ceil_div(F.col("total"), size))
    at = F.lit(number).cast("bigint")
    return counted.select(
        "total",
        (F.least(at, pages) if clamp else at).alias("page"),
        F.lit(size).cast("bigint").alias("per_page"),
        pages.alias("pages"),
    )


#: Buckets a bracket is cut into by a counting pass.
BUCKETS = 256


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probabilities: dict[str, float],
    bounded: int = 10000,
) -> DataFrame:
    """Exact linearly interpolated quantiles per key, however large a key is.

    A key of up to ``bounded`` rows is sorted as one list. In a larger one each asked rank
    is selected: a mergeable sketch gives a first bracket of values around it, and passes
    that only count narrow the bracket until it holds at most ``bounded`` rows or one
    value. A pass counts rows by ``BUCKETS`` parts of each bracket, combined map-side, so no
    key is gathered or ordered anywhere. Returns the keys, ``n`` and one column per named
    probability; keys without any value are left out.
    """
    asked = list(probabilities.items())
    present = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_v"))
    # the sketch is off by about n / 10,000 ranks; a bracket that misses its rank is mended
    margin = 4.0 / 10000
    bounds = sorted({min(1.0, max(0.0, p + side)) for _, p in asked for side in (-margin, margin)})
    sketch = materialize(
        present.groupBy(*keys).agg(
            F.count("*").alias("n"),
            F.min("_v").alias("_min"),
            F.max("_v").alias("_max"),
            F.percentile_approx("_v", bounds, F.lit(10000)).alias("_q"),
        )
    )
    large = F.col("n") > bounded

    def rank(p: float) -> Column:
        return F.col("n").cast("double") * p - p

    few = present
    many = sketch.where(large).limit(1).count() > 0
    if many:
        small_keys = sketch.where(~large).select(*keys, "n")
        few = join_unique(present, small_keys.withColumn("_rows", F.col("n")), list(keys), "_rows").drop("n")
    # at most ``bounded`` rows to a list
    lists = few.groupBy(*keys).agg(F.count("*").alias("n"), F.sort_array(F.collect_list("_v")).alias("_all"))

    def at(place: Column) -> Column:
        return F.element_at("_all", (place + 1).cast("int"))

    picked = [
        (at(F.floor(rank(p))) + (at(F.ceil(rank(p))) - at(F.floor(rank(p)))) * (rank(p) - F.floor(rank(p)))).alias(name)
        for name, p in asked
    ]
    answer = lists.select(*keys, "n", *picked)
    if not many:
        return answer

    targets = []
    for i, (_, p) in enumerate(asked):
        lo = F.col("_q")[bounds.index(p - margin)] if p > margin else F.col("_min")
        hi = F.col("_q")[bounds.index(p + margin)] if p < 1 - margin else F.col("_max")
        for k, place in enumerate((F.floor(rank(p)), F.ceil(rank(p)))):
            targets.append(
                F.struct(F.lit(2 * i + k).alias("j"), place.cast("bigint").alias("rank"), lo.alias("lo"), hi.alias("hi"))
            )
    wanted = sketch.where(large).select(*keys, "n", "_min", "_max", F.inline(F.array(*targets)))
    chosen = _select(present, materialize(wanted), list(keys), bounded)
    ends = chosen.groupBy(*keys).agg(
        F.max("n").alias("n"), *[F.max(F.when(F.col("j") == j, F.col("_v"))).alias(f"_e{j}") for j in range(2 * len(asked))]
    )
    between = [
        (F.col(f"_e{2 * i}") + (F.col(f"_e{2 * i + 1}") - F.col(f"_e{2 * i}")) * (rank(p) - F.floor(rank(p)))).alias(name)
        for i, (name, p) in enumerate(asked)
    ]
    return answer.unionByName(ends.select(*keys, "n", *between))


def _select(rows: DataFrame, wanted: DataFrame, keys: list[str], bounded: int) -> DataFrame:
    """The value at each wanted rank: keys, n, j, _v. ``wanted``: keys, n, _min, _max, j, rank, lo, hi.

    A bracket is [lo, hi] and its rank counts from the first value in it.
    """
    per_key = wanted.groupBy(*keys).agg(
        F.max("n").alias("_rows"), F.collect_list(F.struct("j", "lo", "hi")).alias("_t")
    )
    spread = join_unique(rows, per_key, keys, "_rows").select(*keys, "_v", F.inline("_t"))
    v, lo, hi = F.col("_v"), F.col("lo"), F.col("hi")
    counts = spread.groupBy(*keys, "j").agg(
        F.count_if(v < lo).alias("_lo"),
        F.count_if(v <= lo).alias("_upto_lo"),
        F.count_if(v < hi).alias("_hi"),
        F.count_if(v <= hi).alias("_upto_hi"),
    )
    # should the sketch have missed a rank, the bracket is all that lies on its side
    before, after = F.col("rank") < F.col("_lo"), F.col("rank") >= F.col("_upto_hi")
    state = wanted.join(counts, [*keys, "j"]).select(
        *keys,
        "n",
        "j",
        (F.col("rank") - F.when(before, 0).when(after, F.col("_hi")).otherwise(F.col("_lo"))).alias("rank"),
        F.when(before, F.col("_min")).when(after, hi).otherwise(lo).alias("lo"),
        F.when(before, lo).when(after, F.col("_max")).otherwise(hi).alias("hi"),
        F.when(before, F.col("_upto_lo"))
        .when(after, F.col("n") - F.col("_hi"))
        .otherwise(F.col("_upto_hi") - F.col("_lo"))
        .alias("inside"),
    )
    names, fields = [*keys, "j"], ["j", "n", "rank", "lo", "hi", "inside"]
    wide = (F.col("inside") > bounded) & (lo < hi)
    state = materialize(state)
    brackets = state.where(lo < hi).groupBy(*keys).agg(
        F.max("n").alias("_rows"), F.collect_list(F.struct(*fields)).alias("_t")
    )
    left = join_unique(rows, brackets, keys, "_rows").select(*keys, "_v", F.inline("_t"))
    done: list[DataFrame] = []
    while True:
        done.append(state.where(lo >= hi).select(*names, "n", lo.alias("_v")))
        left = materialize(left.where(v.between(lo, hi)))
        small = left.where(~wide).groupBy(*names, "n", "rank", "_v").agg(F.count("*").alias("_c"))
        listed = small.groupBy(*names, "n", "rank").agg(F.sort_array(F.collect_list(F.struct("_v", "_c"))).alias("_all"))
        done.append(listed.select(*names, "n", _nth(F.col("_all"), F.col("rank")).alias("_v")))
        left = left.where(wide)
        if not left.limit(1).count():
            return reduce(DataFrame.unionByName, done)
        state = materialize(_narrowed(left, names))
        fresh = state.where(lo < hi).withColumn("_rows", F.col("inside"))
        left = join_unique(left.select(*names, "_v"), fresh, names, "_rows")


def _nth(listed: Column, rank: Column) -> Column:
    """The value at a rank (from 0) of sorted (_v, _c) pairs."""
    start = F.struct(F.lit(0).cast("bigint").alias("seen"), F.lit(None).cast("double").alias("hit"))

    def step(acc: Column, x: Column) -> Column:
        here = acc["hit"].isNull() & (rank < acc["seen"] + x["_c"])
        return F.struct((acc["seen"] + x["_c"]).alias("seen"), F.when(here, x["_v"]).otherwise(acc["hit"]).alias("hit"))

    return F.aggregate(listed, start, step)["hit"]


def _narrowed(left: DataFrame, names: list[str]) -> DataFrame:
    """Each bracket cut down to the part that holds its rank, by counts of its parts.

    The parts are of equal width and the two ends are parts of their own, so every pass
    drops something; a part's own least and largest value are the new ends.
    """
    v, lo, hi = F.col("_v"), F.col("lo"), F.col("hi")
    endless = F.isnan(hi) | (F.abs(hi) == float("inf")) | (F.abs(lo) == float("inf"))
    place = F.floor((v / 2 - lo / 2) / (hi / 2 - lo / 2) * BUCKETS)
    part = (
        F.when(v <= lo, 0)
        .when(v >= hi, BUCKETS + 1)
        .when(endless, 1)
        .otherwise(F.least(F.lit(BUCKETS), F.greatest(F.lit(1), place.cast("int") + 1)))
    )
    counted = left.groupBy(*names, "n", "rank", part.alias("_p")).agg(
        F.count("*").alias("_c"), F.min("_v").alias("_a"), F.max("_v").alias("_z")
    )
    parts = counted.groupBy(*names, "n", "rank").agg(
        F.sort_array(F.collect_list(F.struct("_p", "_c", "_a", "_z"))).alias("_parts")  # BUCKETS + 2 at most
    )
    rank = F.col("rank")
    zero = F.lit(0).cast("bigint")
    start = F.struct(
        zero.alias("seen"), zero.alias("rank"), F.lit(0.0).alias("lo"), F.lit(0.0).alias("hi"), zero.alias("inside")
    )

    def step(acc: Column, x: Column) -> Column:
        here = (acc["inside"] == 0) & (rank < acc["seen"] + x["_c"])
        pick = lambda new, name: F.when(here, new).otherwise(acc[name]).alias(name)
        return F.struct(
            (acc["seen"] + x["_c"]).alias("seen"),
            pick(rank - acc["seen"], "rank"),
            pick(x["_a"], "lo"),
            pick(x["_z"], "hi"),
            pick(x["_c"], "inside"),
        )

    found = F.aggregate("_parts", start, step)
    return parts.select(*names, "n", found.alias("_f")).select(*names, "n", "_f.rank", "_f.lo", "_f.hi", "_f.inside")
