"""Corrections, export names, file locations and the exported tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spark_curate.functions import columns as C
from spark_curate.operators.labeling import label_distribution
from spark_curate.operators.sequence import global_sequence


def apply_corrections(labels: DataFrame, corrections: DataFrame, categories: Sequence[str]) -> DataFrame:
    """Labels (image and one column per category) with manual corrections.

    Only corrections marked ``correct = false`` count; the last one of an image
    wins and overrides the categories it gives.
    """
    wrong = corrections.where(F.col("correct").eqNullSafe(False))
    last = wrong.groupBy("image").agg(
        F.max_by(F.struct(*[F.col(f"`{c}`") for c in categories]), "ord").alias("_c")
    )
    joined = labels.join(last, "image", "left")
    fixed = {c: F.coalesce(F.col(f"_c.`{c}`"), F.col(f"`{c}`")).alias(c) for c in categories}
    rest = [fixed.get(c, F.col(f"`{c}`")) for c in labels.columns]
    return joined.select(*rest, F.col("_c").isNotNull().alias("corrected"))


def export_names(
    labels: DataFrame, order: str = "image", prefix: str = "item", suffix: str = ".jpg"
) -> DataFrame:
    """Sequential names ``item_00001.jpg`` in the given order, as ``new_name``."""
    numbered = global_sequence(labels, [order], "seq")
    return numbered.withColumn(
        "new_name", F.format_string(f"{prefix}_%05d{suffix}", F.col("seq"))
    )


def first_locations(*places: DataFrame) -> DataFrame:
    """Path of each image in the first place that has it (columns image, path)."""
    tagged = [p.select("image", "path", F.lit(i).alias("place")) for i, p in enumerate(places)]
    united = tagged[0]
    for more in tagged[1:]:
        united = united.unionByName(more)
    return united.groupBy("image").agg(
        F.min_by("path", F.struct("place", "path")).alias("path"), F.min("place").alias("place")
    )


def clean_table(named: DataFrame, categories: Sequence[str]) -> DataFrame:
    """Main export: new name and labels, without raw scores."""
    return named.select(
        F.col("new_name").alias("image"),
        *[C.or_unknown(F.col(f"`{c}`")).alias(c) for c in categories],
    )


def distribution(clean: DataFrame, categories: Sequence[str]) -> DataFrame:
    """Count and percent of every label per category."""
    pairs = C.map_from_columns((c, F.col(f"`{c}`")) for c in categories)
    return label_distribution(clean.select("image", F.explode(pairs).alias("category", "label")))
