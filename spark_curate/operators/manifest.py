"""Per-image manifest: merge the outcome of a step into the table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spark_curate.sources import schemas as S

STEPS = ("dedup", "filter", "label")


def upsert(manifest: DataFrame, step: str, updates: DataFrame) -> DataFrame:
    """Merge updates of one step (image, fields of the step, maybe ``present``).

    ``present`` names the fields a row gives: those overwrite, even with null;
    absent ones keep their value. Without it every field column is given. Rows
    with a blank name are ignored.
    """
    fields = [f for f in S.MANIFEST[step].dataType.names if f != "updated_at"]
    given = [f for f in fields if f in updates.columns]
    present = (
        F.col("present") if "present" in updates.columns else F.array(*[F.lit(f) for f in given])
    )
    new = updates.where(F.coalesce("image", F.lit("")) != "").select(
        "image", F.struct(*given).alias("_new"), present.alias("_present")
    )
    joined = manifest.join(new, "image", "full_outer")
    touched = F.col("_present").isNotNull()

    def value(field: str) -> Column:
        old = F.col(f"{step}.{field}")
        if field not in given:
            return old.alias(field)
        overwrites = touched & F.array_contains("_present", field)
        return F.when(overwrites, F.col(f"_new.{field}")).otherwise(old).alias(field)

    stamp = F.when(touched, F.current_timestamp()).otherwise(F.col(f"{step}.updated_at"))
    merged = F.struct(*[value(f) for f in fields], stamp.alias("updated_at"))
    state = F.when(touched | F.col(step).isNotNull(), merged)
    columns = [state.alias(s) if s == step else F.col(s) for s in STEPS]
    return joined.select("image", *columns)


def dedup_updates(items: DataFrame, dups: DataFrame) -> DataFrame:
    """Dedup outcome of all items (image, maybe source_path)."""
    path = F.col("source_path") if "source_path" in items.columns else F.lit(None).cast("string")
    return items.select("image", path.alias("source_path")).join(dups, "image", "left").select(
        "image", F.col("duplicate_of").isNull().alias("kept"), "duplicate_of", "source_path"
    )


def filter_updates(decisions: DataFrame, digits: int = 6) -> DataFrame:
    """Filter outcome; resumed and unreadable items leave older scores alone."""
    short = F.array(F.lit("kept"), F.lit("reason"))
    full = F.concat(short, F.array(F.lit("positive_score"), F.lit("negative_score")))
    return decisions.select(
        "image",
        "kept",
        "reason",
        F.round("positive", digits).alias("positive_score"),
        F.round("negative", digits).alias("negative_score"),
        F.when(F.col("reason").isin("resume_existing", "load_error"), short).otherwise(full).alias("present"),
    )


def label_updates(records: DataFrame) -> DataFrame:
    """Label outcome: non-blank categories of each record."""
    named = F.transform_values("predicted", lambda _, v: F.trim(v))
    return records.select(
        F.trim("image").alias("image"),
        F.lit(True).alias("labeled"),
        F.map_filter(named, lambda _, v: v != "").alias("categories"),
    )
