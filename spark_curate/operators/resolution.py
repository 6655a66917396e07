"""Resolution gate, resize dimensions and names of the resize step."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spark_curate.functions import names as N

# Default sizes in pixels.
MIN_SHORTEST = 512
MAX_SIDE = 1024


def passes_resolution(width: Column, height: Column, least: int = MIN_SHORTEST) -> Column:
    return F.least(width, height) >= least


def resize_metric(width: Column, height: Column, mode: str = "shortest_side") -> Column:
    """Side that is bounded; an unknown mode means the shortest one."""
    return F.greatest(width, height) if mode == "longest_side" else F.least(width, height)


def target_dims(
    width: Column, height: Column, most: int = MAX_SIDE, mode: str = "shortest_side"
) -> tuple[Column, Column, Column]:
    """(new width, new height, resized): shrinks only, rounds half to even."""
    metric = resize_metric(width, height, mode)
    scale = F.lit(float(most)) / metric
    shrink = metric > most

    def side(c: Column) -> Column:
        return F.when(shrink, F.bround(c * scale).cast("int")).otherwise(c)

    new_width, new_height = side(width), side(height)
    return new_width, new_height, (new_width != width) | (new_height != height)


def resolution_step(
    items: DataFrame,
    existing: DataFrame | None = None,
    least: int = MIN_SHORTEST,
    most: int = MAX_SIDE,
    mode: str = "shortest_side",
) -> DataFrame:
    """Status and new dimensions of each raw image.

    ``items`` holds path, width and height (null or negative if unreadable);
    ``existing`` holds ``name`` of outputs already there. Status in order: skipped,
    error, discarded, resized, kept.
    """
    readable = F.coalesce((F.col("width") > 0) & (F.col("height") > 0), F.lit(False))
    named = items.withColumn("name", N.resized_name(F.col("path")))
    if existing is None:
        marked = named.withColumn("_done", F.lit(None).cast("boolean"))
    else:
        done = existing.select("name").distinct().withColumn("_done", F.lit(True))
        marked = named.join(done, "name", "left")
    new_width, new_height, resized = target_dims(F.col("width"), F.col("height"), most, mode)
    status = (
        F.when(F.col("_done"), "skipped")
        .when(~readable, "error")
        .when(~passes_resolution(F.col("width"), F.col("height"), least), "discarded")
        .when(resized, "resized")
        .otherwise("kept")
    )
    out = F.col("status").isin("resized", "kept")
    return marked.withColumn("status", status).select(
        "path",
        "name",
        "width",
        "height",
        "status",
        F.when(out, new_width).alias("new_width"),
        F.when(out, new_height).alias("new_height"),
    )


def resolution_counts(step: DataFrame) -> DataFrame:
    """Totals of the step; skipped and resized images count as kept."""
    status = F.col("status")
    return step.agg(
        F.count("*").alias("total"),
        F.count_if(status.isin("skipped", "kept", "resized")).alias("kept"),
        F.count_if(status == "discarded").alias("discarded"),
        F.count_if(status == "resized").alias("resized"),
        F.count_if(status == "error").alias("errors"),
    )


def name_collisions(items: DataFrame) -> DataFrame:
    """Output names claimed by more than one raw path."""
    return (
        items.groupBy(N.resized_name(F.col("path")).alias("name"))
        .agg(F.count("*").alias("n"), F.min("path").alias("first_path"))
        .where(F.col("n") > 1)
    )


def find_originals(resized: DataFrame, raw: DataFrame) -> DataFrame:
    """Raw path of each resized image: image, path (null if it is gone).

    Several suffixes may share a stem; the preferred one is taken.
    """
    suffix = N.suffix(F.col("path"))
    order = F.array_position(F.array(*[F.lit(s) for s in N.LISTED_SUFFIXES]), suffix)
    originals = (
        raw.where(suffix.isin(*N.LISTED_SUFFIXES) & N.query_of_path(F.col("path")).isNotNull())
        .groupBy(N.resized_name(F.col("path")).alias("_key"))
        .agg(F.min_by("path", F.struct(order, "path")).alias("path"))
    )
    return (
        resized.withColumn("_key", N.stem(F.col("image")))
        .join(originals, "_key", "left")
        .select("image", "path")
    )
