"""Prompt-group scores, keep / reject decisions and their boundary analysis."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spark_curate.functions import vectors as V
from spark_curate.functions.session import materialize
from spark_curate.operators.sequence import global_sequence

GROUPS = ("positive", "negative", "overlay", "clean")


@dataclass(frozen=True)
class Thresholds:
    """Decision thresholds; the defaults are the ones of a bare call."""

    threshold: float = 0.30
    overlay_margin: float = 0.07


# Thresholds of the shipped configuration.
CONFIGURED = Thresholds(threshold=0.24, overlay_margin=-0.03)

# Upper limits of the borderline and moderate decision bands.
BORDERLINE_BELOW = 0.03
MODERATE_BELOW = 0.08


def group_vectors(prompts: DataFrame, keys: Sequence[str] = ("group",)) -> DataFrame:
    """Mean vector per prompt group.

    The mean of dot products equals the dot product with the mean vector, so an
    item is compared once per group however many prompts the group holds.
    """
    return prompts.groupBy(*keys).agg(V.mean_vector(F.col("embedding")).alias("vector"))


def vector_blocks(
    vectors: DataFrame, vector: str, order: Sequence[str], max_bytes: int
) -> Iterator[list]:
    """Lists of rows of at most ``max_bytes`` of vectors each, in order.

    A table within the bound is one block. A larger one is numbered and read block
    by block, so that the driver never holds more than a block. The order columns
    identify a row.
    """
    rows, dim = V.bounded_rows(vectors, vector, max_bytes)
    if rows is not None:
        yield sorted(rows, key=lambda r: tuple(r[c] for c in order))
        return
    most = max(1, min(V.MAX_BLOCK_ROWS, max_bytes // (8 * dim)))
    numbered = materialize(global_sequence(vectors, list(order), "_seq"))
    for start in range(0, numbered.count(), most):
        block = numbered.where(F.col("_seq").between(start + 1, start + most))
        yield block.orderBy("_seq").drop("_seq").collect()


def group_scores(
    items: DataFrame,
    prompts: DataFrame,
    groups: Sequence[str] = GROUPS,
    embedding: str = "embedding",
) -> DataFrame:
    """Add one mean-similarity column per prompt group; null without a vector."""
    rows = group_vectors(prompts.where(F.col("group").isin(*groups))).limit(len(groups)).collect()
    found = {r["group"]: r["vector"] for r in rows}
    missing = [g for g in groups if g not in found]
    if missing:
        raise ValueError(f"no prompts for groups {missing}")
    scored = items.withColumn(
        "_scores", V.products(F.col(embedding), [found[g] for g in groups])
    )
    picked = [F.col("_scores")[i].alias(g) for i, g in enumerate(groups)]
    return scored.select(*items.columns, *picked)


def is_flagged(overlay: Column, clean: Column, margin: float) -> Column:
    """Overlay rule: strictly more than ``margin`` above the clean score."""
    return F.coalesce(overlay - clean > F.lit(margin), F.lit(False))


def is_target(positive: Column, negative: Column, threshold: float) -> Column:
    """Target rule: at least the threshold and strictly above the negative score."""
    return F.coalesce((positive >= F.lit(threshold)) & (positive > negative), F.lit(False))


def filter_decisions(
    scores: DataFrame,
    thresholds: Thresholds = Thresholds(),
    existing: DataFrame | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One decision row per item with its reason.

    Reasons in order: overlay, resume_existing, load_error, passed, low_score.
    Positive and negative scores are given only where that rule was evaluated.
    ``existing`` (images) turns on resuming: those items stay kept. Columns named
    in ``keep`` are carried along.
    """
    flagged = is_flagged(F.col("overlay"), F.col("clean"), thresholds.overlay_margin)
    passed = is_target(F.col("positive"), F.col("negative"), thresholds.threshold)
    if existing is None:
        base, done = scores, F.lit(False)
    else:
        marks = existing.select("image").distinct().withColumn("_done", F.lit(True))
        base, done = scores.join(marks, "image", "left"), F.coalesce(F.col("_done"), F.lit(False))
    reason = (
        F.when(flagged, F.lit("overlay"))
        .when(done, F.lit("resume_existing"))
        .when(F.col("positive").isNull(), F.lit("load_error"))
        .when(passed, F.lit("passed"))
        .otherwise(F.lit("low_score"))
    )
    scored = ~flagged & ~done
    return base.withColumn("reason", reason).select(
        "image",
        *keep,
        F.when(scored, F.col("positive")).alias("positive"),
        F.when(scored, F.col("negative")).alias("negative"),
        "overlay",
        "clean",
        flagged.alias("flagged"),
        F.col("reason").isin("passed", "resume_existing").alias("kept"),
        "reason",
    )


def decision_counts(decisions: DataFrame) -> DataFrame:
    """Totals of a filter run in one row."""
    return decisions.agg(
        F.count("*").alias("total"),
        F.count_if("kept").alias("kept"),
        F.count_if(F.col("reason") == "low_score").alias("discarded_target"),
        F.count_if(F.col("reason") == "overlay").alias("discarded_overlay"),
        F.count_if(F.col("reason") == "load_error").alias("errors"),
    )


def margin_analysis(
    decisions: DataFrame, thresholds: Thresholds = Thresholds(), digits: int | None = None
) -> DataFrame:
    """Margins, failed rules, rejection mode, nearest boundary and decision band.

    ``digits`` rounds the scores first, which reproduces an analysis that starts
    from a log written with that many decimals.
    """

    def score(name: str) -> Column:
        c = F.col(name)
        return c if digits is None else F.round(c, digits)

    limit, margin = F.lit(thresholds.threshold), F.lit(thresholds.overlay_margin)
    false = F.lit(False)
    base = decisions.select(
        "image",
        "kept",
        "reason",
        score("positive").alias("positive"),
        score("negative").alias("negative"),
        score("overlay").alias("overlay"),
        score("clean").alias("clean"),
        F.col("flagged"),
    )
    pos, neg = F.col("positive"), F.col("negative")
    measured = base.select(
        "*",
        (pos - limit).alias("target_margin"),
        (pos - neg).alias("target_gap"),
        (F.col("overlay") - F.col("clean")).alias("overlay_delta"),
    ).select("*", (margin - F.col("overlay_delta")).alias("overlay_margin_gap"))
    failed = measured.select(
        "*",
        (
            F.coalesce(F.col("overlay_delta") > margin, false) | F.coalesce(F.col("flagged"), false)
        ).alias("overlay_fail"),
        F.coalesce(pos < limit, false).alias("threshold_fail"),
        F.coalesce(pos <= neg, false).alias("negative_fail"),
    ).select(
        "*",
        (~F.col("overlay_fail") & F.coalesce((pos >= limit) & (pos > neg), false)).alias(
            "kept_by_rule"
        ),
    )
    gap_wins = (neg - pos) >= (limit - pos)
    mode = (
        F.when(F.col("overlay_fail"), "overlay_margin")
        .when(
            F.col("threshold_fail") & F.col("negative_fail"),
            F.when(gap_wins, "target_vs_negative").otherwise("target_threshold"),
        )
        .when(F.col("threshold_fail"), "target_threshold")
        .when(F.col("negative_fail"), "target_vs_negative")
        .otherwise("unknown")
    )

    def candidate(name: str, distance: Column, rank: int, counts: Column) -> Column:
        return F.struct(
            distance.alias("distance"),
            F.lit(rank).alias("rank"),
            F.lit(name).alias("name"),
            counts.alias("counts"),
        )

    def known(*candidates: Column) -> Column:
        return F.filter(F.array(*candidates), lambda c: c["distance"].isNotNull() & c["counts"])

    always = F.lit(True)
    slack = F.array_min(
        known(
            candidate("target_threshold", F.col("target_margin"), 1, always),
            candidate("target_vs_negative", F.col("target_gap"), 2, always),
            candidate("overlay_margin", F.col("overlay_margin_gap"), 3, always),
        )
    )
    violation = F.array_max(
        known(
            candidate("overlay_margin", F.col("overlay_delta") - margin, -1, F.col("overlay_fail")),
            candidate("target_threshold", limit - pos, -2, F.col("threshold_fail")),
            candidate("target_vs_negative", neg - pos, -3, F.col("negative_fail")),
        )
    )
    nearest = failed.withColumn("_near", F.when(F.col("kept_by_rule"), slack).otherwise(violation))
    distance = F.col("_near.distance")
    return nearest.select(
        *failed.columns,
        mode.alias("rejection_mode"),
        F.coalesce(F.col("_near.name"), F.lit("unknown")).alias("nearest_boundary"),
        distance.alias("decision_distance"),
        _band(distance)
        .alias("decision_band"),
    )


def _band(distance: Column) -> Column:
    """How far an item stands from the boundary."""
    return (
        F.when(distance.isNull(), "unknown")
        .when(distance < BORDERLINE_BELOW, "borderline")
        .when(distance < MODERATE_BELOW, "moderate")
        .otherwise("clear")
    )


def rejection_reasons(decisions: DataFrame) -> DataFrame:
    """Rejected items with why, and every score known about them."""
    return decisions.where(~F.col("kept")).select(
        "image",
        F.when(F.col("reason") == "overlay", "overlay").otherwise("low_score").alias(
            "rejection_reason"
        ),
        "positive",
        "negative",
        "overlay",
        "clean",
        "flagged",
    )


def merge_overlay_log(target_log: DataFrame, overlay_log: DataFrame) -> DataFrame:
    """Decisions rebuilt from the two logs; overlay columns null if not logged."""
    flags = overlay_log.select("image", "overlay", "clean", "flagged")
    return target_log.join(flags, "image", "left").withColumn(
        "flagged", F.coalesce("flagged", F.lit(False))
    )
