"""Step statistics, funnel, anomalies, readiness and item browsing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spark_curate.functions import columns as C
from spark_curate.functions import names as N

# Alarm limits in percent.
MIN_RETENTION = 35.0
MAX_REJECTION = 75.0
MAX_REMOVAL = 45.0

# Sizes of the cluster overview.
TOP_REVIEW, TOP_CLUSTERS, TOP_SUGGESTIONS = 150, 20, 120


def step_counts(steps: Mapping[str, DataFrame | tuple[DataFrame, Column]]) -> DataFrame:
    """step, step_ord, n and of (all rows of the step's table): one row per given step.

    A step is a table, whose rows are counted, or a table and an aggregate over it.
    Steps given by the same table are counted in one scan of it.
    """
    tables: dict[int, tuple[DataFrame, list]] = {}
    for i, (step, given) in enumerate(steps.items()):
        df, counted = given if isinstance(given, tuple) else (given, F.count(F.lit(1)))
        tables.setdefault(id(df), (df, []))[1].append((i, step, counted))
    parts = []
    for df, asked in tables.values():
        row = df.agg(F.count(F.lit(1)).alias("_of"), *[c.cast("bigint").alias(f"_n{i}") for i, _, c in asked])
        each = [
            F.struct(
                F.lit(step).alias("step"), F.lit(i).alias("step_ord"), F.col(f"_n{i}").alias("n"), F.col("_of").alias("of")
            )
            for i, step, _ in asked
        ]
        parts.append(row.select(F.inline(F.array(*each))))
    return reduce(DataFrame.unionByName, parts)


def step_rates(counts: DataFrame, steps: Sequence[str] = ("filter", "dedup")) -> DataFrame:
    """step, kept, removed of :func:`step_counts`, as :func:`anomalies` takes them."""
    return counts.where(F.col("step").isin(*steps)).select(
        "step", F.col("n").alias("kept"), (F.col("of") - F.col("n")).alias("removed")
    )


def first_input(counts: DataFrame, candidates: Sequence[str]) -> DataFrame:
    """First non-empty candidate step and its count; no row if all are empty."""
    order = F.array_position(F.array(*[F.lit(c) for c in candidates]), F.col("step"))
    usable = counts.where(F.col("step").isin(*candidates) & (F.col("n") > 0))
    first = usable.agg(F.min_by(F.struct("step", "n"), order).alias("_f"))
    return first.where(F.col("_f").isNotNull()).select("_f.*")


def coalesce_tables(primary: DataFrame, fallback: DataFrame) -> DataFrame:
    """The primary table, or the fallback if the primary has no rows."""
    return fallback if primary.isEmpty() else primary


def download_stats(paths: DataFrame, path: str = "path") -> DataFrame:
    """Counts per source and per query of raw paths: kind, name, n."""
    parsed = paths.select(
        N.source_of_path(F.col(path)).alias("source"), N.query_of_path(F.col(path)).alias("query")
    )
    named = parsed.select(
        F.explode(
            F.array(
                F.struct(F.lit("source").alias("kind"), F.col("source").alias("name")),
                F.struct(F.lit("query").alias("kind"), F.col("query").alias("name")),
            )
        ).alias("e")
    ).select("e.*")
    return (
        named.where(F.col("name").isNotNull())
        .groupBy("kind", "name")
        .agg(F.count("*").alias("n"))
        .orderBy("kind", F.col("n").desc(), "name")
    )


def filter_stats(decisions: DataFrame) -> DataFrame:
    """Cube of (source, outcome): kept, overlay and low_score with all totals."""
    outcome = F.when(F.col("kept"), "kept").when(F.col("reason") == "overlay", "overlay").otherwise(
        "low_score"
    )
    rows = decisions.select(N.source_of_name(F.col("image")).alias("source"), outcome.alias("outcome"))
    return rows.cube("source", "outcome").agg(
        F.count("*").alias("n"), F.grouping_id().cast("int").alias("level")
    )


def overlay_stats(decisions: DataFrame) -> DataFrame:
    return decisions.agg(
        F.count("*").alias("total"),
        F.count_if("flagged").alias("flagged"),
        F.count_if(~F.col("flagged")).alias("clean"),
    )


def dedup_stats(items: DataFrame, dups: DataFrame) -> DataFrame:
    """Kept and removed per source, counted without joining the two tables."""
    marked = items.select("image", F.lit(0).alias("_r")).unionByName(
        dups.select("image", F.lit(1).alias("_r"))
    )
    removed = F.count_if(F.col("_r") == 1)
    return marked.groupBy(N.source_of_name(F.col("image")).alias("source")).agg(
        (F.count_if(F.col("_r") == 0) - removed).alias("kept"), removed.alias("removed")
    )


def sources(items: DataFrame) -> DataFrame:
    return items.select(N.source_of_name(F.col("image")).alias("source")).distinct().orderBy("source")


def flagged_distribution(review: DataFrame) -> DataFrame:
    """How often each category is flagged in a review queue, most common first."""
    return (
        review.select(F.explode("flagged_categories").alias("category"))
        .groupBy("category")
        .agg(F.count("*").alias("n"))
        .orderBy(F.col("n").desc(), "category")
    )


def cluster_stats(summary: DataFrame, review: DataFrame, clusters: DataFrame, suggestions: DataFrame) -> DataFrame:
    """Counters of a run from its summary, else counted from its tables.

    ``summary`` holds at most one row of accepted_images, clusters,
    review_queue_items, suggestion_items and suggested_category_slots, and maybe run_id,
    generated_at, review_only_categories and concentration_factor.
    """
    told = {
        "run_id": F.lit(None).cast("string"),
        "generated_at": F.lit(None).cast("timestamp"),
        "review_only_categories": F.array().cast("array<string>"),
        "concentration_factor": F.lit(None).cast("double"),
    }
    counted = reduce(
        lambda a, b: a.join(b, "_one"),
        [
            review.agg(F.count("*").alias("_review")).withColumn("_one", F.lit(1)),
            clusters.agg(F.count("*").alias("_clusters")).withColumn("_one", F.lit(1)),
            suggestions.agg(
                F.count_distinct("image").alias("_images"), F.count("*").alias("_slots")
            ).withColumn("_one", F.lit(1)),
        ],
    )
    known = summary.select(
        F.lit(1).alias("_one"),
        "accepted_images",
        F.col("clusters").alias("_known_clusters"),
        "review_queue_items",
        "suggestion_items",
        "suggested_category_slots",
        *[(F.col(c) if c in summary.columns else none).alias(c) for c, none in told.items()],
    )
    both = counted.join(known, "_one", "left")
    return both.select(
        "run_id",
        "generated_at",
        F.coalesce("review_only_categories", told["review_only_categories"]).alias("review_only_categories"),
        "concentration_factor",
        F.coalesce("accepted_images", "_review").alias("count"),
        F.coalesce("_known_clusters", "_clusters").alias("clusters"),
        F.coalesce("review_queue_items", "_review").alias("review_queue_count"),
        F.coalesce("suggestion_items", "_images").alias("suggestion_count"),
        F.coalesce("suggested_category_slots", "_slots").alias("suggested_slots"),
    )


def latest_run(runs: DataFrame) -> DataFrame:
    """Rows of the greatest run_id; prunes partitions when runs are partitioned."""
    last = runs.agg(F.max("run_id")).first()[0]
    return runs.where(F.col("run_id") == F.lit(last)) if last is not None else runs


def funnel(counts: DataFrame, not_run: Sequence[str] = ()) -> DataFrame:
    """Each step against the one before: counts, conversion and drop in percent.

    The window runs over one row per step. Steps named in ``not_run`` have no
    conversion, neither has a step after an empty one.
    """
    order = Window.orderBy("step_ord")
    rows = counts.select(
        F.lag("step").over(order).alias("from_step"),
        F.col("step").alias("to_step"),
        F.lag("n").over(order).alias("from_count"),
        F.col("n").alias("to_count"),
    ).where(F.col("from_step").isNotNull())
    conversion = C.ratio(F.col("to_count") * 100, F.col("from_count"))
    if not_run:
        conversion = F.when(~F.col("to_step").isin(*not_run), conversion)
    return rows.withColumn("conversion_pct", conversion).withColumn(
        "drop_pct", 100.0 - F.col("conversion_pct")
    )


def anomalies(funnel_rows: DataFrame, rates: DataFrame) -> DataFrame:
    """Alarms: low retention between steps, high rejection, high removal.

    ``rates`` holds step (``filter`` or ``dedup``), kept and removed.
    """
    low = funnel_rows.where(F.col("conversion_pct") < MIN_RETENTION).select(
        F.lit("high").alias("severity"),
        F.lit("retention").alias("rule"),
        F.col("to_step").alias("step"),
        F.col("conversion_pct").alias("rate"),
    )
    lost = rates.withColumn(
        "rate", C.ratio(F.col("removed") * 100, F.col("kept") + F.col("removed"))
    )
    high = lost.where(
        ((F.col("step") == "filter") & (F.col("rate") > MAX_REJECTION))
        | ((F.col("step") == "dedup") & (F.col("rate") > MAX_REMOVAL))
    ).select(
        F.when(F.col("step") == "filter", "high").otherwise("warn").alias("severity"),
        F.when(F.col("step") == "filter", "rejection").otherwise("removal").alias("rule"),
        "step",
        "rate",
    )
    return low.unionByName(high)


def anomaly_text(alarms: DataFrame) -> DataFrame:
    """Alarms with a sentence for display."""
    return alarms.withColumn(
        "message",
        F.format_string(
            "%s: %s rate is %.1f%%", C.title_words(F.col("step")), F.col("rule"), F.col("rate")
        ),
    )


@dataclass(frozen=True)
class Needs:
    """What a step needs: any one artifact in order, or all of them."""

    artifacts: tuple[str, ...]
    any_of: bool = False
    run_first: tuple[str, ...] = ()  # step that makes each artifact


# Prerequisites of the steps.
STEP_NEEDS: dict[str, Needs] = {
    "download": Needs(()),
    "resize": Needs(("raw",), True, ("download",)),
    "dedup": Needs(("resized", "raw"), True, ("download", "download")),
    "filter": Needs(("deduped", "resized", "raw"), True, ("download",) * 3),
    "label": Needs(("filtered", "deduped", "resized", "raw"), True, ("download",) * 4),
    "eval-sample": Needs(("labels",), False, ("label",)),
    "eval-report": Needs(("labels", "eval_sample"), False, ("eval-sample", "eval-sample")),
    "cluster-review": Needs(
        ("labels", "embeddings", "eval_sample", "eval_metrics"),
        False,
        ("label", "label", "eval-sample", "eval-report"),
    ),
}


def readiness(
    spark: SparkSession, available: DataFrame, needs: Mapping[str, Needs] = STEP_NEEDS
) -> DataFrame:
    """Per step: ready, artifact used, missing artifacts and the step to run first.

    ``available`` holds artifact and n (its row count).
    """
    wanted = spark.createDataFrame(
        [
            (i, step, need.any_of, j, artifact, need.run_first[j])
            for i, (step, need) in enumerate(needs.items())
            for j, artifact in enumerate(need.artifacts)
        ],
        "step_ord int, step string, any_of boolean, priority int, artifact string, run_first string",
    )
    every = spark.createDataFrame(
        [(i, step) for i, step in enumerate(needs)], "step_ord int, step string"
    )
    found = wanted.join(available, "artifact", "left").withColumn(
        "has", F.coalesce(F.col("n") > 0, F.lit(False))
    )
    absent = F.when(~F.col("has"), F.struct("priority", "artifact"))
    judged = found.groupBy("step").agg(
        F.when(F.first("any_of"), F.bool_or("has")).otherwise(F.bool_and("has")).alias("ready"),
        F.min_by(F.when(F.col("has"), F.col("artifact")), F.when(F.col("has"), F.col("priority"))).alias("used"),
        F.array_sort(F.collect_list(absent)).alias("_absent"),
        F.min_by(
            F.when(~F.col("has"), F.col("run_first")), F.when(~F.col("has"), F.col("priority"))
        ).alias("run_first"),
    )
    ready = F.coalesce("ready", F.lit(True))
    none = F.array().cast("array<string>")
    return every.join(judged, "step", "left").select(
        "step_ord",
        "step",
        ready.alias("ready"),
        "used",
        F.when(ready, none).otherwise(F.transform("_absent", lambda a: a["artifact"])).alias("missing"),
        F.when(~ready, F.col("run_first")).alias("run_first"),
    )


@dataclass(frozen=True)
class Browse:
    """Filters of the item browser; empty ones do not filter."""

    source: str = ""
    query: str = ""
    reason: str = ""
    failure_mode: str = ""
    decision_band: str = ""
    nearest_boundary: str = ""
    overlay: str = ""  # flagged or clean
    search: str = ""
    labels: Mapping[str, str] = field(default_factory=dict)

    def predicate(self, raw_paths: bool = False) -> Column:
        """The filters as one predicate.

        ``raw_paths`` reads source and query from the folders of ``image``, else
        the source comes from the name. Other filters use the columns of the
        margin analysis and the ``predicted`` map.
        """
        image = F.col("image")
        parts: list[Column] = []
        if self.source:
            source = F.lower(N.source_of_path(image)) if raw_paths else N.source_of_name(image)
            parts.append(source == self.source)
        if self.query:
            parts.append(N.query_of_path(image) == self.query)
        if self.reason:
            parts.append(F.col("rejection_reason") == self.reason)
        if self.failure_mode:
            parts.append(F.col("rejection_mode") == self.failure_mode)
        if self.decision_band:
            parts.append(F.col("decision_band") == self.decision_band)
        if self.nearest_boundary:
            parts.append(F.col("nearest_boundary") == self.nearest_boundary)
        if self.overlay:
            flagged = F.coalesce("flagged", F.lit(False))
            parts.append(flagged if self.overlay == "flagged" else ~flagged)
        if self.search:
            parts.append(C.contains_ci(image, self.search))
        parts += [C.lookup(F.col("predicted"), c, "") == v for c, v in self.labels.items()]
        return reduce(lambda a, b: a & b, parts, F.lit(True))


def page_size(size: int, largest: int) -> int:
    return min(largest, max(1, size))


def with_labels(listing: DataFrame, records: DataFrame, scores: bool = False) -> DataFrame:
    """Attach predicted labels, and scores for a detail view."""
    wanted = ["image", "predicted", *(["scores"] if scores else [])]
    return listing.join(records.select(*wanted), "image", "left")


def top_review(review: DataFrame, n: int = TOP_REVIEW) -> DataFrame:
    return review.orderBy(F.col("priority_score").desc(), "image").limit(n)


def top_clusters(profile: DataFrame, n: int = TOP_CLUSTERS) -> DataFrame:
    return profile.orderBy(F.col("size").desc(), "cluster_id").limit(n)


def suggestion_preview(suggestions: DataFrame, n: int = TOP_SUGGESTIONS) -> DataFrame:
    return suggestions.orderBy("image", "category").limit(n)
