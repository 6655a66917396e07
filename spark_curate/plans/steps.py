"""The steps of a curation run as functions from tables to tables.

Each step returns lazy DataFrames; only what a later step reads several times is
written to the shared folder first.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spark_curate.functions import columns as C
from spark_curate.functions.session import materialize
from spark_curate.operators import (
    clustering,
    dedup,
    evaluation,
    export,
    harvest,
    images,
    labeling,
    manifest,
    monitor,
    resolution,
    review,
    scoring,
)
from spark_curate.sources import readers, writers
from spark_curate.sources import schemas as S


def harvest_step(
    queries: DataFrame,
    sources: Sequence[str],
    stored_paths: DataFrame,
    pages: DataFrame,
    limit: int,
    rules: harvest.LinkRules = harvest.LinkRules(),
    feeds: DataFrame | None = None,
    search_pages: DataFrame | None = None,
    responses: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Work left to fetch and the candidate urls for it.

    ``pages`` holds fetched result pages: page_id, query, url, html. ``feeds`` (query,
    body) are public feeds, page 0 of a search, and ``search_pages`` (query, page, body)
    the pages after it; their static-host photos are gathered until 1.4 times the limit.
    ``responses`` (query, ord, url, content_type, content) are what was fetched; the
    first usable ones up to the limit are admitted under the name of their source.
    """
    existing = harvest.existing_counts(stored_paths)
    work = harvest.pending_work(queries, sources, existing, limit)
    links = harvest.page_links(pages, rules)
    by_query = links.join(pages.select("page_id", "query"), "page_id").select(
        "query", F.struct("page_id", "ord").alias("ord"), "url"
    )
    wanted = harvest.first_seen(by_query).join(work.select("query").distinct(), "query", "left_semi")
    outcome = {
        "work": work,
        "links": harvest.quota(wanted, int(limit * harvest.OVERFETCH_PAGES)),
        "totals": harvest.download_totals(existing, "n"),
    }
    if feeds is not None and search_pages is not None:
        outcome["search_links"] = harvest.searched_links(
            feeds.join(work.select("query").distinct(), "query", "left_semi"),
            search_pages.join(work.select("query").distinct(), "query", "left_semi"),
            int(limit * harvest.OVERFETCH_SEARCH),
        )
    if responses is not None:
        outcome["admitted"] = harvest.admitted_responses(responses, sources[0], limit)
    return outcome


def resize_step(
    decoded: DataFrame, existing: DataFrame | None = None, **sizes
) -> dict[str, DataFrame]:
    """Status per raw image, counts, resized pixels and colliding names."""
    step = resolution.resolution_step(
        decoded.select("path", "width", "height"), existing=existing, **sizes
    )
    return {
        "status": step,
        "counts": resolution.resolution_counts(step),
        "pixels": images.resized_images(images.to_rgb(decoded), **sizes),
        "collisions": resolution.name_collisions(decoded),
    }


def dedup_step(
    items: DataFrame, threshold: int = 10, order: str = "image", **limits: int
) -> dict[str, DataFrame]:
    """Survivors, removed items and their groups.

    ``items`` holds image, phash and the order column. For decoded images take
    the hashes from :func:`spark_curate.operators.images.perceptual_hashes`.
    """
    dups = materialize(dedup.find_duplicates(items, threshold, order, **limits))
    return {
        "survivors": dedup.survivors(items, dups),
        "duplicates": dups,
        "groups": dedup.duplicate_groups(dups),
        "counts": dedup.dedup_counts(items, dups),
        "updates": manifest.dedup_updates(items, dups),
    }


def filter_step(
    items: DataFrame,
    prompts: DataFrame,
    thresholds: scoring.Thresholds = scoring.CONFIGURED,
    existing: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Decisions, kept items, counts and margin analysis; vectors are read once."""
    scores = scoring.group_scores(items.select("image", "embedding"), prompts)
    decisions = materialize(scoring.filter_decisions(scores, thresholds, existing))
    return {
        "decisions": decisions,
        "kept": decisions.where("kept").select("image"),
        "counts": scoring.decision_counts(decisions),
        "margins": scoring.margin_analysis(decisions, thresholds),
        "updates": manifest.filter_updates(decisions),
    }


def label_step(
    items: DataFrame,
    prompts: DataFrame,
    kept: DataFrame | None = None,
    existing: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Label records of the kept items, reusing existing ones."""
    chosen = items if kept is None else labeling.keep_only(items, kept)
    records = (
        labeling.label_records(chosen, prompts)
        if existing is None
        else labeling.resume_labels(chosen, prompts, existing)
    )
    records = materialize(records)
    return {
        "records": records,
        "embeddings": labeling.labelled_embeddings(records, items.select("image", "embedding")),
        "distribution": labeling.label_distribution(labeling.predicted_long(records)),
        "updates": manifest.label_updates(records),
    }


def export_step(
    records: DataFrame,
    categories: Sequence[str],
    corrections: DataFrame | None = None,
    places: Sequence[DataFrame] = (),
    prefix: str = "item",
) -> dict[str, DataFrame]:
    """Renamed clean table, full table, distribution and where each file is."""
    labels = writers.wide_labels(records, categories)
    if corrections is not None:
        labels = export.apply_corrections(labels, corrections, categories).drop("corrected")
    named = export.export_names(labels, prefix=prefix)
    clean = export.clean_table(named, categories)
    out = {
        "clean": clean,
        "full": labels,
        "distribution": export.distribution(clean, categories),
    }
    if places:
        found = export.first_locations(*places)
        out["files"] = named.select("image", "new_name").join(found, "image", "left")
    return out


def evaluation_step(sample: DataFrame, categories: Sequence[str]) -> dict[str, DataFrame]:
    """All metric and report tables of an annotated sample."""
    stored = materialize(sample)
    if stored.where((F.col("source") == "accepted") & evaluation.is_annotated()).isEmpty():
        raise ValueError("no annotated accepted samples")
    return evaluation.report_tables(stored, categories)


@dataclass(frozen=True)
class ReviewRun:
    """Tables of one cluster-review run."""

    run_id: str
    k: int
    tables: dict[str, DataFrame]
    unchanged: bool


def cluster_review(
    records: DataFrame,
    embeddings: DataFrame,
    sample: DataFrame,
    accuracy: DataFrame,
    categories: Sequence[str],
    clusters: clustering.ClusterSettings = clustering.ClusterSettings(),
    settings: review.ReviewSettings = review.ReviewSettings(),
    max_images: int = 0,
) -> ReviewRun:
    """Cluster labelled items and build the review queue and suggestions.

    ``records`` holds image, predicted and scores; nothing is changed in it, which
    a fingerprint before and after proves.
    """
    spark = records.sparkSession
    first_print = review.fingerprint(records).first()
    margins = F.transform_values("scores", lambda _, r: labeling.margin(r))
    every = F.map_from_arrays(
        F.array(*[F.lit(c) for c in categories]),
        F.array(*[C.lookup(F.col("predicted"), c, C.UNKNOWN) for c in categories]),
    )
    chosen = materialize(
        review.first_records(
            records.select("image", every.alias("predicted"), margins.alias("margins")), max_images
        )
    )
    vectors = materialize(
        clustering.check_embeddings(chosen, embeddings.select("image", "embedding"))
    )
    if vectors.limit(3).count() < 3:
        raise ValueError("need at least 3 labelled items to cluster")
    seeds = materialize(
        review.annotation_seeds(sample, chosen, categories).join(vectors, "image")
    )
    n_seeds = review.require_seeds(seeds, settings)
    weights = {
        r["category"]: (r["weight"], r["review_only"])
        for r in review.category_weights(accuracy, categories).collect()
    }
    features = clustering.reduce_dimensions(vectors, clusters)
    k, model, candidates = clustering.select_best_k(features, clusters)
    assigned = materialize(clustering.assign(features, model))
    profile = materialize(
        review.cluster_profile(assigned, seeds, settings.outlier_quantile_max)
    )
    long = labeling.predicted_long(chosen, categories)
    consensus = materialize(
        review.cluster_consensus(long.join(assigned.select("image", "cluster_id"), "image"))
    )
    votes = review.seed_votes(vectors, seeds, categories, settings.knn_k)
    queue = materialize(
        review.review_queue(chosen, assigned, votes, consensus, profile, weights, settings)
    )
    tables = {
        "clusters": profile,
        "consensus": consensus,
        "exemplars": review.exemplars(assigned),
        "assignments": review.assignments(assigned, profile, seeds),
        "suggestions": review.suggestions(queue),
        "review_queue": review.ranked(queue),
        "k_selection": candidates,
        "concentration": review.priority_concentration(queue),
        "summary": review.run_counts(queue, profile, n_seeds),
    }
    run_id = spark.range(1).select(C.run_id()).first()[0]
    same = review.fingerprint(records).first() == first_print
    return ReviewRun(run_id, k, tables, same)


def run_all(
    items: DataFrame,
    group_prompts: DataFrame,
    label_prompts: DataFrame,
    threshold: int = 10,
    thresholds: scoring.Thresholds = scoring.CONFIGURED,
    skip: Sequence[str] = (),
) -> dict[str, Mapping[str, DataFrame]]:
    """Dedup, filter and label in order; steps named in ``skip`` are left out.

    ``items`` holds image, phash and embedding: each vector is made once and read
    by every step.
    """
    out: dict[str, Mapping[str, DataFrame]] = {}
    current, kept = items, None
    if "dedup" not in skip:
        out["dedup"] = dedup_step(items, threshold)
        current = materialize(out["dedup"]["survivors"])
    if "filter" not in skip:
        out["filter"] = filter_step(current, group_prompts, thresholds)
        kept = out["filter"]["kept"]
    if "label" not in skip:
        out["label"] = label_step(current, label_prompts, kept)
    return out


def record_run(spark: SparkSession, outcome: Mapping[str, Mapping[str, DataFrame]], path: str) -> DataFrame:
    """Merge the outcome of the steps into the manifest and save a new version."""
    state = readers.manifest(spark, path)
    for step in manifest.STEPS:
        if step in outcome:
            state = manifest.upsert(state, step, outcome[step]["updates"])
    version = spark.range(1).select(C.run_id()).first()[0]
    writers.save_manifest(state, path, version)
    return spark.read.schema(S.MANIFEST).parquet(f"{path}/version={version}")


def dashboard(
    outcome: Mapping[str, Mapping[str, DataFrame]], raw: DataFrame, resized: DataFrame
) -> dict[str, DataFrame]:
    """Funnel, alarms and per-source statistics of a run."""
    kept = outcome["filter"]["decisions"].where("kept")
    steps = {
        "download": raw,
        "resize": resized,
        "dedup": outcome["dedup"]["survivors"],
        "filter": kept,
        "label": outcome["label"]["records"],
    }
    rows = monitor.funnel(materialize(monitor.step_counts(steps)))
    rates = outcome["filter"]["decisions"].agg(
        F.lit("filter").alias("step"),
        F.count_if("kept").alias("kept"),
        F.count_if(~F.col("kept")).alias("removed"),
    ).unionByName(outcome["dedup"]["counts"].select(F.lit("dedup").alias("step"), "kept", "removed"))
    return {
        "funnel": rows,
        "anomalies": monitor.anomaly_text(monitor.anomalies(rows, rates)),
        "filter_sources": monitor.filter_stats(outcome["filter"]["decisions"]),
    }
