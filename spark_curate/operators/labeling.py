"""Zero-shot multi-category labelling from prompt ensembles."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spark_curate.functions import columns as C
from spark_curate.functions import vectors as V
from spark_curate.functions.session import materialize
from spark_curate.operators.scoring import group_vectors, vector_blocks

LABEL_KEYS = ("category", "label", "label_ord")


def label_vectors(prompts: DataFrame) -> DataFrame:
    """Ensemble vector of every (category, label), averaged over its prompts."""
    return group_vectors(prompts, LABEL_KEYS)


def keep_only(items: DataFrame, kept: DataFrame) -> DataFrame:
    """Restrict labelling to kept names; an empty kept table keeps nothing."""
    return items.join(kept.select("image"), "image", "left_semi")


def label_scores(
    items: DataFrame,
    prompts: DataFrame,
    embedding: str = "embedding",
    max_bytes: int = V.MAX_BLOCK_BYTES,
) -> DataFrame:
    """Long scores: image, category, label, label_ord, score.

    One pass over the items without a shuffle. A prompt table beyond
    ``max_bytes`` is taken block by block and the scores are united.
    """
    present = items.where(F.col(embedding).isNotNull())
    blocks = vector_blocks(label_vectors(prompts), "vector", ("category", "label_ord", "label"), max_bytes)
    first = next(blocks)
    if not first:
        raise ValueError("no label prompts")
    parts = [_block_scores(present, first, embedding)]
    for block in blocks:  # what a block gives is written before the next is fetched
        parts[-1] = materialize(parts[-1])
        parts.append(_block_scores(present, block, embedding))
    return reduce(DataFrame.unionByName, parts)


def _block_scores(items: DataFrame, block: Sequence, embedding: str) -> DataFrame:
    keys = F.array(
        *[
            F.struct(
                F.lit(r["category"]).alias("category"),
                F.lit(r["label"]).alias("label"),
                F.lit(r["label_ord"]).alias("label_ord"),
            )
            for r in block
        ]
    )
    scored = items.select(
        "image", V.products(F.col(embedding), [r["vector"] for r in block]).alias("_scores")
    )
    return C.unnest_at(scored, ["image"], F.col("_scores"), "_i", "score").select(
        "image",
        *[keys[F.col("_i")][k].alias(k) for k in LABEL_KEYS],
        "score",
    )


def label_records(
    items: DataFrame,
    prompts: DataFrame,
    embedding: str = "embedding",
    digits: int = 4,
    max_bytes: int = V.MAX_BLOCK_BYTES,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Nested label records: image, predicted, scores, and the columns to ``keep``.

    ``predicted`` maps category to label; ``scores`` maps category to assigned,
    confidence, all_scores, runner_up and runner_up_score. Scores are rounded
    before ranking and ties go to the label declared first.
    """
    rows, _ = V.bounded_rows(label_vectors(prompts), "vector", max_bytes)
    if rows == []:
        raise ValueError("no label prompts")
    if rows is None:
        records = _records_from_long(label_scores(items, prompts, embedding, max_bytes), digits)
        return records.join(items.select("image", *keep), "image") if keep else records
    rows = sorted(rows, key=lambda r: (r["category"], r["label_ord"], r["label"]))
    by_category: dict[str, list[int]] = {}
    for i, row in enumerate(rows):
        by_category.setdefault(row["category"], []).append(i)
    scored = items.where(F.col(embedding).isNotNull()).select(
        "image", *keep, V.products(F.col(embedding), [r["vector"] for r in rows]).alias("_scores")
    )
    ranked = scored.select(
        "image",
        *keep,
        *[
            _ranked(F.slice("_scores", places[0] + 1, len(places)), rows, places, digits).alias(cat)
            for cat, places in by_category.items()
        ],
    )
    return _nest(ranked, list(by_category), keep)


def _ranked(scores: Column, rows: Sequence, places: Sequence[int], digits: int) -> Column:
    """Entries of one category, best first; the sort key ends in the label order."""
    names = F.array(*[F.lit(rows[i]["label"]) for i in places])
    orders = F.array(*[F.lit(rows[i]["label_ord"]) for i in places])
    return F.array_sort(
        F.transform(scores, lambda s, i: _entry(F.round(s, digits), orders[i], names[i]))
    )


def _entry(score: Column, label_ord: Column, label: Column) -> Column:
    return F.struct(
        (-score).alias("key"), label_ord.alias("ord"), label.alias("label"), score.alias("score")
    )


def _record(entries: Column) -> Column:
    """Label record of one category from its ranked entries."""
    best, second = F.try_element_at(entries, F.lit(1)), F.try_element_at(entries, F.lit(2))
    return F.struct(
        best["label"].alias("assigned"),
        best["score"].alias("confidence"),
        F.map_from_arrays(
            F.transform(entries, lambda e: e["label"]), F.transform(entries, lambda e: e["score"])
        ).alias("all_scores"),
        second["label"].alias("runner_up"),
        second["score"].alias("runner_up_score"),
    )


def _nest(ranked: DataFrame, categories: Sequence[str], keep: Sequence[str]) -> DataFrame:
    return ranked.select(
        "image",
        *keep,
        C.map_from_columns((c, F.col(f"`{c}`")[0]["label"]) for c in categories).alias("predicted"),
        C.map_from_columns((c, _record(F.col(f"`{c}`"))) for c in categories).alias("scores"),
    )


def _records_from_long(scores: DataFrame, digits: int) -> DataFrame:
    """Records from long scores: each image's entries are bounded by the prompts."""
    entry = _entry(F.round("score", digits), F.col("label_ord"), F.col("label"))
    per_category = scores.groupBy("image", "category").agg(
        F.array_sort(F.collect_list(entry)).alias("entries")
    )
    return (
        per_category.select("image", "category", _record(F.col("entries")).alias("record"))
        .groupBy("image")
        .agg(F.map_from_entries(F.collect_list(F.struct("category", "record"))).alias("scores"))
        .select("image", F.transform_values("scores", lambda _, v: v["assigned"]).alias("predicted"), "scores")
    )


def rank_labels(scores: DataFrame, digits: int = 4) -> DataFrame:
    """Assigned label and runner-up per (image, category) of any long score table."""
    order = Window.partitionBy("image", "category").orderBy(
        F.col("_rounded").desc(), "label_ord", "label"
    )
    top = (
        scores.withColumn("_rounded", F.round("score", digits))
        .withColumn("_rank", F.row_number().over(order))
        .where(F.col("_rank") <= 2)
    )

    def at(rank: int, column: str) -> Column:
        return F.max(F.when(F.col("_rank") == rank, F.col(column)))

    return top.groupBy("image", "category").agg(
        at(1, "label").alias("assigned"),
        at(1, "_rounded").alias("confidence"),
        at(2, "label").alias("runner_up"),
        at(2, "_rounded").alias("runner_up_score"),
    )


def labels_long(records: DataFrame) -> DataFrame:
    """One row per (image, category) of nested label records."""
    return C.unnest(records, ["image"], F.col("scores"), "category", "_r").select(
        "image",
        "category",
        "_r.assigned",
        "_r.confidence",
        "_r.runner_up",
        "_r.runner_up_score",
    )


def margin(record: Column) -> Column:
    """Confidence minus runner-up score; null if either is missing or no number."""
    return C.tolerant_double(record["confidence"]) - C.tolerant_double(record["runner_up_score"])


def margins(records: DataFrame) -> DataFrame:
    """Margin per (image, category)."""
    return labels_long(records).select(
        "image",
        "category",
        (C.tolerant_double(F.col("confidence")) - C.tolerant_double(F.col("runner_up_score"))).alias(
            "margin"
        ),
    )


def score_shares(records: DataFrame) -> DataFrame:
    """Every label's score relative to the best of its category; 0 if none is positive."""
    rows = C.unnest(records, ["image"], F.col("scores"), "category", "_r")
    best = F.array_max(F.map_values("_r.all_scores")).alias("_max")
    exploded = C.unnest(rows, ["image", "category", best], F.col("_r.all_scores"), "label", "score")
    return exploded.select(
        "image",
        "category",
        "label",
        "score",
        F.when(F.col("_max") > 0, F.col("score") / F.col("_max")).otherwise(0.0).alias("share"),
    )


def score_list(records: DataFrame) -> DataFrame:
    """All scores of each item and category, best first: image, category, entries.

    ``entries`` holds label, score and the share of the best score; equal scores come in
    the order of their labels. Sorted inside the row.
    """
    ranked = lambda m: F.array_sort(
        F.transform(F.map_entries(m), lambda e: F.struct((-e["value"]).alias("key"), e["key"].alias("label")))
    )
    best = lambda entries: F.greatest(-F.try_element_at(entries, F.lit(1))["key"], F.lit(0.0))
    listed = C.unnest(records, ["image"], F.col("scores"), "category", "_s").select(
        "image", "category", ranked(F.col("_s.all_scores")).alias("_e")
    )
    entries = F.transform(
        "_e",
        lambda e: F.struct(
            e["label"].alias("label"),
            (-e["key"]).alias("score"),
            F.coalesce(F.try_divide(-e["key"], best(F.col("_e"))), F.lit(0.0)).alias("share"),
        ),
    )
    return listed.select("image", "category", entries.alias("entries"))


def predicted_long(records: DataFrame, categories: Sequence[str] | None = None) -> DataFrame:
    """(image, category, label) rows; missing categories read ``unknown``."""
    if categories is None:
        return C.unnest(records, ["image"], F.col("predicted"), "category", "label")
    pairs = C.map_from_columns((c, C.lookup(F.col("predicted"), c, C.UNKNOWN)) for c in categories)
    return C.unnest(records, ["image"], pairs, "category", "label")


def label_distribution(labels: DataFrame) -> DataFrame:
    """Count and percent of each label within its category, most common first."""
    counts = labels.groupBy("category", "label").agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy("category"))
    return counts.select(
        "category", "label", "n", (F.col("n") / total * 100).alias("percent")
    ).orderBy("category", F.col("n").desc(), "label")


def missing_labels(items: DataFrame, existing: DataFrame) -> DataFrame:
    """Items without a label row yet."""
    return items.join(existing.select("image"), "image", "left_anti")


def resume_labels(
    items: DataFrame, prompts: DataFrame, existing: DataFrame, embedding: str = "embedding"
) -> DataFrame:
    """Existing records plus records for the items that have none."""
    fresh = label_records(missing_labels(items, existing), prompts, embedding)
    return existing.select("image", "predicted", "scores").unionByName(fresh)


def resume_embeddings(items: DataFrame, cached: DataFrame, encode) -> DataFrame:
    """Cached vectors plus ``encode`` applied to the items that have none."""
    absent = items.join(cached.select("image"), "image", "left_anti")
    return cached.select("image", "embedding").unionByName(
        encode(absent).select("image", "embedding")
    )


def labelled_embeddings(records: DataFrame, embeddings: DataFrame) -> DataFrame:
    """Vectors of labelled images only, as persisted next to the labels."""
    return embeddings.join(records.select("image"), "image", "left_semi")

