"""Seed votes, cluster consensus, review queue and conservative suggestions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spark_curate.functions import columns as C
from spark_curate.functions import vectors as V
from spark_curate.functions.session import materialize
from spark_curate.operators.evaluation import is_confirmed
from spark_curate.operators.scoring import vector_blocks
from spark_curate.operators.sequence import exact_quantiles, global_sequence

# Weights of the risk terms.
RISK_REVIEW_ONLY = 1.0
RISK_PRED_CLUSTER = 0.65
RISK_PRED_SEED = 0.85
RISK_CLUSTER_SEED = 0.75
RISK_NO_MARGIN = 0.20
RISK_LOW_MARGIN, RISK_LOW_MARGIN_MOST = 0.35, 1.2
RISK_OUTLIER, RISK_OUTLIER_MOST = 0.90, 1.5

# Category reliability.
DEFAULT_ACCURACY = 0.70
REVIEW_ONLY_BELOW = 0.60

# Share and least size of the top slice, factor aimed at.
TOP_SHARE, TOP_LEAST, TARGET_FACTOR = 0.10, 10, 1.5

# Smallest seed count, exemplars listed per cluster.
MIN_SEEDS, EXEMPLARS = 10, 5

TIE_DIGITS = 9
#: Seeds that serve as pivots, and the room left for rounding in their bounds.
PIVOTS, REACH_SLACK = 64, 1e-7
SMALL_TABLE_ROWS = 100_000


@dataclass(frozen=True)
class ReviewSettings:
    """Limits of the suggestion gate and of the risk terms."""

    knn_k: int = 7
    vote_ratio_min: float = 0.80
    similarity_min: float = 0.28
    margin_min: float = 0.03
    outlier_quantile_max: float = 0.90
    min_seed_count: int = MIN_SEEDS

    def __post_init__(self) -> None:
        if not 0.0 < self.vote_ratio_min <= 1.0:
            raise ValueError("vote_ratio_min must be in (0, 1]")
        if not 0.0 <= self.outlier_quantile_max < 1.0:
            raise ValueError("outlier_quantile_max must be in [0, 1)")


def small(df: DataFrame, most: int = SMALL_TABLE_ROWS) -> DataFrame:
    """Broadcast a table of at most ``most`` rows; leave a larger one to shuffle."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


# Seeds and votes


def annotation_seeds(sample: DataFrame, known: DataFrame, categories: Sequence[str]) -> DataFrame:
    """(image, truth) of accepted target samples with every category filled in."""

    def value(category: str) -> Column:
        return F.trim(F.coalesce(C.lookup(F.col("ground_truth"), category), F.lit("")))

    complete = reduce(lambda a, b: a & b, (value(c) != "" for c in categories))
    chosen = sample.where((F.col("source") == "accepted") & is_confirmed() & complete)
    return chosen.join(known.select("image"), "image", "left_semi").select(
        "image", C.map_from_columns((c, value(c)) for c in categories).alias("truth")
    )


def require_seeds(seeds: DataFrame, settings: ReviewSettings) -> int:
    """Number of seeds, or an error if there are too few."""
    need, have = max(settings.knn_k, settings.min_seed_count), seeds.count()
    if have < need:
        raise ValueError(f"found {have} annotation seeds, need at least {need}; annotate more")
    return have


def _nearest(similarity: np.ndarray, k: int) -> np.ndarray:
    """Column indices of the k largest per row; equal values in column order."""
    if similarity.shape[1] <= k:
        return np.argsort(-similarity, axis=1, kind="stable")
    part = np.sort(np.argpartition(-similarity, k - 1, axis=1)[:, :k], axis=1)
    values = np.take_along_axis(similarity, part, axis=1)
    order = np.argsort(-values, axis=1, kind="stable")
    nearest = np.take_along_axis(part, order, axis=1)
    tied = (similarity >= values.min(axis=1)[:, None]).sum(axis=1) > k
    nearest[tied] = np.argsort(-similarity[tied], axis=1, kind="stable")[:, :k]
    return nearest


@dataclass(frozen=True)
class Reach:
    """What lies between pivots and the seeds of a block.

    ``near`` and ``far`` are the least and the largest distance of a seed of the block
    to each pivot, ``longest`` the largest length of one. Pivots are seeds themselves.
    """

    pivots: np.ndarray
    near: np.ndarray
    far: np.ndarray
    longest: float

    def may_enter(self, x: np.ndarray, k: int) -> np.ndarray:
        """Which rows a seed of the block can be among the ``k`` nearest of.

        The k-th best pivot is a bar that the k-th best seed reaches. By the triangle
        inequality a seed is at least as far from a row as the row's distance to a
        pivot lies outside the block's distances to it; so its product is bounded.
        """
        if len(self.pivots) < k:
            return np.ones(len(x), bool)
        products = x @ self.pivots.T
        length = (x * x).sum(axis=1)
        bar = np.partition(products, -k, axis=1)[:, -k]
        squares = length[:, None] + (self.pivots**2).sum(axis=1) - 2 * products
        apart = np.sqrt(np.maximum(squares, 0))
        gap = np.maximum(0, np.maximum(self.near - apart, apart - self.far)).max(axis=1)
        most = np.minimum((length + self.longest**2 - gap**2) / 2, np.sqrt(length) * self.longest)
        return most >= bar - REACH_SLACK * (1 + np.abs(bar))


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    squares = (x * x).sum(axis=1)[:, None] + (pivots**2).sum(axis=1) - 2 * x @ pivots.T
    return np.sqrt(np.maximum(squares, 0))


def reach_of(matrix: np.ndarray, pivots: np.ndarray) -> Reach:
    """The reach of a block of seeds."""
    apart = _distances(matrix, pivots)
    return Reach(pivots, apart.min(axis=0), apart.max(axis=0), float(np.sqrt((matrix**2).sum(axis=1)).max()))


def _block_neighbours(items: DataFrame, block: Sequence, k: int, pivots: np.ndarray | None = None) -> DataFrame:
    block = sorted(block, key=lambda r: r["image"])
    names = np.asarray([r["image"] for r in block], dtype=object)
    matrix = np.asarray([r["embedding"] for r in block], dtype=np.float64)
    reach = None if pivots is None else reach_of(matrix, pivots)

    @F.arrow_udf("array<struct<seed:string,similarity:double>>")
    def top(column: pa.Array) -> pa.Array:
        valid, x = V.batch_matrix(column, matrix.shape[1])
        asked = np.ones(len(x), bool) if reach is None else reach.may_enter(x, k)
        similarity = np.round(x[asked] @ matrix.T, TIE_DIGITS)
        at = _nearest(similarity, k)
        values = np.take_along_axis(similarity, at, axis=1)
        width = at.shape[1]
        sizes = np.zeros(len(column), np.int64)
        sizes[valid] = np.where(asked, width, 0)
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        entries = pa.StructArray.from_arrays(
            [pa.array(names[at.reshape(-1)], pa.string()), pa.array(values.reshape(-1))],
            names=["seed", "similarity"],
        )
        return pa.ListArray.from_arrays(pa.array(offsets), entries, mask=pa.array(~valid))

    return items.select("image", top("embedding").alias("near"))


def nearest_seeds(
    items: DataFrame, seeds: DataFrame, k: int, max_bytes: int = V.MAX_BLOCK_BYTES
) -> DataFrame:
    """k nearest seeds by dot product: image, seed, similarity, rank.

    Similarities are rounded to ``TIE_DIGITS``, beyond which they are noise; ties go
    to the seed with the smaller name. An item that is a seed may be its own neighbour.

    Seeds beyond a block are ordered by the nearest of ``PIVOTS`` of them, so that a
    block holds seeds that lie together, and taken block by block; the driver holds one
    block. Items that no seed of a block can matter to skip it (:class:`Reach`), and
    only each block's best k of the others are shuffled. Without seeds there are no rows.
    """
    slim = seeds.select("image", "embedding")
    whole, _ = V.bounded_rows(slim, "embedding", max_bytes)
    if whole == []:
        return items.where(F.lit(False)).select(
            "image",
            F.lit(None).cast("string").alias("seed"),
            F.lit(None).cast("double").alias("similarity"),
            F.lit(None).cast("int").alias("rank"),
        )
    if whole is not None:
        best = _block_neighbours(items, whole, k)
    else:
        slim = materialize(slim)
        chosen = slim.orderBy(F.xxhash64("image"), "image").limit(PIVOTS).collect()
        pivots = np.asarray([r["embedding"] for r in chosen], dtype=np.float64)

        @F.arrow_udf("int")
        def cell(column: pa.Array) -> pa.Array:
            _, x = V.batch_matrix(column, pivots.shape[1])
            return pa.array(_distances(x, pivots).argmin(axis=1).astype(np.int32))

        placed = slim.select("image", "embedding", cell("embedding").alias("_cell"))
        parts = []
        for block in vector_blocks(placed, "embedding", ("_cell", "image"), max_bytes):
            parts.append(materialize(_block_neighbours(items, block, k, pivots)))
        united = reduce(DataFrame.unionByName, parts)
        entry = F.struct((-F.col("e.similarity")).alias("key"), F.col("e.seed").alias("seed"))
        best = (
            united.select("image", F.explode("near").alias("e"))
            .groupBy("image")
            .agg(F.slice(F.array_sort(F.collect_list(entry)), 1, k).alias("_n"))
            .select(
                "image",
                F.transform(
                    "_n", lambda e: F.struct(e["seed"].alias("seed"), (-e["key"]).alias("similarity"))
                ).alias("near"),
            )
        )
    return C.unnest_at(best, ["image"], F.col("near"), "_r", "_e").select(
        "image", "_e.seed", "_e.similarity", (F.col("_r") + 1).alias("rank")
    )


_SUGGESTION = (
    "struct<category:string,label:string,confidence:double,cluster_ratio:double,"
    "seed_ratio:double,seed_similarity:double,margin:double>"
)
_VOTE = "struct<label:string,ratio:double,similarity:double,support:bigint>"


NO_VOTES = f"map<string,{_VOTE}>"


def votes_from_neighbours(
    neighbours: DataFrame, seeds: DataFrame, voters: int, categories: Sequence[str]
) -> DataFrame:
    """(image, votes): per category the modal label of the given neighbours.

    Ratio is over all ``voters``, similarity the mean over the winner's seeds;
    ties go to the label of the nearest seed. Blank labels do not vote.
    """
    truth = (
        seeds.select(F.col("image").alias("seed"), F.explode("truth").alias("category", "label"))
        .where(F.col("category").isin(*categories))
        .where(F.col("label") != "")
    )
    counted = (
        neighbours.join(truth, "seed")
        .groupBy("image", "category", "label")
        .agg(
            F.count("*").alias("support"),
            F.avg("similarity").alias("similarity"),
            F.min("rank").alias("_first"),
        )
    )
    vote = F.struct(
        "label",
        F.round(F.col("support") / voters, 6).alias("ratio"),
        F.round("similarity", 6).alias("similarity"),
        "support",
    )
    winner = F.min_by(vote, F.struct(-F.col("support"), "_first"))
    return (
        counted.groupBy("image", "category")
        .agg(winner.alias("vote"))
        .groupBy("image")
        .agg(F.map_from_entries(F.collect_list(F.struct("category", "vote"))).alias("votes"))
    )


def seed_votes(
    items: DataFrame,
    seeds: DataFrame,
    categories: Sequence[str],
    k: int,
    max_bytes: int = V.MAX_BLOCK_BYTES,
) -> DataFrame:
    """(image, votes) from the k nearest seeds (columns image, embedding, truth).

    Seeds within ``max_bytes`` vote inside one Arrow pass without any shuffle;
    more seeds go through :func:`nearest_seeds` and give the same votes. Only the given
    categories vote; an item without votes has an empty map.
    """
    rows, _ = V.bounded_rows(seeds.select("image", "embedding", "truth"), "embedding", max_bytes)
    if rows == []:
        return items.select("image", F.create_map().cast(NO_VOTES).alias("votes"))
    if rows is None:
        seeds = materialize(seeds)
        near = nearest_seeds(items, seeds, k, max_bytes)
        found = votes_from_neighbours(near, seeds, min(k, seeds.count()), categories)
        voted = F.coalesce("votes", F.create_map().cast(NO_VOTES))
        return items.select("image").join(found, "image", "left").select("image", voted.alias("votes"))
    rows = sorted(rows, key=lambda r: r["image"])
    matrix = np.asarray([r["embedding"] for r in rows], dtype=np.float64)
    voters = min(k, len(rows))
    words = [sorted({r["truth"][c] for r in rows if r["truth"].get(c)}) for c in categories]
    codes = [
        np.asarray([w.index(r["truth"][c]) if r["truth"].get(c) else -1 for r in rows])
        for c, w in zip(categories, words)
    ]

    @F.arrow_udf(f"array<{_VOTE}>")
    def vote(column: pa.Array) -> pa.Array:
        valid, x = V.batch_matrix(column, matrix.shape[1])
        similarity = np.round(x @ matrix.T, TIE_DIGITS)
        at = _nearest(similarity, voters)
        near = np.take_along_axis(similarity, at, axis=1)
        labels, supports, means = [], [], []
        for word, code in zip(words, codes):
            cast = code[at]
            same = (cast[:, :, None] == cast[:, None, :]) & (cast[:, None, :] >= 0)
            count = same.sum(axis=2)
            first = count.argmax(axis=1)
            row = np.arange(len(x))
            support = count[row, first]
            mean = (same[row, first] * near).sum(axis=1) / np.maximum(support, 1)
            names = np.asarray([*word, None], dtype=object)
            labels.append(names[np.where(support > 0, cast[row, first], len(word))])
            supports.append(support)
            means.append(mean)
        support = np.stack(supports, axis=1).reshape(-1)
        entries = pa.StructArray.from_arrays(
            [
                pa.array(np.stack(labels, axis=1).reshape(-1), pa.string()),
                pa.array(support / voters),
                pa.array(np.stack(means, axis=1).reshape(-1)),
                pa.array(support.astype(np.int64)),
            ],
            names=["label", "ratio", "similarity", "support"],
        )
        offsets = np.concatenate([[0], np.cumsum(np.where(valid, len(words), 0))]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), entries, mask=pa.array(~valid))

    def rounded(entry: Column) -> Column:
        return F.when(
            entry["label"].isNotNull(),
            F.struct(
                entry["label"].alias("label"),
                F.round(entry["ratio"], 6).alias("ratio"),
                F.round(entry["similarity"], 6).alias("similarity"),
                entry["support"].alias("support"),
            ),
        )

    raw = items.select("image", vote("embedding").alias("_v"))
    votes = F.map_from_arrays(
        F.array(*[F.lit(c) for c in categories]), F.transform("_v", rounded)
    )
    given = F.map_filter(votes, lambda _, v: v.isNotNull())
    return raw.select("image", F.coalesce(given, F.create_map().cast(NO_VOTES)).alias("votes"))


def votes_long(votes: DataFrame) -> DataFrame:
    return C.unnest(votes, ["image"], F.col("votes"), "category", "_v").select(
        "image", "category", "_v.*"
    )


# Clusters


def cluster_consensus(labelled: DataFrame) -> DataFrame:
    """Modal predicted label per (cluster, category) of long labels.

    ``labelled`` holds image, cluster_id, category and label. Ties go to the label
    seen first in image order.
    """
    counts = labelled.groupBy("cluster_id", "category", "label").agg(
        F.count("*").alias("count"), F.min("image").alias("_first")
    )
    best = F.min_by(F.struct("label", "count"), F.struct(-F.col("count"), "_first"))
    return (
        counts.groupBy("cluster_id", "category")
        .agg(best.alias("_b"), F.sum("count").alias("total"))
        .select(
            "cluster_id",
            "category",
            "_b.label",
            F.round(F.col("_b.count") / F.col("total"), 6).alias("ratio"),
            "_b.count",
            "total",
        )
    )


def cluster_profile(
    assigned: DataFrame, seeds: DataFrame, outlier_quantile: float = 0.90
) -> DataFrame:
    """size, seed count and coverage, mean distance and quantiles per cluster."""
    marked = assigned.join(
        seeds.select("image", F.lit(1).alias("_seed")), "image", "left"
    )
    sizes = marked.groupBy("cluster_id").agg(
        F.count("*").alias("size"),
        F.count("_seed").alias("seed_count"),
        F.avg("distance").alias("mean_distance"),
    )
    limits = exact_quantiles(
        assigned,
        ["cluster_id"],
        "distance",
        {"p90_distance": 0.90, "outlier_threshold": outlier_quantile},
    )
    return sizes.join(limits.drop("n"), "cluster_id").select(
        "cluster_id",
        "size",
        "seed_count",
        (F.col("seed_count") / F.col("size")).alias("seed_coverage"),
        "mean_distance",
        "p90_distance",
        "outlier_threshold",
    )


def exemplar_score(distance: Column, p90: Column) -> Column:
    """1 at the centre down to 0 at the 90 % distance; 1 if that is 0."""
    return F.when(p90 <= 0, F.lit(1.0)).otherwise(C.clip(1.0 - distance / p90, 0.0, 1.0))


def exemplars(assigned: DataFrame, n: int = EXEMPLARS) -> DataFrame:
    """The n images nearest to each centre: cluster_id, rank, image, distance."""
    rank = F.row_number().over(Window.partitionBy("cluster_id").orderBy("distance", "image"))
    return (
        assigned.withColumn("rank", rank)
        .where(F.col("rank") <= n)
        .select("cluster_id", "rank", "image", "distance")
    )


def assignments(assigned: DataFrame, profile: DataFrame, seeds: DataFrame) -> DataFrame:
    """Cluster, distance, exemplar score, seed coverage and seed flag per image."""
    marked = assigned.join(
        seeds.select("image", F.lit(True).alias("is_seed")), "image", "left"
    ).join(small(profile.select("cluster_id", "p90_distance", "seed_coverage")), "cluster_id")
    return marked.select(
        "image",
        "cluster_id",
        F.round("distance", 6).alias("centroid_distance"),
        F.round(exemplar_score(F.col("distance"), F.col("p90_distance")), 6).alias("exemplar_score"),
        F.round("seed_coverage", 4).alias("seed_coverage"),
        F.coalesce("is_seed", F.lit(False)).alias("is_seed"),
    )


# Review queue


def category_weights(accuracy: DataFrame, categories: Sequence[str]) -> DataFrame:
    """Weight and review-only flag per category; a missing accuracy counts as .70."""
    every = accuracy.sparkSession.createDataFrame([(c,) for c in categories], "category string")
    value = F.coalesce("accuracy", F.lit(DEFAULT_ACCURACY))
    return every.join(accuracy.select("category", "accuracy"), "category", "left").select(
        "category",
        value.alias("accuracy"),
        (F.lit(1.0) + (F.lit(1.0) - value)).alias("weight"),
        (value < REVIEW_ONLY_BELOW).alias("review_only"),
    )


def gate_reasons(
    settings: ReviewSettings,
    review_only: Column,
    cluster_label: Column,
    cluster_ratio: Column,
    seed_label: Column,
    seed_ratio: Column,
    similarity: Column,
    margin: Column,
) -> Column:
    """Reasons that block a suggestion, as an array; empty means allowed."""
    zero = F.lit(0.0)

    def absent(label: Column) -> Column:
        return F.coalesce(label, F.lit("")) == ""

    def below(value: Column, least: float) -> Column:
        return F.coalesce(value < least, F.lit(True))

    checks = (
        ("review_only", review_only),
        ("no_cluster_consensus", absent(cluster_label)),
        ("no_seed_vote", absent(seed_label)),
        (
            "cluster_seed_disagree",
            ~absent(cluster_label) & ~absent(seed_label) & (cluster_label != seed_label),
        ),
        ("cluster_ratio_low", F.coalesce(cluster_ratio, zero) < settings.vote_ratio_min),
        ("seed_ratio_low", F.coalesce(seed_ratio, zero) < settings.vote_ratio_min),
        ("seed_similarity_low", below(similarity, settings.similarity_min)),
        ("margin_low", below(margin, settings.margin_min)),
    )
    return F.array_compact(F.array(*[F.when(failed, F.lit(name)) for name, failed in checks]))


def suggestion_confidence(
    cluster_ratio: Column, seed_ratio: Column, similarity: Column, similarity_min: float
) -> Column:
    """Bounded confidence of an allowed suggestion."""
    scaled = C.clip(
        (similarity - similarity_min) / max(1e-9, 1.0 - similarity_min), 0.0, 1.0
    )
    return 0.40 * cluster_ratio + 0.35 * seed_ratio + 0.25 * F.coalesce(scaled, F.lit(0.0))


@dataclass(frozen=True)
class _Terms:
    """What one category adds to a review item."""

    risk: Column
    flagged: Column
    reasons: Column
    suggestion: Column


def _terms(category: str, weight: float, review_only: bool, settings: ReviewSettings) -> _Terms:
    if review_only:
        return _Terms(
            F.lit(RISK_REVIEW_ONLY * weight),
            F.array(F.lit(category)),
            F.array(F.lit(f"{category}:review_only")),
            F.lit(None).cast(_SUGGESTION),
        )
    pred = C.lookup(F.col("predicted"), category, C.UNKNOWN)
    margin = C.lookup(F.col("margins"), category)
    cluster = C.lookup(F.col("consensus"), category)
    seed = C.lookup(F.col("votes"), category)
    false = F.lit(False)
    off_cluster = F.coalesce(pred != cluster["label"], false)
    off_seed = F.coalesce(pred != seed["label"], false)
    disagree = F.coalesce(cluster["label"] != seed["label"], false)
    low = F.coalesce(margin < settings.margin_min, false)
    deficit = (settings.margin_min - margin) / max(settings.margin_min, 1e-9)

    def part(condition: Column, value) -> Column:
        value = value if isinstance(value, Column) else F.lit(value * weight)
        return F.when(condition, value).otherwise(0.0)

    risk = (
        part(off_cluster, RISK_PRED_CLUSTER)
        + part(off_seed, RISK_PRED_SEED)
        + part(disagree, RISK_CLUSTER_SEED)
        + part(margin.isNull(), RISK_NO_MARGIN)
        + part(low, F.least(F.lit(RISK_LOW_MARGIN_MOST), RISK_LOW_MARGIN + deficit) * weight)
    )
    blocked = gate_reasons(
        settings, false, cluster["label"], cluster["ratio"], seed["label"], seed["ratio"],
        seed["similarity"], margin,
    )
    texts = F.array(
        F.when(off_cluster, f"{category}:pred_vs_cluster"),
        F.when(off_seed, f"{category}:pred_vs_seed"),
        F.when(disagree, f"{category}:cluster_seed_disagree"),
        F.when(margin.isNull(), f"{category}:missing_margin"),
        F.when(low, f"{category}:low_margin"),
        F.when(
            F.size(blocked) > 0,
            F.concat(F.lit(f"{category}:suggestion_blocked:"), F.array_join(blocked, "+")),
        ),
    )
    suggestion = F.when(
        F.size(blocked) == 0,
        F.struct(
            F.lit(category).alias("category"),
            cluster["label"].alias("label"),
            F.round(
                suggestion_confidence(
                    cluster["ratio"], seed["ratio"], seed["similarity"], settings.similarity_min
                ),
                4,
            ).alias("confidence"),
            F.round(cluster["ratio"], 4).alias("cluster_ratio"),
            F.round(seed["ratio"], 4).alias("seed_ratio"),
            F.round(seed["similarity"], 4).alias("seed_similarity"),
            F.round(margin, 4).alias("margin"),
        ),
    )
    flagged = F.array(F.when(off_cluster | off_seed | disagree | low, F.lit(category)))
    return _Terms(risk, F.array_compact(flagged), F.array_compact(texts), suggestion)


def signal_count(reasons: Column) -> Column:
    """Reasons that signal uncertainty; disagreement is not among them."""
    return F.size(
        F.filter(
            reasons, lambda r: r.rlike(r":pred_vs_|:low_margin|cluster:outlier|:review_only")
        )
    )


def review_queue(
    records: DataFrame,
    assigned: DataFrame,
    votes: DataFrame,
    consensus: DataFrame,
    profile: DataFrame,
    weights: Mapping[str, tuple[float, bool]],
    settings: ReviewSettings = ReviewSettings(),
) -> DataFrame:
    """Risk-ranked items with reasons, flagged categories and suggestions.

    ``records`` holds image, predicted and margins (maps); ``weights`` maps each
    category to (weight, review_only). Cluster facts are one row per cluster and
    join by broadcast when small; an item's categories are scored inside its row.
    Unordered: see :func:`ranked`.
    """
    facts = consensus.groupBy("cluster_id").agg(
        F.map_from_entries(F.collect_list(F.struct("category", F.struct("label", "ratio")))).alias(
            "consensus"
        )
    )
    cluster = profile.select(
        "cluster_id", "p90_distance", "outlier_threshold", "seed_coverage"
    ).join(facts, "cluster_id", "left")
    base = (
        records.select("image", "predicted", "margins")
        .join(assigned, "image")
        .join(votes, "image", "left")
        .join(small(cluster), "cluster_id")
    )
    terms = [_terms(c, w, only, settings) for c, (w, only) in weights.items()]
    limit, distance = F.col("outlier_threshold"), F.col("distance")
    outlier = F.coalesce((limit > 0) & (distance >= limit), F.lit(False))
    excess = (distance - limit) / F.greatest(limit, F.lit(1e-9))
    risk = reduce(lambda a, b: a + b, [t.risk for t in terms]) + F.when(
        outlier, RISK_OUTLIER + F.least(F.lit(RISK_OUTLIER_MOST), excess)
    ).otherwise(0.0)
    outlier_reason = F.array_compact(F.array(F.when(outlier, F.lit("cluster:outlier"))))
    scored = base.select(
        "image",
        "cluster_id",
        F.round(risk, 4).alias("priority_score"),
        F.round("distance", 6).alias("centroid_distance"),
        F.round(exemplar_score(distance, F.col("p90_distance")), 6).alias("exemplar_score"),
        outlier.alias("is_outlier"),
        F.round("seed_coverage", 4).alias("seed_coverage"),
        "predicted",
        F.concat(*[t.flagged for t in terms]).alias("_flagged"),
        F.concat(*[t.reasons for t in terms], outlier_reason).alias("_reasons"),
        F.array_compact(F.array(*[t.suggestion for t in terms])).alias("suggestions"),
    )
    return scored.select(
        "image",
        "cluster_id",
        "priority_score",
        "centroid_distance",
        "exemplar_score",
        "is_outlier",
        "seed_coverage",
        "predicted",
        C.sorted_set(F.col("_flagged")).alias("flagged_categories"),
        "suggestions",
        signal_count(F.col("_reasons")).alias("uncertainty_signal_count"),
        C.sorted_set(F.col("_reasons")).alias("reasons"),
    )


def ranked(review: DataFrame) -> DataFrame:
    """Review queue by falling priority, then image."""
    return review.orderBy(F.col("priority_score").desc(), "image")


def first_records(records: DataFrame, most: int) -> DataFrame:
    """The first ``most`` records by image; 0 means all."""
    return records.orderBy("image").limit(most) if most > 0 else records


def suggestions(review: DataFrame) -> DataFrame:
    """One row per suggested (image, category)."""
    rows = C.unnest_at(review, ["image", "cluster_id"], F.col("suggestions"), "_i", "_s")
    return rows.select("image", "cluster_id", "_s.*")


def uncertainty_score(reasons: Column, is_outlier: Column) -> Column:
    """Severe reasons plus outlier flag.

    A blocked suggestion that starts with a disagreement names it again and so
    counts a second time.
    """
    severe = F.filter(
        reasons, lambda r: r.rlike(r":pred_vs_|:cluster_seed_disagree|:low_margin|:review_only")
    )
    return (F.size(severe) + is_outlier.cast("int")).cast("double")


def priority_concentration(review: DataFrame) -> DataFrame:
    """Uncertainty rate of the top slice against all items, in one row."""
    scored = materialize(
        review.select(
            "image", "priority_score",
            uncertainty_score(F.col("reasons"), F.col("is_outlier")).alias("score"),
        )
    )
    n = scored.count()
    top = min(n, max(TOP_LEAST, int(TOP_SHARE * n)))
    # the score is a small whole number, so the exact quantile needs a few counts only
    threshold = scored.agg(F.percentile("score", 0.75)).first()[0]
    order = [F.col("priority_score").desc(), F.col("image")]
    numbered = global_sequence(scored, order)
    high = ((F.col("score") >= F.lit(threshold)) & (F.col("score") > 0)).cast("int")
    rates = numbered.agg(
        F.avg(high).alias("_all"),
        F.avg(F.when(F.col("seq") <= top, high)).alias("_top"),
    )
    factor = C.ratio(F.col("_top"), F.col("_all"))
    return rates.select(
        F.lit(top).cast("bigint").alias("top_slice_size"),
        F.round(F.coalesce("_all", F.lit(0.0)), 6).alias("baseline_uncertainty_rate"),
        F.round(F.coalesce("_top", F.lit(0.0)), 6).alias("top_slice_uncertainty_rate"),
        F.round(F.lit(threshold).cast("double"), 6).alias("high_uncertainty_threshold"),
        F.round(factor, 6).alias("concentration_factor"),
        F.lit(TARGET_FACTOR).alias("target_factor"),
        F.coalesce(factor >= TARGET_FACTOR, F.lit(False)).alias("passes"),
    )


def run_counts(review: DataFrame, profile: DataFrame, n_seeds: int) -> DataFrame:
    """Counters of a run in one row."""
    counted = review.agg(
        F.count("*").alias("accepted_images"),
        F.count("*").alias("review_queue_items"),
        F.count_if(F.size("suggestions") > 0).alias("suggestion_items"),
        F.coalesce(F.sum(F.size("suggestions")), F.lit(0)).alias("suggested_category_slots"),
    )
    return counted.select(
        "accepted_images",
        F.lit(n_seeds).cast("bigint").alias("annotation_seeds"),
        F.lit(profile.count()).cast("bigint").alias("clusters"),
        "review_queue_items",
        "suggestion_items",
        "suggested_category_slots",
    )


def canonical(c: Column, kind: T.DataType) -> Column:
    """The same value with every map, at any depth, as entries sorted by key."""
    if isinstance(kind, T.MapType):
        return F.transform(
            F.array_sort(F.map_keys(c)),
            lambda k: F.struct(
                k.alias("key"), canonical(F.try_element_at(c, k), kind.valueType).alias("value")
            ),
        )
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda e: canonical(e, kind.elementType))
    if isinstance(kind, T.StructType):
        fields = F.struct(*[canonical(c[f.name], f.dataType).alias(f.name) for f in kind.fields])
        return F.when(c.isNotNull(), fields)
    return c


def fingerprint(df: DataFrame) -> DataFrame:
    """Order-free fingerprint of a table: rows, xor and sum of row digests.

    Maps are digested as sorted entries, so equal contents give equal digests.
    """
    shown = [canonical(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields]
    text = F.to_json(F.struct(*shown))
    digest = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")
    return df.select(digest.alias("_d")).agg(
        F.count("*").alias("n"),
        F.coalesce(F.bit_xor("_d"), F.lit(0)).alias("xor"),
        F.coalesce(F.sum(F.col("_d").cast("decimal(38,0)")), F.lit(0)).cast("string").alias("total"),
    )


def unchanged(before: DataFrame, after: DataFrame) -> bool:
    """True if two fingerprints agree."""
    return before.first() == after.first()
