"""Near-duplicate removal on 64-bit hashes, exact and without all-pairs work.

The rule: in path order an item is kept unless an earlier *kept* item lies within
the Hamming threshold. Copies with equal hashes collapse to their first member.
The distinct hashes are then decided in growing prefixes of the order: a prefix
is settled from its own pairs, its kept items strike out their neighbours in the
rest, and only what is left goes on. Pairs are thus formed inside a prefix of
checked cost and between kept items and the rest, never among all members of a
dense group. (Prefix scheme: Blelloch, Fineman and Shun, SPAA 2012. Band probes:
Norouzi, Punjani and Fleet, CVPR 2012.)
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spark_curate.functions import hashing as H
from spark_curate.functions import names as N
from spark_curate.functions.session import materialize
from spark_curate.operators.sequence import global_sequence
from spark_curate.operators.skew import hot_keys, join_unique, salted_join

FIRST_BATCH = 100_000
SMALLEST_BATCH = 2_000
GROWTH = 4
MAX_CANDIDATES = 20_000_000_000
MAX_DENSE_PAIRS = 500_000
CROWDED = 16
TAIL_EDGES = 200_000
#: Rows by which the plans are weighed.
RATE_ROWS = 100_000
#: Most pairs that one group compares in a task, and the unit of a group compared with itself.
UNIT_PAIRS, WITHIN = 250_000_000, -1
#: Rows of both sides that are compared at once.
TILE = (64, 2048)


def by_sort(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that is sorted, never broadcast.

    For tables that grow with the input: a file of ranks or pairs takes a few bytes a row,
    so the planner holds millions of rows for small enough to pass through the driver.
    """
    return df.hint("merge")


def representatives(hashes: DataFrame, order: str = "image") -> DataFrame:
    """First item in order of every distinct hash, with the number of copies."""
    first = F.min(F.struct(F.col(order).alias("at"), F.col("image")))
    return (
        hashes.where(F.col("phash").isNotNull())
        .groupBy("phash")
        .agg(first.alias("_f"), F.count("*").alias("n"))
        .select("phash", "_f.image", F.col("_f.at").alias("at"), "n")
    )


def _band_counts(ranked: DataFrame, plan: H.BandPlan) -> DataFrame:
    return H.probes(ranked.select("phash"), "phash", plan, 0, "own").groupBy("band", "value").agg(
        F.count("*").alias("n")
    )


def collision_rates(hashes: DataFrame, threshold: int, rows: int) -> dict[tuple[int, int], float]:
    """For each band of the plans, how often two different rows share its value.

    Measured in one aggregation over a share of about ``RATE_ROWS`` rows (chosen by a
    hash): the rates pick a plan, results do not hang on them.
    """
    bands = sorted({band for plan in H.band_plans(threshold) for band in plan.bands})
    step = max(1, rows // RATE_ROWS)
    part = hashes.where(F.pmod(F.xxhash64("phash"), F.lit(step)) == 0)
    values = F.array(
        *(
            F.struct(F.lit(k).alias("band"), H.band_value(F.col("phash"), shift, width).alias("value"))
            for k, (shift, width) in enumerate(bands)
        )
    )
    counted = part.select(F.inline(values)).groupBy("band", "value").agg(F.count("*").cast("double").alias("n"))
    sums = counted.groupBy("band").agg(F.sum("n").alias("n"), F.sum(F.col("n") * (F.col("n") - 1)).alias("same"))
    return {bands[r["band"]]: r["same"] / (r["n"] * (r["n"] - 1)) for r in sums.collect() if r["n"] > 1}


def candidates(few: DataFrame, many: DataFrame, plan: H.BandPlan, spread: bool) -> DataFrame:
    """Pairs of rows that meet in a band (a, ha, b, hb, band and, where both flip, oa, ob, value)."""
    left = H.probes(
        many.select(F.col("rank").alias("b"), F.col("phash").alias("hb")), "hb", plan, plan.flips, "ob"
    )
    right = H.probes(
        few.select(F.col("rank").alias("a"), F.col("phash").alias("ha")),
        "ha",
        plan,
        plan.radius - plan.flips,
        "oa",
    )
    keys = ["band", "value"]
    if not plan.flips:  # the meeting value is b's own band: one per band already
        left, right = left.drop("ob"), right.drop("oa")
    if spread:
        return salted_join(left, right, keys, "b", hot_keys(_band_counts(many, plan), keys))
    # A table of probes is hundreds of times its rows, which the planner cannot see: never broadcast it.
    return left.join(by_sort(right), keys)


def near(few: DataFrame, many: DataFrame, plan: H.BandPlan, spread: bool) -> DataFrame:
    """Pairs (a from ``few``, b from ``many``) within the threshold, each once, by joins alone.

    The removal itself uses :func:`close_pairs`, which makes far fewer rows. Both sides have columns rank and phash. The plan says how many bits each side flips.
    ``spread`` salts crowded bands. A pair counts in its lowest matching band only, and
    there at one meeting value, so no distinct is needed.
    """
    met = candidates(few, many, plan, spread)
    distance = H.hamming(F.col("ha"), F.col("hb"))
    close = distance <= plan.threshold
    if plan.flips:
        close = close & H.canonical_meeting(F.col("oa"), F.col("ob"), F.col("value"), plan.flips)
    once = H.first_band(F.col("ha"), F.col("hb"), plan) == F.col("band")
    return met.where(close & once).select("a", "b", distance.alias("distance"))


def _copies(rows: DataFrame, cut: H.Cut, second: bool) -> DataFrame:
    """Each row under every mask: cut (its number), value (the hash under it), second, rank, phash."""
    masks = json.dumps([{"cut": i, "mask": H._signed(mask)} for i, mask in enumerate(cut.masks)])
    table = F.from_json(F.lit(masks), "array<struct<cut:int,mask:bigint>>")
    return rows.select("rank", "phash", F.explode(table).alias("_k")).select(
        F.col("_k.cut").alias("cut"),
        F.col("phash").bitwiseAND(F.col("_k.mask")).alias("value"),
        F.lit(second).alias("second"),
        "rank",
        "phash",
    )


def close_pairs(few: DataFrame, many: DataFrame | None, cut: H.Cut) -> DataFrame:
    """Pairs (a, b, distance) within the threshold of the cut, each once.

    Both sides have columns rank and phash. With ``many``, a is of ``few`` and b of
    ``many``; without, both are of ``few`` and a < b. Rows that agree under a mask are
    sorted together and compared in tiles, so a task holds one group at a time and no
    candidate becomes a row. A group of more than ``UNIT_PAIRS`` pairs is dealt to several
    units by its second side. A pair counts under the first mask it agrees under.
    """
    first = _copies(few, cut, False)
    every = first if many is None else first.unionByName(_copies(many, cut, True))
    n, m = F.count_if(~F.col("second")), F.count_if("second")
    pairs = (n.cast("double") * n if many is None else n.cast("double") * m).alias("pairs")
    big = materialize(
        every.groupBy("cut", "value").agg(pairs).where(F.col("pairs") > UNIT_PAIRS)
        .select("cut", "value", F.ceil(F.col("pairs") / UNIT_PAIRS).cast("int").alias("_units"))
    )
    alone = F.lit(0 if many is not None else WITHIN)
    if big.isEmpty():
        units = every.withColumn("unit", alone)
    else:
        marked = every.join(F.broadcast(big), ["cut", "value"], "left")
        seconds = marked.where("second") if many is not None else (
            marked.where(F.col("_units").isNotNull()).withColumn("second", F.lit(True))
        )
        own = F.pmod(F.xxhash64("rank"), F.col("_units")).cast("int")
        every_unit = F.when(F.col("_units").isNull(), F.array(alone)).otherwise(F.sequence(F.lit(0), F.col("_units") - 1))
        units = (
            marked.where(~F.col("second")).withColumn("unit", F.explode(every_unit))
            .unionByName(seconds.withColumn("unit", F.coalesce(own, F.lit(0))))
            .drop("_units")
        )
    sorted_units = units.repartition("cut", "value", "unit").sortWithinPartitions("cut", "value", "unit", "second")
    masks, threshold, one_side = np.array(cut.masks, dtype=np.uint64), cut.threshold, many is None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            for a, b, distance in _compared(group, masks, threshold, one_side):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a), pa.array(b), pa.array(distance)], names=["a", "b", "distance"]
                )

    columns = sorted_units.select("cut", "value", "unit", "second", "rank", "phash")
    return columns.mapInArrow(run, "a bigint, b bigint, distance int")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(cut, unit, second, rank, phash) of every run of rows of one cut, value and unit."""
    key, held = None, []

    def whole() -> tuple:
        return (key[0], key[2], *(np.concatenate(part) for part in zip(*held)))

    for batch in batches:
        if not batch.num_rows:
            continue
        cut, value, unit, second, rank, phash = (
            batch.column(i).to_numpy(zero_copy_only=False) for i in range(6)
        )
        turns = (np.diff(cut) != 0) | (np.diff(value) != 0) | (np.diff(unit) != 0)
        edges = [0, *(np.flatnonzero(turns) + 1).tolist(), batch.num_rows]
        for lo, hi in zip(edges, edges[1:]):
            here = (int(cut[lo]), int(value[lo]), int(unit[lo]))
            if key is not None and here != key:
                yield whole()
                held = []
            key = here
            held.append((second[lo:hi], rank[lo:hi], phash[lo:hi]))
    if held:
        yield whole()


def _compared(
    group: tuple, masks: np.ndarray, threshold: int, one_side: bool
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs (a, b, distance) of a group, tile by tile."""
    cut, unit, second, rank, phash = group
    hashes = phash.view(np.uint64)
    within = unit == WITHIN
    left, right = (slice(None), slice(None)) if within else (~second, second)
    ra, ha, rb, hb = rank[left], hashes[left], rank[right], hashes[right]
    for j in range(0, len(hb), TILE[1]):
        across = hb[j : j + TILE[1]]
        for i in range(0, min(len(ha), j + TILE[1]) if within else len(ha), TILE[0]):
            apart = np.bitwise_count(ha[i : i + TILE[0], None] ^ across)
            p, q = np.nonzero(apart <= threshold)
            p, q, distance = p + i, q + j, apart[p, q]
            keep = p < q if within else ra[p] < rb[q] if one_side else np.ones(len(p), bool)
            p, q, distance = p[keep], q[keep], distance[keep]
            differing = ha[p] ^ hb[q]
            for mask in masks[:cut]:
                if not len(p):
                    break
                keep = (differing & mask) != 0
                p, q, distance, differing = p[keep], q[keep], distance[keep], differing[keep]
            if len(p):
                a, b = ra[p], rb[q]
                if within:
                    a, b = np.minimum(a, b), np.maximum(a, b)
                yield a, b, distance.astype(np.int32)


def near_pairs(hashes: DataFrame, threshold: int = 10, order: str = "image") -> DataFrame:
    """Pairs of distinct hashes within the threshold: image_a before image_b.

    Each distinct hash is stood for by its first item.
    """
    ranked = global_sequence(representatives(hashes, order), ["at", "image"], "rank")
    rows = ranked.count()
    pairs = materialize(close_pairs(ranked, None, H.cheapest_cut(threshold, rows, rows)))
    return (
        pairs.join(by_sort(ranked.select(F.col("rank").alias("a"), F.col("image").alias("image_a"))), "a")
        .join(by_sort(ranked.select(F.col("rank").alias("b"), F.col("image").alias("image_b"))), "b")
        .select("image_a", "image_b", "distance")
    )


def _affordable(batch: DataFrame, rows: int, plan: H.BandPlan, most: int) -> bool:
    """Whether the pairs of a batch are worth forming at once.

    Two sums over the band counts decide: expected candidates of all bands, and
    pairs inside crowded bands, where most candidates are true pairs.
    """
    width = max(width for _, width in plan.bands)
    ours, theirs = H.side_probes(plan, width)
    probes = ours * theirs
    squares = F.col("n").cast("double") * F.col("n")
    crowded = F.col("n") > CROWDED * (1 + rows / 2.0**width)
    load = _band_counts(batch, plan).agg(
        F.sum(squares).alias("all"), F.sum(F.when(crowded, squares)).alias("dense")
    ).first()
    return (load["all"] or 0) * probes <= most and (load["dense"] or 0) <= MAX_DENSE_PAIRS


def _prefix(
    todo: DataFrame, rows: int, size: int, threshold: int, rates: dict, most: int
) -> tuple[DataFrame, int | None, int]:
    """Earliest items whose candidate count is affordable.

    Returns the batch, its boundary rank (None if it is everything) and its size.
    """
    while True:
        if rows <= size:
            batch, limit = todo, None
        else:
            share = F.percentile_approx("rank", size / rows, F.lit(10000))
            limit = todo.agg(share).first()[0]
            batch = todo.where(F.col("rank") <= limit)
        size = min(rows, size)
        plan = H.cheapest_plan(threshold, size, size, rates)
        if size <= SMALLEST_BATCH or _affordable(batch, size, plan, most):
            return batch, limit, size
        size = max(SMALLEST_BATCH, size // GROWTH)


def _settle(edges: DataFrame, tail_edges: int) -> DataFrame:
    """Removed items (column b) of the greedy rule over edges a -> b, a < b.

    Each round keeps the items no undecided item points at and removes their
    targets. A remainder of at most ``tail_edges`` edges is finished in order by
    one task, which spares long chains one round per link.
    """
    removed: list[DataFrame] = []
    left = edges.count()
    while left > tail_edges:
        roots = edges.select("a").distinct().join(
            by_sort(edges.select(F.col("b").alias("a")).distinct()), "a", "left_anti"
        )
        gone = materialize(edges.join(by_sort(roots), "a", "left_semi").select("b").distinct())
        removed.append(gone)
        edges = materialize(
            edges.join(by_sort(gone), "b", "left_anti").join(
                by_sort(gone.select(F.col("b").alias("a"))), "a", "left_anti"
            ).select("a", "b")
        )
        left = edges.count()
    if left or not removed:
        removed.append(
            edges.select("a", "b").coalesce(1).sortWithinPartitions("b", "a").mapInArrow(_in_order, "b bigint")
        )
    return reduce(DataFrame.unionByName, removed)


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Removed targets of edges sorted by target: those met by a kept source."""
    removed: set[int] = set()
    for batch in batches:
        fresh = []
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            if a not in removed and b not in removed:
                removed.add(b)
                fresh.append(b)
        yield pa.RecordBatch.from_arrays([pa.array(fresh, pa.int64())], names=["b"])


def greedy(
    ranked: DataFrame,
    threshold: int,
    first_batch: int = FIRST_BATCH,
    max_candidates: int = MAX_CANDIDATES,
    tail_edges: int = TAIL_EDGES,
) -> DataFrame:
    """Removed ranks with the rank of the earliest kept neighbour (b, keeper).

    ``ranked`` holds rank and phash with distinct hashes.
    """
    todo, size = ranked.select("rank", "phash"), first_batch
    found: list[DataFrame] = []
    rates: dict | None = None
    while True:
        rows = todo.count()
        if rates is None:
            rates = collision_rates(todo, threshold, rows)
        batch, limit, taken = _prefix(todo, rows, size, threshold, rates, max_candidates)
        pairs = materialize(close_pairs(batch, None, H.cheapest_cut(threshold, taken, taken)).select("a", "b"))
        removed = materialize(_settle(pairs, tail_edges))
        sources = removed.select(F.col("b").alias("a"))
        inside = pairs.join(by_sort(sources), "a", "left_anti").join(by_sort(removed), "b", "left_semi")
        found.append(inside.groupBy("b").agg(F.min("a").alias("keeper")))
        if limit is None:
            return reduce(DataFrame.unionByName, found)
        kept = materialize(batch.join(by_sort(removed.select(F.col("b").alias("rank"))), "rank", "left_anti"))
        rest = todo.where(F.col("rank") > limit)
        across = H.cheapest_cut(threshold, kept.count(), rows - taken)
        struck = materialize(close_pairs(kept, rest, across).groupBy("b").agg(F.min("a").alias("keeper")))
        found.append(struck)
        todo = materialize(rest.join(by_sort(struck.select(F.col("b").alias("rank"))), "rank", "left_anti"))
        size *= GROWTH


def find_duplicates(
    hashes: DataFrame, threshold: int = 10, order: str = "image", **limits: int
) -> DataFrame:
    """Removed items: image, duplicate_of (the earliest kept item within reach).

    ``hashes`` holds image, phash (null if unreadable: such items stay) and the
    ``order`` column, by default the image name.
    """
    reps = representatives(hashes, order)
    ranked = global_sequence(reps, ["at", "image"], "rank")
    removed = greedy(ranked, threshold, **limits)
    names = ranked.select(F.col("rank").alias("keeper"), F.col("image").alias("_keeper"))
    decided = ranked.join(
        by_sort(removed.join(by_sort(names), "keeper").select(F.col("b").alias("rank"), "_keeper")), "rank", "left"
    ).select("phash", "n", F.coalesce("_keeper", "image").alias("duplicate_of"))
    every = hashes.where(F.col("phash").isNotNull()).select("image", "phash")
    return (
        join_unique(every, decided, "phash", rows=ranked.count())
        .where(F.col("image") != F.col("duplicate_of"))
        .select("image", "duplicate_of")
    )


def survivors(items: DataFrame, dups: DataFrame) -> DataFrame:
    """Items left after removal."""
    return items.join(by_sort(dups.select("image")), "image", "left_anti")


def dedup_counts(items: DataFrame, dups: DataFrame) -> DataFrame:
    """total, removed and kept in one row."""
    marked = items.select("image", F.lit(0).alias("_r")).unionByName(
        dups.select("image", F.lit(1).alias("_r"))
    )
    return marked.agg(
        F.count_if(F.col("_r") == 0).alias("total"), F.count_if(F.col("_r") == 1).alias("removed")
    ).select("total", "removed", (F.col("total") - F.col("removed")).alias("kept"))


def duplicate_groups(dups: DataFrame, piece_rows: int = 10_000) -> DataFrame:
    """Groups as (duplicate_of, piece, removed[]), each piece of bounded size.

    A group of up to ``piece_rows`` is one piece; larger ones are split by the
    hash of the name, so no group has to fit in one row.
    """
    sizes = dups.groupBy("duplicate_of").agg(F.count("*").alias("n"))
    big = sizes.where(F.col("n") > piece_rows).select(
        "duplicate_of", F.ceil(F.col("n") / piece_rows).cast("bigint").alias("_pieces")
    )
    spread = F.pmod(F.conv(F.substring(F.md5("image"), 1, 8), 16, 10).cast("bigint"), F.col("_pieces"))
    placed = dups.join(by_sort(big), "duplicate_of", "left").withColumn(
        "piece", F.when(F.col("_pieces").isNull(), F.lit(0)).otherwise(spread)
    )
    return placed.groupBy("duplicate_of", "piece").agg(
        F.sort_array(F.collect_list("image")).alias("removed")
    )


def explode_groups(groups: DataFrame) -> DataFrame:
    """Back to (image, duplicate_of) rows; blank names are dropped."""
    return groups.select(F.explode("removed").alias("image"), "duplicate_of").where(
        F.trim("image") != ""
    )


def removed_names(groups: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """Removed names: from the groups, or ``before`` minus ``after`` without groups."""
    if not groups.isEmpty():
        return explode_groups(groups).select("image").distinct()
    return before.select("image").subtract(after.select("image"))


def duplicate_lookup(dups: DataFrame) -> DataFrame:
    """Each removed item with its kept item and its number of siblings."""
    sizes = dups.groupBy("duplicate_of").agg(F.count("*").alias("n"))
    return (
        join_unique(dups, sizes.withColumn("siblings", F.col("n") - 1), "duplicate_of")
        .select("image", "duplicate_of", "siblings")
    )


def duplicates_of(dups: DataFrame, kept: str) -> DataFrame:
    """Removed duplicates of one kept item."""
    return dups.where(F.col("duplicate_of") == kept).select(
        "image", N.source_of_name(F.col("image")).alias("source")
    )


def siblings_of(dups: DataFrame, image: str) -> DataFrame:
    """The other removed items of the group one removed item belongs to."""
    group = dups.where(F.col("image") == image).select("duplicate_of")
    return dups.join(F.broadcast(group.limit(1)), "duplicate_of").where(F.col("image") != image).select(
        "image", "duplicate_of", N.source_of_name(F.col("image")).alias("source")
    )
