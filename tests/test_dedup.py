"""Near-duplicate removal against the plain sequential rule."""

import random

import pytest
from pyspark.sql import functions as F

from spark_curate.functions import hashing as H
from spark_curate.operators import dedup, skew

SCHEMA = "image string, phash bigint"


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def distance(a, b):
    return bin((a ^ b) & ((1 << 64) - 1)).count("1")


def sequential(rows, threshold):
    """{removed: kept} of the rule, item by item in name order."""
    kept, removed = [], {}
    for name, value in sorted(rows):
        if value is None:
            continue
        hit = next((k for k, v in kept if distance(v, value) <= threshold), None)
        if hit is None:
            kept.append((name, value))
        else:
            removed[name] = hit
    return removed


def crowd(seed, n, centres, flips):
    """Hashes scattered around a few centres."""
    rng = random.Random(seed)
    middle = [rng.getrandbits(64) for _ in range(centres)]
    rows = []
    for i in range(n):
        value = rng.choice(middle)
        for _ in range(rng.randint(0, flips)):
            value ^= 1 << rng.randrange(64)
        rows.append((f"{i:05d}", signed(value)))
    return rows


def run(spark, rows, threshold, **limits):
    df = spark.createDataFrame(rows, SCHEMA)
    found = dedup.find_duplicates(df, threshold, **limits).collect()
    assert len(found) == len({r["image"] for r in found})
    return {r["image"]: r["duplicate_of"] for r in found}


@pytest.mark.parametrize("threshold", [0, 1, 2, 5, 10, 20])
def test_band_plan_misses_nothing(threshold):
    plan = H.band_plan(threshold)
    assert sum(width for _, width in plan.bands) == 64
    assert (plan.radius + 1) * len(plan.bands) > threshold


@pytest.mark.parametrize("threshold", [0, 3, 10, 20])
def test_every_plan_finds_the_same_pairs(spark, threshold):
    rows = list({v: (n, v) for n, v in crowd(threshold + 1, 90, 6, threshold + 2)}.values())
    ranked = spark.createDataFrame(list(enumerate(v for _, v in rows)), "rank bigint, phash bigint").cache()
    want = sorted((a, b) for a, (_, x) in enumerate(rows) for b, (_, y) in enumerate(rows) if a < b and distance(x, y) <= threshold)
    plans = H.band_plans(threshold)
    assert all((p.radius + 1) * len(p.bands) > threshold for p in plans) and len(plans) > (threshold > 0)
    for plan in plans[::3] if threshold > 3 else plans:
        if sum(map(sum, (H.side_probes(plan, w) for _, w in plan.bands))) < 1500:
            found = dedup.near(ranked, ranked, plan, spread=False).where("a < b").collect()
            assert sorted((r["a"], r["b"]) for r in found) == want, plan


def test_costs_grow_far_slower_than_pairs():
    """Ten times the rows: bands widen with the table, so neither probes nor candidates take all pairs."""
    costs = [H.plan_cost(H.cheapest_plan(10, n, n), n, n) for n in (10**4, 10**5, 10**6, 10**7, 10**8)]
    growth = [b / a for a, b in zip(costs, costs[1:])]
    assert max(growth) < 50, growth  # 100 for all pairs
    assert len({len(H.cheapest_plan(10, n, n).bands) for n in (10**3, 10**5, 10**7)}) > 1


def test_candidates_are_what_the_cost_says(spark):
    rng = random.Random(9)
    sizes, found = (1000, 4000), []
    for n in sizes:
        ranked = spark.createDataFrame([(i, signed(rng.getrandbits(64))) for i in range(n)], "rank bigint, phash bigint")
        rates = dedup.collision_rates(ranked, 10, n)
        plan = H.cheapest_plan(10, n, n, rates)
        met = dedup.candidates(ranked, ranked, plan, spread=False).count()
        probes = sum(n * sum(H.side_probes(plan, w)) for _, w in plan.bands)
        assert met < 2 * (H.plan_cost(plan, n, n, rates) - H.PROBE_COST * probes)
        found.append(met + H.PROBE_COST * probes)
    assert found[1] / found[0] < 12  # 16 for all pairs


def test_poor_bits_turn_the_plan(spark):
    """Bands that hold the same few values count as the crowds they are."""
    flat = spark.createDataFrame([(i, (i % 5) << 40 | i) for i in range(3000)], "rank bigint, phash bigint")
    rates = dedup.collision_rates(flat, 10, 3000)
    assert max(rates.values()) == 1.0 and min(rates.values()) < 0.01
    some = H.cheapest_plan(10, 3000, 3000)
    assert H.plan_cost(some, 3000, 3000, rates) > H.plan_cost(some, 3000, 3000)


@pytest.mark.parametrize("threshold,flips", [(0, 2), (3, 3), (10, 12), (20, 20)])
def test_matches_sequential_rule(spark, threshold, flips):
    rows = crowd(threshold, 300, 12, flips)
    assert run(spark, rows, threshold) == sequential(rows, threshold)


def test_prefixes_and_rounds_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(dedup, "SMALLEST_BATCH", 20)
    rows = crowd(7, 250, 3, 9)
    want = sequential(rows, 10)
    assert run(spark, rows, 10, first_batch=40) == want
    assert run(spark, rows, 10, first_batch=60, tail_edges=0) == want
    assert run(spark, rows, 10, first_batch=200, max_candidates=2000) == want


def test_chain_keeps_both_ends(spark):
    rows = [("a", 0), ("b", 0b1111), ("c", 0b11111111), ("d", None), ("e", None)]
    assert run(spark, rows, 4) == {"b": "a"}


def test_threshold_is_inclusive_and_top_bit_counts(spark):
    rows = [("a", 0), ("b", signed(1 << 63) | 0b1), ("c", 0b111)]
    assert run(spark, rows, 2) == {"b": "a"}


def test_one_hash_owning_most_rows(spark, monkeypatch):
    monkeypatch.setattr(skew, "HOT_KEYS", 3)
    monkeypatch.setattr(skew, "SMALL_ROWS", 0)
    rows = [(f"{i:04d}", 5) for i in range(400)] + [(f"z{i:03d}", i * 977) for i in range(50)]
    assert run(spark, rows, 1) == sequential(rows, 1)


def test_independent_of_partitioning(spark):
    rows = crowd(3, 200, 5, 10)
    df = spark.createDataFrame(rows, SCHEMA)
    results = [
        {tuple(r) for r in dedup.find_duplicates(df.repartition(n, F.rand(n)), 10).collect()}
        for n in (1, 7)
    ]
    assert results[0] == results[1] == set(sequential(rows, 10).items())


def test_pairs_once_each(spark):
    rows = crowd(11, 150, 4, 8)
    found = [tuple(r) for r in dedup.near_pairs(spark.createDataFrame(rows, SCHEMA), 10).collect()]
    first = {}
    for name, value in rows:
        first.setdefault(value, name)
    reps = sorted((n, v) for v, n in first.items())
    want = [
        (a, b, distance(va, vb))
        for i, (a, va) in enumerate(reps)
        for b, vb in reps[i + 1 :]
        if distance(va, vb) <= 10
    ]
    assert sorted(found) == sorted(want)


def test_groups_in_bounded_pieces(spark):
    dups = spark.createDataFrame([(f"x{i}", "k") for i in range(50)] + [("y", "m")], "image string, duplicate_of string")
    groups = dedup.duplicate_groups(dups, piece_rows=10).collect()
    assert len([g for g in groups if g["duplicate_of"] == "m"]) == 1
    pieces = [g["removed"] for g in groups if g["duplicate_of"] == "k"]
    assert 2 <= len(pieces) <= 5 and sum(map(len, pieces)) == 50
    back = dedup.explode_groups(dedup.duplicate_groups(dups, 10))
    assert back.exceptAll(dups).count() == 0 and back.count() == 51


def test_siblings(spark):
    dups = spark.createDataFrame([("h_bing_1", "k"), ("h_google_2", "k"), ("z", "m")], "image string, duplicate_of string")
    got = [tuple(r) for r in dedup.siblings_of(dups, "h_bing_1").select("image", "duplicate_of", "source").collect()]
    assert got == [("h_google_2", "k", "google")]
    assert {r["image"] for r in dedup.duplicates_of(dups, "k").collect()} == {"h_bing_1", "h_google_2"}


@pytest.mark.parametrize("threshold", [0, 1, 4, 10, 20, 40])
def test_every_cut_finds_the_same_pairs(spark, monkeypatch, threshold):
    rows = list({v: (n, v) for n, v in crowd(threshold + 1, 120, 6, threshold + 2)}.values())
    ranked = spark.createDataFrame(list(enumerate(v for _, v in rows)), "rank bigint, phash bigint").cache()
    want = sorted(
        (a, b, distance(x, y))
        for a, (_, x) in enumerate(rows) for b, (_, y) in enumerate(rows) if distance(x, y) <= threshold
    )
    for unit, tile in ((dedup.UNIT_PAIRS, dedup.TILE), (7, (3, 5))):  # small units: groups are dealt out
        monkeypatch.setattr(dedup, "UNIT_PAIRS", unit)
        monkeypatch.setattr(dedup, "TILE", tile)
        for cut in H.cuts(threshold)[:2]:
            own = [tuple(r) for r in dedup.close_pairs(ranked, None, cut).collect()]
            assert sorted(own) == [w for w in want if w[0] < w[1]], (unit, len(cut.masks))
            few, many = ranked.where("rank % 3 = 0"), ranked.where("rank % 3 > 0")
            both = [tuple(r) for r in dedup.close_pairs(few, many, cut).collect()]
            assert sorted(both) == [w for w in want if w[0] % 3 == 0 and w[1] % 3], (unit, len(cut.masks))


def test_candidates_are_never_broadcast(spark, tmp_path):
    """Sides that look small become hundreds of probes or copies a row."""
    ranked = spark.range(20_000).select(F.col("id").alias("rank"), F.xxhash64("id").alias("phash"))
    ranked.write.parquet(str(tmp_path / "ranked"))
    ranked = spark.read.parquet(str(tmp_path / "ranked"))
    for pairs in (
        dedup.close_pairs(ranked, None, H.cheapest_cut(10, 20_000, 20_000)),
        dedup.close_pairs(ranked, ranked, H.cheapest_cut(10, 20_000, 20_000)),
        dedup.candidates(ranked, ranked, H.cheapest_plan(10, 20_000, 20_000), spread=False),
    ):
        plan = pairs._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan and "NestedLoop" not in plan


def _stored(spark, path, df):
    df.write.parquet(str(path))
    return spark.read.parquet(str(path))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_survivors_never_broadcast_the_removed(spark, tmp_path):
    name = F.format_string("doc_%012d", "id").alias("image")
    items = _stored(spark, tmp_path / "items", spark.range(5000).select(name))
    dups = _stored(spark, tmp_path / "dups", spark.range(0, 5000, 5).select(name, F.lit("k").alias("duplicate_of")))
    left = dedup.survivors(items, dups)
    assert "Broadcast" not in _plan(left) and left.count() == 4000


def test_removal_never_broadcasts_what_grows(spark, monkeypatch):
    """Only hot hashes and one row per sort partition are shipped."""
    monkeypatch.setattr(skew, "SMALL_ROWS", 10)
    rows = crowd(11, 150, 4, 8)
    dups = dedup.find_duplicates(spark.createDataFrame(rows, SCHEMA), 10)
    plan = _plan(dups)
    assert "BroadcastHashJoin [keeper" not in plan and "BroadcastHashJoin [rank" not in plan
    assert "SortMergeJoin [phash" in plan
    assert {tuple(r) for r in dups.collect()} == set(sequential(rows, 10).items())


def test_sizes_of_groups_are_never_broadcast(spark, tmp_path):
    rows = spark.range(3000).select(F.format_string("x%06d", "id").alias("image"), (F.col("id") % 500).cast("string").alias("duplicate_of"))
    groups = dedup.duplicate_groups(_stored(spark, tmp_path / "dups", rows), piece_rows=2)
    plan = _plan(groups)
    assert "SortMergeJoin [duplicate_of" in plan and "BroadcastHashJoin" not in plan
    assert groups.select(F.explode("removed")).distinct().count() == 3000


def test_pairs_and_names_meet_by_sort(spark):
    plan = _plan(dedup.near_pairs(spark.createDataFrame(crowd(11, 150, 4, 8), SCHEMA), 10))
    for side in "ab":
        assert f"SortMergeJoin [{side}#" in plan and f"BroadcastHashJoin [{side}#" not in plan
