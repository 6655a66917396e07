"""Votes, consensus, gate, risk and concentration against plain rules."""

import os
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from spark_curate.functions import vectors as V
from spark_curate.operators import clustering, kmeans, review
from spark_curate.plans import steps

CATS = ("c", "d")


def unit_rows(seed, n, dim):
    x = np.random.default_rng(seed).normal(size=(n, dim))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@pytest.fixture(scope="module")
def items(spark):
    vectors = unit_rows(1, 120, 8)
    vectors[7] = vectors[3]  # equal seeds: the smaller name comes first
    rows = [(f"i{i:03d}", v.tolist()) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "image string, embedding array<double>").cache()


@pytest.fixture(scope="module")
def seeds(spark, items):
    rng = random.Random(2)
    truth = [(f"i{i:03d}", {"c": rng.choice("xyz"), "d": rng.choice("uv")}) for i in range(40)]
    return items.join(spark.createDataFrame(truth, "image string, truth map<string,string>"), "image").cache()


def plain_votes(items, seeds, k):
    seed_rows = sorted((r["image"], np.asarray(r["embedding"]), r["truth"]) for r in seeds.collect())
    out = {}
    for r in items.collect():
        near = sorted(
            ((-round(float(np.dot(r["embedding"], v)), 9), name, truth) for name, v, truth in seed_rows),
            key=lambda t: t[:2],
        )[:k]
        for cat in CATS:
            counts = Counter(t[cat] for _, _, t in near)
            label, n = counts.most_common(1)[0]
            sims = [-s for s, _, t in near if t[cat] == label]
            out[r["image"], cat] = (label, round(n / k, 6), round(sum(sims) / n, 6), n)
    return out


@pytest.mark.parametrize("k", [1, 4, 7])
def test_votes(items, seeds, k):
    want = plain_votes(items, seeds, k)
    fast = review.votes_long(review.seed_votes(items, seeds, CATS, k))
    blocks = review.votes_long(review.seed_votes(items, seeds, CATS, k, max_bytes=8 * 8 * 9))
    for found in (fast, blocks):
        got = {
            (r["image"], r["category"]): (r["label"], r["ratio"], pytest.approx(r["similarity"], abs=2e-6), r["support"])
            for r in found.collect()
        }
        assert got == want


def test_neighbours_in_blocks(items, seeds):
    whole = review.nearest_seeds(items, seeds, 5).collect()
    pieces = review.nearest_seeds(items, seeds, 5, max_bytes=8 * 8 * 9).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, pieces)) and len(whole) == 600
    own = {r["image"]: r["seed"] for r in whole if r["rank"] == 1}
    assert own["i003"] == own["i007"] == "i003" and own["i005"] == "i005"


def test_votes_of_given_categories_only(items, seeds):
    """Other keys and blank labels do not vote, on either side of the size bound."""
    more = F.map_concat("truth", F.create_map(F.lit("other"), F.lit("o"), F.lit("blank"), F.lit("")))
    odd = seeds.withColumn("truth", more)
    lone = items.withColumn("embedding", F.when(F.col("image") != "i004", F.col("embedding")))
    named = [*CATS, "blank", "absent"]
    found = []
    for most in (V.MAX_BLOCK_BYTES, 8 * 8 * 9):
        votes = review.seed_votes(lone, odd, named, 4, max_bytes=most)
        assert votes.where("votes is null").count() == 0 and votes.where("size(votes) = 0").count() == 1
        found.append({tuple(r) for r in review.votes_long(votes).collect()})
    assert found[0] == found[1] and {r[1] for r in found[0]} == set(CATS)


def test_bounds_skip_blocks_but_never_a_neighbour():
    rng = np.random.default_rng(12)
    centres = rng.normal(size=(6, 8)) * 5
    seeds = np.concatenate([c + rng.normal(size=(40, 8)) for c in centres])
    x = np.concatenate([c + rng.normal(size=(30, 8)) for c in centres[:4]] + [rng.normal(size=(30, 8))])
    pivots = seeds[::7]
    skipped = 0
    for k in (1, 5):
        wanted = np.argsort(-(x @ seeds.T), axis=1)[:, :k]
        for start in range(0, 240, 40):
            asked = review.reach_of(seeds[start : start + 40], pivots).may_enter(x, k)
            needs = ((wanted >= start) & (wanted < start + 40)).any(axis=1)
            assert not (needs & ~asked).any()
            skipped += (~asked).sum()
    assert skipped > 0.3 * 12 * len(x)
    assert review.reach_of(seeds, pivots[:3]).may_enter(x, 5).all()  # fewer pivots than neighbours: no bar


def test_many_blocks_of_seeds_leave_nothing_out(spark, monkeypatch):
    monkeypatch.setattr(review, "PIVOTS", 9)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(5, 4)) * 3
    point = lambda i: (centres[i % 5] + rng.normal(size=4) * 0.3).tolist()
    seeds = spark.createDataFrame([(f"s{i:03d}", point(i)) for i in range(90)], "image string, embedding array<float>")
    items = spark.createDataFrame([(f"i{i:03d}", point(i)) for i in range(60)] + [("none", None)], "image string, embedding array<float>")
    whole = {tuple(r) for r in review.nearest_seeds(items, seeds, 4).collect()}
    blocks = {tuple(r) for r in review.nearest_seeds(items, seeds, 4, max_bytes=8 * 4 * 11).collect()}
    assert whole == blocks and len(whole) == 240


def test_votes_without_seeds(items, seeds):
    none = review.seed_votes(items, seeds.where("false"), CATS, 3)
    assert none.count() == 120 and review.votes_long(none).count() == 0


def test_consensus_ties(spark):
    rows = [("b", 0, "c", "x"), ("a", 0, "c", "y"), ("d", 0, "c", "x"), ("e", 0, "c", "y"), ("f", 1, "c", "z")]
    df = spark.createDataFrame(rows, "image string, cluster_id int, category string, label string")
    got = {r["cluster_id"]: (r["label"], r["ratio"], r["count"], r["total"]) for r in review.cluster_consensus(df).collect()}
    assert got == {0: ("y", 0.5, 2, 4), 1: ("z", 1.0, 1, 1)}


def test_seed_rules(spark):
    from spark_curate.sources import schemas as S

    rows = [
        ("ok", "accepted", None, None, {"c": " x ", "d": "u"}, True),
        ("blank", "accepted", None, None, {"c": "x", "d": " "}, True),
        ("short", "accepted", None, None, {"c": "x"}, True),
        ("rej", "rejected", None, None, {"c": "x", "d": "u"}, True),
        ("no", "accepted", None, None, {"c": "x", "d": "u"}, False),
        ("unknown", "accepted", None, None, {"c": "x", "d": "u"}, True),
    ]
    sample = spark.createDataFrame(rows, S.SAMPLE)
    known = sample.where("image != 'unknown'")
    got = review.annotation_seeds(sample, known, CATS).collect()
    assert [(r["image"], r["truth"]) for r in got] == [("ok", {"c": "x", "d": "u"})]
    with pytest.raises(ValueError):
        review.require_seeds(review.annotation_seeds(sample, known, CATS), review.ReviewSettings())


def test_weights(spark):
    acc = spark.createDataFrame([("a", 0.599), ("b", 0.60), ("c", None)], "category string, accuracy double")
    got = {r["category"]: (round(r["weight"], 6), r["review_only"]) for r in review.category_weights(acc, ("a", "b", "c", "d")).collect()}
    assert got == {"a": (1.401, True), "b": (1.4, False), "c": (1.3, False), "d": (1.3, False)}


def test_gate_boundaries(spark):
    s = review.ReviewSettings()
    schema = "name string, cl string, cr double, sl string, sr double, ss double, m double"
    rows = [
        ("all", "x", 0.8, "x", 0.8, 0.28, 0.03),
        ("none", None, None, None, None, None, None),
        ("off", "x", 0.79, "y", 0.9, 0.27, 0.02),
        ("blank", "", 0.9, "y", 0.7, 0.3, 0.04),
    ]
    df = spark.createDataFrame(rows, schema)
    gate = review.gate_reasons(s, F.col("name") == "never", *[F.col(c) for c in ("cl", "cr", "sl", "sr", "ss", "m")])
    got = {r["name"]: r["g"] for r in df.select("name", gate.alias("g")).collect()}
    assert got["all"] == []
    assert got["none"] == ["no_cluster_consensus", "no_seed_vote", "cluster_ratio_low", "seed_ratio_low", "seed_similarity_low", "margin_low"]
    assert got["off"] == ["cluster_seed_disagree", "cluster_ratio_low", "seed_similarity_low", "margin_low"]
    assert got["blank"] == ["no_cluster_consensus", "seed_ratio_low"]


def queue_of(spark, **over):
    """Queue of one item 'a' with given facts for category c (weight 1)."""
    facts = dict(pred="x", margin=0.05, cluster=("x", 0.9), seed=("x", 1.0, 0.5, 7), distance=0.5, p90=1.0, limit=1.0)
    facts.update(over)
    records = spark.createDataFrame([("a", {"c": facts["pred"]}, {"c": facts["margin"]})], "image string, predicted map<string,string>, margins map<string,double>")
    assigned = spark.createDataFrame([("a", 0, facts["distance"])], "image string, cluster_id int, distance double")
    votes = spark.createDataFrame(
        [("a", {"c": facts["seed"]} if facts["seed"] else {})],
        "image string, votes map<string,struct<label:string,ratio:double,similarity:double,support:bigint>>",
    )
    consensus = spark.createDataFrame([(0, "c", *facts["cluster"])], "cluster_id int, category string, label string, ratio double")
    profile = spark.createDataFrame([(0, facts["p90"], facts["limit"], 0.5)], "cluster_id int, p90_distance double, outlier_threshold double, seed_coverage double")
    weights = {"c": (1.0, over.get("only", False))}
    return review.review_queue(records, assigned, votes, consensus, profile, weights)


def test_risk_terms(spark):
    clean = queue_of(spark).first()
    assert clean["priority_score"] == 0.0 and clean["reasons"] == [] and not clean["is_outlier"]
    tip = clean["suggestions"][0]
    assert (tip["label"], tip["margin"]) == ("x", 0.05)
    assert tip["confidence"] == pytest.approx(0.4 * 0.9 + 0.35 + 0.25 * (0.22 / 0.72), abs=1e-4)
    off = queue_of(spark, pred="y", seed=("z", 1.0, 0.5, 7)).first()
    assert off["priority_score"] == pytest.approx(0.65 + 0.85 + 0.75)
    assert off["flagged_categories"] == ["c"] and off["uncertainty_signal_count"] == 2
    low = queue_of(spark, margin=0.0).first()
    assert low["priority_score"] == pytest.approx(1.2)
    missing = queue_of(spark, margin=None).first()
    assert missing["priority_score"] == pytest.approx(0.2) and missing["flagged_categories"] == []
    edge = queue_of(spark, distance=1.0).first()
    assert edge["is_outlier"] and edge["priority_score"] == pytest.approx(0.9) and edge["exemplar_score"] == 0.0
    far = queue_of(spark, distance=9.0).first()
    assert far["priority_score"] == pytest.approx(2.4)
    zero = queue_of(spark, distance=0.0, p90=0.0, limit=0.0).first()
    assert zero["exemplar_score"] == 1.0 and not zero["is_outlier"]
    only = queue_of(spark, only=True, pred="y", margin=None).first()
    assert only["priority_score"] == 1.0 and only["reasons"] == ["c:review_only"] and only["suggestions"] == []


def test_disagreement_counts_twice_in_concentration(spark):
    off = queue_of(spark, seed=("z", 1.0, 0.5, 7))
    score = off.select(review.uncertainty_score(F.col("reasons"), F.col("is_outlier")).alias("s")).first()["s"]
    assert score == 3.0  # pred_vs_seed, the disagreement, and the blocked text naming it
    assert off.first()["uncertainty_signal_count"] == 1


def test_concentration(spark):
    rows = [(f"i{i:03d}", float(i // 10), ["c:low_margin"] if i >= 80 else [], False) for i in range(100)]
    df = spark.createDataFrame(rows, "image string, priority_score double, reasons array<string>, is_outlier boolean")
    got = review.priority_concentration(df).first()
    assert got["top_slice_size"] == 10
    assert got["baseline_uncertainty_rate"] == 0.2 and got["top_slice_uncertainty_rate"] == 1.0
    assert got["concentration_factor"] == 5.0 and got["passes"]
    few = review.priority_concentration(df.limit(4)).first()
    assert few["top_slice_size"] == 4 and few["concentration_factor"] is None and not few["passes"]


def test_fingerprint(spark):
    df = spark.createDataFrame([("a", {"x": 1, "y": 2}), ("b", {})], "image string, m map<string,int>")
    same = spark.createDataFrame([("b", {}), ("a", {"y": 2, "x": 1})], df.schema).repartition(3)
    other = spark.createDataFrame([("b", {}), ("a", {"y": 3, "x": 1})], df.schema)
    assert review.unchanged(review.fingerprint(df), review.fingerprint(same))
    assert not review.unchanged(review.fingerprint(df), review.fingerprint(other))


def test_settings_are_checked():
    for bad in ({"vote_ratio_min": 0.0}, {"vote_ratio_min": 1.1}, {"outlier_quantile_max": 1.0}):
        with pytest.raises(ValueError):
            review.ReviewSettings(**bad)
    for bad in ({"k_min": 1}, {"k_min": 5, "k_max": 4}):
        with pytest.raises(ValueError):
            clustering.ClusterSettings(**bad)


def plain_silhouette(x, labels):
    d = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    out = []
    for i, own in enumerate(labels):
        same = (labels == own) & (np.arange(len(x)) != i)
        if not same.any():
            out.append(0.0)
            continue
        a = d[i][same].mean()
        b = min(d[i][labels == other].mean() for other in set(labels) - {own})
        out.append((b - a) / max(a, b))
    return float(np.mean(out))


def test_cluster_quality(spark):
    x = unit_rows(4, 150, 5)
    labels = np.asarray([i % 4 if i else 9 for i in range(150)])
    df = spark.createDataFrame([(f"{i}", v.tolist(), int(c)) for i, (v, c) in enumerate(zip(x, labels))], "image string, features array<double>, cluster_id int")
    assert clustering.silhouette(df) == pytest.approx(plain_silhouette(x, labels))
    means = {c: x[labels == c].mean(axis=0) for c in set(labels)}
    between = sum((labels == c).sum() * ((m - x.mean(axis=0)) ** 2).sum() for c, m in means.items())
    within = sum(((x[labels == c] - m) ** 2).sum() for c, m in means.items())
    want = between / (len(means) - 1) / (within / (150 - len(means)))
    assert clustering.dispersion_ratio(df) == pytest.approx(want)
    assert clustering.silhouette(df.where("cluster_id = 1")) == -1.0


def test_select_k_finds_clear_groups(spark):
    rng = np.random.default_rng(8)
    centres = np.eye(4) * 10
    rows = [(f"{i:03d}", (centres[i % 4] + rng.normal(size=4) * 0.1).tolist()) for i in range(120)]
    df = spark.createDataFrame(rows, "image string, embedding array<float>")
    settings = clustering.ClusterSettings(k_min=2, k_max=6, pca_dim=3, restarts=2, max_iter=20)
    features = clustering.reduce_dimensions(df, settings)
    k, model, table = clustering.select_best_k(features, settings)
    assert k == 4 and [r["k"] for r in table.orderBy("k").collect()] == [2, 3, 4, 5, 6]
    vectors = features.select(array_to_vector("features").alias("features"))
    spark_cost = KMeans(k=4, seed=1, initSteps=5, maxIter=20).fit(vectors).summary.trainingCost
    assert model.cost == pytest.approx(spark_cost)
    placed = clustering.assign(features, model)
    assert placed.agg(F.sum(F.col("distance") ** 2)).first()[0] == pytest.approx(model.cost)
    fallback = clustering.ClusterSettings(k_min=300, k_max=400, pca_dim=3, restarts=1, max_iter=5)
    assert clustering.select_best_k(features.limit(5), fallback)[0] == 4


def plain_lloyd(x, centres, passes):
    for _ in range(passes):
        at = ((x[:, None, :] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
        moved = np.array([x[at == c].mean(axis=0) if (at == c).any() else centres[c] for c in range(len(centres))])
        if np.sqrt(((moved - centres) ** 2).sum(axis=1)).max() <= kmeans.TOLERANCE:
            return moved
        centres = moved
    return centres


def test_models_side_by_side_are_fitted_like_alone(spark):
    x = unit_rows(21, 400, 6)
    df = spark.createDataFrame([(f"{i}", v.tolist()) for i, v in enumerate(x)], "image string, features array<double>").repartition(20)
    tasks = kmeans.task_count(df)
    assert tasks > kmeans.FAN  # sums of tasks are added in groups first
    points, weights = kmeans.candidates(df, tasks, 12, 5)
    assert weights.sum() == 400 and len(points) == 48 and len(np.unique(points, axis=0)) == 48
    fits = kmeans.fit_all(df, [2, 5, 6], 3, 40, 5)
    points, weights = kmeans.candidates(df, tasks, 12, 5)
    assert [(m.k, m.restart) for m in fits] == [(k, r) for k in (2, 5, 6) for r in range(3)]
    for m in fits:
        start = kmeans.seeded(points, weights, m.k, np.random.default_rng([5, m.k, m.restart]))
        want = plain_lloyd(x, start, 40)
        assert np.allclose(m.centres, want)
        squares = ((x[:, None, :] - want[None]) ** 2).sum(axis=2)
        assert m.cost == pytest.approx(squares.min(axis=1).sum()) and m.counts.sum() == 400
    best = [min((m for m in fits if m.k == k), key=lambda m: m.cost) for k in (2, 5, 6)]
    for m, (sil, ratio) in zip(best, kmeans.quality_all(df, best)):
        placed = df.join(clustering.assign(df, m), "image")
        assert sil == pytest.approx(clustering.silhouette(placed)) and ratio == pytest.approx(clustering.dispersion_ratio(placed))


def test_equal_rows_and_tiny_tables(spark):
    same = spark.createDataFrame([(f"{i}", [1.0, 2.0]) for i in range(9)], "image string, features array<double>")
    models = kmeans.fit_all(same, [2, 3], 2, 5, 1)
    assert all(m.cost == pytest.approx(0) and m.counts.sum() == 9 for m in models)
    assert kmeans.quality_all(same, models) == [(-1.0, 0.0)] * 4
    k, model, _ = clustering.select_best_k(same, clustering.ClusterSettings(k_min=2, k_max=3, restarts=1))
    assert k == 2 and clustering.assign(same, model).where("distance > 1e-9").count() == 0


def test_cluster_queries_search_the_whole_range(spark):
    import __spark_entry__ as entry

    folder = entry.SMALL.replace("sf0.001", "sf0.01")
    table = entry.queries()["select_k"](spark, folder).collect()
    assert sorted(r["k"] for r in table) == list(range(18, 41))
    best = max(table, key=lambda r: (r["objective"], -r["k"]))["k"]
    placed = entry.queries()["kmeans_assignments"](spark, folder)
    assert placed.agg(F.max("cluster_id")).first()[0] == best - 1


def test_cluster_review_run(spark, tmp_path):
    from spark_curate.catalog import inputs as I
    from spark_curate.operators import evaluation as ev
    from spark_curate.operators import monitor
    from spark_curate.sources import writers

    folder = "/root/testdata/sf0.001"
    records, sample = I.records(spark, folder), I.sample(spark, folder)
    run = steps.cluster_review(
        records, I.items(spark, folder), sample,
        ev.label_accuracy(ev.comparisons(sample)), I.CATEGORIES,
        clustering.ClusterSettings(k_min=4, k_max=6, k_step=2, pca_dim=8, restarts=1, max_iter=10),
        review.ReviewSettings(vote_ratio_min=0.2, similarity_min=0.0, margin_min=0.001),
    )
    assert run.unchanged and run.k in (4, 6)
    assert run.tables["review_queue"].count() == 500
    assert run.tables["clusters"].agg(F.sum("size")).first()[0] == 500
    scores = [r["priority_score"] for r in run.tables["review_queue"].collect()]
    assert scores == sorted(scores, reverse=True)
    writers.write_run(run.tables, str(tmp_path), "20240101T000000Z")
    writers.write_run({"clusters": run.tables["clusters"].limit(1)}, str(tmp_path), run.run_id)
    stored = spark.read.parquet(f"{tmp_path}/clusters")
    assert monitor.latest_run(stored).count() == 1
    with pytest.raises(ValueError):
        steps.cluster_review(
            records, I.items(spark, folder).where("vec_id > 0"), sample,
            ev.label_accuracy(ev.comparisons(sample)), I.CATEGORIES,
        )


def test_reduced_rows_are_dealt_to_the_cores(spark, tmp_path):
    """Vectors of one file and row group are not one task of every k-means pass."""
    vectors = spark.range(4 * clustering.TASK_ROWS).coalesce(1).select(
        F.col("id").cast("string").alias("image"), F.array(*[F.rand(i) for i in range(4)]).alias("embedding")
    )
    vectors.write.parquet(str(tmp_path / "one"))
    one = spark.read.parquet(str(tmp_path / "one"))
    features = clustering.reduce_dimensions(one, clustering.ClusterSettings(pca_dim=4))
    sizes = features.groupBy(F.input_file_name()).count().select("count").collect()
    assert len(sizes) == 4 and max(r[0] for r in sizes) < 2 * clustering.TASK_ROWS
    assert features.count() == 4 * clustering.TASK_ROWS


def test_places_are_those_of_double_precision():
    """Single precision decides nothing it cannot: ties, near ties, far offsets, huge and equal rows."""
    rng = np.random.default_rng(3)
    x = unit_rows(31, 700, 6)
    grid = np.array(np.meshgrid(*[np.arange(4.0)] * 3)).reshape(3, -1).T
    line = np.concatenate([np.zeros(40), 1.0 + np.arange(40) * 1e-13])[:, None]
    for rows in (x, x * 1e-6 + 1e4, x * 1e25, grid, grid + 1e8, line, np.ones((9, 2))):
        models = [rows[rng.integers(len(rows), size=k)] for k in (1, 2, 5, 5, 70)]
        models[2][:] = models[2].mean(axis=0)  # all centres equal: the first
        found = kmeans.Places(models)(rows)
        for at, centres in zip(found, models):
            assert (at == ((rows[:, None, :] - centres) ** 2).sum(axis=2).argmin(axis=1)).all()


def test_sums_from_kept_places(spark):
    """Rows that moved since their places were kept are found, and nothing else is added."""
    x = unit_rows(33, 300, 5)
    df = spark.createDataFrame([(f"{i}", v.tolist()) for i, v in enumerate(x)], "image string, features array<double>").repartition(3)
    before = {0: x[:4], 2: x[10:17], 5: x[20:22]}
    found, share = kmeans.one_pass(df, 3, before, None)
    assert share == 1.0
    rows = kmeans.placed(df, spark.sparkContext.broadcast(kmeans.Places(list(before.values()))))
    kept = kmeans.Kept(rows, np.dtype("uint8"), {m: i for i, m in enumerate(before)}, found)
    after = {5: before[5] + 0.05, 2: before[2][::-1].copy()}  # model 0 rests; all rows of model 2 move
    again, share = kmeans.one_pass(df, 3, after, kept)
    plain, _ = kmeans.one_pass(df, 3, after, None)
    assert list(again) == [5, 2] and 0.0 < share < 1.0
    for m, centres in after.items():
        at = ((x[:, None, :] - centres) ** 2).sum(axis=2).argmin(axis=1)
        want = np.array([[*x[at == c].sum(axis=0), (at == c).sum()] for c in range(len(centres))])
        assert np.allclose(again[m], want) and np.allclose(plain[m], want)
    moved = np.mean([(((x[:, None] - before[m]) ** 2).sum(axis=2).argmin(axis=1) != ((x[:, None] - after[m]) ** 2).sum(axis=2).argmin(axis=1)) for m in after])
    assert share == pytest.approx(moved)


def test_passes_leave_nothing_behind(spark):
    """Centres sent for a pass are dropped after it, on the driver and on disk, as are kept places."""
    x = unit_rows(35, 200, 64)
    df = spark.createDataFrame([(f"{i}", v.tolist()) for i, v in enumerate(x)], "image string, features array<double>").coalesce(2).cache()
    df.count()
    sent = lambda: {f for _, _, files in os.walk(spark.sparkContext._temp_dir) for f in files}
    cached = lambda: set(spark.sparkContext._jsc.getPersistentRDDs().keys())
    before = sent(), cached()
    fits = kmeans.fit_all(df, [100], 20, 3, 1)  # more than the megabyte from which Spark sends a closure by broadcast
    assert len(fits) == 20 and (sent() - before[0], cached() - before[1]) == (set(), set())
    df.unpersist()
