"""Global numbering, paging and exact quantiles."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from spark_curate.operators import sequence


def test_global_sequence(spark):
    df = spark.range(5000).repartition(13).withColumn("k", F.col("id") % 7)
    got = sequence.global_sequence(df, ["k", "id"]).collect()
    want = sorted((r["k"], r["id"]) for r in got)
    assert [(r["k"], r["id"]) for r in sorted(got, key=lambda r: r["seq"])] == want
    assert sorted(r["seq"] for r in got) == list(range(1, 5001))


@pytest.mark.parametrize("bounded", [20, 10000])
def test_exact_quantiles(spark, bounded):
    rng = random.Random(5)
    rows = [("hot", rng.random()) for _ in range(3000)]
    rows += [("tied", float(rng.randint(0, 3))) for _ in range(1000)]
    rows += [("same", 2.5)] * 200 + [("one", 7.0), ("two", 1.0), ("two", 2.0), ("none", None)]
    rows += [("far", rng.choice([-1, 1]) * 10.0 ** rng.uniform(-300, 300)) for _ in range(500)]
    rows += [("odd", v) for v in [float("inf")] * 30 + [-1.7e308, 1.7e308] * 20 + [0.5] * 40 + [rng.random() for _ in range(90)]]
    df = spark.createDataFrame(rows, "k string, v double")
    asked = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p90": 0.9, "p95": 0.95, "p100": 1.0}
    got = {r["k"]: r for r in sequence.exact_quantiles(df, ["k"], "v", asked, bounded).collect()}
    assert set(got) == {"hot", "tied", "same", "one", "two", "far", "odd"}
    for key, row in got.items():
        values = [v for k, v in rows if k == key]
        assert row["n"] == len(values)
        for name, p in asked.items():
            place = p * (len(values) - 1)
            ends = [sorted(values)[int(f)] for f in (np.floor(place), np.ceil(place))]
            want = ends[0] if ends[0] == ends[1] else ends[0] + (ends[1] - ends[0]) * (place - int(place))
            assert row[name] == pytest.approx(want, rel=1e-9, abs=1e-12, nan_ok=True) or np.isinf(want), (key, name)


def test_a_missed_bracket_is_mended(spark):
    """Brackets that do not hold their rank, on either side, and ones that do."""
    df = spark.createDataFrame([("k", float(i)) for i in range(1000)], "k string, _v double")
    brackets = [(0, 500, 700.0, 800.0), (1, 500, 20.0, 30.0), (2, 500, 480.0, 520.0), (3, 0, 5.0, 5.0), (4, 999, 1.0, 1.0)]
    wanted = spark.createDataFrame(
        [("k", 1000, 0.0, 999.0, *b) for b in brackets],
        "k string, n bigint, _min double, _max double, j int, rank bigint, lo double, hi double",
    )
    got = {r["j"]: r["_v"] for r in sequence._select(df, wanted, ["k"], 7).collect()}
    assert got == {0: 500.0, 1: 500.0, 2: 500.0, 3: 0.0, 4: 999.0}


def test_no_window_over_a_key(spark):
    df = spark.createDataFrame([("k", float(i)) for i in range(300)], "k string, v double")
    plan = sequence.exact_quantiles(df, ["k"], "v", {"p50": 0.5}, 10)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_pages(spark):
    df = spark.range(50)
    assert [r["id"] for r in sequence.page(df, ["id"], 3, 20).collect()] == list(range(40, 50))
    info = sequence.page_info(df, 9, 20, clamp=True).first()
    assert (info["total"], info["page"], info["pages"]) == (50, 3, 3)
    empty = sequence.page_info(df.where("id < 0"), 2, 20).first()
    assert (empty["total"], empty["page"], empty["pages"]) == (0, 2, 1)
