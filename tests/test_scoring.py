"""Decision rules at their boundaries, margins and labelling ties."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from spark_curate.operators import labeling, scoring

T = scoring.Thresholds(0.25, 0.125)
SCORES = "image string, positive double, negative double, overlay double, clean double"


def decide(spark, rows, existing=None):
    df = spark.createDataFrame(rows, SCORES)
    return {r["image"]: r for r in scoring.filter_decisions(df, T, existing).collect()}


def test_decision_reasons(spark):
    done = spark.createDataFrame([("old",), ("flag",)], "image string")
    got = decide(
        spark,
        [
            ("at", 0.25, 0.1, 0.0, 0.0),
            ("equal", 0.3, 0.3, 0.0, 0.0),
            ("low", 0.2, 0.1, 0.0, 0.0),
            ("edge", 0.3, 0.1, 0.25, 0.125),
            ("flag", 0.3, 0.1, 0.26, 0.125),
            ("old", 0.0, 0.1, 0.0, 0.0),
            ("bad", None, None, None, None),
        ],
        done,
    )
    reasons = {k: r["reason"] for k, r in got.items()}
    assert reasons == {
        "at": "passed", "equal": "low_score", "low": "low_score", "edge": "passed",
        "flag": "overlay", "old": "resume_existing", "bad": "load_error",
    }
    assert got["flag"]["positive"] is None and got["old"]["positive"] is None
    assert got["old"]["kept"] and not got["bad"]["kept"]
    counts = scoring.decision_counts(
        spark.createDataFrame(list(got.values()), "image string, positive double, negative double, overlay double, clean double, flagged boolean, kept boolean, reason string")
    ).first()
    assert tuple(counts) == (7, 3, 2, 1, 1)


def test_margin_analysis(spark):
    rows = [
        ("kept", 0.5, 0.25, 0.0, 0.0, False, True, "passed"),
        ("tie", 0.125, 0.25, 0.0, 0.0, False, False, "low_score"),
        ("flag", None, None, 0.5, 0.25, True, False, "overlay"),
        ("logged", 0.5, 0.25, None, None, True, False, "overlay"),
        ("blank", None, None, None, None, False, False, "load_error"),
        ("mid", 0.2, 0.1, 0.0, 0.0, False, False, "low_score"),
    ]
    schema = SCORES + ", flagged boolean, kept boolean, reason string"
    got = {
        r["image"]: (r["rejection_mode"], r["nearest_boundary"], r["decision_band"], r["kept_by_rule"])
        for r in scoring.margin_analysis(spark.createDataFrame(rows, schema), T).collect()
    }
    # kept: threshold slack .25 ties the gap .25; overlay slack .125 is smaller.
    assert got["kept"] == ("unknown", "overlay_margin", "clear", True)
    # equal deficits: the gap wins the mode, the first listed wins the boundary.
    assert got["tie"] == ("target_vs_negative", "target_threshold", "clear", False)
    assert got["flag"] == ("overlay_margin", "overlay_margin", "clear", False)
    assert got["logged"] == ("overlay_margin", "unknown", "unknown", False)
    assert got["blank"] == ("unknown", "unknown", "unknown", False)
    assert got["mid"] == ("target_threshold", "target_threshold", "moderate", False)


def prompts(spark, rows):
    return spark.createDataFrame(
        rows, "category string, label string, label_ord int, prompt_ord int, embedding array<double>"
    )


def test_label_ties_go_to_declaration_order(spark):
    items = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 1.0]), ("c", None)], "image string, embedding array<float>")
    table = prompts(
        spark,
        [
            ("c1", "late", 1, 0, [0.50001, 0.0]), ("c1", "early", 0, 0, [0.5, 0.2]),
            ("c2", "only", 0, 0, [0.3, 0.3]), ("c2", "only", 0, 1, [0.1, 0.1]),
        ],
    )
    got = {r["image"]: r for r in labeling.label_records(items, table).collect()}
    assert set(got) == {"a", "b"}
    one = got["a"]["scores"]["c1"]
    assert (one["assigned"], one["runner_up"], one["confidence"]) == ("early", "late", 0.5)
    two = got["a"]["scores"]["c2"]
    assert (two["assigned"], two["runner_up"], two["runner_up_score"]) == ("only", None, None)
    assert two["confidence"] == pytest.approx(0.2)
    margins = {(r["image"], r["category"]): r["margin"] for r in labeling.margins(labeling.label_records(items, table)).collect()}
    assert margins["a", "c1"] == 0.0 and margins["a", "c2"] is None


def test_blocks_give_the_same_labels(spark):
    rng = np.random.default_rng(0)
    items = spark.createDataFrame([(f"i{i}", rng.normal(size=6).tolist()) for i in range(40)], "image string, embedding array<float>")
    table = prompts(
        spark, [(f"c{c}", f"l{i}", i, p, rng.normal(size=6).tolist()) for c in range(3) for i in range(5) for p in range(2)]
    )
    whole = {r["image"]: r["scores"] for r in labeling.label_records(items, table).collect()}
    pieces = {r["image"]: r["scores"] for r in labeling.label_records(items, table, max_bytes=8 * 6 * 6).collect()}
    assert whole == pieces
    ranked = labeling.rank_labels(labeling.label_scores(items, table))
    for r in ranked.collect():
        assert whole[r["image"]][r["category"]]["assigned"] == r["assigned"]


def test_resume_keeps_existing(spark):
    items = spark.createDataFrame([("a", [1.0]), ("b", [1.0])], "image string, embedding array<float>")
    table = prompts(spark, [("c", "x", 0, 0, [1.0]), ("c", "y", 1, 0, [0.5])])
    old = labeling.label_records(items.where("image = 'a'"), table).withColumn(
        "predicted", F.create_map(F.lit("c"), F.lit("manual"))
    )
    got = {r["image"]: r["predicted"]["c"] for r in labeling.resume_labels(items, table, old).collect()}
    assert got == {"a": "manual", "b": "x"}


def test_empty_kept_labels_nothing(spark):
    items = spark.createDataFrame([("a", [1.0])], "image string, embedding array<float>")
    assert labeling.keep_only(items, items.where("false")).count() == 0
