"""Sample, annotation and metric rules, ties and nulls."""

import pytest
from pyspark.sql import functions as F

from spark_curate.operators import evaluation as ev
from spark_curate.sources import schemas as S


def sample(spark, rows):
    return spark.createDataFrame(rows, S.SAMPLE)


def row(image, source="accepted", pred=None, conf=None, truth=None, hit=None):
    return (image, source, pred, conf, truth, hit)


def test_filter_metric_nulls(spark):
    only = ev.filter_metrics(sample(spark, [row("a", hit=True), row("b", hit=False), row("c")])).first()
    assert (only["precision"], only["recall"], only["f1"], only["rejected_evaluated"]) == (0.5, None, None, 0)
    none = ev.filter_metrics(
        sample(spark, [row("a", hit=False), row("b", "rejected", hit=False)])
    ).first()
    assert (none["precision"], none["recall"], none["f1"]) == (0.0, None, None)
    zero = ev.filter_metrics(
        sample(spark, [row("a", hit=False), row("b", "rejected", hit=True)])
    ).first()
    assert (zero["recall"], zero["f1"]) == (0.0, None)


def test_label_metrics(spark):
    rows = [
        row("a", pred={"c": "x"}, conf={"c": 0.20}, truth={"c": "x"}, hit=True),
        row("b", pred={"c": "y"}, conf={"c": 1.0}, truth={"c": "x"}, hit=True),
        row("d", pred={"c": "z"}, conf={"c": -0.1}, truth={"c": "w"}, hit=True),
        row("e", pred={"c": "x"}, conf={"c": 0.30}, truth={"c": "x"}, hit=True),
        row("f", "rejected", truth={"c": "x"}, hit=True),
        row("g", pred={"c": "x"}, truth={"c": "x"}, hit=False),
    ]
    df = sample(spark, rows)
    compared = ev.comparisons(df, ("c", "d"))
    acc = {r["category"]: tuple(r)[1:] for r in ev.label_accuracy(compared, ("c", "d")).collect()}
    assert acc == {"c": (0.5, 2, 4), "d": (0.0, 0, 0)}
    per = {r["label"]: (r["precision"], r["recall"], r["support"]) for r in ev.per_label_metrics(ev.confusion(compared)).collect()}
    assert per == {"x": (1.0, 0.6667, 3), "y": (0.0, 0.0, 0), "z": (0.0, 0.0, 0), "w": (0.0, 0.0, 1)}
    bins = {r["bin"]: (r["accuracy"], r["n"]) for r in ev.calibration(compared, ("c",)).collect()}
    assert bins["0.20-0.22"] == (1.0, 1) and bins[">0.30"] == (1.0, 1)
    assert sum(n for _, n in bins.values()) == 2 and bins["<0.20"] == (None, 0)
    dense = ev.confusion_dense(ev.confusion(compared))
    assert dense.count() == 16 and dense.where("n = 0").count() == 13
    report = ev.report_tables(df, ("c", "d"))
    assert report["summary"].first()["overall_label_accuracy"] == 0.25
    sizes = report["sample_size"].first()
    assert tuple(sizes) == (6, 5, 1, 5, 4, 1)
    assert report["calibration_grid"].where("bin = '>0.30'").first()["c"] == "100.0% (n=1)"


def test_draw_is_exact_and_repeatable(spark):
    names = spark.range(1000).select(F.format_string("%04d", "id").alias("image"))
    one = {r["image"] for r in ev.draw(names.repartition(5), 100, 42).collect()}
    two = {r["image"] for r in ev.draw(names.repartition(2), 100, 42).collect()}
    assert len(one) == 100 and one == two
    assert one != {r["image"] for r in ev.draw(names, 100, 43).collect()}
    assert ev.draw(names.where("false"), 10, 1).count() == 0


OPTIONS = [("c", "x"), ("c", "y"), ("d", "u")]


def test_annotations(spark):
    df = sample(
        spark,
        [
            row("a", pred={"c": "x", "d": "u"}),
            row("b", pred={"c": "old", "d": "u"}),
            row("e", "rejected"),
            row("f", pred={"c": "x", "d": "u"}, truth={"c": "x", "d": "u"}, hit=True),
            row("g", pred={"c": "x", "d": "u"}),
        ],
    )
    events = spark.createDataFrame(
        [
            ("a", True, {"c": " y "}, "2024-01-01 00:00:01", 1),
            ("a", True, {"c": "wrong"}, "2024-01-01 00:00:02", 2),
            ("b", True, {}, "2024-01-01 00:00:01", 3),
            ("e", True, {"c": "y", "d": "u"}, "2024-01-01 00:00:01", 4),
            ("f", None, {}, "2024-01-01 00:00:01", 5),
            ("g", True, {"c": "y"}, "2024-01-01 00:00:01", 6),
            ("g", False, {"c": "y"}, "2024-01-01 00:00:01", 7),
            ("nobody", True, {"c": "y"}, "2024-01-01 00:00:01", 8),
        ],
        "image string, is_target boolean, labels map<string,string>, ts string, event_id bigint",
    ).withColumn("ts", F.col("ts").cast("timestamp"))
    options = spark.createDataFrame(OPTIONS, "category string, label string")
    joined = events.join(df.select("image", "predicted"), "image", "left")
    sides = [ev.resolve_ground_truth(joined, options, small_rows=n) for n in (ev.SMALL_OPTIONS, 1)]
    near, far = ({r["event_id"]: (r["ground_truth"], r["missing"]) for r in s.collect()} for s in sides)
    assert near == far and len(near) == 8
    done, refused = ev.apply_annotations(df, events, options)
    got = {r["image"]: (r["is_target"], r["ground_truth"]) for r in done.collect()}
    assert got == {
        "a": (True, {"c": "x", "d": "u"}),
        "b": (None, None),
        "e": (True, {"c": "y", "d": "u"}),
        "f": (None, None),
        "g": (False, None),
    }
    errors = {r["event_id"]: (r["error"], r["missing"]) for r in refused.collect()}
    assert errors[3] == ("missing_labels", ["c"])
    assert errors[8][0] == "unknown_image" and set(errors) == {3, 8}


def test_browse_rules(spark):
    df = sample(
        spark,
        [
            row("right", pred={"c": "x"}, truth={"c": "x"}, hit=True),
            row("wrong", pred={"c": "y"}, truth={"c": "x"}, hit=True),
            row("apart", pred={"d": "y"}, truth={"c": "x"}, hit=True),
            row("none", hit=None),
            row("not", hit=False),
        ],
    )

    def names(**filters):
        return {r["image"] for r in df.where(ev.browse_predicate(**filters)).collect()}

    assert names(target="not_target") == {"not"}
    assert names(target="target") == {"right", "wrong", "apart", "none"}
    assert names(correct="correct") == {"right", "none", "not"}
    assert names(correct="incorrect") == {"wrong", "none", "not"}
    assert names(category="d") == {"none", "not"}
    assert names(category="c", correct="incorrect") == {"wrong", "apart", "none", "not"}
    status = {r["image"]: r["status"] for r in ev.match_status(df).collect()}
    assert status == {"right": "match", "wrong": "mismatch", "apart": "mismatch", "none": "unlabelled", "not": "not_target"}


def test_rejected_names(spark):
    log = spark.createDataFrame(
        [("a", "True"), ("b", "False"), ("b", "False"), ("c", "overlay"), (" ", "False"), (None, "x")],
        "filename string, kept string",
    )
    assert {r["image"] for r in ev.rejected_names(log).collect()} == {"b", "c"}
    before = spark.createDataFrame([("s.png",), ("s.jpg",), ("t.webp",), ("u.txt",)], "image string")
    after = spark.createDataFrame([("t.jpg",)], "image string")
    assert [r["image"] for r in ev.rejected_by_difference(before, after).collect()] == ["s.jpg"]


def test_sample_shape(spark):
    records = spark.createDataFrame(
        [("a", {"c": "x"}, {"c": ("x", 0.5, {"x": 0.5}, None, None)})], S.RECORDS
    )
    rejected = spark.createDataFrame([("r",), ("r",)], "image string")
    got = {r["source"]: r for r in ev.eval_sample(records, rejected, ("c", "d")).collect()}
    assert got["accepted"]["predicted"] == {"c": "x", "d": "unknown"}
    assert got["accepted"]["confidence"] == {"c": 0.5}
    assert got["rejected"]["image"] == "r" and got["rejected"]["predicted"] is None


def test_summary_without_data(spark):
    with pytest.raises(ValueError):
        from spark_curate.plans.steps import evaluation_step

        evaluation_step(sample(spark, [row("a")]), ("c",))
