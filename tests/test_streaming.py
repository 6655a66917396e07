"""Incremental labelling and annotation on file streams."""

from pyspark.sql import functions as F

from spark_curate.sources import schemas as S
from spark_curate.streaming import incremental as inc


def test_label_stream(spark, tmp_path):
    src, out, check = (str(tmp_path / n) for n in ("items", "labels", "check"))
    schema = S.struct(image=S.STR, embedding=S.VECTOR)
    prompts = spark.createDataFrame(
        [("c", "x", 0, 0, [1.0, 0.0]), ("c", "y", 1, 0, [0.0, 1.0])],
        "category string, label string, label_ord int, prompt_ord int, embedding array<double>",
    )

    def arrive(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        inc.label_stream(inc.file_stream(spark, src, schema), prompts, out, check).awaitTermination()
        return {r["image"]: r["predicted"]["c"] for r in inc.labels(spark, out).collect()}

    assert arrive([("a", [1.0, 0.0]), ("b", [0.0, 1.0])]) == {"a": "x", "b": "y"}
    got = arrive([("a", [0.0, 1.0]), ("c", [0.0, 1.0])])
    assert got == {"a": "x", "b": "y", "c": "y"}
    assert inc.labels(spark, out).count() == 3


def test_annotation_stream(spark, tmp_path):
    src, out, check = (str(tmp_path / n) for n in ("events", "sample", "check"))
    sample = spark.createDataFrame(
        [("a", "accepted", {"c": "x"}, None, None, None), ("b", "rejected", None, None, None, None)], S.SAMPLE
    )
    options = spark.createDataFrame([("c", "x"), ("c", "y")], "category string, label string")

    def arrive(rows):
        spark.createDataFrame(rows, "image string, is_target boolean, labels map<string,string>, ts string, event_id bigint").withColumn(
            "ts", F.col("ts").cast("timestamp")
        ).coalesce(1).write.mode("append").parquet(src)
        inc.annotation_stream(
            inc.file_stream(spark, src, S.ANNOTATIONS), sample, options, out, check
        ).awaitTermination()
        return {r["image"]: (r["is_target"], r["ground_truth"]) for r in inc.annotated_sample(spark, out, sample).collect()}

    assert arrive([("a", True, {"c": "y"}, "2024-01-01", 1)]) == {"a": (True, {"c": "y"}), "b": (None, None)}
    assert arrive([("b", True, {}, "2024-01-02", 2), ("a", False, {}, "2024-01-03", 3)]) == {"a": (False, None), "b": (None, None)}
    assert arrive([("a", True, {"c": "x"}, "2024-01-02", 9)])["a"] == (False, None), "an older event came late"
    refused = inc.refused_events(spark, out).collect()
    assert [(r["image"], r["error"], r["missing"]) for r in refused] == [("b", "missing_labels", ["c"])]
    before = spark.read.parquet(f"{out}/changes").count()
    got = arrive([("b", True, {"c": "x"}, "2024-01-05", 11), ("b", True, {"c": "y"}, "2024-01-06", 12), ("nobody", True, {"c": "x"}, "2024-01-06", 13)])
    assert got == {"a": (False, None), "b": (True, {"c": "y"})}
    assert spark.read.parquet(f"{out}/changes").count() == before + 2, "a batch writes what it changes"
    # a restart from the same checkpoint with nothing new changes nothing
    assert arrive([]) == got and spark.read.parquet(f"{out}/changes").count() == before + 2


def test_replayed_batch_and_one_batch_agree(spark, tmp_path):
    """All events at once, and dealt to batches in the order of arrival, give the same sample."""
    sample = spark.createDataFrame([(f"i{k}", "accepted", {"c": "x"}, None, None, None) for k in range(6)], S.SAMPLE)
    options = spark.createDataFrame([("c", "x"), ("c", "y")], "category string, label string")
    rows = [(f"i{(7 * k) % 6}", k % 3 > 0, {"c": "xyz"[k % 3]}, f"2024-01-{1 + (5 * k) % 11:02d}", k) for k in range(24)]
    kind = "image string, is_target boolean, labels map<string,string>, ts string, event_id bigint"
    results = []
    for files in (1, 6):
        src, out, check = (str(tmp_path / f"{n}{files}") for n in ("events", "sample", "check"))
        for k in range(files):
            part = spark.createDataFrame(rows[k * 24 // files : (k + 1) * 24 // files], kind)
            part.withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.mode("append").parquet(src)
        stream = inc.file_stream(spark, src, S.ANNOTATIONS, files_per_batch=1)
        inc.annotation_stream(stream, sample, options, out, check).awaitTermination()
        results.append({r["image"]: (r["is_target"], r["ground_truth"]) for r in inc.annotated_sample(spark, out, sample).collect()})
    events = spark.createDataFrame(rows, kind).withColumn("ts", F.col("ts").cast("timestamp"))
    from spark_curate.operators import evaluation as ev

    whole = ev.apply_annotations(sample, events, options)[0].collect()
    assert results[0] == results[1] == {r["image"]: (r["is_target"], r["ground_truth"]) for r in whole}
