"""Writers: labels, embeddings, logs, exports, manifests, runs and metrics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spark_curate.functions import columns as C
from spark_curate.operators import labeling
from spark_curate.operators.scoring import Thresholds
from spark_curate.sources import schemas as S


def wide_labels(records: DataFrame, categories: Sequence[str], scores: bool = True) -> DataFrame:
    """Records with one column per category, as the label files hold them."""
    tail = ["scores"] if scores else []
    return records.select(
        "image", *[C.lookup(F.col("predicted"), c, C.UNKNOWN).alias(c) for c in categories], *tail
    )


def write_labels(records: DataFrame, folder: str, categories: Sequence[str]) -> None:
    """Label table as JSON lines (``labels.json``) and as parquet (``labels``)."""
    wide_labels(records, categories).write.mode("overwrite").json(f"{folder}/labels.json")
    records.write.mode("overwrite").parquet(f"{folder}/labels")


def write_embeddings(
    records: DataFrame,
    vectors: DataFrame,
    path: str,
    model_name: str | None = None,
    pretrained: str | None = None,
) -> None:
    """Vectors of labelled images with their origin."""
    labeling.labelled_embeddings(records, vectors).select(
        "image",
        F.col("embedding").cast("array<float>").alias("embedding"),
        F.lit(model_name).cast("string").alias("model_name"),
        F.lit(pretrained).cast("string").alias("pretrained"),
        F.current_timestamp().alias("generated_at"),
    ).write.mode("overwrite").parquet(path)


def _bool_text(c: Column) -> Column:
    return F.when(c, "True").otherwise("False")


def target_log_rows(decisions: DataFrame) -> DataFrame:
    """Rows of the target log: scores with four decimals, ``overlay`` as its own state."""
    return decisions.select(
        F.col("image").alias("filename"),
        C.four_places(F.col("positive")).alias("positive_score"),
        C.four_places(F.col("negative")).alias("negative_score"),
        F.when(F.col("reason") == "overlay", "overlay").otherwise(_bool_text(F.col("kept"))).alias("kept"),
    )


def overlay_log_rows(decisions: DataFrame) -> DataFrame:
    return decisions.where(F.col("overlay").isNotNull()).select(
        F.col("image").alias("filename"),
        C.four_places(F.col("overlay")).alias("overlay_score"),
        C.four_places(F.col("clean")).alias("clean_score"),
        _bool_text(F.col("flagged")).alias("flagged"),
    )


def write_decision_logs(decisions: DataFrame, folder: str) -> None:
    for name, rows in (
        ("target_filter.csv", target_log_rows(decisions)),
        ("overlay_filter.csv", overlay_log_rows(decisions)),
    ):
        rows.write.mode("overwrite").option("header", True).csv(f"{folder}/{name}")


def append_filter_run(
    spark: SparkSession, path: str, thresholds: Thresholds, source_step: str, source_dir: str,
    persist_kept_images: bool = False,
) -> None:
    """One row per filter run with the settings it used."""
    row = (
        thresholds.threshold, thresholds.overlay_margin, source_step, source_dir,
        persist_kept_images, None,
    )
    spark.createDataFrame([row], S.FILTER_RUNS).withColumn(
        "generated_at", F.current_timestamp()
    ).write.mode("append").parquet(path)


def write_survivors(survivors: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace the output of a step by its survivors.

    Partitioned outputs are replaced partition by partition.
    """
    writer = survivors.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def write_groups(groups: DataFrame, path: str) -> None:
    """Duplicate groups as JSON lines, one bounded piece per line."""
    groups.write.mode("overwrite").json(path)


def write_export(clean: DataFrame, full: DataFrame, folder: str) -> None:
    """Clean JSON, clean CSV and full JSON; empty tables still leave their files."""
    clean.write.mode("overwrite").json(f"{folder}/labels.json")
    clean.write.mode("overwrite").option("header", True).csv(f"{folder}/labels.csv")
    full.write.mode("overwrite").json(f"{folder}/labels_full.json")


def save_manifest(manifest: DataFrame, path: str, version: str) -> None:
    """A new version of the manifest next to the older ones."""
    manifest.select(*S.MANIFEST.names).write.mode("overwrite").parquet(f"{path}/version={version}")


def write_run(tables: Mapping[str, DataFrame], folder: str, run_id: str) -> None:
    """Tables of a cluster run, each partitioned by its run."""
    for name, table in tables.items():
        table.withColumn("run_id", F.lit(run_id)).write.mode("overwrite").partitionBy("run_id").option(
            "partitionOverwriteMode", "dynamic"
        ).parquet(f"{folder}/{name}")


def write_metrics(tables: Mapping[str, DataFrame], folder: str, digits: int = 4) -> None:
    """Metric tables as JSON with rounded numbers, one folder per table."""
    for name, table in tables.items():
        shown = [
            (F.round(f"`{f.name}`", digits) if f.dataType.typeName() == "double" else F.col(f"`{f.name}`")).alias(f.name)
            for f in table.schema.fields
        ]
        table.select(*shown).write.mode("overwrite").json(f"{folder}/{name}")
