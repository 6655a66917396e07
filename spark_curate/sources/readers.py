"""Readers: images, labels, logs, groups, manifests, prompts and settings."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from spark_curate.functions import columns as C
from spark_curate.functions import names as N
from spark_curate.operators import labeling
from spark_curate.operators.scoring import Thresholds
from spark_curate.sources import schemas as S


def _or_empty(spark: SparkSession, load, schema: StructType) -> DataFrame:
    """The loaded table; an empty one if the path does not exist."""
    try:
        return load()
    except AnalysisException as err:
        if "PATH_NOT_FOUND" in str(err):
            return spark.createDataFrame([], schema)
        raise


def _below(path: Column, root: str) -> Column:
    """Part of a file uri below the root folder."""
    plain = re.sub(r"^[a-z0-9]+:/+", "/", root).strip("/")
    return F.regexp_extract(path, rf"^.*?\Q{plain}/\E(.*)$", 1)


# Images


def image_files(
    spark: SparkSession, root: str, suffixes: Sequence[str] = N.IMAGE_SUFFIXES
) -> DataFrame:
    """Image files below ``root``: path (relative), source_path, size, modified.

    Contents are not read. A missing folder gives no rows.
    """
    found = _or_empty(
        spark,
        lambda: spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root),
        S.struct(path=S.STR, modificationTime=S.TIME, length=S.LONG),
    )
    return found.where(N.is_image(F.col("path"), tuple(suffixes))).select(
        _below(F.col("path"), root).alias("path"),
        F.col("path").alias("source_path"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("modified"),
    )


def decoded_images(spark: SparkSession, root: str) -> DataFrame:
    """Decoded images: path, pixels (the image struct), width, height.

    Unreadable files stay as rows with null pixels and dimensions; formats the
    JVM cannot decode (webp) count among them.
    """
    found = (
        spark.read.format("image")
        .option("dropInvalid", "false")
        .option("recursiveFileLookup", "true")
        .load(root)
    )
    readable = F.col("image.width") > 0
    # The origin is a percent-encoded uri in which a plus stands for itself.
    origin = F.url_decode(F.replace("image.origin", F.lit("+"), F.lit("%2B")))
    return found.where(N.is_image(origin)).select(
        _below(origin, root).alias("path"),
        F.when(readable, F.col("image")).alias("pixels"),
        F.when(readable, F.col("image.width")).alias("width"),
        F.when(readable, F.col("image.height")).alias("height"),
    )


def items(images: DataFrame) -> DataFrame:
    """Images with their canonical name as key."""
    return images.withColumn("image", N.canonical_name(F.col("path")))


# Labels and embeddings


def _last_per_key(df: DataFrame, key: str) -> DataFrame:
    """Last row of each key in file order: by file, place in the file, then row.

    Spark packs the splits of files into partitions by size, so the row numbers of
    partitions alone do not follow the files.
    """
    rest = [c for c in df.columns if c != key]
    row = F.monotonically_increasing_id()
    try:
        at = F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), row)
        placed = df.withColumn("_at", at)
    except AnalysisException:  # the empty stand-in of a missing file
        placed = df.withColumn("_at", row)
    return (
        placed.groupBy(key)
        .agg(F.max_by(F.struct(*[F.col(f"`{c}`") for c in rest]), "_at").alias("_r"))
        .select(key, "_r.*")
    )


def label_file(
    spark: SparkSession, path: str, categories: Sequence[str], multi_line: bool = False
) -> DataFrame:
    """A label JSON file, last row per image: one object per line, as the writers write.

    ``multi_line`` reads a file holding one array, which takes one task.
    """
    rows = spark.read.schema(S.label_file(categories)).option("multiLine", multi_line).json(path)
    named = rows.withColumn("image", F.trim("image")).where(F.col("image") != "")
    return _last_per_key(named, "image")


def label_records(
    spark: SparkSession,
    folder: str,
    categories: Sequence[str],
    multi_line: bool = False,
) -> DataFrame:
    """Label records of a step folder, from the full file if there is one.

    Returns image, predicted (missing categories read ``unknown``), margins and
    scores.
    """
    try:
        rows = label_file(spark, f"{folder}/labels_full.json", categories, multi_line)
    except AnalysisException:
        rows = label_file(spark, f"{folder}/labels.json", categories, multi_line)
    return rows.select(
        "image",
        C.map_from_columns((c, C.or_unknown(F.col(f"`{c}`"))) for c in categories).alias("predicted"),
        C.map_from_columns(
            (c, labeling.margin(C.lookup(F.col("scores"), c))) for c in categories
        ).alias("margins"),
        "scores",
    )


def embeddings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.EMBEDDINGS).parquet(path)


def embedding_origin(stored: DataFrame, field: str = "model_name") -> str | None:
    """Model (or weights) the stored embeddings come from; None if not recorded."""
    if field not in stored.columns:
        return None
    return stored.agg(F.max(field)).first()[0]


# Decision logs


def target_log(spark: SparkSession, path: str) -> DataFrame:
    """Target log: image, positive, negative, kept, reason; last row per name."""
    raw = _or_empty(
        spark,
        lambda: spark.read.option("header", True).schema(S.TARGET_LOG).csv(path),
        S.TARGET_LOG,
    )
    named = raw.withColumn("filename", F.trim("filename")).where(F.col("filename") != "")
    kept = C.is_true_text(F.col("kept"))
    overlay = F.lower(F.trim("kept")) == "overlay"
    return _last_per_key(named, "filename").select(
        F.col("filename").alias("image"),
        C.tolerant_double(F.col("positive_score")).alias("positive"),
        C.tolerant_double(F.col("negative_score")).alias("negative"),
        kept.alias("kept"),
        F.when(kept, "passed").when(overlay, "overlay").otherwise("low_score").alias("reason"),
    )


def overlay_log(spark: SparkSession, path: str) -> DataFrame:
    """Overlay log: image, overlay, clean, flagged; last row per name."""
    raw = _or_empty(
        spark,
        lambda: spark.read.option("header", True).schema(S.OVERLAY_LOG).csv(path),
        S.OVERLAY_LOG,
    )
    named = raw.withColumn("filename", F.trim("filename")).where(F.col("filename") != "")
    return _last_per_key(named, "filename").select(
        F.col("filename").alias("image"),
        C.tolerant_double(F.col("overlay_score")).alias("overlay"),
        C.tolerant_double(F.col("clean_score")).alias("clean"),
        C.is_true_text(F.col("flagged")).alias("flagged"),
    )


def kept_names(log: DataFrame) -> DataFrame:
    """Distinct names marked kept in a raw target log (columns filename, kept)."""
    name = F.trim("filename")
    return log.where((name != "") & C.is_true_text(F.col("kept"))).select(name.alias("image")).distinct()


def listing(step_files: DataFrame, log: DataFrame | None = None, labels: DataFrame | None = None) -> DataFrame:
    """Names of a step; without files, the kept names of its log or its labels."""
    names = step_files.select("image")
    fallback = None
    if log is not None:
        fallback = log.where("kept").select("image")
    elif labels is not None:
        fallback = labels.select(F.trim("image").alias("image")).where(F.col("image") != "")
    if fallback is None or not names.isEmpty():
        return names
    return fallback


# Groups, manifest, samples, metrics


def duplicate_groups(spark: SparkSession, path: str, one_object: bool = False) -> DataFrame:
    """(image, duplicate_of) from groups as JSON lines, as the writer writes them.

    ``one_object`` reads a file holding one object {kept: [removed, ...]}, which takes
    one task.
    """
    if not one_object:
        lines = S.struct(duplicate_of=S.STR, removed=ArrayType(S.STR))
        stored = _or_empty(spark, lambda: spark.read.schema(lines).json(path), lines)
        removed = stored.select(F.explode("removed").alias("image"), "duplicate_of")
        return removed.where(F.trim("image") != "")
    text = _or_empty(
        spark, lambda: spark.read.text(path, wholetext=True), S.struct(value=S.STR)
    )
    parsed = F.from_json("value", "map<string,array<string>>")
    return (
        text.select(F.explode(parsed).alias("duplicate_of", "removed"))
        .select(F.explode("removed").alias("image"), "duplicate_of")
        .where(F.trim("image") != "")
    )


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Newest version of the manifest; empty if there is none."""
    schema = StructType([*S.MANIFEST.fields, StructField("version", StringType())])
    stored = _or_empty(
        spark,
        lambda: spark.read.schema(schema).parquet(path),
        schema,
    )
    last = stored.agg(F.max("version")).first()[0]
    return stored.where(F.col("version") == F.lit(last)).drop("version")


def eval_sample(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.SAMPLE).json(path)


def category_accuracy(spark: SparkSession, path: str) -> DataFrame:
    """category, accuracy of stored label metrics."""
    stored = spark.read.schema("category string, accuracy string").json(path)
    return stored.select("category", C.tolerant_double(F.col("accuracy")).alias("accuracy")).where(
        F.col("accuracy").isNotNull()
    )


# Configuration as tables


def label_prompts(spark: SparkSession, prompts: Mapping[str, Mapping[str, Any]]) -> DataFrame:
    """Prompt rows from {category: {label: text or [text]}}; order as declared."""
    rows = []
    for category, labels in prompts.items():
        for label_ord, (label, texts) in enumerate(labels.items()):
            texts = [texts] if isinstance(texts, str) else texts
            rows += [
                (None, category, label, label_ord, i, text) for i, text in enumerate(texts)
            ]
    return spark.createDataFrame(rows, S.PROMPTS)


def group_prompts(spark: SparkSession, prompts: Mapping[str, Sequence[str]]) -> DataFrame:
    """Prompt rows from {group: [text]}."""
    rows = [
        (group, None, None, None, i, text)
        for group, texts in prompts.items()
        for i, text in enumerate(texts)
    ]
    return spark.createDataFrame(rows, S.PROMPTS)


def search_queries(spark: SparkSession, queries: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([(q,) for q in queries], "query string")


def effective_thresholds(runs: DataFrame, config: Thresholds) -> DataFrame:
    """Thresholds of the latest filter run, else of the configuration, in one row.

    ``runs`` holds target_threshold, overlay_margin and generated_at (maybe text);
    fields the run lacks come from the configuration.
    """
    last = runs.agg(
        F.max_by(F.struct("target_threshold", "overlay_margin", "generated_at"), "generated_at").alias("_r")
    )
    found = F.col("_r").isNotNull()
    return last.select(
        F.coalesce(C.tolerant_double(F.col("_r.target_threshold")), F.lit(config.threshold)).alias("threshold"),
        F.coalesce(C.tolerant_double(F.col("_r.overlay_margin")), F.lit(config.overlay_margin)).alias("overlay_margin"),
        F.when(found, "run_metadata").otherwise("config").alias("source"),
        F.col("_r.generated_at").alias("generated_at"),
    )


def thresholds(row: DataFrame) -> Thresholds:
    """The one-row result of :func:`effective_thresholds` as parameters."""
    first = row.first()
    return Thresholds(threshold=first["threshold"], overlay_margin=first["overlay_margin"])
