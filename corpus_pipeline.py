"""Documents to training sequences: four stages, each applied to what the last one kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spark_curate.functions.session import materialize
from spark_curate.llm import packing, quality, simhash, toxicity

#: What SQL cannot express: every stage rests on compression, fingerprints or tokens.
ORACLE_SQL = None


def _kept(docs: DataFrame, judged: DataFrame, rule: str) -> DataFrame:
    """The documents, with all their columns, for which ``rule`` holds."""
    return judged.where(rule).select("_document.*").select(*(F.col(f"`{c}`") for c in docs.columns))


def _whole(docs: DataFrame) -> DataFrame:
    """Documents as one column, so that no column of theirs clashes with a verdict."""
    return docs.select(F.struct("*").alias("_document"), F.col("text").alias("_body"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not scored as toxic, by a model of the labelled ones among them.

    Null and empty texts have no toxic window and stay; repeated rows share a fate.
    Without labels of both classes nothing is known and documents stay unless most of
    the labels there are say toxic.
    """
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.score(_whole(docs), model, "_body", ("_document",))
    return _kept(docs, scored, "predicted = 0")


def apply_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the compression bands keep; null and empty texts go."""
    return _kept(docs, quality.quality(_whole(docs), "_body", ("_document",)), "kept")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of linked fingerprints."""
    return simhash.keep_one(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 tokens: a row per piece of a document."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_rules", apply_quality),
    ("simhash_dedup", drop_near_duplicates),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's rows are written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
