"""Schemas of the curation tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import types as T

STR, BOOL, INT, LONG = T.StringType(), T.BooleanType(), T.IntegerType(), T.LongType()
REAL, TIME = T.DoubleType(), T.TimestampType()
VECTOR = T.ArrayType(T.FloatType())
ARRAY = T.ArrayType(STR)


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def mapping(value: T.DataType) -> T.MapType:
    return T.MapType(STR, value)


RECORD = struct(
    assigned=STR, confidence=REAL, all_scores=mapping(REAL), runner_up=STR, runner_up_score=REAL
)
ITEMS = struct(image=STR, source_path=STR, width=INT, height=INT, phash=LONG, embedding=VECTOR)
PROMPTS = struct(group=STR, category=STR, label=STR, label_ord=INT, prompt_ord=INT, text=STR)
TARGET_LOG = struct(filename=STR, positive_score=STR, negative_score=STR, kept=STR)
OVERLAY_LOG = struct(filename=STR, overlay_score=STR, clean_score=STR, flagged=STR)
EMBEDDINGS = struct(image=STR, embedding=VECTOR, model_name=STR, pretrained=STR, generated_at=TIME)
SAMPLE = struct(
    image=STR,
    source=STR,
    predicted=mapping(STR),
    confidence=mapping(REAL),
    ground_truth=mapping(STR),
    is_target=BOOL,
)
ANNOTATIONS = struct(image=STR, is_target=BOOL, labels=mapping(STR), ts=TIME, event_id=LONG)
RECORDS = struct(image=STR, predicted=mapping(STR), scores=mapping(RECORD))
MANIFEST = struct(
    image=STR,
    dedup=struct(kept=BOOL, duplicate_of=STR, source_path=STR, updated_at=TIME),
    filter=struct(
        kept=BOOL, reason=STR, positive_score=REAL, negative_score=REAL, updated_at=TIME
    ),
    label=struct(labeled=BOOL, categories=mapping(STR), updated_at=TIME),
)
FILTER_RUNS = struct(
    target_threshold=REAL,
    overlay_margin=REAL,
    source_step=STR,
    source_dir=STR,
    persist_kept_images=BOOL,
    generated_at=TIME,
)


def label_file(categories: Sequence[str]) -> T.StructType:
    """Schema of a label file: one text field per category, then the scores."""
    return struct(image=STR, **{c: STR for c in categories}, scores=mapping(RECORD))
