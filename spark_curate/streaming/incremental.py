"""Structured Streaming forms of labelling and annotation.

What a batch must know of earlier ones is keyed state in the state store: the images seen
and the last accepted event of each image. A batch reads its own rows and their state
only, and writes the rows it changes below a folder of its own, named by the batch, so a
batch that is replayed after a failure replaces its own output and nothing else.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from spark_curate.operators import evaluation, labeling
from spark_curate.sources import schemas as S

#: What becomes of an event: ``accepted`` changes the sample, ``refused`` says why not.
CHANGES = S.struct(
    image=S.STR,
    event_id=S.LONG,
    at=S.LONG,
    kind=S.STR,
    is_target=S.BOOL,
    ground_truth=S.mapping(S.STR),
    error=S.STR,
    missing=S.ARRAY,
)
#: An event's place in the order of events: its time in microseconds, then its id.
PLACE = S.struct(at=S.LONG, event_id=S.LONG)
STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _stored(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    full = StructType([*schema.fields, StructField("batch", LongType())])
    try:
        return spark.read.schema(full).parquet(path)
    except AnalysisException as err:
        if "PATH_NOT_FOUND" in str(err):
            return spark.createDataFrame([], full)
        raise


def file_stream(spark: SparkSession, path: str, schema: StructType, files_per_batch: int = 1000) -> DataFrame:
    """Stream of the parquet files arriving in a folder."""
    return (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    )


def _start(stream: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(work)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def label_stream(
    items: DataFrame, prompts: DataFrame, out: str, checkpoint: str, existing: DataFrame | None = None
) -> StreamingQuery:
    """Label each arriving image once.

    The names seen so far are state, so no batch rereads earlier output; images of
    ``existing`` are left alone as well. Records are appended below ``out`` in one
    partition per batch; read them with :func:`labels`.
    """
    fresh = items.dropDuplicates(["image"])
    if existing is not None:
        fresh = labeling.missing_labels(fresh, existing)

    def work(batch: DataFrame, batch_id: int) -> None:
        labeling.label_records(batch, prompts).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return _start(fresh, work, checkpoint)


def labels(spark: SparkSession, out: str) -> DataFrame:
    return _stored(spark, out, S.RECORDS).drop("batch")


class LastAccepted(StatefulProcessor):
    """Per image: the place, in the order of events, of the last accepted one.

    Events at or before that place are passed over, late ones too. Of the others the
    unusable are refused and the last usable one is accepted.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.place = handle.getValueState("place", PLACE)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        last = tuple(self.place.get()) if self.place.exists() else None
        best = None
        for row in rows:
            place = (row["at"], row["event_id"])
            if last is not None and place <= last:
                continue
            if row["error"] is not None:
                yield Row(**{**row.asDict(), "kind": "refused"})
            elif best is None or place > (best["at"], best["event_id"]):
                best = row
        if best is not None:
            self.place.update((best["at"], best["event_id"]))
            yield Row(**{**best.asDict(), "kind": "accepted"})

    def close(self) -> None:
        pass


def annotation_stream(
    events: DataFrame, sample: DataFrame, options: DataFrame, out: str, checkpoint: str
) -> StreamingQuery:
    """Apply arriving annotation events to the evaluation sample.

    Events are judged against ``sample`` and ``options`` where they arrive and meet the
    state of their image (:class:`LastAccepted`), so an older event that comes late
    changes nothing and the outcome is that of one batch over all events. A batch
    writes its accepted and refused events, no other row of the sample; read the sample
    with :func:`annotated_sample`, the others with :func:`refused_events`.
    """
    spark = events.sparkSession
    spark.conf.set(STORE, ROCKS)
    known = sample.select("image", "predicted", F.lit(True).alias("_known"))
    judged = evaluation.resolve_ground_truth(events.join(known, "image", "left"), options)
    error = F.when(F.col("_known").isNull(), "unknown_image").when(F.size("missing") > 0, "missing_labels")
    first = F.lit(-(1 << 63)).cast("bigint")  # an event without a time or an id comes before all
    rows = judged.select(
        "image",
        F.coalesce("event_id", first).alias("event_id"),
        F.coalesce(F.unix_micros("ts"), first).alias("at"),
        F.lit("").alias("kind"),
        "is_target",
        "ground_truth",
        error.alias("error"),
        "missing",
    )
    changes = rows.groupBy("image").transformWithState(LastAccepted(), CHANGES, "append", "none")

    def work(batch: DataFrame, batch_id: int) -> None:
        # one write, one run of the stateful stage
        batch.write.mode("overwrite").parquet(f"{out}/changes/batch={batch_id}")

    return _start(changes, work, checkpoint)


def annotated_sample(spark: SparkSession, out: str, sample: DataFrame) -> DataFrame:
    """The sample with the last accepted change of each image."""
    changes = _stored(spark, f"{out}/changes", CHANGES).where("kind = 'accepted'")
    new = F.max_by(F.struct("is_target", "ground_truth"), F.struct("batch", "at", "event_id"))
    last = changes.groupBy("image").agg(new.alias("_new"))
    changed = F.col("_new").isNotNull()
    merged = sample.select(*S.SAMPLE.names).join(last, "image", "left")
    return merged.select(
        *[
            F.when(changed, F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) if c in ("is_target", "ground_truth") else F.col(c)
            for c in S.SAMPLE.names
        ]
    )


def refused_events(spark: SparkSession, out: str) -> DataFrame:
    """Events that changed nothing and why: image, event_id, error, missing."""
    refused = _stored(spark, f"{out}/changes", CHANGES).where("kind = 'refused'")
    return refused.select("image", "event_id", "error", "missing")
