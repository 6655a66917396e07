"""Contiguous shards of near equal size from global prefix sums of bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spark_curate.functions.session import materialize


def byte_shards(
    docs: DataFrame, count: int = 8, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Cut the documents, in the order of their ids, into ``count`` shards of equal bytes.

    The slim rows (id, size, checksum) are range-partitioned by id and numbered inside
    each partition; the totals of the partitions, one row each, give every partition
    what stands before it, and so every row its global prefix sum. A row belongs to
    the shard in whose span of ``total / count`` bytes its middle lies, so a shard
    misses the target by one document at most. The text itself is never shuffled.

    A document's size is its UTF-8 bytes plus 1; a null text has none and counts 1. Rows
    with a null id come first; repeated rows and equal ids stay separate rows, ordered
    by checksum and place of reading (so one id held by a third of all rows is still
    spread over partitions). An empty table gives an empty result. Other columns are
    not looked at. Returns doc_id, size, text_crc32, law, shard, slot, grown_shard.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    slim = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.monotonically_increasing_id().alias("_row"),
    )
    order = ["doc_id", "text_crc32", "_row"]
    placed = materialize(
        slim.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    )
    totals = placed.groupBy("_part").agg(
        F.sum("size").alias("_bytes"), F.count(F.lit(1)).alias("_rows")
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_part").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    offsets = totals.select(  # one row per partition of the shuffle: small enough to broadcast
        "_part",
        F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_bytes_before"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
        F.sum("_bytes").over(everything).alias("_total"),
    )
    within = Window.partitionBy("_part").orderBy(*order)
    so_far = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = (
        placed.withColumn("_upto", F.sum("size").over(so_far))
        .withColumn("_nth", F.row_number().over(within).cast("long") - 1)
        .join(F.broadcast(offsets), "_part")
        .withColumn("_middle", 2 * (F.col("_bytes_before") + F.col("_upto")) - F.col("size"))
        .withColumn("shard", F.expr(f"cast(_middle * {count} div (2 * _total) as int)"))
        .withColumn("_place", F.col("_rows_before") + F.col("_nth"))
    )
    starts = cut.groupBy("shard").agg(F.min("_place").alias("_start"))  # one row per shard
    return cut.join(F.broadcast(starts), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("_place") - F.col("_start")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
