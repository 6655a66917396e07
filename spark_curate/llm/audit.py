"""What filters take from a corpus in every order, with duplicates found behind a counting Bloom sketch."""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spark_curate.functions.session import materialize
from spark_curate.llm.common import map_texts

#: The filters by letter; the last is that of duplicates. A document's mask has bit k
#: set if it fails the k-th.
FILTERS = "ABCDE"
DUPLICATE = 1 << FILTERS.index("E")
MIN_WORDS = 50
MIN_DISTINCT_PERCENT = 65
MAX_CAPITALS_PERCENT = 5
SYMBOLS = b"#$%&*|"
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Counters of the sketch for each row, and counters that a text raises.
COUNTERS_PER_ROW = 16
PROBES = 2
#: The largest sketch has so many counters: what is shipped is one bit of each, 64 MB.
MAX_COUNTERS = 1 << 29
#: Bits of one part of the bitmap (those of Spark's bitmap functions).
PART_BITS = 32768


def mask_of(text: str) -> int:
    """The filters A to D that a text fails, as bits."""
    raw = text.encode()
    tokens = raw.split()
    capitals = len(raw) - len(raw.translate(None, CAPITALS))
    return (
        (len(tokens) < MIN_WORDS)
        | (100 * len(set(tokens)) < MIN_DISTINCT_PERCENT * len(tokens)) << 1
        | (100 * capitals > MAX_CAPITALS_PERCENT * len(text)) << 2
        | (len(raw.translate(None, SYMBOLS)) < len(raw)) << 3
    )


def masks(docs: DataFrame, carry: tuple[str, ...]) -> DataFrame:
    """The ``carry`` columns and ``mask``, from the column ``text``."""

    def start():
        return lambda texts: {"mask": [mask_of(t) for t in texts]}

    return map_texts(docs, start, "mask int", "text", carry)


def probes(text_hash: Column, counters: int) -> list[Column]:
    """The counters of a text: other bits of a hash for each."""
    width = F.lit(counters)
    return [F.pmod(F.xxhash64(text_hash, F.lit(k)), width) for k in range(PROBES)]


def sketch(hashes: DataFrame, counters: int) -> DataFrame:
    """Which counters of the merged counting Bloom sketch stand at two or more, as bitmaps.

    ``hashes`` has a row per document. Every task counts its own rows and the counts of
    all tasks are added, so a text on a third of the rows is a row per task. The result
    (part, bits) has at most ``counters`` / 8 bytes.
    """
    # a text raises each of its counters once, should two of its probes be the same
    raised = hashes.select(F.explode(F.array_distinct(F.array(*probes(F.col("h"), counters)))).alias("at"))
    full = raised.groupBy("at").count().where("count > 1")
    position = F.call_function("bitmap_bit_position", F.col("at"))
    return full.groupBy(F.call_function("bitmap_bucket_number", F.col("at")).alias("part")).agg(
        F.call_function("bitmap_construct_agg", position).alias("bits")
    )


def possible_repeats(docs: DataFrame, bitmaps: DataFrame, counters: int) -> DataFrame:
    """The rows all of whose counters are shared; the others' texts stand only once.

    The bitmaps travel to the rows: at most ``MAX_COUNTERS`` / 8 bytes, whatever the
    table. No text is shuffled for it.
    """
    parts = F.broadcast(bitmaps)
    for k, at in enumerate(probes(F.col("h"), counters)):
        place = F.call_function("bitmap_bit_position", at)
        found = parts.select(F.col("part").alias(f"_part{k}"), F.col("bits").alias(f"_bits{k}"))
        byte = F.conv(F.hex(F.substring(F.col(f"_bits{k}"), (F.col("_place") / 8).cast("int") + 1, F.lit(1))), 16, 10)
        bit = F.call_function("shiftright", byte.cast("int"), F.pmod("_place", F.lit(8)).cast("int")).bitwiseAND(F.lit(1))
        docs = (
            docs.withColumn("_place", place)
            .join(found, F.call_function("bitmap_bucket_number", at) == F.col(f"_part{k}"))
            .where(bit == 1)
            .drop("_place", f"_part{k}", f"_bits{k}")
        )
    return docs


def _counters(rows: int, per_row: int, most: int) -> int:
    """The power of two from ``per_row`` counters for each row on, within the bound."""
    return min(most, max(PART_BITS, 1 << (rows * per_row - 1).bit_length() if rows else 0))


def mask_counts(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "source",
    counters_per_row: int = COUNTERS_PER_ROW,
    max_counters: int = MAX_COUNTERS,
) -> DataFrame:
    """Documents by part and mask of failed filters: part, mask, n, n_good, n_toxic.

    Everything the audit reports is a sum over these counts.

    A first pass leaves a slim row per document (id, part, mask of A to D, hash of the
    text). From the hashes comes a counting Bloom sketch; a text with a counter of its
    own stands once and is cleared. Only the texts left are read again and shuffled,
    whole, for the exact least id of each; the rows that hold the least id are found by
    text and id together, so a text on a third of the rows is spread by its ids. Beyond
    ``max_counters`` / ``counters_per_row`` rows the sketch clears fewer texts, more
    of them are shuffled and the result is the same.

    Flags are counts with a sign: rows that may be repeats are taken out of the
    unflagged and put to the flagged, those of the least id the other way. Labels are
    joined to the sums by id, mask and flag.

    Null texts are empty, and all empty ones are equal. A null part is the part ''. A
    null id is smaller than none and has none smaller: such rows never fail E and have no
    label. Rows of one id and one text do not fail E for each other. Of repeated labels
    one of 1 counts. Extra columns are not looked at; an empty table gives no rows.
    """
    named = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    ).withColumn("h", F.xxhash64("text"))
    slim = materialize(masks(named, ("doc_id", "part", "h")))
    counters = _counters(slim.count(), counters_per_row, max_counters)
    bitmaps = materialize(sketch(slim.select("h"), counters))
    left = possible_repeats(named.where("doc_id is not null"), bitmaps, counters)
    again = left.select("doc_id", "part", "text", F.col("text").alias("body"))
    repeats = materialize(masks(again, ("doc_id", "part", "body")))
    least = repeats.groupBy("body").agg(F.min("doc_id").alias("doc_id"))
    # the texts of both sides grow with the table: no broadcast
    first = repeats.join(least.hint("merge"), ["body", "doc_id"], "left_semi")

    def signed(rows: DataFrame, flag: int, sign: int) -> DataFrame:
        return rows.select("doc_id", "part", (F.col("mask") + flag).alias("mask"), F.lit(sign).alias("n"))

    flagged = (
        signed(slim, 0, 1)
        .unionAll(signed(repeats, 0, -1))
        .unionAll(signed(repeats, DUPLICATE, 1))
        .unionAll(signed(first, 0, 1))
        .unionAll(signed(first, DUPLICATE, -1))
    )
    per_id = flagged.groupBy("doc_id", "part", "mask").agg(F.sum("n").alias("n")).where("n > 0")
    judged = (
        labels.where(F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(
            F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("bad")
        )
    )
    total = lambda flag: F.coalesce(F.sum(F.when(F.col(flag) == 1, F.col("n"))), F.lit(0))
    return (
        per_id.join(judged, "doc_id", "left")
        .groupBy("part", "mask")
        .agg(F.sum("n").alias("n"), total("good").alias("n_good"), total("bad").alias("n_toxic"))
    )


def audit(counts: DataFrame) -> DataFrame:
    """Every order of the filters, step by step, for each part, from :func:`mask_counts`.

    Returns part, filter_order, step and the counts of the step. A part's masks, 32 at
    most, are brought together in a row, and each step of each order sums over them.
    """
    orders = []
    for order in permutations(FILTERS):
        before = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << FILTERS.index(letter)
            orders.append(("".join(order), step, before, bit))
            before |= bit
    steps = F.array(
        *(
            F.struct(F.lit(o).alias("filter_order"), F.lit(s).alias("step"), F.lit(b).alias("before"), F.lit(t).alias("bit"))
            for o, s, b, t in orders
        )
    )
    held = F.collect_list(F.struct("mask", "n", "n_good", "n_toxic")).alias("held")
    rows = counts.groupBy("part").agg(held).select("part", "held", F.inline(steps))

    def total(which, value: str = "n") -> Column:
        kept = F.filter("held", which)
        return F.aggregate(kept, F.lit(0).cast("long"), lambda acc, x: acc + x[value])

    before, bit = F.col("before"), F.col("bit")
    removed = lambda x: (x["mask"].bitwiseAND(before) == 0) & (x["mask"].bitwiseAND(bit) != 0)
    summed = rows.select(
        "part",
        "filter_order",
        "step",
        "bit",
        total(lambda x: x["mask"].bitwiseAND(before.bitwiseOR(bit)) == 0).alias("kept"),
        total(removed).alias("removed"),
        total(lambda x: (x["mask"].bitwiseAND(before) != 0) & (x["mask"].bitwiseAND(bit) != 0)).alias("redundant"),
        total(lambda x: x["mask"] == bit).alias("unique_fails"),
        total(removed, "n_good").alias("good_lost"),
        total(removed, "n_toxic").alias("toxic_lost"),
    )
    by_filter = summed.groupBy("part", "bit").agg(F.sum("removed").alias("shapley"))
    return summed.join(by_filter, ["part", "bit"]).drop("bit")
