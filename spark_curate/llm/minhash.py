"""Document fingerprints by one-permutation MinHash with optimal densification."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from spark_curate.functions.session import materialize

#: Words of a shingle.
WIDTH = 5
#: Bins, a power of two, and the bits kept of each.
BINS = 512
BITS = 2
SEED = 42
#: Odd multipliers that mix 64-bit numbers (those of a published finalizer).
MIX_A = np.uint64(0xFF51AFD7ED558CCD)
MIX_B = np.uint64(0xC4CEB9FE1A85EC53)
SHIFT = np.uint64(33)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> SHIFT)) * MIX_A
    x = (x ^ (x >> SHIFT)) * MIX_B
    return x ^ (x >> SHIFT)


class Fingerprinter:
    """Texts to packed fingerprints of ``bins`` x ``bits`` bits."""

    def __init__(self, width: int = WIDTH, bins: int = BINS, bits: int = BITS, seed: int = SEED):
        if bins & (bins - 1) or bins * bits % 8 or 8 % bits:
            raise ValueError("bins must be a power of two and bits divide a byte")
        self.width, self.bins, self.bits, self.seed = width, bins, bits, seed
        rng = np.random.Generator(np.random.PCG64(seed))
        # turn[i, j]: when bin i, empty, comes to ask bin j; each asks in an order of its own
        self.turn = np.stack([rng.permutation(bins) for _ in range(bins)]).astype(np.int16)
        self.salt = rng.integers(0, 1 << 64, bins, np.uint64)
        self.starts = np.arange(bins, dtype=np.uint64) << np.uint64(65 - bins.bit_length())
        self.nothing = b"\x00" * (bins * bits // 8)

    def shingles(self, text: str) -> np.ndarray:
        """Hashes of the shingles; a text of fewer words is one shingle, of none has none."""
        tokens = text.encode().lower().split()  # bytes.lower changes A-Z only
        digest, seed = xxhash.xxh64_intdigest, self.seed
        word = np.fromiter((digest(t, seed) for t in tokens), np.uint64, len(tokens))
        spans = max(1, len(word) - self.width + 1) if len(word) else 0
        found = np.zeros(spans, np.uint64)
        for k in range(min(self.width, len(word))):
            found = found * MIX_A + word[k : k + spans]
        return _mixed(found)

    def packed(self, text: str) -> bytes:
        """The fingerprint of a text; of one without words all bits are zero.

        The high bits of a shingle's hash name its bin and the least hash of a bin
        stays: sorted, it is the first of its bin. An empty bin takes over from the first
        filled one in its own order of asking. What is kept of a bin are bits of its value
        mixed with the bin's number, so a value that fills many bins is no single chance.
        """
        found = np.sort(self.shingles(text))
        if not len(found):
            return self.nothing
        first = np.searchsorted(found, self.starts)
        filled = np.append(first[1:], len(found)) > first
        source = np.arange(self.bins)
        if not filled.all():
            empty, full = np.flatnonzero(~filled), np.flatnonzero(filled)
            source[empty] = full[self.turn[np.ix_(empty, full)].argmin(axis=1)]
        value = _mixed(found[first[source]] ^ self.salt) >> np.uint64(64 - self.bits)
        lanes = value.astype(np.uint8).reshape(-1, 8 // self.bits) << np.arange(0, 8, self.bits, dtype=np.uint8)
        return np.bitwise_or.reduce(lanes, axis=1).astype(np.uint8).tobytes()

    def likeness(self, one: bytes, other: bytes) -> float:
        """Estimated share of common shingles, 0 to 1.

        Bins of unlike values still agree once in 2^bits; that chance is taken out. Texts
        without words are like each other and nothing else.
        """
        if one == other:
            return 1.0
        if self.nothing in (one, other):
            return 0.0
        apart = np.frombuffer(one, np.uint8) ^ np.frombuffer(other, np.uint8)
        equal = sum(int(np.count_nonzero(apart >> k & (1 << self.bits) - 1 == 0)) for k in range(0, 8, self.bits))
        chance = 0.5**self.bits
        return min(1.0, max(0.0, (equal / self.bins - chance) / (1 - chance)))


@cache
def fingerprinter(width: int, bins: int, bits: int, seed: int) -> Fingerprinter:
    """The fingerprinter of a worker; its tables depend on these numbers only."""
    return Fingerprinter(width, bins, bits, seed)


def edited(text: str, following: str) -> str:
    """The last third of the text, rounded down, replaced by as much of the next text."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


ROWS = (
    "kind int, part int, doc_id long, n_chars long, edited_sha256 string, fingerprint binary, "
    "edited_fingerprint binary, near_edited double, near_next double, text string"
)
DONE, HEAD, TAIL = 0, 1, 2


def with_next(
    docs: DataFrame,
    width: int = WIDTH,
    bins: int = BINS,
    bits: int = BITS,
    seed: int = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Fingerprints of every text, of its edited form, and how alike it is to that and to the next.

    The next document is that of the next smaller id, after the last the first; a
    document's edited form has its last third replaced by the beginning of the next.
    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint (hex),
    near_edited, near_next.

    Documents are range-partitioned by falling id and each partition is walked once in
    order, two texts at a time. The last document of a partition waits: it and the first
    of each partition are written apart, one row each, and meet by a join on the number of
    the partition. So no text is collected and only ends move twice.

    Null texts are empty; a text without words has a fingerprint of zeros, alike to such
    texts only. Rows of a null id come last; repeated ids follow each other in an order
    set by their texts, so equal rows (a third of the table perhaps) are spread over
    partitions. A single row is its own next. An empty table gives an empty result;
    extra columns are not looked at; texts of any length are read whole.
    """
    schema = T.StructType.fromDDL(ROWS)
    arrow = to_arrow_schema(schema)
    numbers_of = (width, bins, bits, seed)

    def finished(maker: Fingerprinter, doc, text: str, mark: bytes, following: str, next_mark: bytes) -> tuple:
        whole = edited(text, following)
        other = maker.packed(whole)
        digest = hashlib.sha256(whole.encode()).hexdigest()
        return doc, len(text), digest, mark, other, maker.likeness(mark, other), maker.likeness(mark, next_mark)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker = fingerprinter(*numbers_of)
        part = TaskContext.get().partitionId()
        last = None
        for batch in batches:
            rows = []
            for doc, cell in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = cell.as_py()
                mark = maker.packed(text)
                if last is None:
                    rows.append((HEAD, part, doc, None, None, mark, None, None, None, text))
                else:
                    rows.append((DONE, part, *finished(maker, *last, text, mark), None))
                last = doc, text, mark
            if rows:
                yield _batch(rows, arrow)
        if last is not None:
            doc, text, mark = last
            yield _batch([(TAIL, part, doc, None, None, mark, None, None, None, text)], arrow)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker = fingerprinter(*numbers_of)
        for batch in batches:
            for r in batch.to_pylist():
                yield _batch(
                    [(DONE, r["part"], *finished(maker, r["doc_id"], r["text"], r["mark"], r["next_text"], r["next_mark"]), None)],
                    arrow,
                )

    placed = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        F.monotonically_increasing_id().alias("_row"),
    )
    order = [F.desc_nulls_last("doc_id"), F.xxhash64("text"), F.col("_row")]
    ordered = placed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    made = materialize(ordered.mapInArrow(walk, schema))
    ends = made.where("kind > 0")
    # one row a partition of the shuffle: their numbers alone are put in order
    numbers = ends.where(f"kind = {HEAD}").select("part")
    everywhere = Window.orderBy("part")
    follows = numbers.select(
        "part", F.coalesce(F.lead("part").over(everywhere), F.first("part").over(everywhere)).alias("next_part")
    )
    tails = ends.where(f"kind = {TAIL}").select("part", "doc_id", "text", F.col("fingerprint").alias("mark"))
    heads = ends.where(f"kind = {HEAD}").select(
        F.col("part").alias("next_part"), F.col("text").alias("next_text"), F.col("fingerprint").alias("next_mark")
    )
    joined = tails.join(follows, "part").join(heads.hint("merge"), "next_part")
    met = joined.select("part", "doc_id", "text", "mark", "next_text", "next_mark").mapInArrow(meet, schema)
    return made.where(f"kind = {DONE}").unionByName(met).select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        F.lower(F.hex("fingerprint")).alias("fingerprint"),
        F.lower(F.hex("edited_fingerprint")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


def _batch(rows: list[tuple], arrow: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)
