"""Sum-of-squares packing of tokenised documents into sequences of bounded length."""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from spark_curate.functions.session import materialize
from spark_curate.llm.bpe import byte_letters
from spark_curate.llm.common import map_texts

#: Pieces packed together by a task; more pieces make more groups of this size.
GROUP_PIECES = 100_000
NEVER = 1 << 60
#: The word pattern of the byte-level vocabulary (a fixed value of its pre-tokenizer).
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters the quick library takes at once: a million blanks in a row are beyond its stack.
LONG = 500_000
#: Texts of these characters are encoded by the quick library, others by the tokenizer itself.
PLAIN = re.compile(r"[\t\n\r\x20-\x7e\xa1-\xac\xae-\xff]*\Z")
#: The word pattern with its letter and digit properties spelled out for plain characters.
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ÿ"
DIGITS = "0-9²³¹¼-¾"
WORDS = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[{DIGITS}]+| ?[^\s{LETTERS}{DIGITS}]+|\s+(?!\S)|\s+"
)


def by_rank(tokenizer: Tokenizer) -> tiktoken.Encoding | None:
    """A byte-level vocabulary by a quicker library, which merges by rank.

    None if its ids are not in the order of its merges: only then are ids ranks, and the
    tokens of both libraries the same. Strings of special tokens are plain text to it.
    """
    model = json.loads(tokenizer.to_str())["model"]
    made = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    if made != sorted(set(made)):
        return None
    byte = {letter: b for b, letter in enumerate(byte_letters())}
    special = tokenizer.get_added_tokens_decoder()
    ranks = {bytes(byte[c] for c in t): i for t, i in tokenizer.get_vocab().items() if i not in special}
    return tiktoken.Encoding("ranks", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens={})


class Ids:
    """Texts to the little-endian 32-bit ids of their tokens, as the tokenizer gives them."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark fills the cores
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.ranked = by_rank(self.tokenizer)

    def whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(f.ids, "<u4").tobytes() for f in found]

    def of(self, texts: list[str]) -> list[bytes]:
        """The ids of every text."""
        return [self._of(t) for t in texts]

    def _of(self, text: str) -> bytes:
        if not self.ranked or not PLAIN.match(text) or any(s in text for s in self.special):
            return self.whole([text])[0]
        if len(text) <= LONG:
            return self._quick(text)
        return b"".join(self._quick(w) if len(w) <= LONG else self.whole([w])[0] for w in WORDS.findall(text))

    def _quick(self, text: str) -> bytes:
        return np.array(self.ranked.encode_ordinary(text), "<u4").tobytes()


@cache
def ids_of(path: str) -> Ids:
    """The encoder of a worker, kept from task to task; all it holds can be made again."""
    return Ids(path)


def pieces(
    docs: DataFrame,
    path: str,
    capacity: int = 1024,
    end_id: int = 2,
    text_col: str = "text",
    carry: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """The pieces of every document: piece, start, length, ids_crc32.

    A document's ids are those of its text and then ``end_id``. Longer ones are cut
    from the end into pieces of ``capacity``, so only the first may be shorter.
    """
    made = "array<struct<piece:int,start:bigint,length:bigint,ids_crc32:bigint>>"
    end = np.array([end_id], "<u4").tobytes()

    def start():
        ids = ids_of(path)

        def cut(raw: bytes) -> list[dict]:
            total = len(raw) // 4
            first = total % capacity or capacity
            bounds = [0, *range(first, total + 1, capacity)]
            return [
                {"piece": k, "start": a, "length": b - a, "ids_crc32": zlib.crc32(raw[4 * a : 4 * b])}
                for k, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False))
            ]

        return lambda texts: {"pieces": [cut(raw + end) for raw in ids.of(texts)]}

    return map_texts(docs, start, f"pieces {made}", text_col, carry).select(*carry, F.inline("pieces"))


def sum_of_squares(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The bin of each piece, given in the order of packing.

    ``counts[g]`` counts the open bins with ``g`` left. A piece goes into the open bin
    that makes the sum of the squares of these counts least: a bin leaves the count
    of ``g`` and enters that of ``g - size``; a full one enters none. Of equal places
    the one that leaves least room is taken, and a bin is opened only if no open one
    takes the piece (opening bins for the squares' sake costs sequences).
    """
    counts = np.zeros(capacity + 1, np.int64)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    placed = np.empty(len(lengths), np.int64)
    bins = 0
    for k, size in enumerate(lengths.tolist()):
        entered = 2 * counts[: capacity + 1 - size] + 1
        entered[0] = 0
        change = np.where(counts[size:] > 0, entered - 2 * counts[size:] + 1, NEVER)
        left = int(change.argmin())
        if change[left] == NEVER:
            place, left, bins = bins, capacity - size, bins + 1
        else:
            place = stacks[left + size].pop()
            counts[left + size] -= 1
        if left:
            stacks[left].append(place)
            counts[left] += 1
        placed[k] = place
    return placed


def pack(cut: DataFrame, capacity: int = 1024, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Add sequence_id and offset to pieces (any columns, among them ``length``).

    A piece of ``capacity`` tokens is a sequence by itself. The shorter ones are dealt
    into groups of about ``group_pieces`` in turn, as they are read, so that equal rows
    spread like others, and each group is packed in one task, the longest piece first.
    A group leaves a few unfilled sequences, whatever its size, so groups are as large
    as a task takes easily. ``cut`` has to be read alike twice, as a table is.
    """
    short = F.col("length") < capacity
    ones, longs = cut.where(short), cut.where(~short)
    groups = max(1, -(-ones.count() // group_pieces))
    keys = [c for c in cut.columns]
    dealt = (
        ones.withColumn("_group", F.pmod(F.monotonically_increasing_id(), F.lit(groups)).cast("int"))
        .repartition(groups, "_group")
        .sortWithinPartitions("_group", F.desc("length"), *[c for c in keys if c != "length"])
    )
    schema = dealt.withColumn("_bin", F.lit(0).cast("long")).withColumn("offset", F.lit(0).cast("long")).schema
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not sum(b.num_rows for b in held):
            return
        whole = pa.Table.from_batches(held).combine_chunks()
        group = whole.column("_group").to_numpy()
        length = whole.column("length").to_numpy()
        bins, offsets = np.empty(len(group), np.int64), np.empty(len(group), np.int64)
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(group)]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            placed = sum_of_squares(length[lo:hi], capacity)
            order = np.argsort(placed, kind="stable")
            upto = np.cumsum(length[lo:hi][order]) - length[lo:hi][order]
            first = np.flatnonzero(np.diff(placed[order], prepend=-1))
            runs = np.diff(np.append(first, hi - lo))
            offsets[lo:hi][order] = upto - np.repeat(upto[first], runs)
            bins[lo:hi] = placed
        columns = whole.columns + [pa.chunked_array([bins]), pa.chunked_array([offsets])]
        yield from pa.table(columns, names=names).to_batches(max_chunksize=20_000)

    packed = dealt.mapInArrow(run, schema)
    numbered = longs.withColumn("_nth", F.monotonically_increasing_id())
    return packed.select(
        *keys,
        # even numbers for shared sequences, odd ones for full pieces
        (2 * (F.col("_bin") * groups + F.col("_group"))).alias("sequence_id"),
        "offset",
    ).unionByName(
        numbered.select(*keys, (2 * F.col("_nth") + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    )


def pack_documents(
    docs: DataFrame, path: str, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Tokenise the documents and pack them into sequences of at most ``capacity`` tokens.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset, one row per
    piece. Null and empty texts are one piece holding the end id. Repeated rows and
    null ids are packed like any other. An empty table gives an empty result. Other
    columns are not looked at. Texts never leave the task that tokenises them.
    """
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_body"))
    return pack(materialize(pieces(named, path, capacity, end_id, "_body")), capacity)
