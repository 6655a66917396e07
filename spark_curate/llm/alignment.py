"""Alignment of two tokenizers on the same texts, by galloping over the ends of their tokens."""

from __future__ import annotations

import hashlib
import os
import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from tokenizers import Tokenizer

from spark_curate.functions.session import materialize
from spark_curate.llm.bpe import byte_letters
from spark_curate.llm.packing import PLAIN, by_rank

#: Every so manieth end is sought by itself; those between start from its place.
STRIDE = 64
#: A block is closed at this many distinct pairs of documents.
BLOCK_PAIRS = 2_000_000

MARK = "▁"
#: A piece that stands for a byte (a fixed form of the vocabulary).
BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")
#: Tokens whose bytes are compared with the text at once.
SPELLED = 1 << 20

EMPTY = np.empty(0, np.int64)


class Spelling:
    """The bytes of every token of a vocabulary, and whether tokens spell a text."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.all = np.frombuffer(b"".join(tokens), np.uint8)

    def spells(self, ids: np.ndarray, ends: np.ndarray, raw: bytes) -> bool:
        if not len(ids) or int(ends[-1]) != len(raw):
            return False
        text = np.frombuffer(raw, np.uint8)
        for k in range(0, len(ids), SPELLED):
            part, upto = ids[k : k + SPELLED], ends[k : k + SPELLED]
            first, last = int(upto[0] - self.sizes[part[0]]), int(upto[-1])
            shift = self.starts[part] - (upto - self.sizes[part])
            at = np.repeat(shift, self.sizes[part]) + np.arange(first, last)
            if not np.array_equal(self.all[at], text[first:last]):
                return False
        return True


class ByteLevel(Spelling):
    """Texts to ids of a byte-level vocabulary; strings of special tokens are plain text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark fills the cores
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenizer.encode_special_tokens = True
        byte = {letter: b for b, letter in enumerate(byte_letters())}
        special = {i: t.content for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        tokens = [b""] * self.tokenizer.get_vocab_size()
        for piece, i in self.tokenizer.get_vocab().items():
            tokens[i] = special[i].encode() if i in special else bytes(byte[c] for c in piece)
        super().__init__(tokens)
        # ids in the order of the merges are ranks: the same tokens by a quicker library
        self.ranked = by_rank(self.tokenizer)

    def __call__(self, text: str) -> np.ndarray:
        """Ids of one text; those of rare characters by the vocabulary's own library."""
        spaced = " " + text
        if self.ranked and PLAIN.match(spaced):
            return np.array(self.ranked.encode_ordinary(spaced), np.int64)
        return np.array(self.tokenizer.encode(spaced, add_special_tokens=False).ids, np.int64)


class Pieces(Spelling):
    """Texts to ids of a sentencepiece vocabulary, which adds a space in front."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        super().__init__(
            [
                bytes([int(BYTE_PIECE.fullmatch(p)[1], 16)]) if self.model.is_byte(i) else p.replace(MARK, " ").encode()
                for i, p in enumerate(pieces)
            ]
        )

    def __call__(self, text: str) -> np.ndarray:
        return np.array(self.model.encode(text, num_threads=1), np.int64)


def gallop(driver: np.ndarray, longer: np.ndarray) -> np.ndarray:
    """For each end of ``driver``, how many ends of ``longer`` lie below it.

    Both are rising and ``longer`` ends no lower than ``driver``. Every ``STRIDE``-th
    end is sought from where the one before it was found: steps that double until an end
    at or above it is met, then a binary search inside the last step. The ends between
    start from the place of the one before them and go the same way, all side by side.
    """
    size = len(longer)
    heads, place = [], 0
    for value in driver[::STRIDE].tolist():
        step = 1
        while place + step <= size and longer[place + step - 1] < value:
            place += step
            step *= 2
        place = bisect_left(longer, value, place, min(size, place + step))
        heads.append(place)
    low = np.repeat(np.array(heads, np.int64), STRIDE)[: len(driver)]
    high = low.copy()
    moving, step = np.arange(len(driver)), 1
    while len(moving):  # doubling steps
        probe = np.minimum(low[moving] + step, size) - 1
        above = longer[probe] >= driver[moving]
        high[moving] = probe
        moving, probe = moving[~above], probe[~above]
        low[moving] = probe + 1
        step *= 2
    open_ = np.flatnonzero(low < high)
    while len(open_):  # binary search between the last two probes
        middle = (low[open_] + high[open_]) >> 1
        below = longer[middle] < driver[open_]
        low[open_] = np.where(below, middle + 1, low[open_])
        high[open_] = np.where(below, high[open_], middle)
        open_ = open_[low[open_] < high[open_]]
    return low


def intersect(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Indices in both lists of the ends they share, and the ranks of the shorter in the longer.

    The shorter list drives the search, so a few long tokens against many short ones
    cost few steps.
    """
    swap = len(ends_a) > len(ends_b)
    short, long_ = (ends_b, ends_a) if swap else (ends_a, ends_b)
    ranks = gallop(short, long_)
    shared = np.flatnonzero(long_[ranks] == short)
    return (ranks[shared], shared, ranks) if swap else (shared, ranks[shared], ranks)


def overlaps(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index among ``b`` of what overlaps each token of ``a`` (last inclusive).

    The ranks of a token's two ends differ by what lies between them: it overlaps the
    tokens from the one that its start falls into to the one that holds its last byte.
    """
    last = gallop(ends_a, ends_b)
    before = np.concatenate(([0], last[:-1] + (ends_b[last[:-1]] == ends_a[:-1])))
    return before, last


class Aligner:
    """Two tokenizers and what is needed to cut their tokens into common groups."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteLevel(path_a), Pieces(path_b)
        ids = range(max(len(self.a.tokens), len(self.b.tokens)))
        self.written = [f"{i}{after}".encode() for i in ids for after in ",|;"]

    def tokens(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        """Ids and ends under both; None if there are no tokens or their bytes are not the text's."""
        if not text:
            return None
        raw = b" " + text.encode()
        made = []
        for side in (self.a, self.b):
            ids = side(text)
            ends = np.cumsum(side.sizes[ids])
            if not side.spells(ids, ends, raw):
                return None
            made += [ids, ends]
        return made[0], made[2], made[1], made[3]

    def digest(self, ids_a: np.ndarray, ids_b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray) -> str:
        """sha256 of ``a1,a2|b1;a3|b2,b3``: each id with what follows it, put in one order."""
        in_a, in_b = np.diff(at_a, prepend=-1), np.diff(at_b, prepend=-1)
        codes_a, codes_b = 3 * ids_a, 3 * ids_b
        codes_a[at_a] += 1
        codes_b[at_b] += 2
        whole = np.empty(len(ids_a) + len(ids_b), np.int64)
        whole[np.arange(len(ids_a)) + np.repeat(np.concatenate(([0], at_b[:-1] + 1)), in_a)] = codes_a
        whole[np.arange(len(ids_b)) + np.repeat(at_a + 1, in_b)] = codes_b
        return hashlib.sha256(b"".join(map(self.written.__getitem__, whole.tolist()))[:-1]).hexdigest()


@cache
def aligner_of(path_a: str, path_b: str) -> Aligner:
    """The aligner of a worker, kept from task to task; all it holds can be made again."""
    return Aligner(path_a, path_b)


def alignments(
    docs: DataFrame,
    path_a: str,
    path_b: str,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The aligned tokens of every text: doc_id, groups and overlaps.

    ``groups``: the ids of both tokenizers between two common ends, with the group's
    bytes from ``start`` to ``end`` in space+text. ``overlaps``: for each token of A the
    first and last token of B that share a byte with it. Texts without tokens (null,
    empty, or not given back byte for byte by both) have neither. One row per row;
    other columns are not looked at.
    """
    fields = (
        "doc_id long, groups array<struct<start:bigint,end:bigint,a:array<int>,b:array<int>>>, "
        "overlaps array<struct<first:int,last:int>>"
    )
    schema = T.StructType.fromDDL(fields)
    arrow = to_arrow_schema(schema)
    named = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = aligner_of(path_a, path_b)
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                groups, spans = [], []
                found = aligner.tokens(text)
                if found:
                    ids_a, ids_b, ends_a, ends_b = found
                    at_a, at_b, _ = intersect(ends_a, ends_b)
                    cuts = zip(np.split(ids_a, at_a[:-1] + 1), np.split(ids_b, at_b[:-1] + 1), strict=True)
                    bounds = [0, *ends_a[at_a].tolist()]
                    groups = [
                        {"start": s, "end": e, "a": a.tolist(), "b": b.tolist()}
                        for s, e, (a, b) in zip(bounds, bounds[1:], cuts, strict=False)
                    ]
                    first, last = overlaps(ends_a, ends_b)
                    spans = [{"first": f, "last": t} for f, t in zip(first.tolist(), last.tolist(), strict=True)]
                yield pa.RecordBatch.from_pylist([{"doc_id": doc, "groups": groups, "overlaps": spans}], schema=arrow)

    return named.mapInArrow(run, schema)


MADE = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "n_overlaps long, block string, at binary, times binary, codes array<bigint>, totals array<bigint>"
)
LINKED = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
    "groups_sha256 string, n_overlaps long"
)


def _aligned(docs: DataFrame, path_a: str, path_b: str, block_pairs: int) -> DataFrame:
    """Rows of documents, and rows of blocks of them with each pair's links in the block.

    A pair of ids is one number. A document holds its pairs as places in its block's
    sorted list and how often each stands, packed; what a task holds at once is a block.
    """
    schema = T.StructType.fromDDL(MADE)
    arrow = to_arrow_schema(schema)
    names = arrow.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = aligner_of(path_a, path_b)
        part, number = TaskContext.get().partitionId(), 0
        rows: list[tuple] = []
        pairs: list[np.ndarray] = []
        times: list[np.ndarray] = []
        held = 0

        def block() -> pa.RecordBatch:
            name = f"{part}-{number}"
            cuts = np.cumsum([len(p) for p in pairs])[:-1]
            counts = np.concatenate(times)
            codes, at = np.unique(np.concatenate(pairs), return_inverse=True)
            totals = np.bincount(at, weights=counts, minlength=len(codes)).astype(np.int64)
            places = [x.astype("<u4").tobytes() for x in np.split(at, cuts)]
            counted = [x.astype("<u4").tobytes() for x in times]
            columns = [list(c) for c in zip(*rows, strict=True)]
            columns += [[name] * len(rows), places, counted, [None] * len(rows), [None] * len(rows)]
            last = [None] * len(rows[0]) + [name, None, None, codes, totals]
            return pa.RecordBatch.from_arrays(
                [pa.array([*c, x], arrow.field(k).type) for k, (c, x) in enumerate(zip(columns, last, strict=True))],
                names=names,
            )

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = aligner.tokens(text.as_py())
                if found is None:
                    rows.append((doc, 0, 0, 0, 0, "", 0))
                    pairs.append(EMPTY)
                    times.append(EMPTY)
                else:
                    ids_a, ids_b, ends_a, ends_b = found
                    at_a, at_b, _ = intersect(ends_a, ends_b)
                    n_a, n_b, common = len(ids_a), len(ids_b), len(at_a)
                    # two cuttings of one text share as many pairs of bytes as there are cuts
                    rows.append((doc, n_a, n_b, common, common, aligner.digest(ids_a, ids_b, at_a, at_b), n_a + n_b - common))
                    codes, n = np.unique(ids_a[at_a] << 32 | ids_b[at_b], return_counts=True)
                    pairs.append(codes)
                    times.append(n)
                    held += len(codes)
                if held >= block_pairs or len(rows) >= block_pairs // 8 + 1:
                    yield block()
                    rows, pairs, times, held, number = [], [], [], 0, number + 1
        if rows:
            yield block()

    return docs.mapInArrow(run, schema)


def linked_documents(
    docs: DataFrame,
    path_a: str,
    path_b: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_pairs: int = BLOCK_PAIRS,
) -> DataFrame:
    """One row per document: its alignment as counts and a digest, and how usual its links are.

    A link is a token of A and one of B that end at the same byte; the count of an id
    pair is its number of links in the whole corpus. ``n_best`` counts a document's links
    whose pair has the highest count of all pairs of its B id (ties included),
    ``count_sum`` sums the counts over its links. ``n_overlaps`` counts the token pairs
    that share a byte.

    Documents are tokenised once, where they lie. A block of them (what a task held
    until ``block_pairs`` pairs came together) sends each of its pairs once, with the
    number of its links; the sums over blocks go back only to the blocks that hold the
    pair, where they meet the documents' packed pairs. So a pair that stands in every
    document is one row per block, and nothing of the corpus' size is broadcast or
    held. Blocks are columns of a written table, so a lost executor changes none.

    Texts that are null, empty, or not given back byte for byte by both tokenizers have
    no tokens: counts of zero and an empty digest. Repeated rows count as often as they
    stand; a null id is an id like others. An empty table gives an empty result; other
    columns are not looked at; texts of any length are aligned whole.
    """
    named = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )
    made = materialize(_aligned(named, path_a, path_b, block_pairs))
    asked = made.where("codes is not null").select(
        F.col("block").alias("to"), F.inline(F.arrays_zip(F.col("codes").alias("code"), F.col("totals").alias("n")))
    )
    counts = asked.groupBy("code").agg(F.sum("n").alias("count"))
    counts = materialize(counts.withColumn("b", F.col("code").bitwiseAND(F.lit(0xFFFFFFFF))))
    most = counts.groupBy("b").agg(F.max("count").alias("most"))
    judged = counts.join(most, "b").select("code", "count", (F.col("count") == F.col("most")).alias("best"))
    answers = asked.select("to", "code").join(judged, "code")

    def work(texts: pa.Table, answer: pa.Table) -> pa.Table:
        order = np.argsort(answer["code"].to_numpy())
        count = answer["count"].to_numpy()[order]
        best = answer["best"].to_numpy()[order].astype(np.int64)
        n_best, count_sum = [], []
        for at, times in zip(texts["at"], texts["times"], strict=True):
            place = np.frombuffer(at.as_py(), "<u4")
            n = np.frombuffer(times.as_py(), "<u4").astype(np.int64)
            n_best.append(int(n @ best[place]))
            count_sum.append(int(n @ count[place]))
        columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_overlaps"]
        out = {c: texts[c] for c in columns} | {"n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(count_sum, pa.int64())}
        return pa.table({f.split()[0]: out[f.split()[0]] for f in LINKED.split(", ")})

    rows = made.where("codes is null").drop("codes", "totals")
    return rows.groupBy("block").cogroup(answers.groupBy("to")).applyInArrow(work, LINKED)
