"""Language-model scores by a probabilistic suffix tree over words."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spark_curate.functions.session import materialize, shared_dir

#: A word is a symbol of the tree, and a context a candidate, from this share of all
#: training tokens on. So there are at most ``1 / LEAST_SHARE`` of each, whatever the corpus.
LEAST_SHARE = 1e-5
MAX_DEPTH = 2
#: A context is retained if its gain over its suffix is this many nats for every
#: distinct symbol that follows it.
DIVERGENCE = 1.0
DISCOUNT = 0.75
#: Tokens counted at once by a task.
AT_ONCE = 2_500_000
#: Characters of text tokenised at once.
CHARACTERS = 1_000_000
#: Rows of a block whose texts are unpacked at once.
ROWS = 1_000

END = int(np.array([xxhash.xxh64_intdigest(b"")], np.uint64).view(np.int64)[0])  # no word is empty

EMPTY = pa.schema([("context", pa.int64()), ("total", pa.int64()), ("distinct", pa.int64()), ("own", pa.float64()), ("parent", pa.float64())])

SCORES = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
    "base_score double, score double"
)


@dataclass
class Tree:
    """The bounded part of the model: symbols, contexts and their statistics.

    Symbols are numbered as in ``words`` (sorted hashes); the next number stands for
    all rarer words, the one after it for the beginning of a text. A context of depth 1
    is a symbol; one of depth ``d`` is a key of ``contexts[d - 2]``: the number of its
    depth ``d - 1`` beginning and its last symbol. ``total``, ``distinct`` and
    ``retained`` are per depth, by number.
    """

    tokens: int = 0
    types: int = 0
    words: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    counts: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    contexts: list[np.ndarray] = field(default_factory=list)
    total: list[np.ndarray] = field(default_factory=list)
    distinct: list[np.ndarray] = field(default_factory=list)
    retained: list[np.ndarray] = field(default_factory=list)

    @property
    def rare(self) -> int:
        return len(self.words)

    @property
    def width(self) -> int:
        return len(self.words) + 2

    def root(self) -> np.ndarray:
        """Probability of every symbol without context (the last is for the rare ones)."""
        space = self.tokens + self.types + 1
        common = (self.counts + 1) / space
        return np.append(common, (space - int((self.counts + 1).sum())) / space)

    def suffixes(self) -> np.ndarray:
        """The number of the suffix (depth less by one) of every deepest context."""
        keys, width = self.contexts[-1], self.width
        if len(self.contexts) == 1:
            return keys % width
        shorter = Tree(words=self.words, contexts=self.contexts[:-1])
        return find(self.contexts[-2], shorter.suffixes()[keys // width] * width + keys % width)

    def places(self, hashes: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """The symbol at each token and, per depth, the context before it (-1: none)."""
        symbols = find(self.words, hashes)
        symbols[symbols < 0] = self.rare
        before = np.roll(symbols, 1)
        before[begins] = self.rare + 1
        depths = [before]
        for contexts in self.contexts:
            longer = np.roll(depths[-1] * self.width + symbols, 1)
            longer[np.roll(depths[-1], 1) < 0] = -1
            longer[begins] = -1
            depths.append(find(contexts, longer))
        return symbols, depths


def find(keys: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """The place of each asked value in sorted ``keys``, or -1."""
    if not len(keys):
        return np.full(len(asked), -1, np.int64)
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return np.where(keys[at] == asked, at, -1)


def tokenise(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens of the texts, an end after each, and where each text begins."""
    split = [t.encode().lower().split() for t in texts]
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    found = np.fromiter(
        map(xxhash.xxh64_intdigest, chain.from_iterable(split)), np.uint64, int(sizes.sum())
    ).view(np.int64)
    ends = np.cumsum(sizes + 1) - 1
    hashes = np.empty(len(found) + len(texts), np.int64)
    is_word = np.ones(len(hashes), bool)
    is_word[ends] = False
    hashes[is_word] = found
    hashes[ends] = END
    return hashes, ends - sizes


def _chunks(texts: list[str]) -> Iterator[slice]:
    begin = 0
    while begin < len(texts):
        end, size = begin, 0
        while end < len(texts) and (end == begin or size + len(texts[end]) <= CHARACTERS):
            size += len(texts[end])
            end += 1
        yield slice(begin, end)
        begin = end


def _narrow(numbers: np.ndarray) -> bytes:
    """Whole numbers in the least width that holds them, after a byte that tells it."""
    for kind in (np.uint8, np.uint16, np.uint32):
        if not len(numbers) or numbers.min() >= 0 and numbers.max() <= np.iinfo(kind).max:
            break
    else:
        kind = np.int64
    return bytes([np.dtype(kind).itemsize]) + numbers.astype(kind).tobytes()


def _widened(packed: bytes) -> np.ndarray:
    kind = {1: np.uint8, 2: np.uint16, 4: np.uint32, 8: np.int64}[packed[0]]
    return np.frombuffer(packed, kind, offset=1).astype(np.int64)


def _packed(keys: np.ndarray, values: np.ndarray) -> tuple[bytes, bytes]:
    """Sorted keys and their values as two binaries (the keys as differences)."""
    return _narrow(np.diff(keys, prepend=0)), _narrow(values)


def _unpacked(keys: bytes, values: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.cumsum(_widened(keys)), _widened(values)


def _bucket(pairs: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each key, by the high bits of a product with an odd constant."""
    mixed = pairs.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(64 - buckets.bit_length() + 1)).astype(np.int64)


ROW = "block int, bucket int, keys binary, n binary"


def _counted(docs: DataFrame, blocks: int, keys_of) -> DataFrame:
    """Training counts of keys, packed: a row per bucket for all (block -1) and per block.

    ``keys_of(hashes, begins)`` gives a key per token, whether it has one, and what to
    deal it by. A block first adds up its own tokens and sends each bucket one row; a
    bucket then knows the whole count of each of its keys, and answers every block
    with those it asked for. Held-out texts ask without adding. The buckets grow with
    the blocks, so what meets in a bucket stays an eighth of a block's keys or so.
    """
    buckets = 1 << max(6, (8 * blocks - 1).bit_length())

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        block, size = None, 0

        def made() -> pa.RecordBatch:
            keys, first, counts = np.unique(
                np.concatenate([k for k, _, _ in held]), return_index=True, return_counts=True
            )
            deal = _bucket(np.concatenate([d for _, d, _ in held])[first], buckets)
            outside = np.concatenate([k[~learns] for k, _, learns in held])
            asked, times = np.unique(outside, return_counts=True)
            counts[np.searchsorted(keys, asked)] -= times
            order = np.argsort(deal, kind="stable")
            keys, counts, deal = keys[order], counts[order], deal[order]
            cuts = np.flatnonzero(np.diff(deal, prepend=-1)).tolist()
            rows = [_packed(keys[a:b], counts[a:b]) for a, b in zip(cuts, [*cuts[1:], len(keys)], strict=True)]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(cuts), block, np.int32)),
                    pa.array(deal[cuts].astype(np.int32)),
                    pa.array([k for k, _ in rows], pa.binary()),
                    pa.array([n for _, n in rows], pa.binary()),
                ],
                names=["block", "bucket", "keys", "n"],
            )

        for batch in (whole.slice(k, ROWS) for whole in batches for k in range(0, whole.num_rows, ROWS)):
            at = batch.column("block").to_numpy(zero_copy_only=False)
            texts, outside = batch.column("text").to_pylist(), batch.column("held_out").to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(np.diff(at)) + 1).tolist(), len(at)]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if hi == lo:
                    continue
                if size and at[lo] != block:
                    yield made()
                    held, size = [], 0
                block = at[lo]
                for part in _chunks(texts[lo:hi]):
                    hashes, begins = tokenise(texts[lo:hi][part])
                    learns = np.repeat(~outside[lo:hi][part], np.diff(np.append(begins, len(hashes))))
                    keys, some, deal = keys_of(hashes, begins)
                    if not some.any():
                        continue
                    held.append((keys[some], deal[some], learns[some]))
                    size += int(some.sum())
                    if size >= AT_ONCE:
                        yield made()
                        held, size = [], 0
        if size:
            yield made()

    def answer(rows: pa.Table) -> pa.Table:
        parts = [_unpacked(k, n) for k, n in zip(rows["keys"].to_pylist(), rows["n"].to_pylist(), strict=True)]
        keys, place = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
        total = np.zeros(len(keys), np.int64)
        np.add.at(total, place, np.concatenate([n for _, n in parts]))
        known = total > 0
        out = [_packed(keys[known], total[known])]
        end = np.cumsum([len(k) for k, _ in parts])
        for (asked, _), hi in zip(parts, end.tolist(), strict=True):
            out.append(_packed(asked, total[place[hi - len(asked) : hi]]))
        bucket = rows["bucket"][0].as_py()
        return pa.table(
            {
                "block": pa.array([-1, *rows["block"].to_pylist()], pa.int32()),
                "bucket": pa.array([bucket] * len(out), pa.int32()),
                "keys": pa.array([k for k, _ in out], pa.binary()),
                "n": pa.array([n for _, n in out], pa.binary()),
            }
        )

    rows = docs.select("block", "held_out", "text").mapInArrow(gather, ROW)
    return rows.groupBy("bucket").applyInArrow(answer, ROW)


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for batch in batches:
        for keys, n in zip(batch.column("keys").to_pylist(), batch.column("n").to_pylist(), strict=True):
            yield _unpacked(keys, n)


def _usual(counted: DataFrame, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys counted at least ``least`` times, sorted, and their counts."""

    def run(batches):
        for keys, n in _entries(batches):
            yield pa.RecordBatch.from_arrays([pa.array(keys[n >= least]), pa.array(n[n >= least])], names=["key", "n"])

    found = counted.where("block = -1").mapInArrow(run, "key long, n long").toArrow().sort_by("key")
    return found["key"].to_numpy(), found["n"].to_numpy()


STATS = "context long, total long, distinct long, own double, parent double"


def _stats(context: np.ndarray, n: np.ndarray, expected: np.ndarray) -> pa.RecordBatch:
    """Per context, of what was counted here: sums that say how far it is from its suffix."""
    names, place = np.unique(context, return_inverse=True)
    add = lambda x: np.bincount(place, x, len(names))
    columns = [names, add(n).astype(np.int64), np.bincount(place, minlength=len(names)), add(n * np.log(n)), add(n * expected)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[f.split()[0] for f in STATS.split(", ")])


def _against_suffix(width: int, suffix: np.ndarray, totals: np.ndarray):
    """The statistics of contexts in a bucket, expecting what follows their suffixes there."""

    def stats(longer: pa.Table, shorter: pa.Table) -> pa.Table:
        known = list(_entries(shorter.to_batches()))
        made = []
        for keys, n in _entries(longer.to_batches()):
            above = suffix[keys // width]
            at = find(known[0][0], above * width + keys % width)
            made.append(_stats(keys // width, n, np.log(known[0][1][at] / totals[above])))
        return pa.Table.from_batches(made, EMPTY)

    return stats


def grow(docs: DataFrame, blocks: int, least_share: float, max_depth: int, divergence: float) -> tuple[Tree, list[DataFrame]]:
    """The tree, and per depth the counted rows (those of the words first).

    A pass over the corpus counts the words; one more per depth counts what follows
    each candidate context. A context is a candidate if it is usual enough, and
    retained if what follows it diverges from what follows its suffix; suffixes of
    retained contexts stay as well.
    """
    tree = Tree()

    def words(hashes, begins):
        return hashes, np.ones(len(hashes), bool), hashes

    def sizes(batches):
        for _, n in _entries(batches):
            yield pa.RecordBatch.from_arrays([pa.array([int(n.sum())]), pa.array([len(n)])], names=["tokens", "types"])

    counted = [materialize(_counted(docs, blocks, words))]
    whole = counted[0].where("block = -1").mapInArrow(sizes, "tokens long, types long")
    tokens, types = whole.agg(F.sum("tokens"), F.sum("types")).first()
    tree.tokens, tree.types = tokens or 0, types or 0
    least = max(2, int(np.ceil(least_share * tree.tokens)))
    tree.words, tree.counts = _usual(counted[0], least)
    for depth in range(1, max_depth + 1):
        now = Tree(tree.tokens, tree.types, tree.words, tree.counts, list(tree.contexts))
        width, expected = tree.width, np.log(tree.root())
        suffix = now.suffixes() if now.contexts else None
        shorter = tree.total[-1] if depth > 1 else None

        def follow(hashes, begins, now=now, width=width):
            symbols, depths = now.places(hashes, begins)
            # dealt by the last word of the context and the symbol: a context and its suffix meet
            return depths[-1] * width + symbols, depths[-1] >= 0, depths[0] * width + symbols

        def at_first(batches, width=width, expected=expected):
            for keys, n in _entries(batches):
                yield _stats(keys // width, n, expected[keys % width])

        counted.append(materialize(_counted(docs, blocks, follow)))
        pairs = counted[-1].where("block = -1")
        if depth == 1:
            judged = pairs.mapInArrow(at_first, STATS)
        else:
            before = counted[-2].where("block = -1")
            judged = pairs.groupBy("bucket").cogroup(before.groupBy("bucket")).applyInArrow(
                _against_suffix(width, suffix, shorter), STATS
            )
        sums = judged.groupBy("context").agg(*(F.sum(c).alias(c) for c in ("total", "distinct", "own", "parent")))
        found = sums.toArrow()  # a row per candidate context: at most 1 / least_share
        numbers, all_, kinds, own, other = (found[c].to_numpy() for c in ("context", "total", "distinct", "own", "parent"))
        size = width if depth == 1 else len(now.contexts[-1])
        total, distinct, gain = np.zeros(size), np.zeros(size), np.full(size, -np.inf)
        total[numbers], distinct[numbers] = all_, kinds
        gain[numbers] = own - all_ * np.log(np.maximum(all_, 1)) - other
        tree.total.append(total)
        tree.distinct.append(distinct)
        tree.retained.append((total >= least) & (gain >= divergence * distinct))
        if depth < max_depth:
            tree.contexts.append(_usual(counted[-1], least)[0])
    for depth in range(len(tree.contexts), 0, -1):
        upto = Tree(words=tree.words, contexts=tree.contexts[:depth])
        tree.retained[depth - 1][upto.suffixes()[tree.retained[depth]]] = True
    return tree, counted


def token_scores(tree: Tree, hashes: np.ndarray, begins: np.ndarray, seen: list[tuple[np.ndarray, np.ndarray]]):
    """Per token: training count, log10 of the base and of the tree's probability.

    ``seen[0]`` are the counts of words, ``seen[d]`` those of context and symbol at depth
    ``d``, as sorted keys and values; all of the text's words must be among the first.
    The longest retained context before a token gives its discounted counts, and what
    is left goes to the next shorter one, down to the root.
    """
    space = tree.tokens + tree.types + 1
    at = find(seen[0][0], hashes)
    if (at < 0).any():
        raise RuntimeError("a word of the block was not counted")
    count = seen[0][1][at]
    base = np.log10((count + 1) / space)
    symbols, depths = tree.places(hashes, begins)
    root = tree.root()
    p = root[symbols]
    for depth, contexts in enumerate(depths, 1):
        use = np.flatnonzero(contexts >= 0)
        use = use[tree.retained[depth - 1][contexts[use]]]
        if not len(use):
            continue
        context = contexts[use]
        keys, values = seen[depth]
        place = find(keys, context * tree.width + symbols[use])
        n = np.where(place >= 0, values[place], 0) if len(values) else np.zeros(len(use))
        total, distinct = tree.total[depth - 1][context], tree.distinct[depth - 1][context]
        p[use] = np.maximum(n - DISCOUNT, 0) / total + DISCOUNT * distinct / total * p[use]
    score = np.log10(p)
    rare = symbols == tree.rare
    score[rare] += base[rare] - np.log10(root[-1])
    return count, base, score


def score(
    docs: DataFrame,
    held_out: Column,
    least_share: float = LEAST_SHARE,
    max_depth: int = MAX_DEPTH,
    divergence: float = DIVERGENCE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """log10 probability of every whole text under a tree grown from those not ``held_out``.

    Tokens are the words in lower case (A-Z) and an end; an event is one of the training
    words or the unknown word, as in the base distribution, which is the tree's root.
    Words below ``least_share`` are one symbol to the tree, shared out by the root.

    The number of symbols and contexts is bounded by ``1 / least_share``, so they travel
    with the tasks. The counts are not: they grow with the corpus, stay in tables, and
    each block of documents is sent just the counts that its own words and contexts
    ask for. A block is what one task of the first reading holds, kept as a column of a
    table in the shared folder. Words are told apart by 64-bit hashes.

    Null and empty texts are an end alone. Repeated rows count as often as they stand
    and each gets its score; a null id is held out or not as empty text would be. With no
    training text every event is the unknown word and all scores are 0. An empty table
    gives an empty result; other columns are not looked at.
    """
    spark = docs.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{uuid.uuid4().hex}"
    docs.select(
        F.spark_partition_id().alias("block"),
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    ).write.option("compression", "zstd").parquet(path)
    blocks = spark.read.parquet(path)
    count = (blocks.agg(F.max("block")).first()[0] or 0) + 1
    tree, counted = grow(blocks, count, least_share, max_depth, divergence)

    def retained(depth: int):
        """The answers to blocks, without the contexts that are not in the tree."""
        kept, width = tree.retained[depth - 1], tree.width

        def run(batches):
            for batch in batches:
                rows = []
                for keys, n in _entries([batch]):
                    stay = kept[keys // width]
                    rows.append(_packed(keys[stay], n[stay]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("block"), pa.array([k for k, _ in rows], pa.binary()), pa.array([n for _, n in rows], pa.binary())],
                    names=["block", "keys", "n"],
                )

        return run

    sent = counted[0].where("block >= 0").select("block", F.lit(0).alias("depth"), "keys", "n")
    for depth, rows in enumerate(counted[1:], 1):
        asked = rows.where("block >= 0").select("block", "keys", "n")
        kept = asked.mapInArrow(retained(depth), "block int, keys binary, n binary")
        sent = sent.union(kept.select("block", F.lit(depth).alias("depth"), "keys", "n"))

    def work(texts: pa.Table, counts: pa.Table) -> pa.Table:
        found: list[list] = [[] for _ in range(max_depth + 1)]
        for depth, keys, n in zip(*(counts[c].to_pylist() for c in ("depth", "keys", "n")), strict=True):
            found[depth].append(_unpacked(keys, n))
        seen = []
        for parts in found:
            keys = np.concatenate([k for k, _ in parts]) if parts else np.empty(0, np.int64)
            n = np.concatenate([n for _, n in parts]) if parts else np.empty(0, np.int64)
            keys, first = np.unique(keys, return_index=True)
            seen.append((keys, n[first]))
        del found
        sums: list[list] = []
        unpacked = (texts["text"].slice(k, ROWS).to_pylist() for k in range(0, texts.num_rows, ROWS))
        for part in (rows[part] for rows in unpacked for part in _chunks(rows)):
            hashes, begins = tokenise(part)
            count, base, log = token_scores(tree, hashes, begins, seen)
            sums.append(
                [
                    np.diff(np.append(begins, len(hashes))),
                    np.add.reduceat((count > 0).astype(np.int64), begins),
                    np.add.reduceat(base, begins),
                    np.add.reduceat(log, begins),
                ]
            )
        size, known, base, log = (np.concatenate(x) for x in zip(*sums, strict=True))
        return pa.table(
            {
                "doc_id": texts["doc_id"],
                "held_out": texts["held_out"],
                "n_tokens": pa.array(size),
                "n_known": pa.array(known),
                "train_tokens": pa.array(np.full(len(size), tree.tokens, np.int64)),
                "base_score": pa.array(base),
                "score": pa.array(log),
            }
        )

    return blocks.groupBy("block").cogroup(sent.groupBy("block")).applyInArrow(work, SCORES)
