"""Near-duplicates by SimHash, searched with BK-trees."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spark_curate.functions.session import materialize
from spark_curate.llm.common import map_texts
from spark_curate.llm.components import components

BITS = 64
#: Most fingerprints of one shard tree; larger shards are split into several trees.
TREE_ROWS = 4096
#: Shingles whose bits are counted at once.
COUNTED = 1 << 16


def fingerprint(text: str, width: int = 4, seed: int = 42) -> int:
    """SimHash of the ``width``-word shingles of a text, as a signed 64-bit number."""
    tokens = text.encode().lower().split()  # bytes.lower changes A-Z only
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    first = starts[: max(1, len(tokens) - width + 1)].tolist()
    last = ends[min(width, len(tokens)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    set_bits = np.zeros(BITS, np.int64)
    for k in range(0, len(first), COUNTED):
        spans = zip(first[k : k + COUNTED], last[k : k + COUNTED], strict=True)
        hashes = np.array([digest(joined[a:b], seed) for a, b in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits(set_bits * 2 > len(first), bitorder="little")
    return int(packed.view("<i8")[0])


def fingerprints(
    docs: DataFrame, width: int = 4, text_col: str = "text", carry: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """The ``carry`` columns and ``fp``, the fingerprint of the whole text."""

    def start():
        return lambda texts: {"fp": [fingerprint(t, width) for t in texts]}

    return map_texts(docs, start, "fp long", text_col, carry)


class BKTree:
    """A BK-tree over distinct fingerprints, filled and searched a level at a time.

    ``child[node, d]`` is the child at Hamming distance ``d`` of the node, or -1; the
    nodes are the positions in ``values`` and position 0 is the root.
    """

    def __init__(self, values: np.ndarray):
        self.values = values
        self.child = np.full((len(values), BITS + 1), -1, np.int32)
        waiting = np.arange(1, len(values))
        at = np.zeros(len(waiting), np.int64)
        while len(waiting):
            distance = np.bitwise_count(values[waiting] ^ values[at])
            below = self.child[at, distance]
            free = np.flatnonzero(below < 0)
            _, first = np.unique(at[free] * (BITS + 1) + distance[free], return_index=True)
            placed = free[first]  # the first to come to a free edge becomes the child there
            self.child[at[placed], distance[placed]] = waiting[placed]
            at = self.child[at, distance].astype(np.int64)
            moving = at != waiting
            waiting, at = waiting[moving], at[moving]

    def search(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """All (query, node) positions within ``radius``, following only such edges."""
        found: list[tuple[np.ndarray, np.ndarray]] = []
        asked = np.arange(len(queries))
        at = np.zeros(len(queries), np.int64)
        while len(asked):
            distance = np.bitwise_count(queries[asked] ^ self.values[at]).astype(np.int64)
            near = distance <= radius
            found.append((asked[near], at[near]))
            nexts = []
            for step in range(-radius, radius + 1):
                edge = distance + step
                fits = np.flatnonzero((edge >= 0) & (edge <= BITS))
                below = self.child[at[fits], edge[fits]]
                go = below >= 0
                nexts.append((asked[fits[go]], below[go].astype(np.int64)))
            asked = np.concatenate([a for a, _ in nexts])
            at = np.concatenate([b for _, b in nexts])
        return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def _merge(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Lower the labels of linked positions until each linked set has its least one."""
    while True:
        least = np.minimum(labels[a], labels[b])
        before = labels.copy()
        np.minimum.at(labels, a, least)
        np.minimum.at(labels, b, least)
        labels = labels[labels]
        if np.array_equal(labels, before):
            return labels


def shard_links(tree_side: np.ndarray, query_side: np.ndarray | None, radius: int) -> Iterator[tuple[int, int]]:
    """Links that connect what lies within ``radius``: one per fingerprint, not one per pair.

    Without a query side the tree is searched with its own fingerprints.
    """
    values = tree_side if query_side is None else np.concatenate([tree_side, query_side])
    tree = BKTree(tree_side)
    labels = np.arange(len(values))
    offset = 0 if query_side is None else len(tree_side)
    asked = values[offset:]
    for k in range(0, len(asked), 256):
        query, node = tree.search(asked[k : k + 256], radius)
        # the roots are joined, and with them all that earlier batches put under them
        labels = _merge(labels, labels[query + offset + k], labels[node])
    moved = np.flatnonzero(labels != np.arange(len(values)))
    return zip(values[moved].view(np.int64).tolist(), values[labels[moved]].view(np.int64).tolist(), strict=True)


def band_masks(rows: int, radius: int) -> list[int]:
    """Bit masks such that two fingerprints within ``radius`` agree under one of them.

    The bits are cut into ``b`` blocks; ``radius`` changed bits leave ``b - radius``
    blocks untouched, so every choice of so many blocks is a mask. More blocks give
    longer keys, that is smaller shards, and more masks: ``b`` is the least whose keys
    are as many as the rows.
    """
    for blocks in range(radius + 1, radius + 5):
        kept = blocks - radius
        edges = [BITS * k // blocks for k in range(blocks + 1)]
        if BITS * kept // blocks >= np.log2(max(rows, 2)):
            break
    parts = [(1 << hi) - (1 << lo) for lo, hi in zip(edges, edges[1:], strict=False)]
    return [sum(c) for c in combinations(parts, kept)]


def links(classes: DataFrame, radius: int = 4, tree_rows: int = TREE_ROWS) -> DataFrame:
    """Links (a, b) of the distinct fingerprints ``fp`` that connect all within ``radius``.

    Fingerprints are dealt to shards by the bits under each mask, so both ends of a
    link meet in a shard. Each shard becomes a BK-tree, sent to the task of those that
    ask it; a shard of over ``tree_rows`` rows becomes several trees, each asked by
    the rows of every tree of the shard in tasks of their own. A task holds one tree
    and the rows of one more. Only connecting links leave it, never all pairs.
    """
    masks = band_masks(classes.count(), radius)
    signed = [m - (1 << 64) if m >= 1 << 63 else m for m in masks]
    keys = F.array(*(F.col("fp").bitwiseAND(F.lit(m)) for m in signed))
    together = Window.partitionBy("mask", "key")
    trees = F.ceil(F.col("_n") / tree_rows).cast("int")
    members = (
        classes.select("fp", F.posexplode(keys).alias("mask", "key"))
        .withColumn("_n", F.count(F.lit(1)).over(together))
        .where("_n > 1")
        .withColumn("_trees", trees)
        .withColumn("_own", F.pmod(F.xxhash64("fp"), F.col("_trees")).cast("int"))
    )
    units = members.select(
        "mask",
        "key",
        "fp",
        "_own",
        F.explode(F.sequence(F.lit(0), F.col("_trees") - 1)).alias("_other"),
    ).select(
        "mask",
        "key",
        F.least("_own", "_other").alias("tree"),
        F.greatest("_own", "_other").alias("asking"),
        F.col("_own").alias("own"),
        "fp",
    )
    unit = ["mask", "key", "tree", "asking"]
    dealt = units.repartition(*unit).sortWithinPartitions(*unit, "own", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, own, fps in _groups(batches):
            at_tree = own == name[2]
            asking = None if name[2] == name[3] else fps[~at_tree]
            if asking is None or (len(asking) and at_tree.any()):
                found = list(shard_links(fps[at_tree], asking, radius))
                if found:
                    a, b = zip(*found, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"]
                    )

    return dealt.mapInArrow(run, "a long, b long")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, np.ndarray, np.ndarray]]:
    """The runs of equal (mask, key, tree, asking) in sorted batches, with own and fp."""
    name, held = None, []
    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        unit = np.stack([c.astype(np.int64) for c in columns[:4]])
        cuts = np.flatnonzero((unit[:, 1:] != unit[:, :-1]).any(axis=0)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            if hi == lo:
                continue
            this = tuple(unit[:, lo].tolist())
            if this != name and held:
                yield name, *(np.concatenate(x) for x in zip(*held, strict=True))
                held = []
            name = this
            held.append((columns[4][lo:hi], columns[5][lo:hi].view(np.uint64)))
    if held:
        yield name, *(np.concatenate(x) for x in zip(*held, strict=True))


def class_components(marked: DataFrame, radius: int, id_col: str) -> DataFrame:
    """(fp, root, component_id) of every distinct fingerprint of ``marked`` (fp, id_col)."""
    classes = materialize(marked.groupBy("fp").agg(F.min(id_col).alias("least_id")))
    linked = components(links(classes, radius)).withColumnRenamed("node", "fp")
    rooted = classes.join(linked, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return rooted.select("fp", "root").join(least, "root").select("fp", "root", "component_id")


def near_duplicates(
    docs: DataFrame, radius: int = 4, width: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, fp, component_id (smallest doc_id reachable by links).

    Two documents are linked if their fingerprints differ in ``radius`` bits or less.
    Equal fingerprints collapse before any search, so a group of copies counts once.
    Null and empty texts have fingerprint zero, which links like any other. Repeated
    rows stay separate rows of one component; a null id is never the smallest unless
    a component has no other. An empty table gives an empty result.
    """
    marked = materialize(
        fingerprints(docs.select(F.col(id_col).alias("doc_id"), text_col), width, text_col)
    )
    named = class_components(marked, radius, "doc_id").select("fp", "component_id")
    return marked.join(named, "fp").select("doc_id", "fp", "component_id")


def _numbered(docs: DataFrame, names: tuple[str, str]) -> DataFrame:
    """``docs`` with two columns that name each row, the same at every reading.

    A row of a Parquet table is named by its file and its place in it, however the files
    are split among tasks. Rows of any other source are numbered and written once.
    """
    try:
        return docs.select(
            "*", F.col("_metadata.file_path").alias(names[0]), F.col("_metadata.row_index").alias(names[1])
        )
    except AnalysisException:
        number = F.monotonically_increasing_id()
        return materialize(docs.select("*", F.lit("").alias(names[0]), number.alias(names[1])))


def keep_one(
    docs: DataFrame, radius: int = 4, width: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs``, all columns, without all but one of each component.

    The row of the smallest id stays; of repeated ids the one that stands first, and a null
    id only if the component has no other. ``docs`` is read twice, with jobs between, so
    rows are told apart by where they stand in their files (or by a number that is written
    once), never by a number given anew: that would follow how the files are split, which
    changes with the executors.
    """
    names = ("_file", "_place")
    while set(names) & set(docs.columns):
        names = (names[0] + "_", names[1] + "_")
    numbered = _numbered(docs, names)
    slim = numbered.select(
        *(F.col(n).alias(a) for n, a in zip(names, ("file", "place"), strict=True)),
        F.col(id_col).alias("id"),
        F.col(text_col).alias("body"),
    )
    marked = materialize(fingerprints(slim, width, "body", ("file", "place", "id")))
    found = marked.join(class_components(marked, radius, "id").select("fp", "root"), "fp")
    first = F.min(F.struct(F.col("id").isNull(), F.col("id"), F.col("file"), F.col("place")))
    chosen = found.groupBy("root").agg(first.alias("first"))
    stay = materialize(chosen.select(F.col("first.file").alias(names[0]), F.col("first.place").alias(names[1])))
    # never a broadcast: what stays grows with the documents, and the plan is to be one at every size
    return numbered.join(stay.hint("merge"), list(names), "left_semi").drop(*names)
