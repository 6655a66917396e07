"""Reply trees to formatted conversations: paths by self-joins, ranked branches, a chat template."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spark_curate.functions.session import materialize

START, END = "<|im_start|>", "<|im_end|>"
TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + r"\n", re.DOTALL)

FORMATTED = (
    "tree long, leaf long, n_turns long, formatted string, "
    "loss_spans array<struct<start:bigint,length:bigint>>"
)


def escape(text: str) -> str:
    """``<`` and ``|`` never meet in the result: one backslash more stands between them."""
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def render(role: str, text: str) -> tuple[str, int, int]:
    """One turn of the template, and where the text stands in it."""
    head = f"{START}{escape_role(role)}\n"
    body = escape(text)
    return f"{head}{body}{END}\n", len(head), len(body)


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns (role, text) of a formatted conversation."""
    return [(unescape_role(r), unescape(t)) for r, t in TURN.findall(formatted)]


def branches(nodes: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(tree, leaf, depth, score) of every root-to-leaf path, and the jumps found on the way.

    Each round joins the table of ancestors with itself, so round ``k`` knows the
    ``2**k``-th ancestor of every node and the score of the stretch below it: a thread of
    a thousand replies takes ten rounds, of which all but the first few concern only the
    nodes far from their root. ``jumps[k]`` is (node, anc) at that distance. Nodes on a
    cycle never end; after as many rounds as the nodes allow they are left out. Each
    round is written to the shared folder.
    """
    slim = nodes.select("tree", "node", "parent", F.coalesce("score", F.lit(0.0)).alias("score"))
    known = slim.select(F.col("node").alias("_node"), F.col("tree").alias("_tree"))
    state = materialize(
        slim.join(known, (F.col("parent") == F.col("_node")) & F.col("tree").eqNullSafe(F.col("_tree")), "left").select(
            "tree", "node", F.col("_node").alias("anc"), F.lit(1).cast("long").alias("depth"), "score"
        )
    )
    leaves = state.select("node").join(state.select(F.col("anc").alias("node")), "node", "left_anti")
    total = state.count()
    ended, walking = state.where("anc is null"), state.where("anc is not null")
    jumps = []
    while len(jumps) <= total.bit_length() and not walking.isEmpty():
        jumps.append(walking.select("node", "anc"))
        above = ended.union(walking).select(
            F.col("node").alias("anc"),
            F.col("anc").alias("_anc"),
            F.col("depth").alias("_depth"),
            F.col("score").alias("_score"),
        )
        moved = materialize(
            walking.join(above, "anc").select(
                "tree",
                "node",
                F.col("_anc").alias("anc"),
                (F.col("depth") + F.col("_depth")).alias("depth"),
                (F.col("score") + F.col("_score")).alias("score"),
            )
        )
        ended, walking = ended.union(moved.where("anc is null")), moved.where("anc is not null")
    return ended.join(leaves, "node", "left_semi").select("tree", F.col("node").alias("leaf"), "depth", "score"), jumps


def ranked(paths: DataFrame) -> DataFrame:
    """Add rank: the branches of a tree by mean score, then depth, then the leaf."""
    order = Window.partitionBy("tree").orderBy(F.desc(F.col("score") / F.col("depth")), F.desc("depth"), "leaf")
    return paths.withColumn("rank", F.row_number().over(order))


def path_nodes(chosen: DataFrame, jumps: list[DataFrame]) -> DataFrame:
    """(tree, leaf, node, up) for every node of the chosen paths, ``up`` steps above the leaf.

    From the longest jump to the shortest, every node met so far also sends its
    ancestor at that distance: each step of the path is met exactly once.
    """
    met = chosen.select("tree", "leaf", F.col("leaf").alias("node"), F.lit(0).cast("long").alias("up"))
    for k in reversed(range(len(jumps))):
        both = F.array(
            F.struct(F.col("node"), F.col("up")),
            F.struct(F.col("anc").alias("node"), (F.col("up") + (1 << k)).alias("up")),
        )
        met = (
            met.join(jumps[k], "node", "left")
            .select("tree", "leaf", F.inline(both))
            .where("node is not null")
        )
    return met


def format_paths(turns: DataFrame) -> DataFrame:
    """One formatted conversation per (tree, leaf) of ``turns`` (tree, leaf, up, role, text).

    Turns stand from the root down. ``loss_spans`` are the code points of the assistant
    texts. Rows stream through the task in order; what it holds is one conversation.
    """
    keys = ["tree", "leaf"]
    dealt = (
        turns.select(*keys, "up", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
        .repartition(*keys)
        .sortWithinPartitions(*keys, F.desc("up"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, parts, spans, at = None, [], [], 0

        def made() -> pa.RecordBatch:
            row = {"tree": name[0], "leaf": name[1], "n_turns": len(parts), "formatted": "".join(parts), "loss_spans": spans}
            return pa.RecordBatch.from_pylist([row], schema=schema)

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("tree", "leaf", "role", "text"))
            for tree, leaf, role, text in zip(*columns, strict=True):
                if name != (tree, leaf):
                    if name:
                        yield made()
                    name, parts, spans, at = (tree, leaf), [], [], 0
                turn, start, length = render(role, text)
                if role == "assistant":
                    spans.append({"start": at + start, "length": length})
                parts.append(turn)
                at += len(turn)
        if name:
            yield made()

    span = pa.struct([("start", pa.int64()), ("length", pa.int64())])
    schema = pa.schema(
        [("tree", pa.int64()), ("leaf", pa.int64()), ("n_turns", pa.int64()), ("formatted", pa.string()), ("loss_spans", pa.list_(span))]
    )
    return dealt.mapInArrow(run, FORMATTED)


def conversations(nodes: DataFrame, per_tree: int = 1) -> DataFrame:
    """Format the ``per_tree`` best branches of every reply tree.

    ``nodes``: tree, node (unique), parent (null at a root), role, text, score; other
    columns are not looked at. A node whose parent is not in its tree is a root; a tree
    with several roots has the paths of all. Null roles and texts count as empty, null
    scores as 0; nodes on cycles lie on no path. Branches are ranked by mean score; ties
    go to the longer, then to the smaller leaf. An empty table gives an empty result.
    Returns tree, leaf, n_turns, formatted, loss_spans.
    """
    paths, jumps = branches(nodes)
    chosen = ranked(paths).where(F.col("rank") <= per_tree)
    said = nodes.select("node", "role", "text")
    return format_paths(path_nodes(chosen, jumps).join(said, "node"))


def threads(rows: DataFrame, tree_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """Rows by turn as reply trees: each row replies to the one before it.

    The rows are numbered in the order of conversation and turn (then role, text, place
    of reading) by range partitions, so a conversation holding a third of all rows is
    numbered by many tasks; the row before a conversation's first belongs to another
    tree and so is no parent.
    """
    order = ["tree", "turn", "role", "text", "_row"]
    placed = materialize(
        rows.select(
            F.col(tree_col).cast("long").alias("tree"),
            F.col(turn_col).cast("long").alias("turn"),
            F.col("role").cast("string").alias("role"),
            F.col("text").cast("string").alias("text"),
            F.monotonically_increasing_id().alias("_row"),
        )
        .repartitionByRange(*order)
        .withColumn("_part", F.spark_partition_id())
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("_part").count().select(  # one row per partition of the shuffle
        "_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before")
    )
    within = Window.partitionBy("_part").orderBy(*order)
    numbered = placed.withColumn("_nth", F.row_number().over(within)).join(F.broadcast(offsets), "_part")
    node = F.col("_before") + F.col("_nth")
    return materialize(
        numbered.select("tree", node.alias("node"), (node - 1).alias("parent"), "role", "text", F.lit(1.0).alias("score"))
    )


def digests(formatted: DataFrame) -> DataFrame:
    """What formatted conversations say when read back: turns and loss text as digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for tree, text, spans in zip(
                *(batch.column(c).to_pylist() for c in ("tree", "formatted", "loss_spans")), strict=True
            ):
                turns = parse(text)
                said, loss, chars = hashlib.sha256(), hashlib.sha256(), 0
                for role, body in turns:
                    said.update(f"{role}\n{body}\n".encode())
                for span in spans:
                    part = unescape(text[span["start"] : span["start"] + span["length"]])
                    loss.update(part.encode())
                    chars += len(part)
                rows.append(
                    {
                        "conv_id": tree,
                        "n_turns": len(turns),
                        "turns_sha256": said.hexdigest(),
                        "loss_chars": chars,
                        "loss_sha256": loss.hexdigest(),
                        "formatted_chars": len(text),
                    }
                )
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    schema = pa.schema(
        [
            ("conv_id", pa.int64()),
            ("n_turns", pa.int64()),
            ("turns_sha256", pa.string()),
            ("loss_chars", pa.int64()),
            ("loss_sha256", pa.string()),
            ("formatted_chars", pa.int64()),
        ]
    )
    ddl = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return formatted.select("tree", "formatted", "loss_spans").mapInArrow(run, ddl)
