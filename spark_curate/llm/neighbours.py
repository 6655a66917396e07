"""Approximate nearest neighbours by an inverted multi-index."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spark_curate.functions.session import materialize

#: Centroids of each half; the index has the square of it as cells.
CENTROIDS = 32
#: The centroids and the share of the rows to visit are fitted on so many vectors at most.
SAMPLE_ROWS = 20_000
SAMPLE_QUERIES = 256
ROUNDS = 12
#: Recall on the sample that the share of visited rows is chosen for.
TARGET = 0.96
#: A query never visits fewer rows than this (or all there are).
LEAST_ROWS = 1_000
#: Most rows of a cell, and most queries of a cell, that meet in one task.
UNIT_ROWS = 4096


@dataclass
class Index:
    """Centroids of the two halves and the share of rows a query visits."""

    first: np.ndarray
    second: np.ndarray
    share: float


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows.astype(np.float64)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _squares(rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return (rows**2).sum(axis=1)[:, None] - 2 * rows @ centroids.T + (centroids**2).sum(axis=1)


def _centroids(rows: np.ndarray, count: int, seed: int) -> np.ndarray:
    """Lloyd's rounds from rows drawn at random; an emptied centroid keeps its place."""
    rng = np.random.default_rng(seed)
    centres = rows[rng.choice(len(rows), min(count, len(rows)), replace=False)].copy()
    for _ in range(ROUNDS):
        nearest = _squares(rows, centres).argmin(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, rows)
        sizes = np.bincount(nearest, minlength=len(centres))
        centres[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0, None]
    return centres


def cells_of(rows: np.ndarray, index: Index) -> np.ndarray:
    """The cell of each unit vector: nearest first half, then nearest second half."""
    half = index.first.shape[1]
    a = _squares(rows[:, :half], index.first).argmin(axis=1)
    b = _squares(rows[:, half:], index.second).argmin(axis=1)
    return a * len(index.second) + b


def traverse(first: np.ndarray, second: np.ndarray) -> Iterator[int]:
    """Cells by rising sum of the distances to their two centroids.

    A heap holds the frontier in the grid of the two sorted lists; a pair enters it
    once both its predecessors have left.
    """
    rows, columns = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    x, y = first[rows].tolist(), second[columns].tolist()
    rows, columns = rows.tolist(), columns.tolist()
    heap = [(x[0] + y[0], 0, 0)]
    reached = [0] * len(x)  # in each row of the grid, how many columns have left
    while heap:
        _, i, j = heapq.heappop(heap)
        reached[i] = j + 1
        yield rows[i] * len(y) + columns[j]
        if i + 1 < len(x) and reached[i + 1] == j:
            heapq.heappush(heap, (x[i + 1] + y[j], i + 1, j))
        if j + 1 < len(y) and (i == 0 or reached[i - 1] > j + 1):
            heapq.heappush(heap, (x[i] + y[j + 1], i, j + 1))


def visits(query: np.ndarray, index: Index, counts: np.ndarray, least: int) -> list[int]:
    """The filled cells a query visits: by the traversal, until they hold ``least`` rows."""
    half = index.first.shape[1]
    found, rows = [], 0
    for cell in traverse(
        _squares(query[None, :half], index.first)[0], _squares(query[None, half:], index.second)[0]
    ):
        if counts[cell]:
            found.append(cell)
            rows += int(counts[cell])
            if rows >= least:
                break
    return found


def fit(sample: np.ndarray, neighbours: int, centroids: int = CENTROIDS, target: float = TARGET) -> Index:
    """Fit on a sample of distinct vectors; the share visited is what reaches ``target`` there.

    Sample queries are searched among the sample by brute force, and the share is the
    least by which ``target`` of their neighbours have been met in the traversal.
    """
    rows = _unit(sample)
    half = rows.shape[1] // 2
    index = Index(_centroids(rows[:, :half], centroids, 1), _centroids(rows[:, half:], centroids, 2), 1.0)
    cells = cells_of(rows, index)
    counts = np.bincount(cells, minlength=len(index.first) * len(index.second))
    needed: list[float] = []
    for q in range(min(SAMPLE_QUERIES, len(rows))):
        likeness = rows @ rows[q]
        likeness[q] = -np.inf
        best = np.argsort(-likeness, kind="stable")[: min(neighbours, len(rows) - 1)]
        order = visits(rows[q], index, counts, len(rows) + 1)
        before = dict(zip(order, (np.cumsum(counts[order]) - counts[order]).tolist(), strict=True))
        needed += [(before[c] + 1) / len(rows) for c in cells[best].tolist()]
    index.share = float(np.quantile(needed, target)) if needed else 1.0
    return index


def _valid(vector: Column) -> Column:
    """Not null, no null or non-finite component, not zero."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~odd & F.exists(vector, lambda x: x != 0)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    rows = column.combine_chunks()
    return rows.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1).astype(np.float64)


def _best(unit: pa.Table, asking: pa.Table, keep: int) -> pa.Table:
    """The ``keep`` nearest classes of a unit for every query class that asks it."""
    if not unit.num_rows or not asking.num_rows:
        return pa.table({"query": pa.array([], pa.int64()), "least_id": pa.array([], pa.int64()),
                         "ids": pa.array([], pa.list_(pa.int64())), "score": pa.array([], pa.float64())})
    rows, queries = _matrix(unit["vector"]), _matrix(asking["vector"])
    norms, query_norms = np.sqrt((rows**2).sum(axis=1)), np.sqrt((queries**2).sum(axis=1))
    likeness = queries @ rows.T / query_norms[:, None] / norms
    least = unit["least_id"].to_numpy()
    take = min(keep, len(rows))
    chosen = np.lexsort((np.broadcast_to(least, likeness.shape), -likeness), axis=1)[:, :take]
    who = np.repeat(np.arange(len(queries)), take)
    what = chosen.ravel()
    # the final score does not depend on which rows stood together
    exact = np.clip((queries[who] * rows[what]).sum(axis=1) / (query_norms[who] * norms[what]), -1.0, 1.0)
    return pa.table({
        "query": asking["query"].take(pa.array(who)),
        "least_id": unit["least_id"].take(pa.array(what)),
        "ids": unit["ids"].take(pa.array(what)),
        "score": pa.array(exact),
    })


def nearest(
    vectors: DataFrame,
    asking: Column,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    centroids: int = CENTROIDS,
    target: float = TARGET,
) -> DataFrame:
    """The ``k`` nearest found by cosine for every row where ``asking`` holds, but itself.

    Equal vectors are one class, which keeps the ``k + 1`` smallest of its ids: enough
    for any query, and a vector that a third of all rows share is indexed and asked
    once. Classes are put into the cells of two quantised halves; a query class walks
    the centroid pairs by summed distance until the cells passed hold the fitted share
    of all classes (and at least ``LEAST_ROWS``, so small tables are searched whole); those
    cells are reranked by the cosine in double precision. Cells and their queries meet
    in units of bounded size.

    Rows that are null, zero, of another length than most, or hold a null or
    non-finite component take no part; null ids neither. Repeated rows (id and vector)
    count once. Ties go to the smaller id. An empty table gives an empty result; other
    columns are not looked at. Returns query_id, rank, vec_id, score.
    """
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(vector_col).alias("vector"),
        F.coalesce(asking, F.lit(False)).alias("asking"),
    ).where(F.col("id").isNotNull() & _valid(F.col("vector")))
    lengths = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    width = lengths["n"] if lengths else 0
    kept = rows.where(F.size("vector") == width).groupBy("vector", "id").agg(F.max("asking").alias("asking"))
    kept = materialize(kept)
    by_id = Window.partitionBy("vector").orderBy("id")
    few = kept.withColumn("_nth", F.row_number().over(by_id)).where(F.col("_nth") <= k + 1)
    classes = materialize(
        few.groupBy("vector")
        .agg(F.sort_array(F.collect_list("id")).alias("ids"))
        .withColumn("least_id", F.col("ids")[0])
        .withColumn("query", F.xxhash64("least_id", "vector"))
    )
    total = classes.count()
    if not total:
        empty = "query_id long, rank int, vec_id long, score double"
        return spark.createDataFrame([], empty)

    share = min(1.0, SAMPLE_ROWS / total)
    drawn = F.xxhash64("query").bitwiseAND(F.lit((1 << 53) - 1)) / float(1 << 53)
    sample = classes.where(drawn <= share).orderBy("query").limit(SAMPLE_ROWS).select("vector").toArrow()
    index = fit(_matrix(sample["vector"]), k + 1, centroids, target)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cells = cells_of(_unit(_matrix(pa.chunked_array([batch.column("vector")]))), index)
                yield batch.append_column("cell", pa.array(cells.astype(np.int32)))

    placed = materialize(
        classes.mapInArrow(place, T.StructType([*classes.schema.fields, T.StructField("cell", T.IntegerType())]))
    )
    cells = len(index.first) * len(index.second)
    counts = np.zeros(cells, np.int64)
    for row in placed.groupBy("cell").count().collect():  # a row per cell, whatever the table's size
        counts[row["cell"]] = row["count"]
    least = max(k + 1, LEAST_ROWS, int(np.ceil(index.share * total)))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                queries = _unit(_matrix(pa.chunked_array([batch.column("vector")])))
                met = [visits(q, index, counts, least) for q in queries]
                yield batch.append_column("cells", pa.array(met, pa.list_(pa.int32())))

    askers = kept.where("asking").select("vector").distinct()
    asked = classes.join(askers, "vector").select("query", "vector")
    visiting = asked.mapInArrow(
        walk, T.StructType([*asked.schema.fields, T.StructField("cells", T.ArrayType(T.IntegerType()))])
    ).select("query", "vector", F.explode("cells").alias("cell"))

    # a cell of many rows is dealt into parts, and so are its queries
    parts = F.element_at(F.lit([max(1, -(-int(c) // UNIT_ROWS)) for c in counts]), F.col("cell") + 1)
    turns = max(1, -(-asked.count() // UNIT_ROWS))
    unit_rows = (
        placed.select("cell", "vector", "ids", "least_id", F.pmod(F.xxhash64("vector"), parts).cast("int").alias("part"))
        .withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(turns - 1))))
    )
    unit_queries = (
        visiting.withColumn("turn", F.pmod(F.xxhash64("query"), F.lit(turns)).cast("int"))
        .withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
    )
    unit = ["cell", "part", "turn"]
    met = (
        unit_rows.groupBy(*unit)
        .cogroup(unit_queries.groupBy(*unit))
        .applyInArrow(
            lambda left, right: _best(left, right, k + 1),
            "query long, least_id long, ids array<long>, score double",
        )
    )
    order = [F.desc("score"), F.col("least_id")]
    near = (
        met.withColumn("_nth", F.row_number().over(Window.partitionBy("query").orderBy(*order)))
        .where(F.col("_nth") <= k + 1)
        .select("query", "score", F.explode("ids").alias("vec_id"))
    )
    first = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    near = materialize(
        near.withColumn("_nth", F.row_number().over(first))
        .where(F.col("_nth") <= k + 1)
        .join(asked, "query")
        .select("vector", "vec_id", "score")
    )
    own = Window.partitionBy("query_id", "vector").orderBy(F.desc("score"), "vec_id")
    return (
        kept.where("asking")
        .select(F.col("id").alias("query_id"), "vector")
        .join(near, "vector")
        .where("query_id <> vec_id")
        .withColumn("rank", F.row_number().over(own).cast("int"))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
