"""Vector maths: column expressions and Arrow kernels for dense products.

Spark's higher-order functions are interpreted element by element, so dot
products against a table of prompts or seeds run as one matrix product per Arrow
batch. Those tables are bounded by a checked size before they are shipped.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A vector table larger than this is processed in blocks of this size.
MAX_BLOCK_BYTES = 64 * 1024 * 1024
MAX_BLOCK_ROWS = 8192


def doubles(v: Column) -> Column:
    return v.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    """Dot product of two array columns, summed in index order."""
    return F.aggregate(
        F.zip_with(doubles(a), doubles(b), lambda x, y: x * y),
        F.lit(0.0),
        lambda total, x: total + x,
    )


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def unit(v: Column) -> Column:
    """L2-normalised copy; a zero vector becomes null."""
    length = norm(v)
    return F.when(length > 0, F.transform(doubles(v), lambda x: x / length))


def euclidean(a: Column, b: Column) -> Column:
    return F.sqrt(
        F.aggregate(
            F.zip_with(doubles(a), doubles(b), lambda x, y: (x - y) * (x - y)),
            F.lit(0.0),
            lambda total, x: total + x,
        )
    )


def mean_vector(v: Column) -> Column:
    """Aggregate: element-wise mean, combined map-side without exploding."""
    return vector_to_array(Summarizer.mean(array_to_vector(doubles(v))))


def bounded_rows(
    df: DataFrame, vector: str = "vector", max_bytes: int = MAX_BLOCK_BYTES
) -> tuple[list | None, int]:
    """(rows, dimension) of a small vector table.

    Rows are None when there are more than ``MAX_BLOCK_ROWS`` or their vectors take
    more than ``max_bytes``; then none but the first is fetched.
    """
    first = df.select(F.size(vector)).first()
    dim = first[0] if first else 0
    most = min(MAX_BLOCK_ROWS, max_bytes // (8 * max(dim, 1)))
    fits = df.limit(most + 1).count() <= most
    return (df.collect() if fits else None), dim


def batch_matrix(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(validity, float64 matrix of the valid rows) of an Arrow list column."""
    valid = np.asarray(column.is_valid())
    flat = column.drop_null().flatten().to_numpy(zero_copy_only=False)
    return valid, flat.astype(np.float64).reshape(-1, dim)


def list_column(valid: np.ndarray, values: np.ndarray) -> pa.Array:
    """Arrow list column with one row of ``values`` per valid position."""
    width = values.shape[1]
    offsets = np.concatenate([[0], np.cumsum(np.where(valid, width, 0))]).astype(np.int32)
    return pa.ListArray.from_arrays(
        pa.array(offsets), pa.array(values.reshape(-1)), mask=pa.array(~valid)
    )


def products(embedding: Column, vectors: Sequence[Sequence[float]]) -> Column:
    """Dot products with every given vector, as one array per row."""
    matrix = np.asarray(vectors, dtype=np.float64)

    @F.arrow_udf("array<double>")
    def scores(column: pa.Array) -> pa.Array:
        valid, x = batch_matrix(column, matrix.shape[1])
        return list_column(valid, x @ matrix.T)

    return scores(embedding)


def distance_to(embedding: Column, index: Column, centres: Sequence[Sequence[float]]) -> Column:
    """Euclidean distance of each row to the centre with the given index."""
    matrix = np.asarray(centres, dtype=np.float64)

    @F.arrow_udf("double")
    def distances(column: pa.Array, which: pa.Array) -> pa.Array:
        valid, x = batch_matrix(column, matrix.shape[1])
        chosen = which.to_numpy(zero_copy_only=False)[valid].astype(np.int64)
        out = np.full(len(column), np.nan)
        out[valid] = np.linalg.norm(x - matrix[chosen], axis=1)
        return pa.array(out, mask=~valid)

    return distances(doubles(embedding), index)
