"""k-means of many models at once: every pass over the rows serves all of them.

A search over cluster counts and restarts is hundreds of models. Fitted one after another
each needs its own chain of passes; here a tile of rows meets the centres of all models in
matrix products, and a task leaves one row of sums per model. Models whose centres rest
leave the passes.

Nearest centres are found in single precision and settled in double precision where that
leaves a doubt. The places of one pass are kept with the rows, so later passes only move
those rows between the sums that have changed their place since.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of a batch that meet all centres at once.
ROWS = 512
#: Rows of a tile of a pass, so that its tables of distances stay in the caches.
TILE = 512
#: Rows whose changes of place are added to the sums at once.
CHUNK = 4096
#: Places are kept anew once so many times all of them were moved between sums.
RENEW = 0.4
#: Numbers that settling doubtful rows holds at once.
SETTLED = 1 << 20
#: Sums of tasks are added in so many groups before they reach the driver.
FAN = 16
#: Candidates drawn for each cluster of the largest model, and rounds of drawing.
OVERSAMPLING, ROUNDS = 2, 4
#: A model rests once none of its centres moves further.
TOLERANCE = 1e-4


@dataclass
class Model:
    """One fit: its centres, the rows nearest to each, and the summed squared distances."""

    k: int
    restart: int
    centres: np.ndarray
    cost: float = np.inf
    counts: np.ndarray = field(default_factory=lambda: np.empty(0))
    iterations: int = 0


def arrays(features: DataFrame) -> DataFrame:
    """(image, features) with the features as an array of doubles."""
    kind = features.schema["features"].dataType
    column = F.col("features")
    return features.select(
        "image", (column if isinstance(kind, T.ArrayType) else vector_to_array(column)).cast("array<double>").alias("features")
    )


def _matrix(column: pa.ListArray, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of rows and centres, never below zero."""
    found = x @ (-2.0 * centres.T)
    found += np.einsum("ij,ij->i", centres, centres)
    found += np.einsum("ij,ij->i", x, x)[:, None]
    return np.maximum(found, 0.0, out=found)


class Places:
    """The nearest centre in each of several models, for rows (ties: the first).

    One product gives the distances to the j-th centres of all models, in single precision
    about the centres' mean. The lowest bits of a distance give way to j, so plain minima
    leave each model's nearest centre and the distance of the next. Where these two differ by no
    more than the rounding can, the distances are taken again in double precision, by a
    rule that does not hang on the rows around: a row has one place wherever it is met.
    """

    def __init__(self, centres: Sequence[np.ndarray]) -> None:
        self.given = list(centres)
        self.order = sorted(range(len(centres)), key=lambda m: -len(centres[m]))
        self.centres = [centres[m] for m in self.order]
        sizes = np.array([len(c) for c in self.centres])
        self.kind = np.min_scalar_type(sizes[0] - 1)
        self.bits = int(sizes[0] - 1).bit_length()
        self.middle = np.concatenate(centres).mean(axis=0)
        self.reach = max(np.sqrt(((c - self.middle) ** 2).sum(axis=1).max()) for c in self.centres)
        self.layers = []
        for j in range(sizes[0]):
            layer = np.array([c[j] for c in self.centres[: (sizes > j).sum()]]) - self.middle
            lengths = np.einsum("ij,ij->i", layer, layer)
            wide = np.concatenate([-2.0 * layer, lengths[:, None], np.ones((len(layer), 1))], axis=1)
            self.layers.append(wide.astype(np.float32))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """One line of places for each model."""
        found = np.empty((len(self.centres), len(x)), self.kind)
        doubtful = np.empty(found.shape, bool)
        with np.errstate(all="ignore"):  # what single precision cannot hold is doubtful
            for k in range(0, len(x), TILE):
                found[:, k : k + TILE], doubtful[:, k : k + TILE] = self._tile(x[k : k + TILE] - self.middle)
        for place, centres, unsure in zip(found, self.centres, doubtful, strict=True):
            which, step = np.flatnonzero(unsure), max(1, SETTLED // centres.size)
            for k in range(0, len(which), step):
                some = which[k : k + step]
                place[some] = ((x[some][:, None, :] - centres) ** 2).sum(axis=2).argmin(axis=1)
        placed = np.empty_like(found)
        placed[self.order] = found
        return placed

    def _tile(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places, and where they are doubtful."""
        length = np.einsum("ij,ij->i", x, x)
        # no distance is wrong by more; added to all of a row, so that none is below zero
        slack = (x.shape[1] + 10) * 2.0**-23 * (np.sqrt(length) + self.reach) ** 2
        wide = np.concatenate([x, np.ones((len(x), 1)), (length + slack)[:, None]], axis=1)
        wide = np.ascontiguousarray(wide.T, np.float32)
        shape = len(self.centres), len(x)
        least, following = (np.full(shape, np.iinfo(np.int32).max, np.int32) for _ in range(2))
        apart, larger = np.empty(shape, np.float32), np.empty(shape, np.int32)
        low = (1 << self.bits) - 1
        for j, layer in enumerate(self.layers):
            m = len(layer)
            value = np.matmul(layer, wide, out=apart[:m]).view(np.int32)  # ordered like the distances
            value &= ~low
            value |= j
            np.maximum(least[:m], value, out=larger[:m])
            np.minimum(following[:m], larger[:m], out=following[:m])
            np.minimum(least[:m], value, out=least[:m])
        found = least & low
        least, following = ((v & ~low).view(np.float32) for v in (least, following))
        return found, ~(following - least > 2.0 * slack + following * 2.0 ** (self.bits - 23))


def _kept(column: pa.Array, kind: np.dtype) -> np.ndarray:
    """Places as they were kept, one row for each row."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def _send(features: DataFrame, centres: Sequence[np.ndarray]) -> Broadcast:
    return features.sparkSession.sparkContext.broadcast(Places(centres))


@contextmanager
def _sent(features: DataFrame, centres: Sequence[np.ndarray]) -> Iterator[Broadcast]:
    """Places for the tasks of one pass. Hundreds of passes follow, so no node keeps them after it."""
    places = _send(features, centres)
    try:
        yield places
    finally:
        places.destroy()


def placed(features: DataFrame, places: Broadcast) -> DataFrame:
    """(features, places): the rows and their nearest centre in every model."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0)
            if len(column):
                at = np.ascontiguousarray(places.value(_matrix(column, len(column[0]))).T)
                cells = pa.array([line.tobytes() for line in at], pa.binary())
                yield pa.RecordBatch.from_arrays([column, cells], names=["features", "places"])

    return features.select("features").mapInArrow(run, "features array<double>, places binary")


def task_count(features: DataFrame) -> int:
    """Tasks that a pass over the rows takes, as planned now."""
    return features.rdd.getNumPartitions()


def _summed(
    features: DataFrame, tasks: int, width: int, add: Callable[..., None], step: int = ROWS, kind: np.dtype | None = None
) -> np.ndarray:
    """A vector of ``width`` sums over all rows; ``add`` puts those of some rows into it.

    With ``kind``, that of kept places, ``add`` gets the rows, their places and the vector.

    Each task leaves one vector. With many tasks they are added in ``FAN`` groups by tasks
    of their own, so the driver holds ``FAN`` vectors whatever the table.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(width), False
        for batch in batches:
            column = batch.column(0)
            if not len(column):
                continue
            seen = True
            given = [_matrix(column, len(column[0]))]
            if kind is not None:
                given.append(_kept(batch.column(1), kind))
            for k in range(0, len(column), step):
                add(*(part[k : k + step] for part in given), total)
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    def together(table: pa.Table) -> pa.Table:
        total = np.zeros(width)
        for cell in table["sums"]:
            total += np.frombuffer(cell.as_buffer())
        return pa.table({"sums": pa.array([total.tobytes()], pa.binary())})

    partial = features.select("features", *(["places"] if kind is not None else [])).mapInArrow(run, "sums binary")
    if tasks > FAN:
        grouped = partial.withColumn("_to", F.spark_partition_id() % FAN).groupBy("_to")
        partial = grouped.applyInArrow(lambda t: together(t.select(["sums"])), "sums binary")
    total = np.zeros(width)
    for cell in partial.toArrow()["sums"]:  # at most FAN rows, of a size that the models set
        total += np.frombuffer(cell.as_buffer())
    return total


def candidates(
    features: DataFrame, tasks: int, size: int, seed: int, rounds: int = ROUNDS
) -> tuple[np.ndarray, np.ndarray]:
    """Rows spread over the data, and how many rows are nearest to each.

    ``size`` rows are drawn in each round, in proportion to the squared distance from
    those drawn before (the first evenly), by the least of random numbers divided by that
    weight. The numbers hang on the row's name, so a lost task draws the same again. One
    round is one pass in which a task keeps its own ``size`` best.
    """
    chosen: np.ndarray | None = None
    for number in range(rounds):
        bits = F.xxhash64("image", F.lit(seed), F.lit(number)).bitwiseAND(F.lit((1 << 53) - 1))
        drawn = features.select("features", "image", ((bits + 1) / float(1 << 53)).alias("u"))

        def run(batches: Iterator[pa.RecordBatch], chosen=chosen) -> Iterator[pa.RecordBatch]:
            best: list[tuple[np.ndarray, np.ndarray, list]] = []
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = _matrix(batch.column(0), len(batch.column(0)[0]))
                parts = [x[k : k + ROWS] for k in range(0, len(x), ROWS)]
                weight = np.ones(len(x)) if chosen is None else np.concatenate([_squares(p, chosen).min(axis=1) for p in parts])
                with np.errstate(divide="ignore"):
                    key = np.where(weight > 1e-12, -np.log(batch.column(2).to_numpy()) / weight, np.inf)
                best.append((key, x, batch.column(1).to_pylist()))
                key, x = (np.concatenate([b[i] for b in best]) for i in (0, 1))
                names = [n for b in best for n in b[2]]
                keep = np.argsort(key, kind="stable")[:size]
                keep = keep[np.isfinite(key[keep])]
                best = [(key[keep], x[keep], [names[i] for i in keep])]
            for key, x, names in best:
                if len(key):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key), pa.array(list(x), pa.list_(pa.float64())), pa.array(names, pa.string())],
                        names=["key", "features", "image"],
                    )

        named = drawn.withColumn("image", F.col("image").cast("string"))
        found = named.mapInArrow(run, "key double, features array<double>, image string")
        rows = found.orderBy("key", "image").limit(size).collect()
        if rows:
            fresh = np.array([r["features"] for r in rows])
            chosen = fresh if chosen is None else np.concatenate([chosen, fresh])
    if chosen is None:
        raise ValueError("no rows to draw from")
    points = chosen

    def add(x: np.ndarray, total: np.ndarray) -> None:
        total += np.bincount(_squares(x, points).argmin(axis=1), minlength=len(points))

    return points, _summed(features, tasks, len(points), add)


def seeded(points: np.ndarray, weights: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """``k`` of the weighted candidates, each new one in proportion to its squared distance."""
    chosen = [int(rng.choice(len(points), p=weights / weights.sum()))]
    nearest = ((points - points[chosen[0]]) ** 2).sum(axis=1)
    while len(chosen) < k:
        mass = np.cumsum(nearest * weights)
        if mass[-1] > 0:
            at = int(np.searchsorted(mass, rng.random() * mass[-1], side="right"))
            at = min(at, len(points) - 1)
        else:  # fewer different rows than clusters
            at = int(rng.integers(len(points)))
        chosen.append(at)
        nearest = np.minimum(nearest, ((points - points[at]) ** 2).sum(axis=1))
    return points[chosen].copy()


def _edges(models: Sequence[Model]) -> np.ndarray:
    return np.concatenate([[0], np.cumsum([len(m.centres) for m in models])])


@dataclass
class Kept:
    """Rows with their places in some models, and what the models' clusters held by those places."""

    rows: DataFrame
    kind: np.dtype
    column: dict[int, int]
    sums: dict[int, np.ndarray]
    places: Broadcast | None = None

    def drop(self) -> None:
        self.rows.unpersist()
        if self.places:
            self.places.destroy()


def one_pass(
    features: DataFrame, tasks: int, centres: dict[int, np.ndarray], kept: Kept | None
) -> tuple[dict[int, np.ndarray], float]:
    """By model, the vector sum of each cluster with its row count behind; the share of places moved.

    From kept places only the rows that have left theirs are added and taken away.
    """
    edges = np.concatenate([[0], np.cumsum([len(c) for c in centres.values()])])
    spans = list(zip(edges, edges[1:], strict=False))
    columns = [kept.column[m] for m in centres] if kept else []
    size, dim = edges[-1], next(iter(centres.values())).shape[1]

    def add(x: np.ndarray, *given: np.ndarray) -> None:
        *before, total = given
        sums = total[:-2].reshape(size, dim + 1)  # a view
        wide = np.concatenate([x, np.ones((len(x), 1))], axis=1)
        moved = 0
        old = np.ascontiguousarray(before[0][:, columns].T) if before else None
        for m, (at, (lo, hi)) in enumerate(zip(places.value(x), spans, strict=True)):
            which = np.flatnonzero(at != old[m]) if before else np.arange(len(x))
            if len(which):
                member, row = np.zeros((hi - lo, len(which))), np.arange(len(which))
                member[at[which], row] = 1.0
                if before:
                    member[old[m, which], row] = -1.0
                sums[lo:hi] += member @ wide[which]
                moved += len(which)
        total[-2:] += moved, len(x) * len(spans)

    rows, kind = (kept.rows, kept.kind) if kept else (features, None)
    with _sent(features, list(centres.values())) as places:
        total = _summed(rows, tasks, size * (dim + 1) + 2, add, CHUNK, kind)
    sums = total[:-2].reshape(size, dim + 1)
    found = {m: sums[lo:hi] + (kept.sums[m] if kept else 0.0) for m, (lo, hi) in zip(centres, spans, strict=True)}
    return found, float(total[-2] / max(total[-1], 1.0))


def costs(features: DataFrame, tasks: int, models: Sequence[Model]) -> list[tuple[np.ndarray, float]]:
    """For each model the row counts of its clusters, and the sum of squared distances."""
    edges, own = _edges(models), [m.centres for m in models]
    spans = list(zip(edges, edges[1:], strict=False))

    def add(x: np.ndarray, total: np.ndarray) -> None:
        for m, (at, (lo, hi)) in enumerate(zip(places.value(x), spans, strict=True)):
            total[lo:hi] += np.bincount(at, minlength=hi - lo)
            total[edges[-1] + m] += ((x - places.value.given[m][at]) ** 2).sum()

    with _sent(features, own) as places:
        total = _summed(features, tasks, edges[-1] + len(models), add)
    return [(total[lo:hi], float(c)) for (lo, hi), c in zip(spans, total[edges[-1] :], strict=True)]


def fit_all(
    features: DataFrame, ks: Sequence[int], restarts: int, max_iter: int, seed: int, tolerance: float = TOLERANCE
) -> list[Model]:
    """Lloyd's rule for every k and restart, all in the same passes over (image, features).

    A cluster that no row is nearest to keeps its centre. The number of passes is that of
    the slowest model; a pass costs as many products as its models have centres. Places
    are cached beside the rows and follow from one set of centres, so a lost part of the cache
    costs a pass over that part.
    """
    tasks = task_count(features)
    points, weights = candidates(features, tasks, OVERSAMPLING * max(ks), seed)
    models = [
        Model(k, r, seeded(points, weights, k, np.random.default_rng([seed, k, r]))) for k in ks for r in range(restarts)
    ]
    centres = {m: model.centres for m, model in enumerate(models)}  # those of moving models
    kept, spent = None, 0.0
    try:
        for number in range(1, max_iter + 1):
            found, share = one_pass(features, tasks, centres, kept)
            spent += share
            still = {}
            for m, sums in found.items():
                counts, model = sums[:, -1:], models[m]
                moved = np.where(counts > 0, sums[:, :-1] / np.maximum(counts, 1), model.centres)
                step = np.sqrt(((moved - model.centres) ** 2).sum(axis=1).max())
                model.centres, model.iterations = moved, number
                if step > tolerance:
                    still[m] = moved
            if not still:
                break
            if spent > RENEW:
                if kept:
                    kept.drop()
                places = _send(features, [centres[m] for m in still])
                rows = placed(features, places).persist()
                column = {m: i for i, m in enumerate(still)}
                kept = Kept(rows, places.value.kind, column, {m: found[m] for m in still}, places)
                spent = 0.0
            centres = still
    finally:
        if kept:
            kept.drop()
    for model, (counts, cost) in zip(models, costs(features, tasks, models), strict=True):
        model.counts, model.cost = counts, cost
    return models


def quality_all(features: DataFrame, models: Sequence[Model]) -> list[tuple[float, float]]:
    """Silhouette (squared Euclidean) and dispersion ratio of every model, in two passes.

    Rows belong to their nearest centre. Both follow from each cluster's count, vector
    sum and sum of squared lengths. -1 and 0 where all rows are in one cluster.
    """
    tasks = task_count(features)
    edges = _edges(models)
    spans = list(zip(edges, edges[1:], strict=False))
    centres = np.concatenate([m.centres for m in models])
    size, dim = centres.shape

    def add(x: np.ndarray, total: np.ndarray) -> None:
        squares, length = _squares(x, centres), np.einsum("ij,ij->i", x, x)
        member = np.zeros((len(x), size))
        row = np.arange(len(x))
        for lo, hi in spans:
            member[row, lo + squares[:, lo:hi].argmin(axis=1)] = 1.0
        total += np.concatenate([(member.T @ x).reshape(-1), member.sum(axis=0), member.T @ length])

    total = _summed(features, tasks, size * (dim + 2), add)
    sums, counts, lengths = np.split(total, [size * dim, size * (dim + 1)])
    means = sums.reshape(size, dim) / np.maximum(counts, 1)[:, None]
    spread = np.maximum(lengths / np.maximum(counts, 1), 0.0)  # mean squared length of a cluster

    def score(x: np.ndarray, total: np.ndarray) -> None:
        squares, length = _squares(x, centres), np.einsum("ij,ij->i", x, x)
        apart = length[:, None] + spread - 2.0 * (x @ means.T)  # mean squared distance to a cluster
        apart[:, counts == 0] = np.inf
        row = np.arange(len(x))
        for m, (lo, hi) in enumerate(spans):
            own = squares[:, lo:hi].argmin(axis=1)
            n = counts[lo + own]
            other = apart[:, lo:hi].copy()
            inner = other[row, own] * n / np.maximum(n - 1, 1)
            other[row, own] = np.inf
            outer = other.min(axis=1)
            with np.errstate(invalid="ignore", divide="ignore"):
                value = (outer - inner) / np.maximum(inner, outer)
            total[m] += np.where((n > 1) & np.isfinite(outer), np.nan_to_num(value), 0.0).sum()

    silhouettes = _summed(features, tasks, len(models), score)
    found = []
    for m, (lo, hi) in enumerate(spans):
        n, mean = counts[lo:hi], means[lo:hi]
        filled = int((n > 0).sum())
        rows = n.sum()
        if filled < 2:
            found.append((-1.0, 0.0))
            continue
        centre = (mean * n[:, None]).sum(axis=0) / rows
        between = (n * ((mean - centre) ** 2).sum(axis=1)).sum()
        within = max(0.0, (lengths[lo:hi] - n * (mean**2).sum(axis=1)).sum())
        ratio = 1.0 if within <= 1e-12 * rows else between / (filled - 1) / (within / (rows - filled))
        found.append((float(silhouettes[m] / rows), float(ratio)))
    return found
