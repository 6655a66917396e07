"""Dimension reduction, k-means with automatic k, and cluster quality."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spark_curate.functions import vectors as V
from spark_curate.functions.session import materialize
from spark_curate.operators import kmeans
from spark_curate.operators.kmeans import Model

# Weights of the two signals.
SILHOUETTE_WEIGHT, DISPERSION_WEIGHT = 0.7, 0.3

#: Rows that a task of a k-means pass takes at least, while there are cores for more tasks.
TASK_ROWS = 1024


@dataclass(frozen=True)
class ClusterSettings:
    """Search range and effort of the clustering."""

    k_min: int = 18
    k_max: int = 40
    k_step: int = 1
    pca_dim: int = 128
    restarts: int = 10
    max_iter: int = 300
    seed: int = 42

    def __post_init__(self) -> None:
        if self.k_min < 2:
            raise ValueError("k_min must be at least 2")
        if self.k_max < self.k_min:
            raise ValueError("k_max must be at least k_min")


def check_embeddings(records: DataFrame, embeddings: DataFrame) -> DataFrame:
    """Embeddings of all records, or an error if any is missing or ragged."""
    sizes = embeddings.agg(F.min(F.size("embedding")), F.max(F.size("embedding"))).first()
    if sizes[0] is None or sizes[0] != sizes[1]:
        raise ValueError("embeddings differ in length; label again")
    names = records.select("image")
    missing = names.join(embeddings, "image", "left_anti").count()
    if missing:
        raise ValueError(f"embeddings are missing for {missing} records; label again")
    return embeddings.join(names, "image", "left_semi")


def reduce_dimensions(embeddings: DataFrame, settings: ClusterSettings) -> DataFrame:
    """(image, features): embeddings projected to max(2, min(dim, n, d)) components.

    Hundreds of passes follow, so the rows are dealt evenly to the cores, however few
    files or row groups the vectors came in.
    """
    vectors = embeddings.select("image", array_to_vector(V.doubles(F.col("embedding"))).alias("_v"))
    width = embeddings.select(F.size("embedding")).first()[0]
    rows = embeddings.count()
    dim = max(2, min(settings.pca_dim, rows, width))
    model = PCA(k=dim, inputCol="_v", outputCol="features").fit(vectors)
    reduced = model.transform(vectors).select("image", vector_to_array("features").alias("features"))
    cores = embeddings.sparkSession.sparkContext.defaultParallelism
    return materialize(reduced.repartition(max(1, min(cores, rows // TASK_ROWS)), "image"))


def best_kmeans(features: DataFrame, k: int, settings: ClusterSettings) -> Model:
    """The model of lowest cost of several restarts, which share their passes."""
    fits = kmeans.fit_all(kmeans.arrays(features), [k], settings.restarts, settings.max_iter, settings.seed)
    return min(fits, key=lambda m: m.cost)


def assign(features: DataFrame, model: Model) -> DataFrame:
    """image, cluster_id and distance to the own centre, the nearest (ties: the first)."""
    centres = model.centres

    @F.arrow_udf("struct<cluster_id:int,distance:double>")
    def nearest(column: pa.Array) -> pa.Array:
        valid, x = V.batch_matrix(column, centres.shape[1])
        at = kmeans._squares(x, centres).argmin(axis=1)
        place, distance = np.zeros(len(column), np.int32), np.zeros(len(column))
        place[valid], distance[valid] = at, np.linalg.norm(x - centres[at], axis=1)
        return pa.StructArray.from_arrays(
            [pa.array(place), pa.array(distance)], names=["cluster_id", "distance"], mask=pa.array(~valid)
        )

    placed = kmeans.arrays(features).select("image", nearest("features").alias("_at"))
    return placed.select("image", "_at.cluster_id", "_at.distance")


def silhouette(assigned: DataFrame) -> float:
    """Mean silhouette of all rows of (features, cluster_id), by squared Euclidean distance.

    The squared form needs only the sums of each cluster, so the work is linear in
    the rows and no sample is taken. -1 if all rows lie in one cluster.
    """
    rows = assigned.select(
        array_to_vector(V.doubles(F.col("features"))).alias("features"),
        F.col("cluster_id").cast("double").alias("prediction"),
    )
    if rows.select("prediction").distinct().limit(2).count() < 2:
        return -1.0
    return ClusteringEvaluator(distanceMeasure="squaredEuclidean").evaluate(rows)


def dispersion_ratio(assigned: DataFrame) -> float:
    """Calinski-Harabasz score of (features, cluster_id) from one aggregation.

    Only one row per cluster reaches the driver. 0 for a single cluster.
    """
    stats = Summarizer.metrics("mean", "variance", "count")
    vector = array_to_vector(V.doubles(F.col("features")))
    rows = assigned.groupBy("cluster_id").agg(stats.summary(vector).alias("s")).collect()
    if len(rows) < 2:
        return 0.0
    n = np.asarray([r["s"]["count"] for r in rows], dtype=np.float64)
    means = np.asarray([r["s"]["mean"].toArray() for r in rows])
    within = sum(r["s"]["variance"].toArray().sum() * (r["s"]["count"] - 1) for r in rows)
    centre = (means * n[:, None]).sum(axis=0) / n.sum()
    between = (n * ((means - centre) ** 2).sum(axis=1)).sum()
    if within == 0:
        return 1.0
    return float(between / (len(rows) - 1) / (within / (n.sum() - len(rows))))


def search_range(n: int, settings: ClusterSettings) -> tuple[list[int], bool]:
    """The cluster counts to try for ``n`` rows, and whether only a fallback is left."""
    low, high = max(2, settings.k_min), min(settings.k_max, n - 1)
    if low > high:
        return [max(2, min(n - 1, settings.k_min, settings.k_max))], True
    return list(range(low, high + 1, settings.k_step)), False


def select_best_k(features: DataFrame, settings: ClusterSettings) -> tuple[int, Model, DataFrame]:
    """Best k by silhouette and dispersion: (k, its model, candidates table).

    The objective is .7 of the normalised silhouette plus .3 of the dispersion
    relative to its maximum; ties go to the smaller k. The range is clamped to
    [2, n - 1]; if nothing is left a single fallback k is used. All models of all k are
    fitted in the same passes and judged in two more.
    """
    features = kmeans.arrays(features)
    n = features.count()
    if n < 3:
        raise ValueError("need at least 3 rows to choose a cluster count")
    ks, fallback = search_range(n, settings)
    fits = kmeans.fit_all(features, ks, settings.restarts, settings.max_iter, settings.seed)
    models = [min((m for m in fits if m.k == k), key=lambda m: m.cost) for k in ks]
    measured = kmeans.quality_all(features, models)
    top = max(ratio for _, ratio in measured)
    top = top if top > 0 else 1.0
    rows, best = [], None
    for model, (sil, ratio) in zip(models, measured, strict=True):
        norm = (sil + 1.0) / 2.0
        objective = norm if fallback else SILHOUETTE_WEIGHT * norm + DISPERSION_WEIGHT * ratio / top
        rows.append((model.k, round(sil, 6), round(ratio, 4), round(float(objective), 6), float(model.cost)))
        if best is None or objective > best[0] + 1e-9:
            best = (objective, model)
    table = features.sparkSession.createDataFrame(
        rows, "k int, silhouette double, calinski_harabasz double, objective double, cost double"
    )
    return best[1].k, best[1], table
