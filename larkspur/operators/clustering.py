"""K-means, cluster quality and distance-based anomalies."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import numpy as np
from py4j.protocol import Py4JJavaError
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F

from larkspur.functions.vectors import as_vector, euclidean, nearest_centre
from larkspur.operators import lloyd
from larkspur.operators.parallel import run_all
from larkspur.session import fitting

# The numbers of clusters tried in each sweep, as (from, to, step).
RAW_SWEEP = (5, 30, 5)
RAW_SWEEP_LONG = (30, 100, 10)
SCALED_SWEEP = (60, 120, 10)
ONE_HOT_SWEEP = (80, 160, 10)
ENTROPY_SWEEP = (80, 160, 10)
# Settings of the long sweeps and of the anomaly detector.
SWEEP_ITERATIONS, SWEEP_TOLERANCE = 10, 1.0e-6
#: Bytes of the products of one block of rows with all centres, which should stay in a core's own cache.
PRODUCT_BYTES = 256 << 10
#: Numbers of a row up to which products pay: the start of such a fit reads the rows several times, which costs more for wider ones.
PRODUCT_WIDTH = 8
#: Squared means over variances beyond which products of rows and centres lose the places that tell centres apart.
MOST_OFFSET = 1.0e6
ANOMALY_CLUSTERS, ANOMALY_RANK = 150, 100
#: Rows from which all fits of a sweep are made in shared passes; a pass over fewer takes less time than its start.
SHARED_ROWS = 200_000


def steps(sweep: tuple[int, int, int]) -> list[int]:
    first, last, step = sweep
    return list(range(first, last + 1, step))


def kmeans_fit(
    df: DataFrame, k: int = 2, max_iter: int = 100, tol: float = 1.0e-4, seed: int = 11, features: str = "features", **solver
) -> KMeansModel:
    return KMeans(k=k, maxIter=max_iter, tol=tol, seed=seed, featuresCol=features, predictionCol="cluster", **solver).fit(df)


def block_solver(df: DataFrame, features: str = "features") -> int:
    """The width of the rows if distances may be taken from products of blocks of rows with the centres, else 0.

    Products take half to two thirds of the time for rows of few numbers, but lose places where the rows lie far from the origin for their spread.
    """
    stats = Summarizer.metrics("mean", "variance").summary(F.col(features))
    s = df.select(stats.alias("s")).first()["s"]
    near = sum(x * x for x in s["mean"]) <= MOST_OFFSET * sum(s["variance"])
    return len(s["mean"]) if near and len(s["mean"]) <= PRODUCT_WIDTH else 0


@contextmanager
def shared_passes(df: DataFrame, features: str, label: str | None = None) -> Iterator[tuple[DataFrame, np.ndarray] | None]:
    """The rows for fits in shared passes (lloyd.py) and a point near their mean; nothing for few rows, or numbers that are not finite."""
    if df.count() < SHARED_ROWS:
        yield None
        return
    with lloyd.packed(df, features, label) as data:
        near = lloyd.origin(data)
        yield None if near is None else (data, near)


def fit_in_blocks(df: DataFrame, k: int, max_iter: int, tol: float, seed: int, features: str, width: int) -> KMeansModel:
    """The same fit by products of blocks; row by row where the start finds fewer than k centres, which blocks are not made for."""
    size = PRODUCT_BYTES / k * width / (1 << 20)
    try:
        return kmeans_fit(df, k, max_iter, tol, seed, features, solver="block", maxBlockSizeInMB=size)
    except Py4JJavaError as error:
        # every row is compared with k centres, so fewer of them always end like this
        if "ArrayIndexOutOfBounds" not in str(error):
            raise
        return kmeans_fit(df, k, max_iter, tol, seed, features)


def label_counts(df: DataFrame, label: str = "label") -> DataFrame:
    """Label frequencies, most frequent first."""
    return df.groupBy(label).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc(label))


def cluster_label_counts(df: DataFrame, cluster: str = "cluster", label: str = "label") -> DataFrame:
    return df.groupBy(cluster, label).agg(F.count("*").alias("n"))


def group_means(df: DataFrame, group: str, features: str, limit: int = 10_000) -> tuple[list[int], list[list[float]]]:
    """Mean vector per group, for use as fixed centres.  The number of groups is checked."""
    means = df.groupBy(group).agg(Summarizer.mean(as_vector(features)).alias("mean"))
    rows = means.orderBy(group).limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} groups in {group}")
    return [r[group] for r in rows], [list(map(float, r["mean"])) for r in rows]


def assign_clusters(
    df: DataFrame, centres: Sequence[Sequence[float]], ids: Sequence[int] | None = None, features: str = "features"
) -> DataFrame:
    """Add ``cluster`` and ``distance`` (to the closest centre) for an array column."""
    return df.withColumn("_n", nearest_centre(features, centres, ids)).withColumns(
        {"cluster": F.col("_n.cluster"), "distance": F.col("_n.distance")}
    ).drop("_n")


def assign_by_model(df: DataFrame, model: KMeansModel, features: str = "features") -> DataFrame:
    """The same for a fitted model and its vector column: the model's own choice, then the distance to that one centre."""
    centres = [(k, list(map(float, c))) for k, c in enumerate(model.clusterCenters())]
    table = df.sparkSession.createDataFrame(centres, "cluster int, _centre array<double>")
    # one row per cluster of the model
    placed = model.transform(df).join(F.broadcast(table), "cluster")
    return placed.withColumn("distance", euclidean(vector_to_array(features), F.col("_centre"))).drop("_centre")


def mean_distance(df: DataFrame, distance: str = "distance") -> DataFrame:
    """Cluster score: mean distance of a row to its own centre (not squared)."""
    return df.agg(F.avg(distance).alias("mean_distance"))


def entropy_of_counts(df: DataFrame, count: str = "n", *groups: str) -> DataFrame:
    """Natural-log entropy of counts per group; zero counts are skipped.

    From sum(n) and sum(n ln n) alone: H = ln N - sum(n ln n) / N.
    """
    used = df.filter(F.col(count) > 0)
    sums = used.groupBy(*groups).agg(F.sum(count).alias("size"), F.sum(F.col(count) * F.ln(count)).alias("_nln"))
    entropy = F.when(F.col("size") > 0, F.greatest(F.ln("size") - F.col("_nln") / F.col("size"), F.lit(0.0)))
    return sums.select(*groups, "size", F.coalesce(entropy, F.lit(0.0)).alias("entropy"))


def weighted_entropy(df: DataFrame, cluster: str = "cluster", label: str = "label") -> DataFrame:
    """Cluster purity: entropy of the labels in each cluster, weighted by cluster size."""
    per_cluster = entropy_of_counts(cluster_label_counts(df, cluster, label), "n", cluster)
    weighted = F.sum(F.col("size") * F.col("entropy")) / F.sum("size")
    return per_cluster.agg(weighted.alias("weighted_entropy"))


def _shared_entropy(data: DataFrame, centres: dict[int, np.ndarray], near: np.ndarray) -> dict[int, float]:
    counts = lloyd.label_counts(data, centres, near)
    per_cluster = entropy_of_counts(counts, "n", "k", "cluster")
    weighted = F.sum(F.col("size") * F.col("entropy")) / F.sum("size")
    # one row for each k
    return {r["k"]: float(r["e"]) for r in per_cluster.groupBy("k").agg(weighted.alias("e")).collect()}


def sweep(
    df: DataFrame,
    ks: Sequence[int],
    max_iter: int = SWEEP_ITERATIONS,
    tol: float = SWEEP_TOLERANCE,
    seed: int = 11,
    features: str = "features",
    label: str | None = None,
    parallelism: int = 8,
) -> DataFrame:
    """Fit each k on the same cached input and score it.

    The score is the mean distance to the own centre, or, when a label column is
    named, the size-weighted entropy of the labels.  Every k that was asked for has
    its row; ``clusters`` beside it says how many centres the fit found, which is
    fewer than k where there are fewer distinct rows.
    """
    columns = [features] + ([label] if label else [])
    name = "weighted_entropy" if label else "mean_distance"
    schema = f"k int, clusters int, {name} double"
    with shared_passes(df, features, label) as shared:
        if shared:
            data, near = shared
            centres = lloyd.fit(data, ks, max_iter, tol, seed, near)
            values = _shared_entropy(data, centres, near) if label else lloyd.mean_distances(data, centres, near)
            return df.sparkSession.createDataFrame([(k, len(centres[k]), values[k]) for k in ks], schema)
    with fitting(df, *columns) as data:
        width = block_solver(data, features)

        def score(k: int) -> tuple[int, int, float]:
            settings = (data, k, max_iter, tol, seed, features)
            model = fit_in_blocks(*settings, width) if width else kmeans_fit(*settings)
            if label:
                value = weighted_entropy(model.transform(data), "cluster", label).first()[0]
            else:
                value = mean_distance(assign_by_model(data, model, features)).first()[0]
            return k, len(model.clusterCenters()), float(value)

        scores = run_all(score, list(ks), parallelism)
    return df.sparkSession.createDataFrame(scores, schema)


def distance_threshold(df: DataFrame, rank: int = ANOMALY_RANK, distance: str = "distance") -> float | None:
    """The ``rank``-th largest distance, or the smallest there is when rows are fewer."""
    top = df.select(distance).orderBy(F.desc(distance)).limit(rank)
    return top.agg(F.min(distance)).first()[0]


def distance_anomalies(df: DataFrame, rank: int = ANOMALY_RANK, distance: str = "distance") -> DataFrame:
    """Rows strictly farther from their centre than the threshold."""
    return _beyond(df, distance_threshold(df, rank, distance), distance)


def _beyond(df: DataFrame, threshold: float | None, distance: str = "distance") -> DataFrame:
    return df.filter(F.col(distance) > F.lit(threshold).cast("double"))


def anomaly_rows(anomalies: DataFrame, order: Sequence[str], n: int = 10) -> DataFrame:
    """The first ``n`` anomalies in a total order, for a report."""
    return anomalies.orderBy(*order).limit(n)


def anomaly_detector(
    df: DataFrame, k: int = ANOMALY_CLUSTERS, rank: int = ANOMALY_RANK, seed: int = 11, features: str = "features"
) -> DataFrame:
    """Fit k-means on (already scaled) vectors and return the anomalous rows with their distance."""
    with shared_passes(df, features) as shared:
        if shared:
            centres = lloyd.fit(shared[0], [k], SWEEP_ITERATIONS, SWEEP_TOLERANCE, seed, shared[1])[k]
            threshold = lloyd.distance_of_rank(shared[0], centres, shared[1], rank)
            return _beyond(lloyd.assign(df, centres, features, shared[1]), threshold)
    with fitting(df, features) as data:
        model = kmeans_fit(data, k, SWEEP_ITERATIONS, SWEEP_TOLERANCE, seed, features)
        threshold = distance_threshold(assign_by_model(data, model, features), rank)
    return _beyond(assign_by_model(df, model, features), threshold)
