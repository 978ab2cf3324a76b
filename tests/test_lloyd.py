"""K-means in shared passes against the library's fits, one by one."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import types as T

from larkspur.operators import clustering as km, lloyd


def frame(spark, values):
    rows = [(Vectors.dense(v) if n % 2 else Vectors.sparse(len(v), [i for i, x in enumerate(v) if x], [x for x in v if x]), "abc"[n % 3] if n % 7 else None) for n, v in enumerate(values)]
    schema = T.StructType([T.StructField("features", VectorUDT()), T.StructField("label", T.StringType())])
    return spark.createDataFrame(rows, schema).repartition(spark.sparkContext.defaultParallelism + 1).cache()


def test_draws_are_those_of_the_library(spark):
    jvm = spark._jvm
    for seed in (11, -5, 0, 2**31 - 1):
        theirs, ours = jvm.org.apache.spark.util.random.XORShiftRandom(seed), lloyd.Draws(seed)
        assert [theirs.nextDouble() for _ in range(700)] == [*ours.doubles(300), *ours.doubles(0), *ours.doubles(400)]
        assert theirs.nextInt() == ours.integer()
        theirs, ours = jvm.java.util.Random(seed), lloyd.JavaRandom(seed)
        assert [theirs.nextDouble() for _ in range(9)] == [ours.double() for _ in range(9)]
        assert [theirs.nextInt(n) for n in (1, 7, 64, 1_500_000_000)] == [ours.below(n) for n in (1, 7, 64, 1_500_000_000)]


def values(kind):
    draw = np.random.default_rng(5)
    spread = draw.normal(size=(3000, 5)) * [1, 10, 0.1, 3, 1] + draw.integers(0, 9, size=(3000, 1))
    return {"spread": spread, "far": spread + 1.0e6, "steps": np.round(spread[:, :3]), "few": spread[draw.integers(0, 12, 500)], "one": spread[:1]}[kind]


@pytest.mark.parametrize("kind", ["spread", "far", "few", "one"])
def test_centres_are_those_of_the_library(spark, kind):
    rows = frame(spark, values(kind))
    with lloyd.packed(rows, "features") as data:
        near = lloyd.origin(data)
        for iterations, tol in ((0, 1.0e-6), (30, 1.0e-4)):
            found = lloyd.fit(data, [40, 3, 10], iterations, tol, 11, near)
            for k, centres in found.items():
                model = km.KMeans(k=k, maxIter=iterations, tol=tol, seed=11, predictionCol="cluster", solver="row").fit(rows)
                theirs = np.array(model.clusterCenters())
                assert centres.shape == theirs.shape and np.allclose(centres, theirs, rtol=1e-7, atol=1e-7)


def test_rows_on_a_grid(spark):
    """Rows as far from one centre as from another go to either, by rounding: other clusters than the library's, as good ones."""
    rows = frame(spark, values("steps"))
    with lloyd.packed(rows, "features") as data:
        near = lloyd.origin(data)
        found = lloyd.fit(data, [3, 40], 10, 1.0e-6, 11, near)
        scores = lloyd.mean_distances(data, found, near)
    for k, score in scores.items():
        model = km.KMeans(k=k, maxIter=10, tol=1.0e-6, seed=11, predictionCol="cluster", solver="row").fit(rows)
        assert len(found[k]) == k and score == pytest.approx(km.mean_distance(km.assign_by_model(rows, model)).first()[0], rel=0.2)


def library(rows, k):
    model = km.KMeans(k=k, maxIter=km.SWEEP_ITERATIONS, tol=km.SWEEP_TOLERANCE, seed=11, predictionCol="cluster", solver="row").fit(rows)
    return km.assign_by_model(rows, model).cache()


@pytest.mark.parametrize("label", [None, "label"])
def test_sweeps_in_shared_passes(spark, monkeypatch, label):
    rows = frame(spark, values("spread"))
    want = {k: km.weighted_entropy(library(rows, k)) if label else km.mean_distance(library(rows, k)) for k in (30, 2, 15)}
    monkeypatch.setattr(km, "SHARED_ROWS", 1)
    monkeypatch.setattr(km.KMeans, "_fit", None)
    got = km.sweep(rows, [30, 2, 15], label=label).collect()
    assert [(r["k"], r["clusters"]) for r in got] == [(30, 30), (2, 2), (15, 15)]
    for r in got:
        assert r[2] == pytest.approx(want[r["k"]].first()[0], rel=1e-9)


def test_anomalies_in_shared_passes(spark, monkeypatch):
    rows = frame(spark, values("spread"))
    want = sorted((r["distance"], r["cluster"], r["label"] or "") for r in km.distance_anomalies(library(rows, 8), 20).collect())
    monkeypatch.setattr(km, "SHARED_ROWS", 1)
    monkeypatch.setattr(km.KMeans, "_fit", None)
    got = sorted((r["distance"], r["cluster"], r["label"] or "") for r in km.anomaly_detector(rows, 8, 20).collect())
    assert len(got) == len(want) == 19 and [g[1:] for g in got] == [w[1:] for w in want]
    assert [g[0] for g in got] == pytest.approx([w[0] for w in want], rel=1e-9)


def test_numbers_that_are_not_finite_stay_with_the_library(spark, monkeypatch):
    monkeypatch.setattr(km, "SHARED_ROWS", 1)
    for values, near in (([[1.0, 2.0], [3.0, float("nan")]], None), ([[1.0, 2.0], [3.0, 4.0], [9.0, 4.0]], [4.0, 3.5])):
        with km.shared_passes(frame(spark, values), "features") as shared:
            assert (shared and shared[1].tolist()) == near
    rows = frame(spark, [[1.0, 2.0]] * 9)
    monkeypatch.setattr(km, "SHARED_ROWS", 10)
    with km.shared_passes(rows, "features") as shared:
        assert shared is None
