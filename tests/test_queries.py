"""Every registered query: against its SQL check, or for rows and a stable schema."""

import os

import pytest
from check import check, connect

import __spark_entry__ as entry_point
from larkspur.operators import similarity as sim
from larkspur.plans import tables
from larkspur.plans.catalog import ORACLES, QUERIES
from larkspur.plans.recommend_queries import dimsum_sql
from larkspur.plans.registry import r6

SF = os.environ.get("LARKSPUR_TEST_SF", "/root/testdata/sf0.001")
# fits of several hundred jobs each; run them with LARKSPUR_SLOW=1
SLOW = {
    "kmeans_sweep_raw", "kmeans_sweep_scaled", "kmeans_sweep_onehot", "kmeans_sweep_entropy", "kmeans_anomalies",
    "tree_grid", "refit_best", "tree_categorical", "forest_grid", "linear_svm", "ovr_svm", "perceptron", "ovr_tree_grid",
    "classifier_comparison", "als_grid", "kfold_tree", "kfold_forest", "kfold_svm", "kfold_ovr_svm", "kfold_logistic", "cv_tree",
    "cv_logistic", "ovr_tree", "ovr_logistic_grid", "random_forest",
}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, con, name):
    problem, _, _ = check(spark, con, SF, name)
    assert not problem


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_model_query(spark, con, name):
    if name in SLOW and not os.environ.get("LARKSPUR_SLOW"):
        pytest.skip("slow")
    problem, rows, _ = check(spark, con, SF, name)
    assert not problem and rows > 0


def test_sampled_cosine_draws_alike(spark, con):
    """At a threshold that leaves entries out, both engines leave out the same ones."""
    got = sim.cosine_dimsum(tables.vectors(spark, SF), "vec_id", "features", 500.0).withColumn("value", r6("value")).collect()
    want = con.execute(dimsum_sql(500.0)).fetchall()
    assert sorted(map(tuple, got)) == sorted(want)


def test_entry_point(spark):
    df = entry_point.entry(spark)
    assert df.columns == ["term", "tf", "df"] and df.count() > 0
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())
