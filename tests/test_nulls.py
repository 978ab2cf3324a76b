"""Nulls, NaN and repeats in scores, labels and keyed updates."""

from larkspur.functions.vectors import as_vector
from larkspur.operators import classify as cl, clustering as km, corpus, evaluate as ev, recommend as rec
from larkspur.operators.ordering import position, running_totals


def test_rows_without_a_score_count_nowhere(spark):
    scored = [(1, 0.9), (0, 0.8), (1, 0.7), (1, 0.6), (0, 0.1)]
    whole = spark.createDataFrame(scored, "label int, score double")
    more = spark.createDataFrame([*scored, (1, None), (0, None), (1, float("nan"))], "label int, score double")
    assert sorted(map(tuple, ev.score_steps(more).collect())) == sorted(map(tuple, ev.score_steps(whole).collect()))


def test_confusion_matrix_leaves_out_null_labels(spark):
    rows = spark.createDataFrame([("a", "a"), ("a", "b"), (None, "a"), ("b", None)], "label string, prediction string")
    cells = {(r["actual"], r["predicted"]): r["n"] for r in ev.confusion_matrix(rows).collect()}
    assert cells == {("a", "a"): 1, ("a", "b"): 1, ("b", "a"): 0, ("b", "b"): 0}


def test_later_update_wins(spark):
    base = spark.createDataFrame([(1, "old", 0), (2, "kept", 1), (2, "zz", 0)], "k int, v string, at int")
    updates = spark.createDataFrame([(1, "zz", 1), (1, "aa", 2)], "k int, v string, at int")
    assert {r.k: r.v for r in corpus.upsert(base, updates, "k", order="at").collect()} == {1: "aa", 2: "kept"}


def test_running_totals_keep_null_keys_and_values(spark):
    rows = [("a", None, 1), ("a", 1.0, 2), ("a", float("nan"), 3), (None, 5.0, 4), (None, 6.0, 5)]
    frame = spark.createDataFrame(rows, "k string, v double, n int")
    out = running_totals(frame, ["k"], "v", {"before": "n"}, blocks=3)
    assert sorted((r.n, r.before) for r in out.collect()) == [(1, 0), (2, 1), (3, 3), (4, 0), (5, 4)]


def test_position_with_nulls_and_large_ties(spark):
    rows = [("a", None, 1), ("a", None, 2), *[("a", 1.0, n) for n in range(3, 40)], (None, 2.0, 50)]
    frame = spark.createDataFrame(rows, "k string, v double, n int")
    for blocks in (1, 4):
        out = position(frame, ["k"], [("v", False), ("n", False)], blocks=blocks)
        assert sorted((r.n, r.position) for r in out.collect()) == [*[(n, n) for n in range(1, 40)], (50, 1)]


def test_declared_categories_reach_the_tree(spark):
    rows = [(float(n % 2), [float(n % 3), float(n % 2), float(n)]) for n in range(40)]
    frame = spark.createDataFrame(rows, "label double, x array<double>").select("label", as_vector("x").alias("features"))
    marked = cl.declare_categories(frame, "features", 3, {0: 3, 1: 2})
    model = cl.fit(cl.decision_tree("features", "label", maxDepth=2), marked, "label", "features")
    assert "feature 1 in {" in model.toDebugString


def test_sweep_keeps_every_k(spark):
    frame = spark.createDataFrame([([float(n)],) for n in range(5)], "x array<double>").select(as_vector("x").alias("features"))
    found = {r.k: (r.clusters, r.mean_distance) for r in km.sweep(frame, [2, 6, 9]).collect()}
    assert sorted(found) == [2, 6, 9] and found[2][0] == 2 and found[6] == found[9] == (5, 0.0)


def test_users_without_enough_samples_are_reported(spark):
    owned = spark.createDataFrame([(1, n) for n in range(95)] + [(2, 0)], "user int, item int")
    items = spark.createDataFrame([(n,) for n in range(100)], "item int")
    short = {r.user: (r.wanted, r.drawn) for r in rec.sample_shortfall(owned, rec.negative_samples(owned, items)).collect()}
    assert short[1][0] == 95 and short[1][1] < 95
    assert rec.sample_shortfall(owned, rec.negative_samples(owned, items, tries=60)).isEmpty()
