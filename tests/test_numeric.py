import math
import random

import numpy as np
import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RankingEvaluator, RegressionEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.sql import Window, functions as F

from larkspur.operators import classify as cl, clustering as km, evaluate as ev, recommend as rec, similarity as sim
from larkspur.operators.ordering import position, quantile_cuts, running_totals, value_blocks
from larkspur.session import fitting


# --- ordering: hot groups against the plain window -------------------------------


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows belong to group 0; one value is shared by many of them."""
    draw = random.Random(5)
    rows = [(0 if draw.random() < 0.34 else draw.randrange(1, 40), draw.choice([1, 2, 3, draw.randrange(500)]), i) for i in range(3000)]
    return spark.createDataFrame(rows, "g int, v int, id int")


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("blocks", [1, 7])
def test_running_totals(skewed, descending, blocks):
    counts = skewed.groupBy("g", "v").agg(F.count("*").alias("n"))
    order = F.col("v").desc() if descending else F.col("v").asc()
    window = Window.partitionBy("g").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    want = counts.withColumn("before", F.coalesce(F.sum("n").over(window), F.lit(0)))
    got = running_totals(counts, ["g"], "v", {"before": "n"}, descending, blocks=blocks)
    assert sorted(map(tuple, got.select("g", "v", "n", "before").collect())) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize("keys", [["g"], []])
def test_position(skewed, keys):
    window = Window.partitionBy(*keys).orderBy(F.desc("v"), F.asc("id"))
    want = sorted(map(tuple, skewed.withColumn("p", F.row_number().over(window)).collect()))
    for blocks in (2, 6):  # with six ranges the frequent values fill whole ranges
        got = position(skewed, keys, [("v", True), ("id", False)], "p", blocks=blocks)
        assert sorted(map(tuple, got.select("g", "v", "id", "p").collect())) == want


def test_no_block_holds_a_hot_group(spark):
    df = spark.range(0, 8000).select(F.lit(1).alias("g"), F.col("id").alias("v"))
    cuts, heavy = quantile_cuts(df, "v", 8)
    sizes = [r["count"] for r in value_blocks(df, "v", cuts).groupBy("_block").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 8000 / 8 * 1.5 and not heavy
    assert quantile_cuts(df.withColumn("v", F.col("v") % 3), "v", 8)[1]


# --- evaluation ----------------------------------------------------------------------


@pytest.fixture(scope="module")
def pairs(spark):
    draw = random.Random(3)
    rows = [(float(draw.randrange(4)), float(draw.choice([0, 1, 1, 2]))) for _ in range(400)]
    return spark.createDataFrame(rows, "label double, prediction double")


def test_classification_scores_equal_the_evaluator(pairs):
    got = ev.weighted_scores(pairs).first().asDict()
    for ours, theirs in (("weighted_f", "f1"), ("weighted_precision", "weightedPrecision"), ("weighted_recall", "weightedRecall"), ("accuracy", "accuracy")):
        assert got[ours] / 100 == pytest.approx(MulticlassClassificationEvaluator(metricName=theirs).evaluate(pairs))
    per_label = {r["label"]: r for r in ev.per_label_scores(pairs).collect()}
    assert per_label[3.0]["precision"] == 0.0 and per_label[3.0]["f_measure"] == 0.0


def test_confusion_matrix_has_empty_cells(pairs):
    cells = {(r["actual"], r["predicted"]): r["n"] for r in ev.confusion_matrix(pairs).collect()}
    assert len(cells) == 16 and cells[0.0, 3.0] == 0 and sum(cells.values()) == 400


def test_grid_scores_weigh_pair_counts(pairs, spark):
    class Same:
        def transform(self, df):
            return df

    want = MulticlassClassificationEvaluator(metricName="f1").evaluate(pairs)
    assert cl.scores(Same(), pairs, ["f1"], "label")[0] == pytest.approx(want)


def test_threshold_and_roc(spark):
    rows = [(1, 0.9), (1, 0.8), (0, 0.8), (0, 0.3), (1, 0.1)]
    df = spark.createDataFrame(rows, "label int, score double")
    best = ev.best_f_threshold(df).first()
    assert (best["threshold"], best["f_measure"]) == (0.1, pytest.approx(0.75))
    points = {r["threshold"]: (r["fpr"], r["tpr"]) for r in ev.roc_points(df).collect()}
    assert points[0.8] == (0.5, pytest.approx(2 / 3)) and points[0.1] == (1.0, 1.0)
    assert ev.roc_area(df).first()[0] == pytest.approx((1 + 1 + 0.5 + 1 + 0 + 0) / 6)


def test_ranking_metrics_equal_the_evaluator(spark):
    draw = random.Random(9)
    lists = {u: (draw.sample(range(20), 10), draw.sample(range(20), draw.randrange(0, 6))) for u in range(40)}
    recommended = spark.createDataFrame([(u, i, p + 1) for u, (r, _) in lists.items() for p, i in enumerate(r)], "user int, item int, position int")
    relevant = spark.createDataFrame([(u, i) for u, (_, g) in lists.items() for i in g], "user int, item int")
    hits = ev.ranked_hits(recommended, relevant, recommended.select("user").distinct())
    both = spark.createDataFrame(
        [([float(i) for i in r], [float(i) for i in g]) for r, g in lists.values()], "prediction array<double>, label array<double>"
    )
    for frame, ours, theirs in ((ev.precision_at(hits), "precision", "precisionAtK"), (ev.ndcg_at(hits), "ndcg", "ndcgAtK")):
        for r in frame.collect():
            assert r[ours] == pytest.approx(RankingEvaluator(metricName=theirs, k=r["k"]).evaluate(both))
    want = RankingEvaluator(metricName="meanAveragePrecision").evaluate(both)
    assert ev.mean_average_precision(hits).first()[0] == pytest.approx(want)


def test_regression_scores(spark):
    df = spark.createDataFrame([(3.0, 2.5), (1.0, 1.5), (4.0, 4.0)], "rating double, prediction double")
    got = ev.rmse_r2(df).first()
    for name in ("rmse", "r2"):
        assert got[name] == pytest.approx(RegressionEvaluator(labelCol="rating", metricName=name).evaluate(df))
    assert ev.mse(df).first()[0] == pytest.approx(0.5 / 3)


def test_mean_user_auc_by_hand_with_ties(spark):
    positives = spark.createDataFrame([(1, 3.0), (1, 1.0), (2, 2.0), (3, 1.0)], "user int, score double")
    negatives = spark.createDataFrame([(1, 1.0), (1, 2.0), (2, 2.0)], "user int, score double")
    row = ev.mean_user_auc(positives, negatives).first()
    assert (row["mean_auc"], row["users"]) == (pytest.approx((2 / 4 + 0) / 2), 2)


def test_mean_user_auc_against_pairs(spark):
    draw = random.Random(1)
    pos = [(0 if draw.random() < 0.4 else draw.randrange(1, 9), float(draw.randrange(6))) for _ in range(300)]
    neg = [(0 if draw.random() < 0.4 else draw.randrange(1, 9), float(draw.randrange(6))) for _ in range(300)]
    per_user = []
    for user in {u for u, _ in pos} & {u for u, _ in neg}:
        p, n = [s for u, s in pos if u == user], [s for u, s in neg if u == user]
        per_user.append(sum(a > b for a in p for b in n) / (len(p) * len(n)))
    frames = [spark.createDataFrame(rows, "user int, score double") for rows in (pos, neg)]
    assert ev.mean_user_auc(*frames).first()["mean_auc"] == pytest.approx(np.mean(per_user))


def test_random_baseline(spark):
    train = spark.createDataFrame([("a",)] * 3 + [("b",)], "label string")
    test = spark.createDataFrame([("a",), ("c",)], "label string")
    assert ev.random_baseline(train, test).first()[0] == pytest.approx(0.75 * 0.5)


# --- clustering ------------------------------------------------------------------------


def test_entropy(spark):
    df = spark.createDataFrame([("x", 1), ("x", 1), ("x", 0), ("y", 5)], "g string, n int")
    got = {r["g"]: r["entropy"] for r in km.entropy_of_counts(df, "n", "g").collect()}
    assert got == {"x": pytest.approx(math.log(2)), "y": 0.0}


def test_threshold_is_strict_and_short_inputs(spark):
    df = spark.createDataFrame([(float(i),) for i in range(5)], "distance double")
    assert km.distance_threshold(df, 2) == 3.0
    assert [r[0] for r in km.distance_anomalies(df, 2).collect()] == [4.0]
    assert km.distance_threshold(df, 100) == 0.0


def test_centres_and_ties(spark):
    df = spark.createDataFrame([([0.0, 0.0],), ([1.0, 0.0],), ([3.0, 4.0],)], "features array<double>")
    rows = km.assign_clusters(df, [[0.0, 0.0], [2.0, 0.0]], [7, 9]).orderBy("distance").collect()
    assert [(r["cluster"], r["distance"]) for r in rows] == [(7, 0.0), (7, 1.0), (9, pytest.approx(math.sqrt(17)))]


def test_model_assignment_equals_prediction(spark):
    draw = np.random.default_rng(0)
    data = spark.createDataFrame([(r.tolist(),) for r in draw.normal(size=(200, 3))], "a array<double>")
    from larkspur.operators.features import array_vectors

    rows = array_vectors(data, "a")
    model = km.kmeans_fit(rows, 4)
    both = km.assign_by_model(model.transform(rows).withColumnRenamed("cluster", "predicted"), model)
    assert both.filter("cluster <> predicted").count() == 0
    scored = km.sweep(rows, [2, 4, 500])
    assert [(r["k"], r["clusters"]) for r in scored.orderBy("k").collect()] == [(2, 2), (4, 4), (500, 200)]


def test_sweeps_of_narrow_rows_multiply_blocks(spark, monkeypatch):
    draw = np.random.default_rng(3)
    plain = km.KMeans._fit
    used = {}
    monkeypatch.setattr(km.KMeans, "_fit", lambda self, df: used.setdefault(self.getK(), []).append(self.getSolver()) or plain(self, df))

    def sweep(values):
        used.clear()
        rows = spark.createDataFrame([(Vectors.dense(v),) for v in values], ["features"]).coalesce(1).cache()
        swept = {r["k"]: r["mean_distance"] for r in km.sweep(rows, [3, 40]).collect()}
        solvers = {k: s[0] for k, s in used.items()}
        for k, score in swept.items():
            model = km.KMeans(k=k, maxIter=km.SWEEP_ITERATIONS, tol=km.SWEEP_TOLERANCE, seed=11, predictionCol="cluster", solver="row").fit(rows)
            assert score == pytest.approx(km.mean_distance(km.assign_by_model(rows, model)).first()[0], rel=1e-9)
        return solvers

    near = draw.normal(size=(500, 4))
    assert sweep(near) == {3: "block", 40: "block"}
    # products would lose the places that tell these rows apart, and do not pay for wide ones
    assert set(sweep(near + 1.0e9).values()) == {"auto"}
    assert set(sweep(draw.normal(size=(200, 20))).values()) == {"auto"}


# --- similarity ---------------------------------------------------------------------------


@pytest.fixture(scope="module")
def table_of_vectors(spark):
    draw = np.random.default_rng(4)
    values = draw.normal(size=(60, 5))
    values[7] = 0.0
    values[8] = values[9]
    return values, spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(values)], "id bigint, v array<double>")


@pytest.mark.parametrize("blocks", [1, 5])
def test_cosine_pairs(table_of_vectors, blocks):
    values, df = table_of_vectors
    lengths = np.linalg.norm(values, axis=1)
    want = {}
    for i in range(60):
        for j in range(i + 1, 60):
            if lengths[i] and lengths[j]:
                want[i, j] = values[i] @ values[j] / lengths[i] / lengths[j]
    got = {(r["i"], r["j"]): r["value"] for r in sim.cosine_pairs(df, "id", "v", blocks=blocks).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)
    assert got[8, 9] == pytest.approx(1.0)
    best = sorted(want, key=lambda k: (-round(want[k], 9), k))[:12]
    assert [(r["i"], r["j"]) for r in sim.cosine_topk(df, "id", "v", 12, blocks=blocks).collect()] == best
    high = sim.cosine_pairs(df, "id", "v", at_least=0.5, blocks=blocks).count()
    assert high == sum(v >= 0.5 for v in want.values())


def test_sampled_cosine(table_of_vectors):
    _, df = table_of_vectors
    exact = sim.cosine_pairs(df, "id", "v")
    short = sim.cosine_dimsum(df, "id", "v", 0.1)
    assert sim.similarity_error(exact, short).first()["mean_error"] < 1e-12
    long = df.withColumn("v", F.transform("v", lambda x: x * 1000))
    sampled = sim.cosine_dimsum(long, "id", "v", 0.9)
    again = sim.cosine_dimsum(long.repartition(7), "id", "v", 0.9)
    assert sorted((r["i"], r["j"], round(r["value"], 9)) for r in sampled.collect()) == sorted(
        (r["i"], r["j"], round(r["value"], 9)) for r in again.collect()
    )
    assert sim.similarity_error(exact, sampled).first()["mean_error"] > 0


def test_transpose_and_blocks(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [3.0, 4.0]), (2, [5.0, 6.0])], "id bigint, v array<double>")
    cells = sim.transpose(df, "id", "v")
    assert sorted(map(tuple, cells.collect())) == [(0, 0, 1.0), (0, 1, 3.0), (0, 2, 5.0), (1, 0, 2.0), (1, 1, 4.0), (1, 2, 6.0)]
    packed = {(r["i"], r["block"]): r["values"] for r in sim.row_blocks(cells, 2).collect()}
    assert packed == {(0, 0): [1.0, 3.0], (0, 1): [5.0], (1, 0): [2.0, 4.0], (1, 1): [6.0]}


# --- recommendation -------------------------------------------------------------------------


def test_negative_samples(spark, monkeypatch):
    monkeypatch.setattr(rec, "SLOTS_PER_BLOCK", 8)
    rows = [(0, i) for i in range(60)] + [(u, (u * 7) % 100) for u in range(1, 30)]
    positives = spark.createDataFrame(rows, "user int, item int")
    items = spark.range(100).select(F.col("id").cast("int").alias("item"))
    got = rec.negative_samples(positives, items).collect()
    owned = set(rows)
    assert not any((r["user"], r["item"]) in owned for r in got)
    per_user = {}
    for r in got:
        per_user.setdefault(r["user"], []).append(r["slot"])
    assert len(per_user[0]) <= 60 and all(len(v) <= 1 for u, v in per_user.items() if u)
    monkeypatch.setattr(rec, "SLOTS_PER_BLOCK", 4096)
    again = rec.negative_samples(positives.repartition(5), items).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_popularity_and_alias(spark):
    ratings = spark.createDataFrame([(1, 11, 2.0), (2, 10, 3.0), (2, 11, 1.0)], "user int, item int, rating double")
    alias = spark.createDataFrame([(11, 10)], "bad_id int, good_id int")
    clean = rec.canonical_ratings(ratings, alias)
    scores = rec.popularity_scores(spark.createDataFrame([(5, 10), (5, 99)], "user int, item int"), clean)
    assert {r["item"]: r["score"] for r in scores.collect()} == {10: 6.0, 99: 0.0}


def test_als_is_seeded_and_drops_unknown(spark):
    draw = random.Random(2)
    rows = [(u, i, float(draw.randrange(1, 6))) for u in range(12) for i in range(9) if draw.random() < 0.7]
    ratings = spark.createDataFrame(rows, "user int, item int, rating double")
    first, second = rec.als_fit(ratings, rank=3), rec.als_fit(ratings, rank=3)
    ask = spark.createDataFrame([(0, 1), (99, 1), (0, 99)], "user int, item int")
    a, b = rec.als_predict(first, ask).collect(), rec.als_predict(second, ask).collect()
    assert len(a) == 1 and a[0]["prediction"] == b[0]["prediction"]
    lists = rec.recommend_all_users(first, 4)
    assert lists.groupBy("user").count().filter("count <> 4").count() == 0
    assert lists.filter("score < 0 or score > 1").count() == 0
    assert rec.recommend_item_users(first, ratings.select("item").limit(1), 5).count() == 5


# --- classification ---------------------------------------------------------------------------


@pytest.fixture(scope="module")
def points(spark):
    from larkspur.operators.features import array_vectors

    draw = np.random.default_rng(8)
    rows = []
    for i in range(240):
        kind = i % 3
        rows.append((i, float(kind), (draw.normal(size=2) * 0.5 + [[0, 0], [3, 0], [0, 3]][kind] + 2).clip(0).tolist()))
    return array_vectors(spark.createDataFrame(rows, "id int, label double, a array<double>"), "a")


BUILD = {
    "tree": lambda: cl.decision_tree("features", "label"),
    "forest": lambda: cl.random_forest("features", "label", numTrees=5),
    "logistic": lambda: cl.one_vs_rest(cl.logistic_regression("features", "label"), "features", "label"),
    "svm": lambda: cl.one_vs_rest(cl.linear_svm("features", "label", maxIter=20), "features", "label"),
    "perceptron": lambda: cl.perceptron([2, 4, 3], "features", "label"),
}


@pytest.mark.parametrize("kind", BUILD)
def test_classifiers_beat_the_baseline(points, kind):
    train, test = cl.hash_split(points, "id", {"train": 70, "test": 30})
    model = cl.fit(BUILD[kind](), train, "label", "features")
    baseline = ev.random_baseline(train, test).first()[0]
    assert cl.scores(model, test, ["accuracy"], "label")[0] > baseline + 0.2


def test_grid_refit_and_folds(points):
    grid = {"impurity": ["gini", "entropy"], "maxDepth": [1, 4]}

    def build(**params):
        return cl.decision_tree("features", "label", **params)

    parts = cl.hash_split(points, "id", {"train": 80, "valid": 10, "test": 10})
    ranked = cl.grid_search(*parts[:2], build, grid, label="label", features="features")
    assert ranked.count() == 4 and cl.best_point(ranked, grid)["maxDepth"] == 4
    report, _ = cl.refit_best(*parts, build, grid, label="label", features="features")
    assert report.first()["test_accuracy"] > 0.7
    folded = cl.with_fold(points, "id", 3)
    scored = cl.kfold_scores(folded, build, {"maxDepth": [1, 4]}, folds=3, label="label", features=["features"])
    means = cl.mean_fold_scores(scored).collect()
    assert [m["params"] for m in means] == ["maxDepth=4", "maxDepth=1"] and means[0]["folds"] == 3


def test_splits_do_not_depend_on_partitions(points):
    one = [sorted(r["id"] for r in p.collect()) for p in cl.hash_split(points.repartition(1), "id", {"a": 60, "b": 40})]
    many = [sorted(r["id"] for r in p.collect()) for p in cl.hash_split(points.repartition(9), "id", {"a": 60, "b": 40})]
    assert one == many and sorted(one[0] + one[1]) == list(range(240))


def test_fitting_sizes_tasks(spark):
    with fitting(spark.range(100).repartition(8), "id", rows_per_task=50) as few:
        assert few.rdd.getNumPartitions() == 2
    with fitting(spark.range(100).coalesce(1), "id", rows_per_task=20) as many:
        assert many.rdd.getNumPartitions() == 5 and many.count() == 100
