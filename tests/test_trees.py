import random

import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.linalg import Vectors

from larkspur.operators import classify as cl
from larkspur.operators.trees import of_depths


@pytest.fixture(scope="module")
def mixed(spark):
    """Numbers and a category that say little about the class, so that trees grow deep."""
    draw = random.Random(1)
    rows = [(float(draw.randrange(3)), i % 2, Vectors.dense([draw.random() for _ in range(3)] + [float(draw.randrange(5))])) for i in range(400)]
    df = spark.createDataFrame(rows, ["label", "fold", "features"])
    return cl.declare_categories(df, "features", 4, {3: 5}).cache()


def _tree(**params):
    return cl.decision_tree("features", "label", **params)


@pytest.mark.parametrize("impurity", ["gini", "entropy"])
def test_trees_of_smaller_depths(spark, mixed, impurity):
    depths = [1, 4, 9, 20, 30]
    made = of_depths(spark, _tree(maxDepth=30, maxBins=40, impurity=impurity).fit(mixed), depths)
    for depth, model in zip(depths, made):
        direct = _tree(maxDepth=depth, maxBins=40, impurity=impurity).fit(mixed)
        assert model.toDebugString.split("\n", 1)[1] == direct.toDebugString.split("\n", 1)[1]
        raw = [[r["rawPrediction"] for r in m.transform(mixed).select("rawPrediction").collect()] for m in (model, direct)]
        assert raw[0] == raw[1]
    with pytest.raises(ValueError):
        of_depths(spark, _tree(maxDepth=2).fit(mixed), [3])


def test_depth_beyond_an_early_leaf(spark):
    rows = spark.createDataFrame([(1.0, Vectors.dense([float(i)])) for i in range(9)], ["label", "features"])
    one = _tree(maxDepth=5).fit(rows)
    assert [m.numNodes for m in of_depths(spark, one, [0, 3, 5])] == [1, 1, 1]


@pytest.mark.parametrize("per_class", [False, True])
def test_depths_share_a_fit(spark, mixed, monkeypatch, per_class):
    fits = []
    plain = DecisionTreeClassifier._fit
    monkeypatch.setattr(DecisionTreeClassifier, "_fit", lambda self, df: fits.append(self.getMaxDepth()) or plain(self, df))

    def build(**params):
        tree = _tree(**params)
        return cl.one_vs_rest(tree, "features", "label") if per_class else tree

    grid = {"impurity": ["gini"], "maxDepth": [2, 5], "maxBins": [8, 40]}
    train, valid = mixed.where("fold = 0"), mixed.where("fold = 1")
    ranked = {(r["maxDepth"], r["maxBins"]): r["score"] for r in cl.grid_search(train, valid, build, grid, "f1", "label", "features").collect()}
    assert fits == [5] * (6 if per_class else 2)
    for (depth, bins), score in ranked.items():
        model = build(maxDepth=int(depth), maxBins=int(bins)).fit(train)
        assert score == cl.scores(model, valid, ["f1"], "label")[0]


def test_folds_of_shared_fits(mixed):
    grid = {"maxDepth": [2, 5]}
    got = {(r["params"], r["fold"]): r["score"] for r in cl.kfold_scores(mixed, _tree, grid, folds=2, label="label", features=("features",)).collect()}
    assert sorted(got) == [("maxDepth=2", 0), ("maxDepth=2", 1), ("maxDepth=5", 0), ("maxDepth=5", 1)]
    for (params, fold), score in got.items():
        model = _tree(maxDepth=int(params[-1])).fit(mixed.where(f"fold <> {fold}"))
        assert score == cl.scores(model, mixed.where(f"fold = {fold}"), ["f1"], "label")[0]


@pytest.mark.parametrize("name, fits_of", [("tree_grid", 2), ("refit_best", 3), ("tree_categorical", 3), ("ovr_tree_grid", 6), ("cv_tree", 20)])
def test_queries_fit_every_point(spark, monkeypatch, name, fits_of):
    """Each point of a grid is a fit of its own, for each class and fold, and so is the refit."""
    from larkspur.plans import model_queries as q

    draw = random.Random(2)
    made = [(k, "abc"[k % 3], float(k % 3), Vectors.dense([draw.random() for _ in range(10)] + [float(k % 4), float(k % 40)])) for k in range(200)]
    rows = spark.createDataFrame(made, ["doc_id", "category", cl.LABEL, cl.FEATURES]).cache()
    cover = rows.toDF("l_orderkey", "category", "label", "features").drop("category")
    monkeypatch.setattr(q, "_labelled", lambda *_: rows)
    monkeypatch.setattr(q, "_cover", lambda *_: cl.declare_categories(cover, "features", cl.COVER_WIDTH, cl.COVER_CATEGORIES))
    for grid in ("TREE_GRID", "OVR_TREE_GRID"):
        monkeypatch.setattr(cl, grid, {"impurity": ["gini"], "maxDepth": [2, 5], "maxBins": [40]})
    fits = []
    plain = DecisionTreeClassifier._fit
    monkeypatch.setattr(DecisionTreeClassifier, "_fit", lambda self, df: fits.append(self.getMaxDepth()) or plain(self, df))
    found = getattr(q, name)(spark, "").collect()
    assert len(found) == (1 if name == "refit_best" else 2) and len(fits) == fits_of
    assert {2, 5} <= set(fits)
