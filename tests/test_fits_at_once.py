import random
import threading
import time

import pytest
from pyspark.ml.classification import DecisionTreeClassifier, LinearSVC, OneVsRest
from pyspark.ml.linalg import Vectors

from larkspur.operators import classify as cl
from larkspur.operators.parallel import at_once


@pytest.fixture(scope="module")
def rows(spark):
    draw = random.Random(3)
    made = [(str(i), float(i % 3), "abc"[i % 3], i % 2, Vectors.dense([i % 3 + draw.random(), draw.random()])) for i in range(32_000)]
    return spark.createDataFrame(made, ["id", "label", "category", "fold", "features"]).repartition(16).cache()


def test_fits_at_once(spark):
    cores = spark.sparkContext.defaultParallelism
    data = spark.range(1000)
    assert [at_once(data.repartition(n), 16) for n in (1, cores, 2 * cores, 9 * cores)] == [min(16, 2 * cores), 2, 1, 1]
    assert at_once(data.repartition(1), 4) == 4


class _Running:
    """How many fits of a class run at a time, and over how many tasks."""

    def __init__(self, monkeypatch, kind):
        self.now, self.most, self.tasks, lock = 0, 0, set(), threading.Lock()
        plain = kind._fit

        def fit(estimator, data):
            with lock:
                self.now += 1
                self.most = max(self.most, self.now)
                self.tasks.add(data.rdd.getNumPartitions())
            time.sleep(0.3)
            try:
                return plain(estimator, data)
            finally:
                with lock:
                    self.now -= 1

        monkeypatch.setattr(kind, "_fit", fit)


def test_fits_that_fill_the_cores_run_one_by_one(spark, rows, monkeypatch):
    """A copy of the rows for each of several fits takes memory and saves no time."""
    running = _Running(monkeypatch, DecisionTreeClassifier)
    cl.kfold_scores(rows, lambda: cl.decision_tree("features", "label", maxDepth=2), folds=2, label="label", features=("features",))
    assert running.most == 1
    grid = {"impurity": ["gini", "entropy"], "maxDepth": [2]}
    cl.grid_search(rows, rows.where("fold = 1"), lambda **p: cl.decision_tree("features", "label", **p), grid, "f1", "label", "features")
    assert running.most == 1
    one = _Running(monkeypatch, OneVsRest)
    many = []
    monkeypatch.setattr(OneVsRest, "setParallelism", lambda self, n: many.append(n) or self._set(parallelism=n))
    cl.fit(cl.one_vs_rest(cl.decision_tree(maxDepth=2), "features", "label"), rows, "label", "features")
    assert many[-1] == 1 and one.most == 1


def test_linear_fits_are_few_tasks_in_the_comparison(rows, monkeypatch):
    """The same means as from fits one by one; passes of linear models are over few tasks, those of trees over many."""
    trees, machines = _Running(monkeypatch, DecisionTreeClassifier), _Running(monkeypatch, LinearSVC)
    kinds = {
        "svm": lambda **c: cl.linear_svm(maxIter=5, **c),
        "tree": lambda **c: cl.decision_tree(maxDepth=2, **c),
    }
    got = cl.compare_classifiers(rows, ["a", "b"], kinds, "category", "features", "id", 2)
    assert got.columns == ["category", "svm", "tree"]
    assert machines.tasks == {1} and trees.tasks == {16} and machines.most > 1
    folded = cl.with_fold(rows, "id", 2).selectExpr("*", "double(category = 'a') as is_a").drop("label").withColumnRenamed("is_a", "label")
    for row in got.where("category = 'a'").collect():
        for kind, build in kinds.items():
            each = [cl.scores(build(features="features", label="label").fit(folded.where(f"fold <> {i}")), folded.where(f"fold = {i}"), ["f1"], "label")[0] for i in (0, 1)]
            assert abs(row[kind] - sum(each) / 2) < 1e-9


def test_holdouts_that_fill_the_cores_run_one_by_one(rows, monkeypatch):
    running = _Running(monkeypatch, DecisionTreeClassifier)
    words = rows.union(rows).selectExpr("id as doc_id", "category", "array(category, concat('w', cast(id as int) % 5)) as words")
    found = cl.category_holdout(words, ["a", "b", "c"], "words", ["a", "b", "w0", "w1"])
    assert [r["category"] for r in found.collect()] == ["a", "b", "c"]
    assert min(running.tasks) > 16 and running.most == 1
