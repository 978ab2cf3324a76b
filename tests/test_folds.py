import random

from pyspark.ml.classification import LinearSVC
from pyspark.ml.linalg import Vectors

from larkspur.operators import classify as cl
from larkspur.plans import model_queries as mq


def test_folds_of_linear_models_are_few_tasks(spark, monkeypatch):
    """The same scores from tasks of many rows, which is what the folds of support vector machines ask for."""
    draw = random.Random(2)
    rows = [(float(i % 3), str(i), Vectors.sparse(6, {i % 3: 1.0, 3 + draw.randrange(3): draw.random()})) for i in range(6000)]
    df = spark.createDataFrame(rows, [mq.ft.LABEL, "doc_id", mq.ft.FEATURES]).repartition(8).cache()
    monkeypatch.setattr(mq, "_labelled", lambda spark, sf: df)
    monkeypatch.setitem(cl.SVM, "maxIter", 5)
    tasks = []
    plain = LinearSVC._fit
    monkeypatch.setattr(LinearSVC, "_fit", lambda self, data: tasks.append(data.rdd.getNumPartitions()) or plain(self, data))
    got = {r["fold"]: r["score"] for r in mq.kfold_ovr_svm(spark, "").collect()}
    assert set(tasks) == {1} and len(tasks) == 3 * cl.FOLDS
    folded = cl.with_fold(df, "doc_id")
    model = cl.one_vs_rest(cl.linear_svm()).fit(folded.where("fold <> 4"))
    assert abs(got[4] - cl.scores(model, folded.where("fold = 4"), ["f1"])[0]) < 1e-9
