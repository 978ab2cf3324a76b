"""Keyed tables, files by category, word lists, fold models, indexed cosine and the evaluation of many models at once, on small tables."""

import math
import os
import random

import pytest
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import StandardScaler
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from larkspur.operators import bayes, classify as cl, corpus, evaluate as ev, features as ft, recommend as rec, similarity as sim
from larkspur.sources import documents, stores


# --- keyed tables -------------------------------------------------------------------


def files(path):
    return {os.path.join(folder, f) for folder, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_update_rewrites_only_touched_folders(spark, tmp_path):
    path = str(tmp_path / "keyed")
    base = [(k, f"v{k}", 1) for k in range(200)] + [(k, "later", 2) for k in range(0, 200, 10)] + [(7, "older", 0)]
    stores.write_keyed(spark.createDataFrame(base, "k long, v string, version int"), path, "k", "version", parts=16)
    before = files(path)
    updates = [(3, "first", 5), (3, "second", 6), (3, "none", 4), (20, "new", 1), (1000, "added", 1)]
    changed = stores.update_keyed(spark, path, spark.createDataFrame(updates, "k long, v string, version int"), "k", "version")
    expected = {k: (f"v{k}", 1) for k in range(200)} | {k: ("later", 2) for k in range(0, 200, 10)} | {3: ("second", 6), 20: ("new", 1), 1000: ("added", 1)}
    rows = stores.read_keyed(spark, path).collect()
    assert len(rows) == 201 and {r.k: (r.v, r.version) for r in rows} == expected
    assert changed <= 3 and len(before - files(path)) == changed == len(files(path) - before)
    assert stores.update_keyed(spark, path, spark.createDataFrame([], "k long, v string, version int"), "k") == 0
    assert stores.read_keyed(spark, path).count() == 201


def test_keyed_tables_with_null_keys_and_values(spark, tmp_path):
    path = str(tmp_path / "keyed")
    stores.write_keyed(spark.createDataFrame([(None, "a"), (None, "b"), (1, None)], "k long, v string"), path, "k", parts=4)
    stores.update_keyed(spark, path, spark.createDataFrame([(1, "x"), (2, None)], "k long, v string"), "k")
    assert {(r.k, r.v) for r in stores.read_keyed(spark, path).collect()} == {(None, "b"), (1, "x"), (2, None)}
    with pytest.raises(ValueError):
        spark.range(3).write.parquet(str(tmp_path / "plain"))
        stores.update_keyed(spark, str(tmp_path / "plain"), spark.range(1), "id")


# --- files by category -----------------------------------------------------------------


def test_files_by_category_stand_alone(spark, tmp_path):
    path = str(tmp_path / "sets")
    rows = [(k, ["a", "b", "it's"][k % 3], Vectors.sparse(4, {0: 0.5 * k, 3: 1.0}) if k % 2 else Vectors.dense([0.0, float(k), 0.0, 0.0])) for k in range(60)]
    df = spark.createDataFrame(rows, ["doc_id", "category", "features"]).repartition(3)
    stores.export_by_category(df, path, 4, ["a", "b", "it's"])
    folders = [f for f in os.listdir(path) if f.startswith("category=")]
    assert len(folders) == 3
    for folder in folders:
        for name in os.listdir(os.path.join(path, folder)):
            if name.startswith("part-"):
                lines = open(os.path.join(path, folder, name)).read().splitlines()
                assert lines[0].startswith("@relation") and lines[5:7] == ["@attribute class {0,1}", "@data"]
                assert all(x.startswith("{") for x in lines[7:]) and sum(x.startswith("@") for x in lines) == 7
    read = stores.read_by_category(spark, path).collect()
    expected = sorted(
        (c, float(own == c), tuple((int(i), float(x)) for i, x in enumerate(v.toArray()) if x)) for _, own, v in rows for c in ("a", "b", "it's")
    )
    assert sorted((r.category, r.label, tuple(map(tuple, r.entries))) for r in read) == expected


# --- word lists --------------------------------------------------------------------------


def test_long_word_lists_give_the_same_rows(spark, tmp_path):
    path = str(tmp_path / "words")
    spark.createDataFrame([("The",), ("of",), ("",), ("Ärger",)], "value string").write.text(path)
    words = documents.stop_word_table(spark, path)
    rows = [(1, ["the", "of", "THE"]), (2, ["a", "of", "b", "a", "ärger", "a"]), (3, []), (4, None), (5, ["x", None, "the"])]
    df = spark.createDataFrame(rows, "k long, w array<string>")
    expected = {1: [], 2: ["a", "b", "a", "a"], 3: [], 4: None, 5: ["x", None]}
    for most in (corpus.LITERAL_WORDS, 1):
        kept = {r.k: r.w for r in corpus.remove_words(df, "k", "w", words, most).collect()}
        assert kept == expected


def test_arrays_are_read_element_by_element(spark, tmp_path):
    path = str(tmp_path / "arrays")
    docs = spark.createDataFrame([("t", f"body, \"{k}\" [x] {{y}}\n", "1987", ["ship"], [], [], k) for k in range(10)], documents.NEWS_SCHEMA)
    documents.write_news_arrays(docs, path, size=4)
    texts = [open(os.path.join(path, f)).read() for f in os.listdir(path) if f.startswith("part-")]
    assert sorted(t.startswith("[{") and t.strip().endswith("}]") for t in texts if t) == [True] * 3
    assert sorted(map(tuple, documents.read_news_arrays(spark, path).collect())) == sorted(map(tuple, docs.collect()))


# --- text statistics -----------------------------------------------------------------------


def test_term_statistics(spark):
    rows = [(1, ["a", "b", "a"]), (2, []), (3, None), (4, ["c", "a"]), (5, ["b", "b", "b"])]
    df = spark.createDataFrame(rows, "k long, w array<string>")
    found = {r.term: (r.tf, r.df, r.squares) for r in ft.term_statistics(df, "w").collect()}
    assert found == {"a": (3, 2, 5), "b": (4, 2, 10), "c": (1, 1, 1)}


def test_weights_are_those_of_the_fitted_stages(spark):
    draw = random.Random(3)
    rows = [(k, [draw.choice("abcdefgh") for _ in range(draw.randrange(12))] + ["always"]) for k in range(60)]
    df = spark.createDataFrame(rows, "k long, w array<string>").repartition(3)
    table = ft.term_table(df, "w", 6, 2)
    counted = ft.count_vectorizer(table.terms, "w", "tf").transform(df)
    fitted = StandardScaler(inputCol="tf", outputCol="x", withStd=True, withMean=False).fit(counted).transform(counted)
    idf = ft.fit_idf(counted, "tf", "y").transform(fitted)
    ours = ft.weighted(table.idf(), "tf", "v").transform(ft.weighted(table.per_deviation(), "tf", "u").transform(idf))
    for r in ours.collect():
        assert r.u.toArray() == pytest.approx(r.x.toArray()) and r.v.toArray() == pytest.approx(r.y.toArray())


def test_features_from_stored_tokens(spark):
    draw = random.Random(5)
    words = ["corn", "ship", "trade", "money", "the", "wheat"]
    rows = [(k, draw.choice(["en", "fr"]), " ".join(draw.choice(words) for _ in range(20)), " ".join(draw.choice(words) for _ in range(3))) for k in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, category string, content string, title string")
    recipes = [ft.content_recipe(["the"]), ft.title_recipe(["the"])]
    model, made = ft.build_features(df, recipes, ["doc_id", "category"])
    again = {r.doc_id: (r[ft.LABEL], r[ft.FEATURES]) for r in ft.fit_features(df, recipes).transform(df).collect()}
    assert {r.doc_id: (r[ft.LABEL], r[ft.FEATURES]) for r in made.collect()} == again
    assert {r.doc_id: (r[ft.LABEL], r[ft.FEATURES]) for r in model.transform(df).collect()} == again


# --- naive Bayes ------------------------------------------------------------------------------


def bayes_rows(spark, n=160, classes=3):
    draw = random.Random(8)
    rows = []
    for k in range(n):
        c = draw.randrange(classes)
        entries = {i: float(draw.randrange(1, 4)) for i in range(12) if draw.random() < (0.6 if i % classes == c else 0.25)}
        rows.append((k, float(c), Vectors.sparse(12, entries)))
    return spark.createDataFrame(rows, ["doc_id", "label", "features"]).repartition(3)


def test_fold_models_are_those_fitted_fold_by_fold(spark):
    df = cl.with_fold(bayes_rows(spark), "doc_id", 4).cache()
    found = {(r.doc_id, r.smoothing): r.prediction for r in bayes.fold_predictions(df, 12, [0.5, 2.0], label="label", features="features").collect()}
    scores = {(r.smoothing, r.fold): r.score for r in bayes.fold_scores(df, 12, [0.5, 2.0], label="label", features="features").collect()}
    for smoothing in (0.5, 2.0):
        for fold in range(4):
            model = NaiveBayes(smoothing=smoothing).fit(df.where(F.col("fold") != fold))
            part = model.transform(df.where(F.col("fold") == fold))
            assert {r.doc_id: r.prediction for r in part.collect()} == {k: p for (k, s), p in found.items() if s == smoothing and k in {r.doc_id for r in part.collect()}}
            assert scores[smoothing, fold] == pytest.approx(cl.evaluator("f1", "label").evaluate(part))
    df.unpersist()


def test_bayes_edges(spark):
    df = bayes_rows(spark, 12).withColumn("fold", F.lit(0))
    assert bayes.fold_predictions(df.limit(0), 12, [1.0], label="label", features="features").count() == 0
    # a class that only the scored fold has is not predicted; a row without entries goes by the priors
    rows = [(1, 0.0, Vectors.sparse(2, {0: 1.0}), 0), (2, 0.0, Vectors.sparse(2, {0: 2.0}), 0), (3, 1.0, Vectors.sparse(2, {1: 1.0}), 0), (4, 2.0, Vectors.sparse(2, {1: 5.0}), 1), (5, 0.0, Vectors.sparse(2, {}), 1)]
    table = spark.createDataFrame(rows, ["doc_id", "label", "features", "fold"])
    found = {r.doc_id: r.prediction for r in bayes.fold_predictions(table, 2, [1.0], label="label", features="features").where("fold = 1").collect()}
    assert found == {4: 1.0, 5: 0.0}


# --- cosine ------------------------------------------------------------------------------------


def sparse_table(spark, n=120, width=60):
    draw = random.Random(4)
    rows = []
    for k in range(n):
        chosen = {0: 1.0, **{draw.randrange(1, width): float(draw.randrange(1, 5)) for _ in range(8)}}
        rows.append({**rows[k - 1], draw.randrange(1, width): 1.0} if k % 4 == 3 else chosen)
    rows[50] = dict(rows[10])
    table = [(k, Vectors.sparse(width, r)) for k, r in enumerate(rows)] + [(500, Vectors.sparse(width, {})), (501, Vectors.dense(rows_of(rows[10], width)))]
    return spark.createDataFrame(table, ["id", "v"]).repartition(3), [*rows, {}, rows[10]], [*range(n), 500, 501]


def rows_of(entries, width):
    return [entries.get(k, 0.0) for k in range(width)]


def brute_cosine(rows, ids):
    size = [math.sqrt(sum(x * x for x in r.values())) for r in rows]
    out = {}
    for b in range(len(rows)):
        for a in range(len(rows)):
            if ids[a] < ids[b] and size[a] and size[b]:
                out[ids[a], ids[b]] = sum(x * rows[b].get(k, 0.0) for k, x in rows[a].items()) / size[a] / size[b]
    return out


@pytest.mark.parametrize("at_least, list_rows", [(0.9, 4096), (0.6, 4096), (0.6, 7), (0.2, 30)])
def test_indexed_cosine_finds_every_pair(spark, at_least, list_rows):
    df, rows, ids = sparse_table(spark)
    every = brute_cosine(rows, ids)
    entries = sim.vector_entries(df, "id", "v").cache()
    listed = sim.index_entries(entries, at_least).cache()
    found = {(r.i, r.j): r.value for r in sim.indexed_pairs(entries, listed, at_least, list_rows).collect()}
    expected = {p: v for p, v in every.items() if v >= at_least - 1e-12}
    assert set(found) == set(expected) and all(found[p] == pytest.approx(v) for p, v in expected.items())
    assert listed.count() < entries.count()
    chosen = {(r.i, r.j) for r in sim.cosine_at_least(df, "id", "v", at_least).collect()}
    assert chosen == set(expected)


def test_error_of_a_thresholded_list(spark):
    df, rows, ids = sparse_table(spark)
    every = brute_cosine(rows, ids)
    kept = sim.cosine_at_least(df, "id", "v", 0.6)
    found = sim.mean_error_below(sim.vector_entries(df, "id", "v"), kept).first()
    missing = sum(v for v in every.values() if v < 0.6)
    assert found.pairs == len(every) and found.mean_error == pytest.approx(missing / len(every))
    negative = spark.createDataFrame([(1, Vectors.dense([1.0, -1.0])), (2, Vectors.dense([1.0, 1.0]))], ["id", "v"])
    with pytest.raises(Exception, match="must not be negative"):
        sim.mean_error_below(sim.vector_entries(negative, "id", "v"), kept).collect()
    with pytest.raises(ValueError):
        sim.entries_at_least(sim.vector_entries(df, "id", "v"), 0.0)


# --- evaluation ------------------------------------------------------------------------------------


def test_confusion_grid_of_many_labels(spark):
    """More labels than the driver would be asked to hold, with gaps and nulls."""
    rows = [(f"l{k:04d}", f"l{k * 7 % 1100:04d}") for k in range(1100)] + [("l0001", None), (None, "l0002")]
    grid = ev.confusion_matrix(spark.createDataFrame(rows, "label string, prediction string").repartition(5))
    assert grid.count() == 1100 * 1100
    assert {(r.actual, r.predicted) for r in grid.where("n > 0").collect()} == set(rows[:1100])
    assert ev.confusion_matrix(spark.createDataFrame([], "label string, prediction string")).count() == 0


def test_all_models_are_judged_at_once(spark):
    draw = random.Random(6)
    positives = [(m, u, round(draw.random(), 1)) for m in range(3) for u in range(6) for _ in range(draw.randrange(4))]
    negatives = [(m, u, round(draw.random(), 1)) for m in range(3) for u in range(6) for _ in range(5)]
    frames = [spark.createDataFrame(x, "point int, user int, score double") for x in (positives, negatives)]
    together = {r.point: (r.mean_auc, r.users) for r in ev.mean_user_auc(*frames, by=["point"]).collect()}
    for m in range(3):
        one = ev.mean_user_auc(*[f.where(F.col("point") == m) for f in frames]).first()
        assert together[m] == (pytest.approx(one.mean_auc), one.users)


def test_grid_of_recommenders(spark):
    draw = random.Random(9)
    rows = [(u, i, float(draw.randrange(1, 6))) for u in range(25) for i in range(20) if draw.random() < 0.4]
    df = spark.createDataFrame(rows, "user int, item int, rating double")
    train, test = df.where("(user + item) % 5 > 0"), df.where("(user + item) % 5 = 0")
    grid = {"rank": [2, 3], "regParam": [0.1], "alpha": [1.0]}
    ranked = {r["rank"]: r.mean_auc for r in rec.als_grid(train, test, df, grid, max_iter=3).collect()}
    positives = test.select("user", "item").distinct()
    negatives = rec.negative_samples(positives, df)
    assert ranked[None] == pytest.approx(rec.popularity_auc(train, test, df).first()["mean_auc"])
    for rank in (2, 3):
        model = rec.als_fit(train, True, 11, maxIter=3, rank=rank, regParam=0.1, alpha=1.0)
        parts = [rec.als_predict(model, p).select("user", F.col("prediction").cast("double").alias("score")) for p in (positives, negatives)]
        assert ranked[rank] == pytest.approx(ev.mean_user_auc(*parts).first()["mean_auc"], abs=1e-3)
