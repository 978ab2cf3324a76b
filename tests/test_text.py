import pytest
from pyspark.errors import AnalysisException
from pyspark.ml.feature import IDF, CountVectorizer, StopWordsRemover
from pyspark.sql import functions as F

from larkspur.functions import text as tx
from larkspur.functions.vectors import sparse_entries
from larkspur.operators import corpus, features as ft
from larkspur.session import scratch_path
from larkspur.sources import documents, lines, stores


def column(spark, expression, *values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_word_tokens(spark):
    got = column(spark, tx.word_tokens("x", 3), "The cat, a dog_1 Keinä", "", "ab")
    assert got == [["The", "cat", "dog_1", "Kein"], [], []]
    assert column(spark, tx.word_tokens("x", 2, lower=True), "AB c D_e") == [["ab", "d_e"]]


def test_space_tokens_equal_the_tokenizer(spark):
    texts = ["A b\tC", "", "  ", "x  y ", " lead", "a\n\nb\n"]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    rows = ft.whitespace_words("x", "t").transform(df).select("t", tx.space_tokens("x").alias("s")).collect()
    assert all(r["t"] == r["s"] for r in rows)


@pytest.mark.parametrize("n", [1, 2, 3])
def test_ngrams(spark, n):
    cases = [["a", "b", "c"], ["a"], []]
    df = spark.createDataFrame([(c,) for c in cases], "w array<string>")
    got = [r[0] for r in df.select(tx.word_ngrams("w", n)).collect()]
    want = [[" ".join(c[i : i + k]) for k in range(1, n + 1) for i in range(len(c) - k + 1)] for c in cases]
    assert got == want


def test_letters_clean_concat(spark):
    assert column(spark, tx.letters_only("x"), "abcÄé", "", "a1", "a b", "a\n") == [True, True, False, False, False]
    assert column(spark, tx.clean_text("x"), "a\nb\x03c") == ["a bc"]
    assert column(spark, tx.clean_text("x", ""), "a\nb\x03c") == ["abc"]
    df = spark.createDataFrame([("a b", ["c", "d"])], "x string, y array<string>")
    assert df.select(tx.concat_columns("x", "y")).first()[0] == ["a", "b", "c", "d"]


def test_default_stop_words_and_case(spark):
    assert len(StopWordsRemover.loadDefaultStopWords("english")) == 181
    df = spark.createDataFrame([(["The", "Cat", "is", "IN"],)], "w array<string>")
    assert ft.stop_word_remover("w", "o", None).transform(df).first()["o"] == ["Cat"]
    assert df.select(tx.drop_words("w", ["the", "IN"])).first()[0] == ["Cat", "is"]


def test_news_labels(spark):
    news = spark.createDataFrame(
        [(1, "T", "wheat\nrose", ["wheat", "ship"]), (2, None, None, None), (3, "U", "b", ["tea", "corn"]), (4, "V", "b", ["tea"])],
        "id int, title string, body string, topics array<string>",
    )
    first = corpus.parse_corpus(news, tx.TOP_TOPICS).select("id", "category", "content").collect()
    assert sorted(map(tuple, first)) == [(1, "wheat", "wheat\nroseT"), (3, "corn", "bU")]
    one = corpus.parse_corpus(news, tx.TOP_TOPICS, "ship").select("id", "category").collect()
    assert sorted(map(tuple, one)) == [(1, "ship"), (2, "other"), (3, "other"), (4, "other")]
    kept = documents.clean_news(news, tx.TOP_TOPICS).select("id", "body").collect()
    assert sorted(map(tuple, kept)) == [(1, "wheatrose"), (3, "b")]


def test_json_array_files(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"id": 1, "topics": ["acq"], "body": "x"},\n {"id": 2, "title": "only"}]')
    rows = documents.read_news_arrays(spark, str(tmp_path)).select("id", "body", "title").collect()
    assert sorted(map(tuple, rows), key=lambda r: r[0]) == [(1, "x", None), (2, None, "only")]


def test_xml_reads_every_record_of_a_file(spark, tmp_path):
    (tmp_path / "a.xml").write_text("<dump><page><id>1</id><text>a &lt; b</text></page><page><id>2</id><text> c </text></page></dump>")
    rows = documents.read_xml_pages(spark, str(tmp_path), "id int, text string").collect()
    assert sorted(map(tuple, rows)) == [(1, "a < b"), (2, " c ")]


def test_stop_word_file_and_limit(spark, tmp_path):
    path = tmp_path / "words.txt"
    path.write_text("a\nb\n")
    assert documents.read_stop_words(spark, str(path)) == ["a", "b"]
    with pytest.raises(ValueError):
        documents.read_stop_words(spark, str(path), limit=1)


def test_line_parsers(spark):
    def rows(parser, *values):
        return [tuple(r) for r in parser(spark.createDataFrame([(v,) for v in values], "value string").coalesce(1)).collect()]

    assert rows(lines.parse_labeled_csv, "0,tcp,http,SF,181,0.5,normal.") == [("normal.", [0.0, 181.0, 0.5])]
    assert rows(lines.parse_class_csv, "1,2,7") == [(6.0, [1.0, 2.0])]
    assert rows(lines.parse_play_counts, "1000002 1 55") == [(1000002, 1, 55.0)]
    assert rows(lines.parse_id_names, "10\tSome Band ", "x\tBroken", "no tab", "5\t", "1\t2\t3") == [(10, "Some Band")]
    assert rows(lines.count_malformed_names, "10\tSome Band", "x\tBroken", "no tab") == [(1, 2)]
    assert rows(lines.parse_ratings, "0::2::3") == [(0, 2, 3.0)]
    assert rows(lines.parse_items, "2::A Long Title::Anime|Drama") == [(2, "A Long Title", ["Anime", "Drama"])]
    assert rows(lines.parse_vectors, "1 0 2.5") == [([1.0, 0.0, 2.5],)]


def test_alias_later_line_wins(spark):
    df = spark.createDataFrame([(1, "11\t10"), (2, "11\t12"), (3, "\t7")], "line_no int, value string")
    assert sorted(map(tuple, lines.parse_alias(df).collect())) == [(0, 0), (11, 12)]


def test_upsert_and_subtract(spark):
    base = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a"), (3, "a"), (None, "n")], "k int, v string")
    updates = spark.createDataFrame([(2, "b"), (9, "c")], "k int, v string")
    got = sorted(map(tuple, corpus.upsert(base, updates, "k").collect()), key=str)
    assert got == [(1, "a"), (2, "b"), (3, "a"), (9, "c"), (None, "n")]
    left = corpus.subtract_rows(base, spark.createDataFrame([(2, "a"), (None, "n")], "k int, v string"))
    assert sorted(map(tuple, left.collect())) == [(1, "a"), (1, "a"), (3, "a")]


def grams(spark):
    docs = [["a", "b", "a"], ["a", "c"], ["b", "a", "c", "c"], []]
    return spark.createDataFrame(list(enumerate(docs)), "id int, w array<string>")


def test_vocabulary_is_the_estimators_up_to_ties(spark):
    df = grams(spark)
    assert [tuple(r) for r in ft.build_vocabulary(df, "w", 10, 2).collect()] == [("a", 4, 3), ("c", 3, 2), ("b", 2, 2)]
    fitted = CountVectorizer(inputCol="w", outputCol="v", minDF=2.0, vocabSize=10).fit(df)
    assert fitted.vocabulary == ft.vocabulary_terms(df, "w", 10, 2)


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_vocabulary_does_not_depend_on_partitions(spark, parts):
    assert ft.vocabulary_terms(grams(spark).repartition(parts), "w", 2, 1) == ["a", "c"]


def test_empty_vocabulary(spark):
    docs = spark.createDataFrame(
        [("bigdata", "one two"), ("java", "three four"), ("ml", "five six")], "category string, content string"
    )
    recipe = ft.content_recipe()
    out = ft.fit_text(docs, recipe).transform(docs)
    assert sparse_entries(out, recipe.out, "category").count() == 0


def test_idf_floor_and_l1(spark):
    df = grams(spark)
    counted = ft.count_vectorizer(["a", "b", "c"], "w", "tf").transform(df)
    assert IDF(inputCol="tf", outputCol="x", minDocFreq=3).fit(counted).idf.toArray().tolist()[1:] == [0.0, 0.0]
    scaled = ft.l1_normalizer("tf", "n").transform(counted)
    sums = sparse_entries(scaled, "n", "id").groupBy("id").agg(F.sum("value").alias("s")).collect()
    assert all(abs(r["s"] - 1) < 1e-12 for r in sums) and len(sums) == 3


def test_pipeline_roundtrip_and_feature_store(spark):
    docs = spark.createDataFrame(
        [(i, c, f"word{i % 3} common text number{i}", f"title {c}", f"{c} tag{i % 2}") for i, c in enumerate("xxyyxyxxyz")],
        "doc_id int, category string, content string, title string, labels string",
    )
    recipes = [ft.content_recipe(), ft.title_recipe(), ft.tag_recipe()]
    model = ft.fit_features(docs, recipes)
    path = scratch_path(spark, "test-model")
    stores.save_model(model, path)
    want = [r[0] for r in model.transform(docs).orderBy("doc_id").select(ft.FEATURES).collect()]
    got = [r[0] for r in stores.load_model(path).transform(docs).orderBy("doc_id").select(ft.FEATURES).collect()]
    assert want == got
    with pytest.raises(AnalysisException):
        stores.load_model(path + "-missing")


def test_one_hot_layout_and_unseen(spark):
    df = spark.createDataFrame([(1.0, 9.0, "b", "x"), (2.0, 8.0, "a", "y")], "n double, m double, p string, q string")
    rows = [list(r[0]) for r in ft.one_hot(df, ["n", "m"], ["p", "q"]).select("features").collect()]
    assert rows == [[1, 0, 1, 1, 0, 9], [2, 1, 0, 0, 1, 8]]


def test_un_one_hot_first_and_last(spark):
    first = [float(i) for i in range(10)] + [1.0, 0, 0, 0] + [1.0] + [0.0] * 39
    last = [float(i) for i in range(10)] + [0, 0, 0, 1.0] + [0.0] * 39 + [1.0]
    df = spark.createDataFrame([([float(v) for v in r],) for r in (first, last)], "features array<double>")
    assert [r[0][10:] for r in ft.un_one_hot(df).collect()] == [[0.0, 0.0], [3.0, 39.0]]


def test_zscore_constant_column(spark):
    df = ft.assemble(spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, c double"), ["x", "c"])
    assert [(r["z_x"], r["z_c"]) for r in ft.zscore(df, ["x", "c"]).collect()] == [(-1.0, 0.0), (1.0, 0.0)]
    assert [list(r[0]) for r in ft.zscore_vectors(df).select("scaled").collect()] == [[-1.0, 0.0], [1.0, 0.0]]
