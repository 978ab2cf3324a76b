import random

import pytest

from larkspur.functions.text import ngrams_sql
from larkspur.operators import features as ft


def _texts(spark, draw, rows, words):
    data = [(i, [f"w{min(int(draw.expovariate(0.1)), words)}" for _ in range(draw.randrange(30))]) for i in range(rows)]
    return spark.createDataFrame(data, "id int, words array<string>").selectExpr("*", f"{ngrams_sql('words', 2)} as grams", f"{ngrams_sql('words', 3)} as threes")


@pytest.mark.parametrize("size,min_docs", [(1, 1), (20, 3), (60, 2), (5000, 1), (5000, 3)])
def test_same_vocabulary_as_from_all_ngrams(spark, size, min_docs):
    df = _texts(spark, random.Random(size), 300, 60).cache()
    assert ft.ngram_table(df, "words", "grams", 2, size, min_docs) == ft.term_table(df, "grams", size, min_docs)
    assert ft.ngram_table(df, "words", "threes", 3, size, min_docs) == ft.term_table(df, "threes", size, min_docs)


def test_rare_ngrams_are_not_counted(spark, monkeypatch):
    """A recipe counts combinations of frequent words, never all n-grams."""
    df = _texts(spark, random.Random(7), 300, 60).withColumnsRenamed({"words": "filteredWords", "grams": "ngrams"}).cache()
    recipe = ft.content_recipe([], size=20)
    want = ft.term_table(df, "ngrams", 20, ft.CONTENT_MIN_DOCS)
    monkeypatch.setattr(ft, "term_statistics", lambda *a: pytest.fail("all n-grams were counted"))
    assert ft._table_of(df, recipe) == want
    assert ft.frequent_ngrams(df, "filteredWords", 2, 20, 3)[1] > 3


def test_frequent_terms_of_few_documents(spark):
    """Where the most frequent words lie in too few documents, the terms come from all n-grams."""
    loud = [(i, [f"x{i}"] * 50) for i in range(40)]
    df = spark.createDataFrame(loud + [(100 + i, ["a", "b", f"c{i % 4}"]) for i in range(20)], "id int, words array<string>")
    df = df.selectExpr("*", f"{ngrams_sql('words', 2)} as grams").cache()
    got = ft.ngram_table(df, "words", "grams", 2, 5, 3)
    assert got == ft.term_table(df, "grams", 5, 3) and got.terms[:3] == ["a", "a b", "b"]


def test_many_equally_frequent_words(spark, monkeypatch):
    monkeypatch.setattr(ft, "MAX_FREQUENT", 10)
    df = spark.createDataFrame([(i, [f"x{i}", f"y{i}"]) for i in range(30)], "id int, words array<string>")
    df = df.selectExpr("*", f"{ngrams_sql('words', 2)} as grams").cache()
    assert ft.ngram_table(df, "words", "grams", 2, 4, 1) == ft.term_table(df, "grams", 4, 1)


def test_no_words(spark):
    df = spark.createDataFrame([(1, []), (2, None)], "id int, words array<string>").where("id = 1").selectExpr("*", f"{ngrams_sql('words', 2)} as grams")
    assert ft.ngram_table(df, "words", "grams", 2, 4, 1) == ft.term_table(df, "grams", 4, 1)
