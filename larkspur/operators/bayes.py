"""Multinomial naive Bayes for all folds and smoothings at once, from sums that are subtracted.

The model of a fold needs, for each class and term, the sum over the rows of all other folds: the sum over all rows less that of the fold.  One
aggregate over the entries therefore holds the models of all folds, and the smoothing is only added when
logarithms are taken.  Nothing is fitted fold by fold, and the vectors are read twice in all: once for the sums, once to be scored.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from larkspur.functions.vectors import sparse_entries
from larkspur.operators.features import FEATURES, LABEL
from larkspur.session import stored_copy

#: Numbers of (fold, term, class, smoothing) that a broadcast model may hold; beyond it the model is joined by a shuffle.
MAX_MODEL_VALUES = 8_000_000
MAX_CLASSES = 1_000


def _entries(df: DataFrame, features: str, *keep: str) -> DataFrame:
    return sparse_entries(df, features, *keep).where("value <> 0")


def class_sums(df: DataFrame, label: str = LABEL, features: str = FEATURES, fold: str = "fold") -> DataFrame:
    """(fold, class, index, total): one pass, partial sums in each task."""
    rows = _entries(df.select(fold, F.col(label).cast("int").alias("class"), features), features, fold, "class")
    return rows.groupBy(F.col(fold).alias("fold"), "class", "index").agg(F.sum("value").alias("total"))


def fold_predictions(
    df: DataFrame,
    width: int,
    smoothings: Sequence[float],
    key: str = "doc_id",
    label: str = LABEL,
    features: str = FEATURES,
    fold: str = "fold",
) -> DataFrame:
    """(key, fold, class, smoothing, prediction): every row scored by the models of all other folds, one for each smoothing.

    ``width`` is the length of the vectors, sparse ones with entries that are not negative.  Classes are 0, 1, ...; of equal scores the first class
    wins, and a class that no other fold has is never predicted.  ``key`` must be unique.
    """
    rows = df.select(key, F.col(fold).cast("int").alias("fold"), F.col(label).cast("int").alias("class"), features).where("fold is not null and class is not null")
    counts = {(r["fold"], r["class"]): r["n"] for r in rows.groupBy("fold", "class").agg(F.count("*").alias("n")).limit(MAX_CLASSES * 100).collect()}
    classes = max((c for _, c in counts), default=-1) + 1
    if classes > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes")
    names = "fold int, class int, smoothing double, prediction double"
    if not classes:
        return df.sparkSession.createDataFrame([], f"{key} {dict(df.dtypes)[key]}, {names}")
    sums = stored_copy(class_sums(rows, "class", features, "fold"), "sums")
    folds = sorted({f for f, _ in counts})
    in_fold = {(r["fold"], r["class"]): r["s"] for r in sums.groupBy("fold", "class").agg(F.sum("total").alias("s")).collect()}  # one row for each key of counts

    def others(table: dict, f: int, c: int) -> float:
        return sum(table.get((g, c), 0) for g in folds if g != f)

    # per (fold, index): the sums of each class over the other folds, then logarithms for every class and smoothing
    wide = sums.groupBy("fold", "index").agg(*[F.sum(F.when(F.col("class") == c, F.col("total")).otherwise(0.0)).alias(f"own{c}") for c in range(classes)])
    whole = wide.groupBy("index").agg(*[F.sum(f"own{c}").alias(f"all{c}") for c in range(classes)])
    both = wide.join(whole, "index")
    fold_at = F.array_position(F.array(*[F.lit(f) for f in folds]), F.col("fold")).cast("int")

    def per_fold(values: list[float]) -> Column:
        return F.element_at(F.array(*[F.lit(float(v)) for v in values]), fold_at)

    logs = []
    for s in smoothings:
        for c in range(classes):
            mass = per_fold([math.log(others(in_fold, f, c) + width * s) for f in folds])
            logs.append(F.log(F.greatest(F.lit(0.0), F.col(f"all{c}") - F.col(f"own{c}")) + F.lit(float(s))) - mass)
    model = both.select("fold", "index", F.array(*logs).alias("logs"))
    if len(folds) * width * len(logs) <= MAX_MODEL_VALUES:
        model = F.broadcast(model)  # of the size that was just checked

    scored = _entries(rows, features, key, "fold").join(model, ["fold", "index"])
    # a row's entries lie in one task, so its sums are complete before the shuffle
    sums_of_row = scored.groupBy(key).agg(*[F.sum(F.col("value") * F.get("logs", F.lit(k))).alias(f"s{k}") for k in range(len(logs))])
    placed = rows.select(key, "fold", "class").join(sums_of_row, key, "left")
    results = []
    for at, s in enumerate(smoothings):
        scores = []
        for c in range(classes):
            train = {f: others(counts, f, c) for f in folds}
            kinds = {f: sum(others(counts, f, k) > 0 for k in range(classes)) for f in folds}
            rows_of = {f: sum(others(counts, f, k) for k in range(classes)) for f in folds}
            prior = per_fold([math.log(train[f] + s) - math.log(rows_of[f] + kinds[f] * s) if train[f] else -math.inf for f in folds])
            scores.append(F.coalesce(F.col(f"s{at * classes + c}"), F.lit(0.0)) + prior)
        every = F.array(*scores)
        best = F.array_position(every, F.array_max(every)) - 1
        results.append(F.struct(F.lit(float(s)).alias("smoothing"), best.cast("double").alias("prediction")))
    return placed.select(key, "fold", "class", F.explode(F.array(*results)).alias("r")).select(key, "fold", "class", "r.*")


def weighted_f1(predictions: DataFrame, *by: str) -> DataFrame:
    """(by, score): F1 of each class, weighted by its rows, for each group of predictions."""
    cells = predictions.groupBy(*by, "class", F.col("prediction").cast("int").alias("guess")).agg(F.count("*").alias("n"))
    sides = cells.select(
        *by,
        F.explode(F.array(
            F.struct(F.col("class").alias("of"), F.col("n").alias("actual"), F.lit(0).cast("bigint").alias("guessed"), F.when(F.col("class") == F.col("guess"), F.col("n")).otherwise(0).alias("hits")),
            F.struct(F.col("guess").alias("of"), F.lit(0).cast("bigint").alias("actual"), F.col("n").alias("guessed"), F.lit(0).cast("bigint").alias("hits")),
        )).alias("e"),
    ).select(*by, "e.*")
    per_class = sides.groupBy(*by, "of").agg(*[F.sum(c).alias(c) for c in ("actual", "guessed", "hits")])
    f1 = 2 * F.col("hits") / (F.col("actual") + F.col("guessed"))
    return per_class.groupBy(*by).agg((F.sum(f1 * F.col("actual")) / F.sum("actual")).alias("score"))


def fold_scores(df: DataFrame, width: int, smoothings: Sequence[float] = (1.0,), **columns: str) -> DataFrame:
    """k-fold F1 for every smoothing: (smoothing, fold, score)."""
    return weighted_f1(fold_predictions(df, width, smoothings, **columns), "smoothing", "fold")


def holdout_predictions(train: DataFrame, test: DataFrame, width: int, smoothings: Sequence[float] = (1.0,), **columns: str) -> DataFrame:
    """(key, class, smoothing, prediction) of the test rows by models of the training rows."""
    both = train.withColumn("_part", F.lit(0)).unionByName(test.withColumn("_part", F.lit(1)))
    return fold_predictions(both, width, smoothings, fold="_part", **columns).where("fold = 1").drop("fold")
