"""Classifiers, grids, folds, hold-out runs and batch scoring."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import product

from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    NaiveBayes,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import IndexToString
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F, types as T

from larkspur.functions.hashing import bucket, split_name
from larkspur.operators.corpus import union_parts
from larkspur.operators.evaluate import best_f_threshold
from larkspur.operators.features import FEATURES, LABEL, PREDICTION, tf_idf
from larkspur.operators.parallel import at_once, run_all
from larkspur.operators.trees import grows_by_depth, of_depths
from larkspur.session import fitting

Params = dict[str, object]

# The hyper-parameter grids.
TREE_GRID = {"impurity": ["gini", "entropy"], "maxDepth": [10, 20, 30], "maxBins": [40, 300]}
FOREST_GRID = {**TREE_GRID, "numTrees": [10, 50]}
OVR_TREE_GRID = {"impurity": ["entropy"], "maxDepth": [10, 20, 30], "maxBins": [40, 300]}
BAYES_GRID = {"smoothing": [1.0, 2.0, 5.0]}
LOGISTIC_GRID = {"regParam": [0.01, 0.1]}
# Settings shared by every point of a grid, or of single fits.
TREE = {"impurity": "gini", "maxDepth": 10, "maxBins": 300}
FOREST = {**TREE, "numTrees": 50, "featureSubsetStrategy": "auto"}
LOGISTIC = {"maxIter": 600, "tol": 1.0e-5, "elasticNetParam": 0.0, "fitIntercept": True, "standardization": True}
SVM = {"maxIter": 300}
PERCEPTRON = {"maxIter": 100, "blockSize": 128, "seed": 1234}
FINAL_TREE = {"impurity": "entropy", "maxDepth": 30, "maxBins": 300}
FOLDS, FOLD_SEED = 10, 10
# Rows of a task of linear models, whose passes over the rows are short and many.
LINEAR_ROWS = 64_000
# Fits that run side by side at most, and classes of one against the others.
FITS_AT_ONCE, CLASSES_AT_ONCE = 16, 4
# Ten measurements, then two categories with their numbers of values.
COVER_WIDTH, COVER_CATEGORIES = 12, {10: 4, 11: 40}


def points(grid: dict[str, Sequence]) -> list[Params]:
    """All combinations of a grid, as parameter maps."""
    return [dict(zip(grid, values)) for values in product(*grid.values())]


# --- estimators -----------------------------------------------------------------


def _columns(features: str, label: str) -> dict[str, str]:
    return {"featuresCol": features, "labelCol": label, "predictionCol": PREDICTION}


def decision_tree(features: str = FEATURES, label: str = LABEL, **params) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(**_columns(features, label), **{**TREE, "seed": 1, "maxMemoryInMB": 512, **params})


def random_forest(features: str = FEATURES, label: str = LABEL, **params) -> RandomForestClassifier:
    """Seeded with the number of trees."""
    chosen = {**FOREST, "maxMemoryInMB": 512, **params}
    chosen.setdefault("seed", chosen["numTrees"])
    return RandomForestClassifier(**_columns(features, label), **chosen)


def logistic_regression(features: str = FEATURES, label: str = LABEL, **params) -> LogisticRegression:
    return LogisticRegression(**_columns(features, label), **{"maxIter": 100, "regParam": 0.0, **params})


def linear_svm(features: str = FEATURES, label: str = LABEL, **params) -> LinearSVC:
    return LinearSVC(**_columns(features, label), **{**SVM, **params})


def naive_bayes(features: str = FEATURES, label: str = LABEL, **params) -> NaiveBayes:
    return NaiveBayes(**_columns(features, label), **{"modelType": "multinomial", "smoothing": 1.0, **params})


def perceptron(layers: Sequence[int], features: str = FEATURES, label: str = LABEL, **params) -> MultilayerPerceptronClassifier:
    return MultilayerPerceptronClassifier(**_columns(features, label), layers=list(layers), **{**PERCEPTRON, **params})


def perceptron_layers(df: DataFrame, classes: int, features: str = FEATURES, narrowing: int = 1000) -> list[int]:
    """Input width, the same again, the width less ``narrowing``, one output per class; width read from the data."""
    width = vector_width(df, features)
    return [width, width, max(width - narrowing, classes), classes]


def vector_width(df: DataFrame, features: str = FEATURES) -> int:
    return df.select(F.size(vector_to_array(features))).first()[0]


def one_vs_rest(classifier, features: str = FEATURES, label: str = LABEL, parallelism: int = 4) -> OneVsRest:
    return OneVsRest(classifier=classifier, parallelism=parallelism, **_columns(features, label))


def declare_categories(df: DataFrame, features: str, width: int, arities: dict[int, int]) -> DataFrame:
    """Mark slots of a vector column as categories 0 .. arity - 1, the others as numbers.

    The kind of a feature is declared and does not depend on the values that happen to
    be in the data.  Tree learners read it from the column; a value outside its arity is an error.
    """
    nominal = [{"idx": at, "name": f"f{at}", "num_vals": n} for at, n in sorted(arities.items())]
    numeric = [{"idx": at, "name": f"f{at}"} for at in range(width) if at not in arities]
    attributes = {"ml_attr": {"attrs": {"numeric": numeric, "nominal": nominal}, "num_attrs": width}}
    return df.withMetadata(features, attributes)


# --- splits -----------------------------------------------------------------------


def hash_split(df: DataFrame, key: str, shares: dict[str, int], buckets: int = 100) -> list[DataFrame]:
    """Disjoint parts by a hash of the key: the same rows whatever the partitioning."""
    tagged = df.withColumn("_split", split_name(F.col(key), shares, buckets))
    return [tagged.filter(F.col("_split") == name).drop("_split") for name in shares]


def with_fold(df: DataFrame, key: str, folds: int = FOLDS, out: str = "fold") -> DataFrame:
    return df.withColumn(out, bucket(F.concat_ws(":", F.lit(str(FOLD_SEED)), F.col(key)), folds).cast("int"))


# --- metrics and grids ----------------------------------------------------------------


def evaluator(metric: str = "f1", label: str = LABEL, class_index: float = 1.0) -> MulticlassClassificationEvaluator:
    """Weighted F1 by default; ``fMeasureByLabel`` scores one class."""
    return MulticlassClassificationEvaluator(
        labelCol=label, predictionCol=PREDICTION, metricName=metric, metricLabel=class_index
    )


def scores(model: Model, df: DataFrame, metrics: Sequence[str], label: str = LABEL) -> list[float]:
    predicted = model.transform(df).select(F.col(label).cast("double").alias(label), PREDICTION)
    counts = predicted.groupBy(label, PREDICTION).agg(F.count("*").cast("double").alias("_w")).cache()
    try:
        return [evaluator(m, label).setWeightCol("_w").evaluate(counts) for m in metrics]
    finally:
        counts.unpersist()


def fit_on(estimator: Estimator, data: DataFrame) -> Model:
    """Fit on rows that are cut for it; one against the others fits few classes at once where one fit fills the cores."""
    if isinstance(estimator, OneVsRest):
        estimator = estimator.copy().setParallelism(at_once(data, CLASSES_AT_ONCE))
    return estimator.fit(data)


def is_linear(estimator: Estimator) -> bool:
    """Whether a fit makes many short passes over the rows: a linear model, or one for each class."""
    inner = estimator.getClassifier() if isinstance(estimator, OneVsRest) else estimator
    return isinstance(inner, (LinearSVC, LogisticRegression))


def rows_of_task(estimator: Estimator) -> int:
    return LINEAR_ROWS if is_linear(estimator) else 2000


def fit(estimator: Estimator, df: DataFrame, label: str = LABEL, features: str = FEATURES, rows_per_task: int | None = None) -> Model:
    """Fit on a cached copy of just the two columns; a model that is costly per row takes fewer rows per task."""
    with fitting(df, label, features, rows_per_task=rows_per_task or rows_of_task(estimator)) as data:
        return fit_on(estimator, data)


def shared_fits(build: Callable[..., Estimator], grid: dict[str, Sequence] | None, shared: bool = True) -> list[list[Params]]:
    """The points of a grid, those that one fit serves together: trees that differ in their depth alone if ``shared``, else each by itself."""
    groups: dict[str, list[Params]] = {}
    for params in points(grid or {}):
        together = shared and "maxDepth" in params and grows_by_depth(build(**params))
        rest = {k: v for k, v in params.items() if not (together and k == "maxDepth")}
        groups.setdefault(repr(rest), []).append(params)
    return list(groups.values())


def fit_shared(build: Callable[..., Estimator], group: list[Params], data: DataFrame) -> list[Model]:
    """The models of points that :func:`shared_fits` put together, by one fit of the deepest."""
    if len(group) == 1:
        return [fit_on(build(**group[0]), data)]
    deepest = max(group, key=lambda p: p["maxDepth"])
    return of_depths(data.sparkSession, fit_on(build(**deepest), data), [p["maxDepth"] for p in group])


def grid_search(
    train: DataFrame,
    valid: DataFrame,
    build: Callable[..., Estimator],
    grid: dict[str, Sequence],
    metric: str = "f1",
    label: str = LABEL,
    features: str = FEATURES,
    parallelism: int = FITS_AT_ONCE,
    train_metrics: bool = False,
    shared: bool = True,
) -> DataFrame:
    """Fit every grid point on ``train``, score on ``valid``; best first.  Trees of several depths come from one fit if ``shared``.

    Columns: one per parameter (as text), ``score``, and ``train_score`` on request.  ``parallelism`` bounds the fits side by side.
    """
    rows_per_task = rows_of_task(build(**points(grid)[0]))
    with fitting(train, label, features, rows_per_task=rows_per_task) as data, fitting(valid, label, features) as test_on:

        def score(params: Params, model: Model) -> tuple:
            out = (*map(str, params.values()), scores(model, test_on, [metric], label)[0])
            return (*out, scores(model, data, [metric], label)[0]) if train_metrics else out

        def score_group(group: list[Params]) -> list[tuple]:
            return [score(params, model) for params, model in zip(group, fit_shared(build, group, data))]

        rows = [row for found in run_all(score_group, shared_fits(build, grid, shared), at_once(data, parallelism)) for row in found]
    names = [T.StructField(n, T.StringType()) for n in grid] + [T.StructField("score", T.DoubleType())]
    if train_metrics:
        names.append(T.StructField("train_score", T.DoubleType()))
    ranked = train.sparkSession.createDataFrame(rows, T.StructType(names))
    return ranked.orderBy(F.desc("score"), *grid)


def best_point(ranked: DataFrame, grid: dict[str, Sequence]) -> Params:
    """The parameters of the best row, in their own types."""
    best = ranked.first()
    return {name: next(v for v in values if str(v) == best[name]) for name, values in grid.items()}


def refit_best(
    train: DataFrame,
    valid: DataFrame,
    test: DataFrame,
    build: Callable[..., Estimator],
    grid: dict[str, Sequence],
    metric: str = "f1",
    label: str = LABEL,
    features: str = FEATURES,
    parallelism: int = FITS_AT_ONCE,
    shared: bool = True,
) -> tuple[DataFrame, Model]:
    """Grid search, then the best point refitted on train and validation together.

    Returns one row (parameters, score on test, on train+validation) and the model.
    """
    ranked = grid_search(train, valid, build, grid, metric, label, features, parallelism, shared=shared)
    params = best_point(ranked, grid)
    with fitting(union_parts(train, valid), label, features) as both:
        model = build(**params).fit(both)
        on_test = scores(model, test, [metric, "accuracy", "weightedPrecision", "weightedRecall"], label)
        on_both = scores(model, both, ["accuracy"], label)
    names = ", ".join(f"{n} string" for n in grid)
    row = [(*map(str, params.values()), *on_test, *on_both)]
    report = train.sparkSession.createDataFrame(
        row,
        f"{names}, score double, test_accuracy double, test_precision double, test_recall double, train_accuracy double",
    )
    return report, model


def split_scores(model: Model, parts: dict[str, DataFrame], label: str = LABEL) -> DataFrame:
    """Accuracy and weighted precision of one model on train, validation and test."""
    rows = [(name, *scores(model, part, ["accuracy", "weightedPrecision"], label)) for name, part in parts.items()]
    spark = next(iter(parts.values())).sparkSession
    return spark.createDataFrame(rows, "part string, accuracy double, weighted_precision double")


def kfold_scores(
    df: DataFrame,
    build: Callable[..., Estimator],
    grid: dict[str, Sequence] | None = None,
    fold: str = "fold",
    folds: int = FOLDS,
    metric: str = "f1",
    label: str = LABEL,
    features: Sequence[str] = (FEATURES,),
    parallelism: int = FITS_AT_ONCE,
    rows_per_task: int | None = None,
    shared: bool = True,
) -> DataFrame:
    """k-fold scores of every grid point: (params, fold, score).  Folds are rows of a fold column.  ``shared`` as in :func:`grid_search`.

    Fits run side by side, so those whose passes are short keep the cores busy with few tasks of many rows each; where one fit
    has tasks for all cores, they run one after the other.
    """
    rows_per_task = rows_per_task or rows_of_task(build(**points(grid or {})[0]))
    with fitting(df, label, fold, *features, rows_per_task=rows_per_task) as data:

        def score(item: tuple[list[Params], int]) -> list[tuple[str, int, float]]:
            group, number = item
            models = fit_shared(build, group, data.filter(F.col(fold) != number))
            test = data.filter(F.col(fold) == number)
            named = [", ".join(f"{k}={v}" for k, v in params.items()) for params in group]
            return [(name, number, scores(model, test, [metric], label)[0]) for name, model in zip(named, models)]

        items = [(group, i) for group in shared_fits(build, grid, shared) for i in range(folds)]
        rows = [row for found in run_all(score, items, at_once(data, parallelism)) for row in found]
    return df.sparkSession.createDataFrame(rows, "params string, fold int, score double")


def mean_fold_scores(fold_scores: DataFrame) -> DataFrame:
    """Mean score per parameter set, best first."""
    means = fold_scores.groupBy("params").agg(F.avg("score").alias("mean_score"), F.count("*").alias("folds"))
    return means.orderBy(F.desc("mean_score"), "params")


def compare_classifiers(
    df: DataFrame,
    categories: Sequence[str],
    classifiers: dict[str, Callable[..., Estimator]],
    category: str = "category",
    features: str = FEATURES,
    key: str = "doc_id",
    folds: int = FOLDS,
    parallelism: int = FITS_AT_ONCE,
) -> DataFrame:
    """One row per category: mean k-fold F1 of each classifier on "category against the rest".

    The features do not depend on the category, so they are computed and cached once for each size of tasks.
    """
    sizes: dict[int, list[str]] = {}
    for kind, build in classifiers.items():
        sizes.setdefault(rows_of_task(build(features=features, label="label")), []).append(kind)
    found: dict[tuple[str, str, int], float] = {}
    for rows_per_task, kinds in sizes.items():
        with fitting(with_fold(df, key, folds), category, features, "fold", rows_per_task=rows_per_task) as data:

            def one(item: tuple[str, str, int]) -> float:
                name, kind, number = item
                labelled = data.withColumn("label", (F.col(category) == name).cast("double"))
                model = classifiers[kind](features=features, label="label").fit(labelled.filter(F.col("fold") != number))
                return scores(model, labelled.filter(F.col("fold") == number), ["f1"], "label")[0]

            items = [(c, k, i) for k in kinds for c in categories for i in range(folds)]
            found.update(zip(items, run_all(one, items, at_once(data, parallelism))))
    rows = [(c, *[sum(found[c, k, i] for i in range(folds)) / folds for k in classifiers]) for c in categories]
    names = ", ".join(f"{k} double" for k in classifiers)
    return df.sparkSession.createDataFrame(rows, f"category string, {names}")


def category_holdout(
    df: DataFrame,
    categories: Sequence[str],
    tokens: str,
    vocabulary: list[str],
    key: str = "doc_id",
    category: str = "category",
    build: Callable[..., Estimator] = decision_tree,
    parallelism: int = 4,
) -> DataFrame:
    """Per category: 90/10 hold-out, TF-IDF fitted on the training part, a tree, its F1.  Fits run side by side until the cores are busy."""
    train, test = hash_split(df.select(key, category, tokens), key, {"train": 90, "test": 10})
    train, test = tf_idf(train, [test], tokens, vocabulary, out="features")
    with fitting(train, category, "features") as train, fitting(test, category, "features") as test:

        def one(name: str) -> tuple[str, float]:
            label = (F.col(category) == name).cast("double")
            model = build(features="features", label="label").fit(train.withColumn("label", label))
            return name, scores(model, test.withColumn("label", label), ["f1"], "label")[0]

        rows = run_all(one, categories, at_once(train, parallelism))
    return df.sparkSession.createDataFrame(rows, "category string, f1 double")


def with_best_threshold(model, df: DataFrame, label: str = "label") -> tuple[Model, float, float]:
    """Set the threshold that maximises F1 on ``df``; returns model, threshold and that F1."""
    scored = model.transform(df).select(F.col(label), vector_to_array("probability")[1].alias("score"))
    best = best_f_threshold(scored, label, "score").first()
    return model.copy().setThreshold(best["threshold"]), best["threshold"], best["f_measure"]


def batch_score(model: PipelineModel, df: DataFrame, labels: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Apply a stored pipeline and turn predictions into label names."""
    named = IndexToString(inputCol=PREDICTION, outputCol="predictedLabel", labels=list(labels))
    return named.transform(model.transform(df)).select(*keep, PREDICTION, "predictedLabel")
