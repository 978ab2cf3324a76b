"""Evaluation arithmetic: classification, ranking, regression and AUC."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from larkspur.operators.ordering import running_totals
from larkspur.session import stored_copy


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


# --- classification -----------------------------------------------------------


def pair_counts(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(actual, predicted, n): the one pass over the data that all the scores below start from."""
    return df.groupBy(F.col(label).alias("actual"), F.col(prediction).alias("predicted")).agg(F.count("*").alias("n"))


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Counts on the full label grid, rows actual and columns predicted, zero where no row fell.

    The grid is built in Spark: labels are numbered by their order, every label is laid out once for each number, and the number brings
    the other label by a join, so that neither labels nor counts pass through the driver, however many there are.  Rows without
    a label or a prediction have no cell and are left out.
    """
    known = stored_copy(pair_counts(df, label, prediction).where("actual is not null and predicted is not null"), "pairs")
    labels = known.select(F.explode(F.array("actual", "predicted")).alias("_label")).distinct()
    # numbers without gaps: order of the label inside a range, after the labels of the ranges before
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = stored_copy(labels.repartitionByRange(parts, "_label").withColumn("_range", F.spark_partition_id()), "labels")
    inside = Window.partitionBy("_range").orderBy("_label")
    sizes = ranged.groupBy("_range").agg(F.count("*").alias("_n"))
    # as many rows as there are ranges
    before = sizes.select("_range", F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    numbered = ranged.join(F.broadcast(before), "_range").select("_label", (F.col("_before") + F.row_number().over(inside)).alias("_at"))
    total = numbered.count()
    rows = numbered.select(F.col("_label").alias("actual"), F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(total).cast("bigint"))).alias("_at"))
    grid = rows.join(numbered.withColumnRenamed("_label", "predicted"), "_at").drop("_at")
    return grid.join(known, ["actual", "predicted"], "left").fillna(0, ["n"])


def per_label_scores(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """F1, precision and recall of each label in percent, 0 when the denominator is 0."""
    counts = pair_counts(df, label, prediction)
    sides = counts.select(
        F.explode(
            F.array(
                F.struct(F.col("actual").alias("label"), F.lit(1).alias("is_actual"), F.lit(0).alias("is_predicted")),
                F.struct(F.col("predicted").alias("label"), F.lit(0).alias("is_actual"), F.lit(1).alias("is_predicted")),
            )
        ).alias("s"),
        "n",
        (F.col("actual") == F.col("predicted")).alias("hit"),
    )
    sums = sides.groupBy(F.col("s.label").alias("label")).agg(
        F.sum(F.when(F.col("hit") & (F.col("s.is_actual") == 1), F.col("n")).otherwise(0)).alias("tp"),
        F.sum(F.col("s.is_actual") * F.col("n")).alias("actual_n"),
        F.sum(F.col("s.is_predicted") * F.col("n")).alias("predicted_n"),
    )
    tp, actual, predicted = F.col("tp"), F.col("actual_n"), F.col("predicted_n")
    return sums.select(
        "label",
        "actual_n",
        (100 * _ratio(2 * tp, actual + predicted)).alias("f_measure"),
        (100 * _ratio(tp, predicted)).alias("precision"),
        (100 * _ratio(tp, actual)).alias("recall"),
    )


def weighted_scores(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Scores weighted by actual counts, true-positive rate and accuracy, in percent."""
    per_label = per_label_scores(df, label, prediction)
    total, n = F.sum("actual_n"), F.col("actual_n")
    recall = F.sum(F.col("recall") * n) / total
    return per_label.agg(
        (F.sum(F.col("f_measure") * n) / total).alias("weighted_f"),
        (F.sum(F.col("precision") * n) / total).alias("weighted_precision"),
        recall.alias("weighted_recall"),
        recall.alias("true_positive_rate"),
        # the weighted recall is the share of hits, so it is the accuracy too
        recall.alias("accuracy"),
    )


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    hit = F.when(F.col(label) == F.col(prediction), 1.0).otherwise(0.0)
    return df.agg(F.avg(hit).alias("accuracy"))


def random_baseline(train: DataFrame, test: DataFrame, label: str = "label") -> DataFrame:
    """Expected accuracy of guessing labels at their training shares."""
    one = train.groupBy(label).agg(F.count("*").alias("a"))
    two = test.groupBy(label).agg(F.count("*").alias("b"))
    both = one.join(two, label, "full").select(F.coalesce("a", F.lit(0)).alias("a"), F.coalesce("b", F.lit(0)).alias("b"))
    share = F.sum(F.col("a") * F.col("b")) / (F.sum("a") * F.sum("b"))
    return both.agg(share.alias("accuracy"))


# --- binary scores ----------------------------------------------------------------


def score_steps(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Per distinct score: positives and negatives at it, above it, and in all.

    Rows without a score (null or NaN) cannot be ranked and count nowhere.
    """
    df = df.where(F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")))
    counts = df.groupBy(F.col(score).alias("score")).agg(
        F.count(F.when(F.col(label) == 1, 1)).alias("pos"), F.count(F.when(F.col(label) != 1, 1)).alias("neg")
    )
    steps = running_totals(counts, [], "score", {"pos_above": "pos", "neg_above": "neg"}, descending=True)
    all_rows = df.agg(F.count(F.when(F.col(label) == 1, 1)), F.count(F.when(F.col(label) != 1, 1))).first()
    return steps.withColumns({"pos_all": F.lit(all_rows[0]), "neg_all": F.lit(all_rows[1])})


def f_by_threshold(df: DataFrame, label: str = "label", score: str = "score", beta: float = 1.0) -> DataFrame:
    """F measure of "positive when score >= threshold" for every distinct score."""
    steps = score_steps(df, label, score)
    tp, fp = F.col("pos_above") + F.col("pos"), F.col("neg_above") + F.col("neg")
    b = beta * beta
    f = _ratio((1 + b) * tp, b * F.col("pos_all") + tp + fp)
    return steps.select(F.col("score").alias("threshold"), f.alias("f_measure"))


def best_f_threshold(df: DataFrame, label: str = "label", score: str = "score", beta: float = 1.0) -> DataFrame:
    """The threshold with the highest F measure; among equals the highest threshold."""
    return f_by_threshold(df, label, score, beta).orderBy(F.desc("f_measure"), F.desc("threshold")).limit(1)


def roc_points(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """False and true positive rate at every distinct score."""
    steps = score_steps(df, label, score)
    return steps.select(
        F.col("score").alias("threshold"),
        _ratio(F.col("neg_above") + F.col("neg"), F.col("neg_all")).alias("fpr"),
        _ratio(F.col("pos_above") + F.col("pos"), F.col("pos_all")).alias("tpr"),
    )


def roc_area(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Area under the ROC curve; equal scores count half."""
    steps = score_steps(df, label, score)
    won = F.sum(F.col("neg") * (2 * F.col("pos_above") + F.col("pos")))
    return steps.agg((won / (2.0 * F.max("pos_all") * F.max("neg_all"))).alias("area"))


# --- ranking ------------------------------------------------------------------------


def ranked_hits(recommended: DataFrame, relevant: DataFrame, rated_users: DataFrame | None = None) -> DataFrame:
    """(user, position, hit, n_relevant) for recommendation lists of bounded length.

    ``recommended`` has user, item and a 1-based position; ``relevant`` the (user,
    item) pairs that count as hits.  The lists meet in a join on both columns, so a
    user with very many relevant items is spread over tasks.  Only users with
    recommendations and ratings count (``rated_users``, by default those in
    ``relevant``).
    """
    relevant = relevant.select("user", "item").distinct()
    totals = relevant.groupBy("user").agg(F.count("*").alias("n_relevant"))
    if rated_users is not None:
        totals = rated_users.select("user").distinct().join(totals, "user", "left").fillna(0, ["n_relevant"])
    marked = recommended.select("user", "item", "position").join(
        relevant.withColumn("_hit", F.lit(1)), ["user", "item"], "left"
    )
    return marked.join(totals, "user").select(
        "user", "position", F.coalesce("_hit", F.lit(0)).alias("hit"), "n_relevant"
    )


def precision_at(hits: DataFrame, ks: Sequence[int] = (1, 3, 5)) -> DataFrame:
    """Mean share of hits among the first k, always divided by k."""
    per_user = hits.groupBy("user").agg(
        *[(F.sum(F.when(F.col("position") <= k, F.col("hit")).otherwise(0)) / k).alias(f"k{k}") for k in ks]
    )
    return _per_k(per_user, ks, "precision")


def mean_average_precision(hits: DataFrame) -> DataFrame:
    """Mean over users of the average precision; a user without relevant items counts 0."""
    so_far = Window.partitionBy("user").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    gains = hits.withColumn("_gain", F.when(F.col("hit") == 1, F.sum("hit").over(so_far) / F.col("position")).otherwise(0.0))
    per_user = gains.groupBy("user").agg(F.sum("_gain").alias("gain"), F.max("n_relevant").alias("n"))
    return per_user.agg(F.avg(_ratio(F.col("gain"), F.col("n"))).alias("mean_average_precision"))


def ndcg_at(hits: DataFrame, ks: Sequence[int] = (1, 3, 5)) -> DataFrame:
    """Normalised discounted cumulative gain with binary gain."""
    gain = F.lit(1.0) / F.log2(F.col("position") + 1)
    per_user = hits.groupBy("user").agg(
        F.max("n_relevant").alias("n"),
        *[F.sum(F.when((F.col("position") <= k) & (F.col("hit") == 1), gain).otherwise(0.0)).alias(f"g{k}") for k in ks],
    )

    def best(k: int) -> Column:
        first = F.least(F.col("n"), F.lit(k)).cast("int")
        places = F.when(first > 0, F.sequence(F.lit(1), first)).otherwise(F.array().cast("array<int>"))
        return F.aggregate(places, F.lit(0.0), lambda s, j: s + F.lit(1.0) / F.log2(j + 1))

    scored = per_user.select(*[_ratio(F.col(f"g{k}"), best(k)).alias(f"k{k}") for k in ks])
    return _per_k(scored, ks, "ndcg")


def _per_k(per_user: DataFrame, ks: Sequence[int], name: str) -> DataFrame:
    means = per_user.agg(*[F.avg(f"k{k}").alias(f"k{k}") for k in ks])
    cells = F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"k{k}").alias(name)) for k in ks])
    return means.select(F.explode(cells).alias("c")).select("c.*")


def mean_user_auc(positives: DataFrame, negatives: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean over users of the share of (positive, negative) pairs with the positive scored higher.

    Both inputs hold user and score; ties do not count as correct, and only users
    with both kinds count.  Pairs are never formed: scores are counted per user and
    each positive is credited with the negatives below it by a running total.
    Rows without a score (null or NaN) cannot be ranked and count nowhere.
    ``by`` names further columns, such as the model that gave the score: all their values are judged in the same jobs, one row each.
    """
    keys = [*by, "user"]
    both_kinds = positives.select(*keys, "score", F.lit(1).alias("_p")).unionByName(
        negatives.select(*keys, "score", F.lit(0).alias("_p"))
    )
    scored = both_kinds.where(F.col("score").isNotNull() & ~F.isnan(F.col("score").cast("double")))
    counts = scored.groupBy(*keys, "score").agg(
        F.sum("_p").alias("pos"), F.sum(1 - F.col("_p")).alias("neg")
    )
    below = running_totals(counts, keys, "score", {"neg_below": "neg"})
    per_user = below.groupBy(*keys).agg(
        F.sum(F.col("pos") * F.col("neg_below")).alias("won"), F.sum("pos").alias("p"), F.sum("neg").alias("n")
    )
    both = per_user.filter((F.col("p") > 0) & (F.col("n") > 0))
    means = [F.avg(F.col("won") / (F.col("p") * F.col("n"))).alias("mean_auc"), F.count("*").alias("users")]
    return both.groupBy(*by).agg(*means) if by else both.agg(*means)


# --- regression ----------------------------------------------------------------------


def mse(df: DataFrame, label: str = "rating", prediction: str = "prediction") -> DataFrame:
    error = F.col(label) - F.col(prediction)
    return df.agg(F.avg(error * error).alias("mse"))


def rmse_r2(df: DataFrame, label: str = "rating", prediction: str = "prediction") -> DataFrame:
    """Root mean squared error and R squared, in one pass."""
    error = F.col(label) - F.col(prediction)
    squared = F.avg(error * error)
    return df.agg(F.sqrt(squared).alias("rmse"), (1 - squared / F.var_pop(label)).alias("r2"))
