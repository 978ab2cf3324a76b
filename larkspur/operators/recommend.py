"""Collaborative filtering: ratings, ALS, baselines, sampling, ranked lists."""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import product

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, Window, functions as F

from larkspur.functions.hashing import hash_number
from larkspur.operators.corpus import clamp, containing_any
from larkspur.operators.evaluate import mean_user_auc
from larkspur.operators.ordering import position, running_totals
from larkspur.operators.parallel import run_all
from larkspur.operators.ranking import best_partners
from larkspur.session import cut_lineage, shared_dir, stored_copy

# Settings of the fits and of the grid.
EXPLICIT = {"rank": 10, "maxIter": 10, "regParam": 0.01}
IMPLICIT = {"rank": 10, "maxIter": 10, "regParam": 0.01, "alpha": 1.0}
IMPLICIT_FINAL = {"rank": 50, "maxIter": 10, "regParam": 1.0, "alpha": 40.0}
GRID = {"rank": [10, 50], "regParam": [0.0001, 1.0], "alpha": [1.0, 40.0]}
SLOTS_PER_BLOCK = 4096
#: Bytes of factors that a fit may send in all before it gets fewer blocks than there are cores, the least it then gets,
#: and the ratings that a block may hold.
SENT_BYTES, LEAST_BLOCKS, BLOCK_RATINGS = 1 << 30, 4, 9_000_000
#: Iterations after which factors are checkpointed, so that the shuffles before them can be dropped.
CHECKPOINT_EVERY = 2


# --- ratings ------------------------------------------------------------------


def id_stats(ratings: DataFrame) -> DataFrame:
    """Count, mean, population deviation, minimum and maximum of the user and the item ids."""

    def stats(name: str) -> list:
        c = F.col(name)
        made = [F.lit(name).alias("column"), F.count(c).alias("n"), F.avg(c).alias("mean"), F.stddev_pop(c).alias("stdev")]
        return [*made, F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max")]

    both = F.array(*[F.struct(*stats(name)) for name in ("user", "item")])
    return ratings.agg(both.alias("s")).select(F.explode("s").alias("s")).select("s.*")


def canonical_ratings(ratings: DataFrame, alias: DataFrame) -> DataFrame:
    """Replace item ids by their canonical id.

    A left join whose strategy Spark picks from the alias table's size; a hot item
    is split by the adaptive skew join when the join is a sort-merge join.
    """
    names = alias.select(F.col("bad_id").alias("item"), "good_id")
    return ratings.join(names, "item", "left").select("user", F.coalesce("good_id", "item").alias("item"), "rating")


def rating_summary(ratings: DataFrame) -> DataFrame:
    return ratings.agg(
        F.count("*").alias("ratings"), F.count_distinct("user").alias("users"), F.count_distinct("item").alias("items")
    )


def user_known_items(ratings: DataFrame, names: DataFrame, users: DataFrame) -> DataFrame:
    """Names of the items the given users already have."""
    owned = ratings.join(users.select("user").distinct(), "user", "left_semi").select("user", "item").distinct()
    return owned.join(names, owned["item"] == names["id"]).select("user", "item", "name")


def item_totals(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("item").agg(F.sum("rating").alias("total"))


def popularity_scores(pairs: DataFrame, train: DataFrame) -> DataFrame:
    """Baseline score of the given pairs: total training rating of the item, 0.0 when unseen."""
    return pairs.join(item_totals(train), "item", "left").withColumn("score", F.coalesce("total", F.lit(0.0))).drop("total")


# --- ALS --------------------------------------------------------------------------


def als_blocks(ratings: DataFrame, rank: int, iterations: int, least: int = LEAST_BLOCKS) -> int:
    """Blocks of users and of items for a fit: one for each core, or fewer where many factors are sent.

    An iteration sends each factor to nearly every block, so what a fit shuffles grows with the number of blocks; a block
    is one task.  With few blocks some cores are idle, and the number rises again with the ratings a block has to hold.
    """
    most = max(10, ratings.sparkSession.sparkContext.defaultParallelism)
    counts = [F.count("*").alias("n"), F.approx_count_distinct("user").alias("users"), F.approx_count_distinct("item").alias("items")]
    found = ratings.agg(*counts).first()
    sent = (found["users"] + found["items"]) * iterations * (4 * rank + 10)
    return max(math.ceil(found["n"] / BLOCK_RATINGS), min(most, max(least, SENT_BYTES // max(1, sent))))


def als_fit(ratings: DataFrame, implicit: bool = False, seed: int = 11, blocks: int | None = None, least_blocks: int = LEAST_BLOCKS, **params) -> ALSModel:
    """Alternating least squares on integer ids; intermediate factors are checkpointed to the shared folder."""
    spark = ratings.sparkSession
    shared_dir(spark)
    settings = {**(IMPLICIT if implicit else EXPLICIT), "checkpointInterval": CHECKPOINT_EVERY, **params}
    blocks = blocks or als_blocks(ratings, settings["rank"], settings["maxIter"], least_blocks)
    als = ALS(
        userCol="user", itemCol="item", ratingCol="rating", implicitPrefs=implicit, coldStartStrategy="drop",
        seed=seed, numUserBlocks=blocks, numItemBlocks=blocks, **settings,
    )
    return als.fit(ratings.select(F.col("user").cast("int"), F.col("item").cast("int"), F.col("rating").cast("float")))


def als_predict(model: ALSModel, pairs: DataFrame) -> DataFrame:
    """Predictions for the given pairs; users or items unknown to the model are dropped."""
    return model.transform(pairs.withColumns({"user": F.col("user").cast("int"), "item": F.col("item").cast("int")}))


def _best_items(users: DataFrame, model: ALSModel, n: int) -> DataFrame:
    return best_partners(users, model.itemFactors, n).toDF("user", "item", "position", "score")


def recommend_users(model: ALSModel, users: DataFrame, n: int = 5, names: DataFrame | None = None) -> DataFrame:
    """Top n items of the given users in one job, with item names on request."""
    chosen = users.select(F.col("user").cast("int").alias("id")).distinct()
    rows = _best_items(model.userFactors.join(chosen, "id", "left_semi"), model, n)
    if names is None:
        return rows
    return rows.join(names, rows["item"] == names["id"]).drop("id")


def recommend_all_users(model: ALSModel, n: int = 10) -> DataFrame:
    """Top n items of every user, scores clamped to [0, 1]."""
    return clamp(_best_items(model.userFactors, model, n), "score")


def recommend_item_users(model: ALSModel, items: DataFrame, n: int = 5) -> DataFrame:
    """Top n users of the given items."""
    chosen = items.select(F.col("item").cast("int").alias("id")).distinct()
    return best_partners(model.itemFactors.join(chosen, "id", "left_semi"), model.userFactors, n).toDF("item", "user", "position", "score")


def top_items(scored: DataFrame, n: int = 10) -> DataFrame:
    """Each user's n best items by score, ties by item.

    With a small ``n`` Spark drops surplus rows in each task before the shuffle.
    """
    order = Window.partitionBy("user").orderBy(F.desc("score"), F.asc("item"))
    return scored.withColumn("position", F.row_number().over(order)).filter(F.col("position") <= n)


# --- negative sampling and AUC --------------------------------------------------------


def negative_samples(positives: DataFrame, items: DataFrame, tries: int = 2) -> DataFrame:
    """(user, item, slot): hash draws from the item list, kept where the user does not own the item.

    A user with n distinct items gets ``tries`` * n numbered slots.  The hash of
    (user, slot) names an item; slots that name an owned one fall away, and of the
    rest the n lowest stay, which may repeat an item.  A user who owns most of the
    list ends up with fewer than n: ``sample_shortfall`` lists these users, and a
    larger ``tries`` fills them up.  Slots come in blocks of fixed size, so one
    large user is dealt over many tasks; a task run again draws the same items.
    """
    owned = positives.select("user", "item").distinct()
    known = cut_lineage(items.select("item").distinct())
    index = position(known, [], [("item", False)], "_at", stored=True)
    size = known.count()
    wanted = owned.groupBy("user").agg(F.count("*").alias("_want"))
    last = F.col("_want") * tries
    blocks = wanted.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((last - 1) / SLOTS_PER_BLOCK))))
    # a fixed number of tasks: few bytes go in, but every row becomes thousands of slots
    tasks = int(positives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = blocks.repartition(tasks, "user", "_block")
    first = F.col("_block") * SLOTS_PER_BLOCK + 1
    upto = F.least(F.col("_block") * SLOTS_PER_BLOCK + SLOTS_PER_BLOCK, last)
    slots = spread.withColumn("slot", F.explode(F.sequence(first, upto))).drop("_block")
    drawn = slots.withColumn("_at", hash_number(F.concat_ws(":", "user", "slot")) % F.lit(size) + 1)
    outside = drawn.join(index, "_at").join(owned, ["user", "item"], "left_anti").select("user", "item", "slot", "_want")
    ones = outside.withColumn("_one", F.lit(1).cast("bigint"))
    block = F.floor((F.col("slot") - 1) / SLOTS_PER_BLOCK)
    counted = running_totals(ones, ["user"], "slot", {"_before": "_one"}, block=block)
    return counted.filter(F.col("_before") < F.col("_want")).select("user", "item", "slot")


def sample_shortfall(positives: DataFrame, negatives: DataFrame) -> DataFrame:
    """(user, wanted, drawn) of the users with fewer negative samples than distinct items."""
    wanted = positives.select("user", "item").distinct().groupBy("user").agg(F.count("*").alias("wanted"))
    drawn = negatives.groupBy("user").agg(F.count("*").alias("drawn"))
    both = wanted.join(drawn, "user", "left").withColumn("drawn", F.coalesce("drawn", F.lit(0).cast("bigint")))
    return both.filter(F.col("drawn") < F.col("wanted"))


def popularity_auc(train: DataFrame, test: DataFrame, items: DataFrame) -> DataFrame:
    """Mean per-user AUC of the popularity baseline on held-out pairs."""
    positives = test.select("user", "item").distinct()
    negatives = negative_samples(positives, items)
    return mean_user_auc(popularity_scores(positives, train), popularity_scores(negatives, train))


def als_grid(
    train: DataFrame,
    test: DataFrame,
    items: DataFrame,
    grid: dict[str, Sequence] | None = None,
    seed: int = 11,
    max_iter: int = 10,
    parallelism: int = 4,
) -> DataFrame:
    """Implicit ALS for every grid point, ranked by mean per-user AUC, next to the popularity baseline.

    Fits run side by side; their predictions are tagged with the grid point and judged together, in one evaluation.
    """
    grid = grid or GRID
    spark = train.sparkSession
    train = train.select("user", "item", "rating").cache()
    positives = test.select("user", "item").distinct().cache()
    negatives = negative_samples(positives, items).cache()
    grid_points = [dict(zip(grid, values)) for values in product(*grid.values())]
    # fits run side by side, so the cores are busy with fewer blocks for each
    least = max(2, min(LEAST_BLOCKS, math.ceil(spark.sparkContext.defaultParallelism / parallelism)))
    try:

        def predict(at: int) -> list[DataFrame]:
            model = als_fit(train, True, seed, least_blocks=least, maxIter=max_iter, **grid_points[at])
            scored = [als_predict(model, part).select(F.lit(at).alias("point"), "user", F.col("prediction").cast("double").alias("score")) for part in (positives, negatives)]
            return [stored_copy(part, "scores") for part in scored]

        # the baseline is the point before the first of the grid
        parts = [popularity_scores(part, train).select(F.lit(-1).alias("point"), "user", F.col("score").cast("double").alias("score")) for part in (positives, negatives)]
        for scored in run_all(predict, range(len(grid_points)), parallelism):
            parts = [a.unionByName(b) for a, b in zip(parts, scored)]
        # one row for each point
        found = {r["point"]: r["mean_auc"] for r in mean_user_auc(*parts, by=["point"]).collect()}
    finally:
        for part in (train, positives, negatives):
            part.unpersist()
    rows = [("popularity", None, None, None, found.get(-1))]
    rows += [("als", int(p["rank"]), float(p["regParam"]), float(p["alpha"]), found.get(k)) for k, p in enumerate(grid_points)]
    ranked = spark.createDataFrame(rows, "model string, rank int, lambda double, alpha double, mean_auc double")
    return ranked.orderBy(F.desc("mean_auc"))


# --- ranked lists --------------------------------------------------------------------------


def filter_by_genre(pairs: DataFrame, items: DataFrame, genres: Sequence[str]) -> DataFrame:
    """Pairs whose item carries one of the genres; ``items`` has id, title, genres."""
    chosen = containing_any(items, "genres", list(genres)).select(F.col("id").alias("item"), "title", "genres")
    return pairs.join(chosen, "item")


def genre_ranked_list(scored: DataFrame, items: DataFrame, genres: Sequence[str]) -> DataFrame:
    """Every user's items of a genre, best score first, as rows with a position.

    The list is complete, so positions are computed in value ranges rather than by
    one window per user.  (user, item) must be unique.
    """
    return position(filter_by_genre(scored, items, genres), ["user"], [("score", True), ("item", False)])
