"""Decision trees of several depths from one fit.

A tree grows level by level and a split depends only on the rows of its node, so the tree of a smaller depth is the upper
part of the deeper one.  What the learner does at its last level is done here: nodes there become leaves with the
statistics they have, and leaves of one parent that predict the same are merged into it.  This holds for single trees,
which look at all features; a forest draws the features of its nodes in an order that depends on the depth.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

import numpy as np
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import DecisionTreeClassificationModel, DecisionTreeClassifier, OneVsRest, OneVsRestModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from larkspur.session import scratch_path


def grows_by_depth(estimator: Estimator) -> bool:
    """Whether a fit holds the fits of all smaller depths: a single tree, or one for each class."""
    inner = estimator.getClassifier() if isinstance(estimator, OneVsRest) else estimator
    return isinstance(inner, DecisionTreeClassifier)


def upper_part(left: np.ndarray, right: np.ndarray, prediction: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Which nodes the tree of ``depth`` has, and which of them are leaves; nodes are numbered in pre-order, children -1 for none."""
    levels = [np.array([0])]
    while len(levels) <= depth:
        inner = levels[-1][left[levels[-1]] >= 0]
        if not len(inner):
            break
        levels.append(np.concatenate([left[inner], right[inner]]))
    leaf = left < 0
    if len(levels) > depth:
        leaf[levels[depth]] = True
    for level in reversed(levels[:depth]):
        inner = level[~leaf[level]]
        a, b = left[inner], right[inner]
        leaf[inner[leaf[a] & leaf[b] & (prediction[a] == prediction[b])]] = True
    kept = np.zeros(len(left), dtype=bool)
    level = levels[0]
    while len(level):
        kept[level] = True
        inner = level[~leaf[level]]
        level = np.concatenate([left[inner], right[inner]])
    return kept, leaf


def _cut(spark: SparkSession, stored: str, nodes: DataFrame, links: tuple[np.ndarray, ...], depth: int) -> DecisionTreeClassificationModel:
    left, right, prediction = links
    kept, leaf = upper_part(left, right, prediction, depth)
    place = np.cumsum(kept) - 1
    at = np.flatnonzero(kept)
    new = [np.where(leaf[at], -1, place[child[at]]) for child in (left, right)]
    rows = list(zip(at.tolist(), place[at].tolist(), new[0].tolist(), new[1].tolist()))
    table = spark.createDataFrame(rows, "id int, _id int, _left int, _right int")
    ends = F.col("_left") < 0
    no_split = F.struct(F.lit(-1).alias("featureIndex"), F.array().cast("array<double>").alias("leftCategoriesOrThreshold"), F.lit(-1).alias("numCategories"))
    changed = {
        "id": F.col("_id"), "leftChild": F.col("_left"), "rightChild": F.col("_right"),
        "gain": F.when(ends, -1.0).otherwise(F.col("gain")), "split": F.when(ends, no_split).otherwise(F.col("split")),
    }
    path = scratch_path(spark, "tree")
    nodes.join(table, "id").select(*[changed.get(c, F.col(c)).alias(c) for c in nodes.columns]).write.parquet(f"{path}/data")
    about = json.loads(spark.read.text(f"{stored}/metadata").first()[0])
    about["paramMap"]["maxDepth"] = depth
    spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    return DecisionTreeClassificationModel.load(path)


def of_depths(spark: SparkSession, model: Model, depths: Sequence[int]) -> list[Model]:
    """The models a fit with each of ``depths`` gives, none deeper than the one at hand; through its stored form."""
    if isinstance(model, OneVsRestModel):
        by_class = zip(*[of_depths(spark, m, depths) for m in model.models])
        return [model._copyValues(OneVsRestModel(models=list(models))) for models in by_class]
    if any(d > model.getMaxDepth() for d in depths):
        raise ValueError(f"a tree of depth {model.getMaxDepth()} has no part of depth {max(depths)}")
    less = [d for d in dict.fromkeys(depths) if d < model.depth]
    made: dict[int, Model] = {}
    if less:
        stored = scratch_path(spark, "tree")
        model.write().save(stored)
        nodes = spark.read.parquet(f"{stored}/data")
        # as many rows as the model has nodes, all of which the driver holds already
        rows = nodes.select("id", "leftChild", "rightChild", "prediction").orderBy("id").collect()
        links = tuple(np.array([r[c] for r in rows]) for c in ("leftChild", "rightChild", "prediction"))
        made = {d: _cut(spark, stored, nodes, links, d) for d in less}
    return [made.get(d, model) for d in depths]
