"""Array and vector expressions."""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

# Centres travel inside the task closure, so their total size is bounded.
MAX_CENTRE_VALUES = 4_000_000


def doubles(column: Column | str) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return column.cast("array<double>")


def as_vector(column: Column | str) -> Column:
    return array_to_vector(doubles(column))


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x * x))


def euclidean(a: Column, b: Column) -> Column:
    """Euclidean distance of two equally long array columns."""
    squares = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda s, x: s + x))


def sparse_entries(df: DataFrame, vector: str, *keep: str) -> DataFrame:
    """Long form of a sparse vector column: the kept columns plus ``index`` and ``value``."""
    parts = df.select(*keep, F.unwrap_udt(vector).alias("_v"))
    pairs = F.arrays_zip(F.col("_v.indices").alias("index"), F.col("_v.values").alias("value"))
    return parts.select(*keep, F.explode(pairs).alias("_e")).select(*keep, "_e.index", "_e.value")


def matrix_of(arrays: pa.Array) -> np.ndarray:
    """Rows of an Arrow list column as a two-dimensional float64 array."""
    flat = arrays.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(len(arrays), -1) if len(arrays) else flat.reshape(0, 0)


def nearest_centre(column: Column | str, centres: Sequence[Sequence[float]], ids: Sequence[int] | None = None) -> Column:
    """Struct (cluster, distance) of the closest centre; ties go to the first centre listed.

    Each centre in turn is compared with all rows of an Arrow batch, so the cost per
    row grows with the number of centres.  Distances are compared after rounding
    to nine places, which makes the choice independent of summation order.
    """
    table = np.asarray(centres, dtype=np.float64)
    if table.size > MAX_CENTRE_VALUES:
        raise ValueError(f"{table.size} centre values are more than a task closure should carry")
    names = np.asarray(range(len(table)) if ids is None else ids, dtype=np.int32)

    @F.arrow_udf("struct<cluster:int,distance:double>")
    def assign(rows: pa.Array) -> pa.Array:
        points = matrix_of(rows)
        if not len(points):
            return pa.StructArray.from_arrays([pa.array([], pa.int32()), pa.array([], pa.float64())], ["cluster", "distance"])
        best = np.full(len(points), np.inf)
        owner = np.zeros(len(points), dtype=np.int32)
        for name, centre in zip(names, table):
            distance = np.sqrt(((points - centre) ** 2).sum(axis=1))
            closer = np.round(distance, 9) < np.round(best, 9)
            best[closer] = distance[closer]
            owner[closer] = name
        return pa.StructArray.from_arrays([pa.array(owner), pa.array(best)], ["cluster", "distance"])

    return assign(doubles(column))


# functions of this module travel with the job, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
