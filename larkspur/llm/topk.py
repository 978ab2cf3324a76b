"""Exact top-k inner products: vectors by descending length, partial sums in a rotated basis, Cauchy-Schwarz bounds.

Vectors become integers, floor(256 x).  The basis is that of the singular vectors of all vectors (from the sum of their outer products,
d x d numbers), so most of a product lies in its first ``HEAD`` coordinates.  Candidates are dealt into
blocks by descending length.  The block of the longest vectors gives every query a first bound; a pair of a query block and a candidate
block is formed only if the lengths can reach that bound.  In a pair, slabs of candidates are taken by descending length:
a partial product plus the product of the residual lengths bounds a score from above, and
only pairs that can reach the k-th score so far get their exact integer product.

Edge cases: null vectors and vectors with null or non-finite components take no part, and neither do rows with a null id;
shorter vectors count as padded with zeros; a repeated candidate row counts as often as it is there, a repeated query id is answered
once for each row; a query with fewer candidates gets all of them.  Products are 64-bit integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from larkspur.llm.tables import cut

K, EVERY, SCALE = 5, 50, 256
HEAD, BLOCK, QUERY_BLOCK, SLAB = 16, 2048, 512, 256
BLOCKS = "block long, longest double, ids binary, values binary"


def integers(table: DataFrame) -> DataFrame:
    """(vec_id, v, size2): usable vectors as longs, and their squared lengths."""
    whole = F.transform("embedding", lambda x: F.floor(F.lit(SCALE) * x.cast("double")))
    usable = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    rows = table.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & usable)
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v"))
    return rows.withColumn("size2", F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def matrix(column: pa.Array, d: int) -> np.ndarray:
    sizes = column.value_lengths().to_numpy()
    flat = column.flatten().to_numpy()
    if (sizes == d).all():
        return flat.reshape(-1, d).astype(np.int64)
    out = np.zeros((len(sizes), d), np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.concatenate([np.arange(s) for s in sizes])] = flat
    return out


def rotation(vectors: DataFrame, d: int) -> np.ndarray:
    """Singular vectors of all rows, by descending singular value, as columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for batch in batches:
            m = matrix(batch["v"], d).astype(float)
            total += m.T @ m
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d * d, dtype=np.int32)), pa.array(total.ravel())], ["cell", "value"])

    cells = vectors.select("v").mapInArrow(run, "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value")).collect()  # d * d rows
    products = np.zeros(d * d)
    for r in cells:
        products[r.cell] = r.value
    products = products.reshape(d, d)
    return np.linalg.eigh((products + products.T) / 2)[1][:, ::-1].copy()


def blocks(vectors: DataFrame, d: int, most: int, by_length: bool) -> DataFrame:
    """Rows packed into blocks of at most ``most``."""
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = vectors.repartitionByRange(parts, F.desc("size2"), "vec_id").sortWithinPartitions(F.desc("size2"), "vec_id") if by_length else vectors

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for a in range(0, len(batch), most):
                part = batch.slice(a, most)
                m = matrix(part["v"], d)
                longest = float(np.sqrt(max(part["size2"].to_numpy())))
                yield pa.RecordBatch.from_pylist([{"block": number, "longest": longest, "ids": part["vec_id"].to_numpy().tobytes(), "values": m.tobytes()}], BLOCK_SCHEMA)
                number += 1

    return dealt.mapInArrow(run, BLOCKS)


BLOCK_SCHEMA = pa.schema([("block", pa.int64()), ("longest", pa.float64()), ("ids", pa.binary()), ("values", pa.binary())])


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of the rows of a and b."""
    largest = np.abs(a).max(initial=0).astype(float) * np.abs(b).max(initial=0).astype(float) * a.shape[1]
    if largest < 2**52:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    return a @ b.T


def best(queries: np.ndarray, query_ids: np.ndarray, candidates: np.ndarray, ids: np.ndarray, basis: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scores and ids (query, k) of the best candidates that reach the bounds, and which places are filled.

    Candidates come by descending length.  ``bounds`` are scores that k candidates are known to reach.
    """
    q, c = queries @ basis, candidates @ basis
    q_size, c_size = np.linalg.norm(q, axis=1), np.linalg.norm(c, axis=1)
    q_rest, c_rest = np.linalg.norm(q[:, HEAD:], axis=1), np.linalg.norm(c[:, HEAD:], axis=1)
    lowest = np.iinfo(np.int64).min
    top, who = np.full((len(q), k), lowest), np.full((len(q), k), np.iinfo(np.int64).max)
    known = bounds.astype(float)
    for a in range(0, len(c), SLAB):
        b = min(a + SLAB, len(c))
        rounding = 1e-9 * q_size * c_size[a:b].max() + 1e-6
        rows = np.flatnonzero(q_size * c_size[a:b].max() + rounding >= known)
        if not len(rows):
            break
        part = q[rows, :HEAD] @ c[a:b, :HEAD].T + q_rest[rows, None] * c_rest[None, a:b] + rounding[rows, None]
        reach = (part >= known[rows, None]) & (query_ids[rows, None] != ids[None, a:b])
        columns = np.flatnonzero(reach.any(axis=0))
        if not len(columns):
            continue
        score = np.where(reach[:, columns], product(queries[rows], candidates[a:b][columns]), lowest)
        names = np.where(reach[:, columns], ids[a:b][columns][None, :], np.iinfo(np.int64).max)
        score, names = np.hstack([top[rows], score]), np.hstack([who[rows], names])
        order = np.lexsort((names, ~score), axis=1)[:, :k]
        top[rows], who[rows] = np.take_along_axis(score, order, 1), np.take_along_axis(names, order, 1)
        known = np.maximum(known, np.where(top[:, -1] > lowest, top[:, -1].astype(float), -np.inf))
    return top, who, top > lowest


def search(table: DataFrame, k: int = K, every: int = EVERY) -> DataFrame:
    """The k best rows for each row whose id is divisible by ``every``: (query_id, rank, vec_id, score)."""
    spark = table.sparkSession
    vectors = integers(table)
    d = vectors.agg(F.max(F.size("v"))).first()[0]
    schema = "query_id long, rank int, vec_id long, score long"
    if not d:
        return spark.createDataFrame([], schema)
    basis = rotation(vectors, d)
    candidates = cut(blocks(vectors, d, BLOCK, True))
    queries = cut(blocks(vectors.where(F.col("vec_id") % every == 0), d, QUERY_BLOCK, False))
    # one block, BLOCK rows at most
    longest = candidates.orderBy(F.desc("longest"), "block").limit(1).select(F.col("ids").alias("c_ids"), F.col("values").alias("c_values"))

    def unpack(row: dict) -> tuple[np.ndarray, ...]:
        read = lambda name: np.frombuffer(row[name], np.int64)
        return read("values").reshape(-1, d), read("ids"), read("c_values").reshape(-1, d), read("c_ids")

    def first_bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                q, q_ids, c, c_ids = unpack(row)
                top, _, filled = best(q, q_ids, c, c_ids, basis, np.full(len(q), -np.inf), k)
                bounds = np.where(filled[:, -1], top[:, -1].astype(float), -np.inf)
                least = float((bounds / np.maximum(np.linalg.norm(q.astype(float), axis=1), 1e-300)).min())
                yield pa.RecordBatch.from_pylist([{"block": row["block"], "bounds": bounds.tobytes(), "reach": least if bounds.min() > 0 else float("-inf")}], BOUND_SCHEMA)

    bounded = cut(queries.crossJoin(F.broadcast(longest)).mapInArrow(first_bounds, "block long, bounds binary, reach double"))
    # block numbers and lengths alone: which pairs of blocks can hold a result
    pairs = bounded.select(F.col("block").alias("query_block"), "reach").join(
        candidates.select(F.col("block").alias("c_block"), F.col("longest").alias("c_longest")), F.col("c_longest") * (1 + 1e-9) + 1e-6 >= F.col("reach"))
    work = (
        pairs.join(queries.join(bounded, "block").select(F.col("block").alias("query_block"), "ids", "values", "bounds"), "query_block")
        .join(candidates.select(F.col("block").alias("c_block"), F.col("ids").alias("c_ids"), F.col("values").alias("c_values")), "c_block")
        .select("ids", "values", "c_ids", "c_values", "bounds")
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                q, q_ids, c, c_ids = unpack(row)
                top, who, filled = best(q, q_ids, c, c_ids, basis, np.frombuffer(row["bounds"]), k)
                at, _ = np.nonzero(filled)
                yield pa.RecordBatch.from_arrays([pa.array(q_ids[at]), pa.array(who[filled]), pa.array(top[filled])], ["query_id", "vec_id", "score"])

    found = work.mapInArrow(score, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


BOUND_SCHEMA = pa.schema([("block", pa.int64()), ("bounds", pa.binary()), ("reach", pa.float64())])
