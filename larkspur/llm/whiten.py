"""Whitening of embeddings by a bidiagonal qd solver.

Vectors become integers, floor(64 c) + 1,000,000.  The fit list holds each distinct integer vector once; its size n and sums S are
exact.  Then:

1. Blockwise QR: every task centres its rows as (n x - S) / n, exact but for one rounding, and reduces block after block to one
   triangle R.  Triangles of the tasks are joined ``FAN`` at a time, so that no task sees more than that many, until one is left.
2. R (d x d) is made bidiagonal by Householder reflections, the right ones kept.
3. dqds, the shifted quotient-difference iteration, gives all singular values to high relative accuracy, the small ones too.
4. A twisted factorisation of L D L^T - e I for each of the first values gives its direction: the stationary transform from the top
   and the progressive one from the bottom meet where the pivot is smallest.  Directions of values that lie close together
   are solved again from different starts and made orthogonal to each other.
5. Whitened rows are projections over the square root of the eigenvalue; their covariance is measured in a second pass.

All that is collected is of size d x d or less.

Edge cases: null vectors and vectors with null or non-finite entries are dropped; a vector without entries is dropped too; shorter vectors
are filled up with entries 0 (1,000,000 as integer); repeated rows and rows with a null id are returned each; components are at most
min(16, d); a component whose eigenvalue vanishes against the largest one (``NOTHING``) has no whitened value (null) and takes no part in the
identity error; ``explained`` is null where the trace is zero; a deviation beyond 64 bits is null; entries that are too large for exact sums
in 64 bits are an error; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from larkspur.llm.tables import cut

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
FAN = 16  # triangles that one task joins
ROWS = 4096  # rows reduced at once
NOTHING = 1e-13  # share of the largest eigenvalue that counts as zero
CLOSE = 1e-3  # relative gap under which directions are made orthogonal
RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
LARGEST = 2**63 - 1


# --- the table ---------------------------------------------------------------


def integers(table: DataFrame, column: str = "embedding", key: str = "vec_id") -> DataFrame:
    """(vec_id, x): usable vectors as longs."""
    whole = F.transform(column, lambda c: F.floor(F.lit(float(SCALE)) * c.cast("double")) + SHIFT)
    unusable = F.exists(column, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    rows = table.where(F.col(column).isNotNull() & (F.size(column) > 0) & ~unusable)
    large = F.exists(column, lambda c: F.abs(c.cast("double")) > 1e12)
    rows = rows.select(F.col(key).cast("long").alias("vec_id"), F.when(large, F.raise_error("an entry is too large for exact sums")).otherwise(whole).alias("x"))
    return rows.withColumn("x", F.col("x").cast("array<long>"))


def filled(rows: DataFrame, d: int) -> DataFrame:
    """Shorter vectors with entries 0 at their end."""
    short = F.concat("x", F.array_repeat(F.lit(SHIFT).cast("long"), F.lit(d) - F.size("x")))
    return rows.withColumn("x", F.when(F.size("x") < d, short).otherwise(F.col("x")))


def matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - S / n, by an exact difference and one rounding."""
    return (n * x - sums) / n


def moments(fit: DataFrame, d: int) -> tuple[int, np.ndarray]:
    """Rows and exact sums of the fit list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros(d, np.int64), 0
        for batch in batches:
            total += matrix(batch["x"], d).sum(axis=0)
            count += len(batch)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d + 1, dtype=np.int32)), pa.array(np.r_[total, count])], ["cell", "value"])

    cells = {r.cell: r.value for r in fit.select("x").mapInArrow(run, "cell int, value long").groupBy("cell").agg(F.sum("value").alias("value")).collect()}  # d + 1 rows
    if cells[d] * max(map(abs, cells.values())) > LARGEST:
        raise OverflowError("n times the sums of the table need more than 64 bits")
    return cells[d], np.array([cells[k] for k in range(d)], np.int64)


# --- triangles ---------------------------------------------------------------


def stacked(triangles: list[np.ndarray]) -> np.ndarray:
    """The triangle of rows of triangles."""
    return np.linalg.qr(np.vstack(triangles), mode="r")


def triangle(fit: DataFrame, d: int, n: int, sums: np.ndarray) -> np.ndarray:
    """R of the centred fit list, d x d."""

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, d))
        for batch in batches:
            x = matrix(batch["x"], d)
            for a in range(0, len(x), ROWS):
                r = stacked([r, centred(x[a : a + ROWS], n, sums)])
        if len(r):
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([r.tobytes()], pa.binary())], ["node", "r"])

    def join(table: pa.Table) -> pa.Table:
        r = stacked([np.frombuffer(b.as_buffer()).reshape(-1, d) for b in table["r"].combine_chunks()])
        return pa.table({"node": pa.array([table["node"][0].as_py() // FAN], pa.int64()), "r": pa.array([r.tobytes()], pa.binary())})

    level = cut(fit.select("x").mapInArrow(reduce, "node long, r binary"))
    while level.count() > 1:
        level = cut(level.groupBy(F.floor(F.col("node") / FAN)).applyInArrow(join, "node long, r binary"))
    r = np.frombuffer(level.first().r).reshape(-1, d)
    return np.vstack([r, np.zeros((d - len(r), d))])


# --- the small problem -------------------------------------------------------


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal and upper diagonal of B with R = U B W^T, and W."""
    a, d = r.astype(float).copy(), len(r)
    w = np.eye(d)

    def reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
        v, size = x.copy(), np.linalg.norm(x)
        if size == 0:
            return v, 0.0
        v[0] += math.copysign(size, x[0])
        return v, 2.0 / float(v @ v)

    for k in range(d):
        v, beta = reflector(a[k:, k])
        a[k:, k:] -= beta * np.outer(v, v @ a[k:, k:])
        if k < d - 2:
            v, beta = reflector(a[k, k + 1 :])
            a[k:, k + 1 :] -= beta * np.outer(a[k:, k + 1 :] @ v, v)
            w[:, k + 1 :] -= beta * np.outer(w[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), w


def squared_singular_values(diagonal: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """Squares of the singular values of a bidiagonal matrix, descending, by dqds with deflation."""
    out: list[float] = []
    stack = [(np.square(diagonal).tolist(), np.square(upper).tolist(), 0.0)]
    tiny = np.finfo(float).eps ** 2
    while stack:
        q, e, shift = stack.pop()
        rounds = 0
        while q:
            cuts = [k for k, x in enumerate(e) if x <= tiny * (q[k] + q[k + 1] + shift)]
            if cuts:
                k = cuts[-1]
                stack.append((q[: k + 1], e[:k], shift))
                q, e, rounds = q[k + 1 :], e[k + 1 :], 0
                continue
            if len(q) == 1:
                out.append(q[0] + shift)
                break
            if len(q) == 2:
                # the smaller value of a 2 x 2 block as product over sum, which cancels nothing
                half = (q[0] + q[1] + e[0]) / 2
                larger = half + math.sqrt(max(half * half - q[0] * q[1], 0.0))
                out += [larger + shift, (q[0] * (q[1] / larger) if larger else 0.0) + shift]
                break
            if q[0] * 1.5 < q[-1]:  # small values belong at the end
                q, e = _flipped(q, e)
            q, e, step = _dqds_step(q, e, 0.0 if rounds < 2 else _lower_bound(q, e))
            shift += step
            rounds += 1
            if rounds > 60 * len(q) + 200:
                raise ArithmeticError("dqds does not converge")
    return np.sort(np.array(out))[::-1]


def _flipped(q: list[float], e: list[float]) -> tuple[list[float], list[float]]:
    """The matrix read from its end: the same singular values."""
    return q[::-1], e[::-1]


def _lower_bound(q: list[float], e: list[float]) -> float:
    """A guess below the smallest eigenvalue of B^T B: the smaller one of its last 2 x 2 block, as determinant over the larger one."""
    above = e[-2]
    trace, determinant = q[-2] + above + q[-1] + e[-1], q[-2] * q[-1] + above * (q[-1] + e[-1])
    larger = (trace + math.sqrt(max(trace * trace - 4 * determinant, 0.0))) / 2
    return 0.98 * determinant / larger if larger else 0.0


def _dqds_step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float]:
    """One transform; a shift beyond the smallest value turns a pivot negative and is tried again smaller, at last as zero."""
    while True:
        d, new_q, new_e = q[0] - shift, [], []
        for k in range(len(e)):
            pivot = d + e[k]
            if d < 0 or pivot <= 0:
                break
            ratio = q[k + 1] / pivot
            new_q.append(pivot)
            new_e.append(e[k] * ratio)
            d = d * ratio - shift
        else:
            if d >= 0:
                return [*new_q, d], new_e, shift
        if shift == 0.0:  # a zero pivot: the value zero itself
            return [*(x if x > 0 else 0.0 for x in q)], [x if q[k] > 0 else 0.0 for k, x in enumerate(e)], 0.0
        shift = shift / 4 if shift > 1e-300 and shift > 1e-16 * q[-1] else 0.0


def twisted(diagonal: np.ndarray, upper: np.ndarray, value: float, start: np.ndarray | None = None) -> np.ndarray:
    """A unit vector z with (B^T B - value) z close to zero.

    B^T B = L D L^T with D = diagonal^2 and L = upper / diagonal.  Without ``start`` the equations are solved for
    the unit vector at the twist; with it, for ``start``.
    """
    n = len(diagonal)
    floor = np.finfo(float).tiny ** 0.5
    safe = np.where(np.abs(diagonal) < floor, floor, diagonal)
    d, ell = safe * safe, np.append(upper / safe[:-1], 0.0)
    nudge = np.finfo(float).eps * max(float(d.max()), float(np.square(upper).max(initial=0.0)), floor)
    plus_d, plus_l, s = np.zeros(n), np.zeros(n), np.zeros(n)
    s[0] = -value
    for k in range(n - 1):
        plus_d[k] = s[k] + d[k] or nudge
        plus_l[k] = d[k] * ell[k] / plus_d[k]
        s[k + 1] = plus_l[k] * ell[k] * s[k] - value
    plus_d[-1] = s[-1] + d[-1]
    minus_u, p = np.zeros(n), np.zeros(n)
    p[-1] = d[-1] - value
    for k in range(n - 2, -1, -1):
        pivot = d[k] * ell[k] ** 2 + p[k + 1] or nudge
        ratio = d[k] / pivot
        minus_u[k] = ell[k] * ratio
        p[k] = p[k + 1] * ratio - value
    gamma = s + p + value
    if start is None:
        r = int(np.argmin(np.where(np.isfinite(gamma), np.abs(gamma), np.inf)))
        z = np.zeros(n)
        z[r] = 1.0
        for k in range(r - 1, -1, -1):
            z[k] = -plus_l[k] * z[k + 1]
        for k in range(r, n - 1):
            z[k + 1] = -minus_u[k] * z[k]
    else:
        z = start.copy()  # L+ D+ L+^T z = start
        for k in range(1, n):
            z[k] -= plus_l[k - 1] * z[k - 1]
        z /= np.where(np.abs(plus_d) < nudge, nudge, plus_d)
        for k in range(n - 2, -1, -1):
            z[k] -= plus_l[k] * z[k + 1]
    if not np.isfinite(z).all():
        z = np.nan_to_num(z, nan=0.0, posinf=1.0, neginf=-1.0)
    z = z / (np.abs(z).max() or 1.0)
    return z / (np.linalg.norm(z) or 1.0)


def blocks(diagonal: np.ndarray, upper: np.ndarray) -> list[slice]:
    """Parts between negligible upper entries; within a part all singular values differ, if by little."""
    small = np.abs(upper) <= 8 * np.finfo(float).eps * (np.abs(diagonal[:-1]) + np.abs(diagonal[1:]))
    edges = [0, *(np.flatnonzero(small) + 1).tolist(), len(diagonal)]
    return [slice(a, b) for a, b in zip(edges[:-1], edges[1:])]


def directions(diagonal: np.ndarray, upper: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Columns: right singular directions of one part for its squared values, descending."""
    n = len(diagonal)
    out, draw = np.zeros((n, len(values))), np.random.default_rng(0)
    first = 0  # of the values that lie close together
    for k, value in enumerate(values):
        if k and values[k - 1] - value > CLOSE * values[k - 1]:
            first = k
        near = out[:, first:k]
        z = twisted(diagonal, upper, value)
        for _ in range(6):
            apart = z - near @ (near.T @ z)
            apart -= near @ (near.T @ apart)
            size = np.linalg.norm(apart)
            if size > 0.5:
                break
            start = draw.normal(size=n)
            z = twisted(diagonal, upper, value, start - near @ (near.T @ start))
        out[:, k] = apart / (size or 1.0)
    return out


def principal(r: np.ndarray, n: int, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray, float]:
    """Eigenvalues of R^T R / n, descending, their eigenvectors as columns (the first ``most`` of both), and the trace."""
    diagonal, upper, w = bidiagonal(r)
    parts = [(part, squared_singular_values(diagonal[part], upper[part.start : part.stop - 1])) for part in blocks(diagonal, upper)]
    ranked = sorted(((v, -k, -i) for k, (_, found) in enumerate(parts) for i, v in enumerate(found)), reverse=True)[:most]
    columns = {k: directions(diagonal[part], upper[part.start : part.stop - 1], found[: sum(-c == k for _, c, _ in ranked)]) for k, (part, found) in enumerate(parts)}
    values, vectors = np.array([v for v, _, _ in ranked]), np.zeros((len(r), len(ranked)))
    for at, (_, k, i) in enumerate(ranked):
        vectors[parts[-k][0], at] = columns[-k][:, -i]
    vectors = w @ vectors
    # reflections and twists leave errors of some units in the last place; one more orthogonalisation takes them out
    vectors = np.linalg.qr(vectors)[0]
    return values / n, vectors, float(np.square(r).sum()) / n


# --- rows --------------------------------------------------------------------


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> pa.Array:
    """Sum over the dimensions of (n x - S)^2, exact; null beyond 64 bits."""
    gap = n * x - sums
    rough = np.square(gap.astype(float)).sum(axis=1)
    if rough.max(initial=0.0) < 0.99 * LARGEST:
        return pa.array((gap * gap).sum(axis=1))
    exact = [sum(v * v for v in row) for row in gap.tolist()]
    return pa.array([v if v <= LARGEST else None for v in exact], pa.int64())


def whiten(table: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Whitened components of every usable row: (vec_id, component, n, deviation, whitened, explained, identity_error)."""
    spark = table.sparkSession
    rows = integers(table)
    d = rows.agg(F.max(F.size("x"))).first()[0]
    if not d:
        return spark.createDataFrame([], RESULT)
    rows = filled(rows, d)
    fit = cut(rows.select("x").distinct())
    n, sums = moments(fit, d)
    values, vectors, trace = principal(triangle(fit, d, n, sums), n, components)
    some = values > NOTHING * values[0]
    axes = vectors / np.sqrt(np.where(some, values, np.inf))
    k = len(values)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            w = centred(matrix(batch["x"], d), n, sums) @ axes
            total += np.vstack([w.T @ w, w.sum(axis=0)])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size, dtype=np.int32)), pa.array(total.ravel())], ["cell", "value"])

    cells = fit.select("x").mapInArrow(products, "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value")).collect()  # k (k + 1) rows
    total = np.zeros(k * (k + 1))
    for cell in cells:
        total[cell.cell] = cell.value
    total = total.reshape(k + 1, k) / n
    gap = np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k))[np.ix_(some, some)]
    error = float(gap.max(initial=0.0))
    explained = [float(v / trace) if trace else None for v in values]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, m = matrix(batch["x"], d), len(batch)
            w = centred(x, n, sums) @ axes
            whitened = pa.array(w.ravel(), mask=np.tile(~some, m))
            each = np.repeat(np.arange(m), k)
            yield pa.RecordBatch.from_arrays([
                batch["vec_id"].take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n, np.int64)),
                deviations(x, n, sums).take(pa.array(each)), whitened, pa.array(explained * m, pa.float64()), pa.array(np.full(m * k, error)),
            ], ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(project, RESULT)
