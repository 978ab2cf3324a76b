"""K-means for several numbers of clusters in shared passes over the rows.

The method is the library's: a start by k-means|| with two rounds of draws, weighted k-means++ on the candidates, then Lloyd's
iterations, each with its draws (the same generator and seeds) and its stops.  The library makes every pass once for each k, row by
row, over a copy of the rows for each fit; here a pass serves all k, and the distances of a tile of rows come from one product with
the centres.  Rows and centres are taken less an origin near the mean of the rows, so products keep the places that tell centres apart, and each
row's distance to the centre it got is taken from their difference.  Centres equal the library's but for rounding; where a row is just as
far from two centres, rounding decides, here and there.
"""

from __future__ import annotations

import struct
import sys
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F, types as T

#: Products of a tile of rows with the centres of a fit, which should stay in a core's own cache.
TILE_VALUES = 1 << 16
#: Rounds of draws of the start, iterations of k-means++ on its candidates, groups that partial sums are added in.
ROUNDS, LOCAL_ITERATIONS, GROUPS = 2, 30, 16
#: Bytes of a block of rows, of which an Arrow batch holds 10,000, and the rows that are worked on at once.
BLOCK_BYTES, BATCH_ROWS = 1536, 8192

U = np.uint64


# --- draws: the generators of the library and of Java -------------------------------------------


def _murmur(data: bytes, seed: int) -> int:
    h, m = seed, 0xFFFFFFFF
    for (k,) in struct.iter_unpack("<I", data):
        k = k * 0xCC9E2D51 & m
        h ^= (k << 15 | k >> 17) * 0x1B873593 & m
        h = ((h << 13 | h >> 19) & m) * 5 + 0xE6546B64 & m
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & m
    h = (h ^ h >> 13) * 0xC2B2AE35 & m
    return h ^ h >> 16


def _step(states: np.ndarray) -> np.ndarray:
    states = states ^ (states << U(21))
    states = states ^ (states >> U(35))
    return states ^ (states << U(4))


class _Jump:
    """A linear map of 64 bits, by tables for each byte."""

    def __init__(self, columns: np.ndarray) -> None:
        self.columns = columns
        self.tables = np.zeros((8, 256), U)
        for byte in range(8):
            for bit in range(8):
                self.tables[byte, 1 << bit : 2 << bit] = self.tables[byte, : 1 << bit] ^ columns[8 * byte + bit]

    def __call__(self, states: np.ndarray) -> np.ndarray:
        out = np.zeros(len(states), U)
        for byte in range(8):
            out ^= self.tables[byte][(states >> U(8 * byte)) & U(255)]
        return out

    def twice(self) -> _Jump:
        return _Jump(self(self.columns))


class Draws:
    """The library's generator of random numbers, many at a time."""

    def __init__(self, seed: int) -> None:
        data = struct.pack(">q", seed)
        low = _murmur(data, 0x3C074A61)
        self.state = np.array([_murmur(data, low) << 32 | low], U)
        self.jumps = [_Jump(_step(U(1) << np.arange(64, dtype=U)))]

    def _next(self, n: int) -> np.ndarray:
        if not n:
            return np.empty(0, U)
        states, at = self.jumps[0](self.state), 0
        while len(states) < n:
            if at == len(self.jumps):
                self.jumps.append(self.jumps[-1].twice())
            states, at = np.concatenate([states, self.jumps[at](states)]), at + 1
        self.state = states[n - 1 : n]
        return states[:n]

    def integer(self) -> int:
        return int(self._next(1)[0].astype(np.uint32).astype(np.int32))

    def doubles(self, n: int) -> np.ndarray:
        states = self._next(2 * n)
        high, low = states[::2] & U((1 << 26) - 1), states[1::2] & U((1 << 27) - 1)
        # the library's next(27) has its 27 bits as they are: all are below the sign
        return ((high << U(27)) + low).astype(np.float64) * 2.0**-53


class JavaRandom:
    """java.util.Random."""

    def __init__(self, seed: int) -> None:
        self.state = (seed ^ 0x5DEECE66D) & ((1 << 48) - 1)

    def _next(self, bits: int) -> int:
        self.state = (self.state * 0x5DEECE66D + 0xB) & ((1 << 48) - 1)
        return self.state >> (48 - bits)

    def double(self) -> float:
        high = self._next(26)
        return ((high << 27) + self._next(27)) * 2.0**-53

    def below(self, bound: int) -> int:
        bits = self._next(31)
        if bound & (bound - 1) == 0:
            return bound * bits >> 31
        while bits - bits % bound + bound - 1 >= 1 << 31:
            bits = self._next(31)
        return bits % bound


# --- distances ------------------------------------------------------------------------------------


def extended(x: np.ndarray) -> np.ndarray:
    """Rows with a one behind, whose product with centres and their squares leaves out the row's own square alone."""
    return np.concatenate([x, np.ones((len(x), 1))], axis=1)


def owners(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The closest centre of each extended row, the first one on ties."""
    table = np.concatenate([-2 * centres, (centres * centres).sum(axis=1)[:, None]], axis=1).T
    at = np.empty(len(rows), np.intp)
    tile = max(1, TILE_VALUES // len(centres))
    for s in range(0, len(rows), tile):
        (rows[s : s + tile] @ table).argmin(axis=1, out=at[s : s + tile])
    return at


def squares(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distance of each extended row to its closest centre, none for the row itself."""
    apart = rows[:, :-1] - centres[owners(rows, centres)]
    return (apart * apart) @ np.ones(apart.shape[1])


def _squares_to_prefixes(rows: np.ndarray, first: np.ndarray, groups: Sequence[np.ndarray]) -> Iterator[np.ndarray]:
    """Squared distance to the first centre and the groups up to each."""
    least = squares(rows, first)
    for group in groups:
        if len(group):
            least = np.minimum(least, squares(rows, group))
        yield least


# --- passes over the rows ---------------------------------------------------------------------------


def _pack(df: DataFrame, features: str, label: str | None) -> DataFrame:
    """(part, at, n, x, labels): the rows in blocks of a few, their numbers as bytes, which is what a pass hands to Python at once.

    ``part`` and ``at`` are the partition and the place in it of the first row.
    """
    kind = df.schema[label].dataType if label else T.NullType()
    schema = T.StructType([T.StructField(c, t) for c, t in (("part", T.IntegerType()), ("at", T.LongType()), ("n", T.IntegerType()), ("x", T.BinaryType()))])
    if label:
        schema.add("labels", T.ArrayType(kind))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = 0
        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            x = batch["x"].flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)
            size = max(1, BLOCK_BYTES // (8 * x.shape[1]))
            starts = np.arange(0, rows, size)
            ends = np.append(starts[1:], rows)
            part = np.full(len(starts), batch["part"][0].as_py(), np.int32)
            columns = [pa.array(part), pa.array(starts + before), pa.array((ends - starts).astype(np.int32)), pa.array([x[s:e].tobytes() for s, e in zip(starts, ends)], pa.binary())]
            if label:
                columns.append(pa.ListArray.from_arrays(pa.array(np.append(starts, rows).astype(np.int32)), batch["label"]))
            yield pa.RecordBatch.from_arrays(columns, schema.names)
            before += rows

    rows = df.select(F.spark_partition_id().alias("part"), vector_to_array(features).alias("x"), *([F.col(label).alias("label")] if label else []))
    return rows.mapInArrow(blocks, schema)


@contextmanager
def packed(df: DataFrame, features: str, label: str | None = None) -> Iterator[DataFrame]:
    """The rows as the passes of this module read them, cached; spread over the cores where they come in fewer tasks."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    data = _pack(df.repartition(cores) if df.rdd.getNumPartitions() < cores else df, features, label).cache()
    try:
        yield data
    finally:
        data.unpersist()


def _rows(batches: Iterator[pa.RecordBatch], shift: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, pa.Array | None]]:
    """(partition, place of the first row, rows less the shift and extended, labels) for some thousand rows at a time."""
    for batch in batches:
        if not batch.num_rows:
            continue
        part, first = batch["part"][0].as_py(), batch["at"][0].as_py()
        x = np.frombuffer(b"".join(batch["x"].to_pylist()), np.float64).reshape(-1, len(shift))
        labels = batch["labels"].flatten() if "labels" in batch.schema.names else None
        for s in range(0, len(x), BATCH_ROWS):
            yield part, first + s, extended(x[s : s + BATCH_ROWS] - shift), None if labels is None else labels[s : s + BATCH_ROWS]


def _summed(data: DataFrame, shift: np.ndarray, size: int, part_sums: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all rows of what ``part_sums`` gives for some of them, ``size`` numbers."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, part = np.zeros(size), None
        for part, _, x, _ in _rows(batches, shift):
            out += part_sums(x)
        if part is not None:
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([out.tobytes()], pa.binary())], ["part", "sums"])

    def add(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        sums = np.sum([np.frombuffer(b, np.float64) for b in table["sums"].to_pylist()], axis=0)
        return pa.table({"part": table["part"][:1], "sums": pa.array([sums.tobytes()], pa.binary())})

    schema = "part int, sums binary"
    partial = data.select("part", "at", "x").mapInArrow(count, schema)
    if data.rdd.getNumPartitions() > GROUPS:
        partial = partial.groupBy(F.pmod("part", F.lit(GROUPS))).applyInArrow(add, schema)
    # one row for each group
    found = sorted(partial.collect(), key=lambda r: r["part"])
    return np.sum([np.frombuffer(bytes(r["sums"]), np.float64) for r in found], axis=0) if found else np.zeros(size)


def _drawn(data: DataFrame, shift: np.ndarray, seed: int, chosen: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> list[tuple[set[int], list[float]]]:
    """Rows that ``chosen`` takes, given rows and a draw for each, as (fits that take them, row), in the order of the rows."""

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        draws = None
        for part, first, x, _ in _rows(batches, shift):
            draws = draws or Draws(seed ^ part)
            takes = chosen(x, draws.doubles(len(x)))
            at = np.flatnonzero(takes.any(axis=1))
            if len(at):
                fits = pa.array([np.flatnonzero(t).tolist() for t in takes[at]], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), part, np.int32)), pa.array(at + first), fits, pa.array(list(x[at, :-1]), pa.list_(pa.float64()))], ["part", "at", "fits", "x"]
                )

    # some 2 k rows in each round, as the method draws them
    found = data.select("part", "at", "x").mapInArrow(draw, "part int, at long, fits array<int>, x array<double>").collect()
    return [(set(r["fits"]), r["x"]) for r in sorted(found, key=lambda r: (r["part"], r["at"]))]


def origin(data: DataFrame) -> np.ndarray | None:
    """A point near the mean of the rows; none where there are no rows or numbers that are not finite."""
    row = data.select(F.expr("octet_length(x) div (8 * n)").alias("width"), "x").first()
    if row is None:
        return None
    width = row["width"]
    near = np.frombuffer(bytes(row["x"]), np.float64)[:width]
    near = np.where(np.isfinite(near), near, 0.0)

    def moments(x: np.ndarray) -> np.ndarray:
        with np.errstate(all="ignore"):
            return np.concatenate([x.sum(axis=0), (x[:, :-1] ** 2).sum(axis=0)])

    sums = _summed(data, near, 2 * width + 1, moments)
    if not np.isfinite(sums).all():
        return None
    mean, square = sums[:width] / sums[width], sums[width + 1 :] / sums[width]
    # a multiple of a power of two below the spread: whole numbers stay whole, so that equal distances stay equal
    spread = np.sqrt(np.maximum(square - mean * mean, 0.0))
    with np.errstate(divide="ignore"):
        grain = np.where(spread > 0, 2.0 ** np.floor(np.log2(spread)), 0.0)
    mean = mean + near
    return np.where(grain > 0, np.round(mean / np.where(grain > 0, grain, 1.0)) * grain, mean)


# --- the start ----------------------------------------------------------------------------------------


def _distinct(rows: np.ndarray) -> np.ndarray:
    return rows[np.sort(np.unique(rows + 0.0, axis=0, return_index=True)[1])]


def local_centres(points: np.ndarray, weights: np.ndarray, k: int) -> np.ndarray:
    """Weighted k-means++ and Lloyd's iterations on the candidates, with the library's draws."""
    draw = JavaRandom(0)
    mass = np.cumsum(weights)
    chosen = [max(0, min(len(points) - 1, int(np.searchsorted(mass, draw.double() * mass[-1]))))]
    cost = ((points - points[chosen[0]]) ** 2).sum(axis=1)
    for _ in range(1, k):
        score = np.cumsum(weights * cost)
        r = draw.double() * score[-1]
        at = min(len(points) - 1, int(np.searchsorted(score, r))) if r > 0 else 0
        chosen.append(at)
        cost = np.minimum(cost, ((points - points[at]) ** 2).sum(axis=1))
    centres, before = points[chosen].copy(), None
    rows = extended(points)
    for _ in range(LOCAL_ITERATIONS):
        at = owners(rows, centres)
        counts = np.bincount(at, weights, k)
        sums = np.stack([np.bincount(at, weights * column, k) for column in points.T], axis=1)
        for j in range(k):
            centres[j] = sums[j] / counts[j] if counts[j] else points[draw.below(len(points))]
        if before is not None and (at == before).all():
            break
        before = at
    return centres


def _first_row(data: DataFrame, width: int, seed: int) -> np.ndarray:
    """One row by the library's sampling, which looks at the places of rows alone."""
    places = data.select("part", "at", F.explode(F.expr("sequence(0, n - 1)")).alias("i")).select("part", "at", "i")
    found = places._jdf.toJavaRDD().takeSample(False, 1, seed)[0]
    part, at, i = (found.get(c) for c in range(3))
    block = data.where((F.col("part") == part) & (F.col("at") == at)).select("x").first()
    return np.frombuffer(bytes(block["x"]), np.float64).reshape(-1, width)[i : i + 1]


def start(data: DataFrame, ks: Sequence[int], seed: int, shift: np.ndarray) -> list[np.ndarray]:
    """The starting centres for each of ``ks``, which rise; fewer than k where the candidates are fewer."""
    seed = Draws(seed).integer()
    first = _first_row(data, len(shift), seed) - shift
    taken: list[list[np.ndarray]] = [[] for _ in ks]
    number = np.array(ks, np.float64)
    for step in range(ROUNDS):
        # a round with fewer clusters takes some of the rows that one with more takes: rows grouped by the first that has them
        sets = [{tuple(row): None for rows in t for row in rows} for t in taken]
        if all(a.keys() <= b.keys() for a, b in zip(sets, sets[1:])):
            own = [[row for row in b if row not in a] for a, b in zip([{}, *sets], sets)]
            groups = [np.array(rows).reshape(-1, first.shape[1]) for rows in own]
            costs = lambda x: np.stack(list(_squares_to_prefixes(x, first, groups)), axis=1)
        else:
            alone = [np.concatenate([first, *t]) for t in taken]
            costs = lambda x: np.stack([squares(x, c) for c in alone], axis=1)
        sums = _summed(data, shift, len(ks), lambda x: costs(x).sum(axis=0))

        def chosen(x: np.ndarray, draws: np.ndarray) -> np.ndarray:
            with np.errstate(all="ignore"):
                return draws[:, None] < 2.0 * costs(x) * number / sums

        found = _drawn(data, shift, seed ^ (step << 16), chosen)
        for fit, rows in enumerate(taken):
            rows.append(np.array([row for fits, row in found if fit in fits]).reshape(-1, first.shape[1]))
    candidates = [_distinct(np.concatenate([first, *rows])) for rows in taken]
    ends = np.cumsum([len(c) for c in candidates])
    masses = _summed(data, shift, int(ends[-1]), lambda x: np.concatenate([np.bincount(owners(x, c), minlength=len(c)) for c in candidates]).astype(np.float64))
    parts = np.split(masses, ends[:-1])
    return [c if len(c) <= k else local_centres(c, mass, k) for k, c, mass in zip(ks, candidates, parts)]


# --- fits and scores ------------------------------------------------------------------------------------


def fit(data: DataFrame, ks: Sequence[int], max_iter: int, tol: float, seed: int, shift: np.ndarray) -> dict[int, np.ndarray]:
    """The centres for each of ``ks``, as the library's fits end: after ``max_iter`` iterations or when no centre moves by more than ``tol``."""
    order = sorted(set(ks))
    centres = dict(zip(order, start(data, order, seed, shift)))
    moving = list(order)
    for _ in range(max_iter):
        if not moving:
            break
        tables = [centres[k] for k in moving]
        width = len(shift) + 1

        def sums(x: np.ndarray) -> np.ndarray:
            columns = np.ascontiguousarray(x.T)
            at = [owners(x, c) for c in tables]
            return np.concatenate([np.stack([np.bincount(a, column, len(c)) for column in columns], axis=1).ravel() for a, c in zip(at, tables)])

        ends = np.cumsum([len(c) * width for c in tables])
        found = np.split(_summed(data, shift, int(ends[-1]), sums), ends[:-1])
        still = []
        for k, table, total in zip(moving, tables, found):
            total = total.reshape(-1, width)
            held = total[:, -1] > 0
            moved = table.copy()
            moved[held] = total[held, :-1] / total[held, -1:]
            centres[k] = moved
            if (((moved - table) ** 2).sum(axis=1) > tol * tol).any():
                still.append(k)
        moving = still
    return {k: c + shift for k, c in centres.items()}


def mean_distances(data: DataFrame, centres: dict[int, np.ndarray], shift: np.ndarray) -> dict[int, float]:
    """For each k the mean distance of a row to its closest centre."""
    tables = [c - shift for c in centres.values()]
    sums = _summed(data, shift, 1 + len(tables), lambda x: np.array([len(x), *[np.sqrt(squares(x, c)).sum() for c in tables]]))
    return {k: float(s / sums[0]) for k, s in zip(centres, sums[1:])}


def label_counts(data: DataFrame, centres: dict[int, np.ndarray], shift: np.ndarray) -> DataFrame:
    """(k, cluster, label, n) for the clusters of each k."""
    tables = {k: c - shift for k, c in centres.items()}
    kind = data.schema["labels"].dataType.elementType

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, x, labels in _rows(batches, shift):
            coded = labels.dictionary_encode(null_encoding="encode")
            codes, size = coded.indices.to_numpy().astype(np.int64), len(coded.dictionary)
            for k, table in tables.items():
                cells = np.bincount(owners(x, table) * size + codes, minlength=len(table) * size)
                at = np.flatnonzero(cells)
                columns = [pa.array(np.full(len(at), k, np.int32)), pa.array((at // size).astype(np.int32)), coded.dictionary.take(pa.array(at % size)), pa.array(cells[at])]
                yield pa.RecordBatch.from_arrays(columns, ["k", "cluster", "label", "n"])

    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("cluster", T.IntegerType()), T.StructField("label", kind), T.StructField("n", T.LongType())])
    return data.mapInArrow(count, schema).groupBy("k", "cluster", "label").agg(F.sum("n").alias("n"))


def distance_of_rank(data: DataFrame, centres: np.ndarray, shift: np.ndarray, rank: int) -> float | None:
    """The ``rank``-th largest distance of a row to its closest centre, or the smallest there is when rows are fewer."""
    table = centres - shift

    def largest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = np.empty(0)
        for _, _, x, _ in _rows(batches, shift):
            top = np.sort(np.concatenate([top, _distances(x[:, :-1], table, owners(x, table))]))[-rank:]
        yield pa.RecordBatch.from_arrays([pa.array(top)], ["distance"])

    top = data.select("part", "at", "x").mapInArrow(largest, "distance double").orderBy(F.desc("distance")).limit(rank)
    return top.agg(F.min("distance")).first()[0]


def _distances(x: np.ndarray, table: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.sqrt(((x - table[at]) ** 2).sum(axis=1))


def assign(df: DataFrame, centres: np.ndarray, features: str, shift: np.ndarray) -> DataFrame:
    """Add ``cluster`` and ``distance``: the closest centre of a vector column and the distance to it."""
    table = centres - shift

    @F.arrow_udf("struct<cluster:int,distance:double>")
    def place(rows: pa.Array) -> pa.Array:
        if not len(rows):
            return pa.StructArray.from_arrays([pa.array([], pa.int32()), pa.array([], pa.float64())], ["cluster", "distance"])
        x = rows.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1) - shift
        at = owners(extended(x), table)
        return pa.StructArray.from_arrays([pa.array(at.astype(np.int32)), pa.array(_distances(x, table, at))], ["cluster", "distance"])

    return df.withColumn("_n", place(vector_to_array(features))).withColumns({"cluster": F.col("_n.cluster"), "distance": F.col("_n.distance")}).drop("_n")


# functions of this module travel with the job, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
