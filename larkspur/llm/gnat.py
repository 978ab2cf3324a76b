"""Hard negatives by a multiway hyperplane tree with distance ranges.

Vectors become integers, floor(256 x).  For an anchor its *positives* are the rows of its label with the highest inner products; a hard
negative of a positive is a row of another label whose product lies in a window below the positive's.

1. The tree is fitted on a bounded sample (``SAMPLE`` rows, those with the smallest hash of their id): a node has up to ``FANOUT`` split points
   that lie far apart, and a row goes to the child of the closest one.  Every row of the table is indexed.
2. For each node one aggregate over all rows gives, for every split point and every sibling subtree, the smallest and largest distance between
   them, and the norms in the subtree.  These tables are as large as the tree, which the sample bounds.
3. A window of products is, with the norms of a subtree, an annulus of distances around the anchor.  A subtree is eliminated if, for
   any split point next to it, no distance in its range is possible within the annulus (triangle inequality).  What the sample holds gives
   each anchor a first bound, which narrows its window.
4. Blocks of anchors visit the leaves that remain; leaves are scanned exactly, in blocks of at most ``BLOCK`` rows, and pass on the
   best rows that reach the bound.  Anchors of a block come from the same part of the tree.

Two searches: positives (no upper end), then negatives with one window for each positive.  Elimination leaves a margin for
rounding; products are exact integers.  A hot vector fills many blocks, each with a key of its own.

Edge cases: rows with a null id, label or vector, without components, or with null or non-finite components take no part; shorter vectors are
filled up with zeros; of rows that repeat an id that with the smallest label and vector stands; an anchor with fewer positives or a
positive with fewer negatives gets all of them; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from larkspur.llm.tables import cut, labelled_vectors
from larkspur.llm.topk import product

SCALE, ANCHOR_EVERY, SHIFT_EVERY, LABELS = 256, 100, 7, 10
POSITIVES, NEGATIVES = 5, 5
LOW, HIGH = 80, 100  # percent of the positive's score
SAMPLE, FANOUT, LEAF, LEAF_SAMPLE = 16_384, 8, 1_024, 32
BLOCK, ANCHORS = 4_096, 512
NONE = -(2**62)  # no bound
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def integers(table: DataFrame) -> DataFrame:
    """(vec_id, label, v): rows that take part, labels as the contract shifts them, components as longs."""
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = labelled_vectors(table).where(F.col("label").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & ~bad)
    label = F.when(F.col("vec_id") % SHIFT_EVERY == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    return rows.select("vec_id", label.alias("label"), F.transform("v", lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double"))).alias("v"))


def matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def squares(v: np.ndarray) -> np.ndarray:
    return np.square(v.astype(float)).sum(axis=1)


# --- the tree ----------------------------------------------------------------


@dataclass
class Tree:
    """Split points of all nodes, one node after the other, parents first.  ``child`` is a node, or -1 - leaf."""

    points: np.ndarray
    first: np.ndarray  # of each node; one more entry than nodes
    child: np.ndarray
    leaves: int

    def __post_init__(self) -> None:
        self.size2 = squares(self.points)

    def distances(self, v: np.ndarray) -> np.ndarray:
        """Squared distances to all split points."""
        return np.maximum(squares(v)[:, None] + self.size2[None, :] - 2 * product(v, self.points).astype(float), 0)

    def descend(self, d2: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Node by node: its rows, and the child (0, 1, ...) of each."""
        rows = {0: np.arange(len(d2))}
        for node in range(len(self.first) - 1):
            mine = rows.pop(node, None)
            if mine is None:
                continue
            a, b = self.first[node], self.first[node + 1]
            nearest = d2[mine, a:b].argmin(axis=1)
            yield node, mine, nearest
            for j in range(b - a):
                if self.child[a + j] >= 0:
                    rows[int(self.child[a + j])] = mine[nearest == j]

    def leaf_of(self, d2: np.ndarray) -> np.ndarray:
        out = np.zeros(len(d2), np.int64)
        for node, rows, nearest in self.descend(d2):
            out[rows] = -1 - self.child[self.first[node] + nearest]
        return out


def fit(v: np.ndarray, total: int, leaf_size: int = LEAF, least: int = LEAF_SAMPLE) -> Tree:
    """A tree over sampled rows that stand for ``total``."""
    weight, draw = total / max(len(v), 1), np.random.default_rng(1)
    points: list[np.ndarray] = []
    first, child, leaves = [0], [], 0
    todo = [(np.arange(len(v)), -1)]  # rows, place of the node's number in child
    while todo:
        rows, place = todo.pop(0)
        chosen: list[int] = []
        if len(rows) * weight > leaf_size and len(rows) >= least:
            some = draw.choice(rows, min(len(rows), 3 * FANOUT), replace=False)
            gap = squares(v[some] - v[some[0]])
            chosen = [int(some[0])]
            while len(chosen) < FANOUT and gap.max() > 0:
                chosen.append(int(some[gap.argmax()]))
                gap = np.minimum(gap, squares(v[some] - v[chosen[-1]]))
        if len(chosen) < 2 and place >= 0:
            child[place] = -1 - leaves
            leaves += 1
            continue
        chosen = chosen or [int(rows[0])]  # a root that needs no split has one point and one leaf
        if place >= 0:
            child[place] = len(first) - 1
        at = v[chosen]
        nearest = (squares(v[rows])[:, None] + squares(at)[None, :] - 2 * product(v[rows], at)).argmin(axis=1)
        for j in range(len(chosen)):
            todo.append((rows[nearest == j], len(child)))
            child.append(0)
            if len(chosen) == 1:
                todo.pop()
                child[-1], leaves = -1 - leaves, leaves + 1
        points.append(at)
        first.append(first[-1] + len(chosen))
    return Tree(np.concatenate(points), np.array(first), np.array(child), leaves)


@dataclass
class Ranges:
    """Distances between the split points of a node and the subtree of each child, and squared norms in that subtree."""

    low: np.ndarray  # (split point, child)
    high: np.ndarray
    size_low: np.ndarray  # (split point as child)
    size_high: np.ndarray


def ranges(indexed: DataFrame, tree: Tree, d: int) -> Ranges:
    """Exact ranges over all rows."""
    n = len(tree.points)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = np.full((n, FANOUT + 1), np.inf), np.full((n, FANOUT + 1), -np.inf)  # the last column: norms
        for batch in batches:
            v = matrix(batch["v"], d)
            d2, size = tree.distances(v), squares(v)
            for node, rows, nearest in tree.descend(d2):
                a, b = tree.first[node], tree.first[node + 1]
                for j in np.unique(nearest).tolist():
                    mine = rows[nearest == j]
                    low[a:b, j] = np.minimum(low[a:b, j], d2[mine, a:b].min(axis=0))
                    high[a:b, j] = np.maximum(high[a:b, j], d2[mine, a:b].max(axis=0))
                    low[a + j, FANOUT] = min(low[a + j, FANOUT], size[mine].min())
                    high[a + j, FANOUT] = max(high[a + j, FANOUT], size[mine].max())
        cells = np.flatnonzero(np.isfinite(low.ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(low.ravel()[cells]), pa.array(high.ravel()[cells])], ["cell", "low", "high"])

    cells = indexed.select("v").mapInArrow(run, "cell long, low double, high double").groupBy("cell").agg(F.min("low").alias("low"), F.max("high").alias("high")).toArrow()  # as large as the tree
    low, high = np.full(n * (FANOUT + 1), np.inf), np.full(n * (FANOUT + 1), -np.inf)
    low[cells["cell"].to_numpy()], high[cells["cell"].to_numpy()] = cells["low"].to_numpy(), cells["high"].to_numpy()
    low, high = low.reshape(n, -1), high.reshape(n, -1)
    return Ranges(np.sqrt(low[:, :FANOUT]), np.sqrt(np.maximum(high[:, :FANOUT], 0)), low[:, FANOUT], high[:, FANOUT])


def reachable(tree: Tree, r: Ranges, v: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """(anchor, leaf): which leaves may hold a row whose product with the anchor lies in one of its windows (anchor, window)."""
    size, near = squares(v), np.sqrt(tree.distances(v))
    out = np.zeros((len(v), tree.leaves), bool)
    alive = {0: low <= high}
    slack = 1e-6 * (1 + np.sqrt(size))[:, None] + 1e-9 * near.max(axis=1, initial=0.0)[:, None]
    for node in range(len(tree.first) - 1):
        open_ = alive.pop(node, None)
        if open_ is None or not open_.any():
            continue
        a, b = tree.first[node], tree.first[node + 1]
        to_points = near[:, None, a:b]
        for j in range(b - a):
            if not np.isfinite(r.size_low[a + j]):
                continue  # no row at all
            outer2 = np.where(low > NONE, size[:, None] + r.size_high[a + j] - 2.0 * low, np.inf)
            inner2 = size[:, None] + r.size_low[a + j] - 2.0 * high
            possible = open_ & (outer2 >= -1e-6)
            inner, outer = (np.sqrt(np.maximum(inner2, 0)) - slack)[:, :, None], (np.sqrt(np.maximum(outer2, 0)) + slack)[:, :, None]
            nearest_point, farthest = np.maximum(inner - to_points, to_points - outer), outer + to_points
            possible &= ((r.high[a:b, j] >= nearest_point) & (r.low[a:b, j] <= farthest)).all(axis=2)
            if tree.child[a + j] < 0:
                out[:, -1 - tree.child[a + j]] = possible.any(axis=1)
            elif possible.any():
                alive[int(tree.child[a + j])] = possible
    return out


# --- searching ------------------------------------------------------------------


@dataclass
class Rows:
    """A block of rows."""

    ids: np.ndarray
    labels: np.ndarray
    v: np.ndarray


def best(owner: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k of each owner: higher scores, then smaller ids."""
    order = np.lexsort((ids, -score, owner))
    own = owner[order]
    new = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(own) else np.zeros(0, int)
    rank = np.arange(len(own)) - np.repeat(new, np.diff(np.r_[new, len(own)]))
    return order[rank < k]


def in_window(anchors: Rows, rows: Rows, low: np.ndarray, high: np.ndarray, other_label: bool, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, window, row, score): the first k rows of each window of each anchor, of its label or of others."""
    score = product(anchors.v, rows.v)
    fits = (anchors.labels[:, None] != rows.labels[None, :]) if other_label else (anchors.labels[:, None] == rows.labels[None, :]) & (anchors.ids[:, None] != rows.ids[None, :])
    parts = []
    for w in range(low.shape[1]):
        i, j = np.nonzero(fits & (score >= low[:, w, None]) & (score <= high[:, w, None]))
        s = score[i, j]
        keep = best(i, s, rows.ids[j], k)
        parts.append((i[keep], np.full(len(keep), w), j[keep], s[keep]))
    return tuple(np.concatenate(x) for x in zip(*parts))


def first_bounds(anchors: Rows, sample: Rows, low: np.ndarray, high: np.ndarray, other_label: bool, k: int) -> np.ndarray:
    """The windows' lower ends raised to the k-th best score that the sample has in them."""
    held: tuple[np.ndarray, ...] = (np.zeros(0, int), np.zeros(0, int), np.zeros(0, np.int64), np.zeros(0, np.int64))  # anchor, window, id, score
    for a in range(0, len(sample.ids), BLOCK):
        part = Rows(sample.ids[a : a + BLOCK], sample.labels[a : a + BLOCK], sample.v[a : a + BLOCK])
        i, w, j, s = in_window(anchors, part, low, high, other_label, k)
        held = tuple(np.concatenate(x) for x in zip(held, (i, w, part.ids[j], s)))
        keep = best(held[0] * low.shape[1] + held[1], held[3], held[2], k)
        held = tuple(x[keep] for x in held)
    out = low.copy()
    owner = held[0] * low.shape[1] + held[1]
    full = np.bincount(owner, minlength=low.size) >= k
    worst = np.full(low.size, np.iinfo(np.int64).max)
    np.minimum.at(worst, owner, held[3])
    out.ravel()[full] = np.maximum(out.ravel()[full], worst[full])
    return out


class Index:
    """The table in blocks of leaves, and the tree over it."""

    def __init__(self, table: DataFrame, leaf_size: int = LEAF, sample: int = SAMPLE):
        rows = integers(table)
        facts = rows.agg(F.max(F.size("v")), F.count("*"), F.max(F.array_max(F.transform("v", lambda x: F.abs(x))))).first()
        self.d, self.total = facts[0], facts[1]
        if not self.total:
            return
        d = self.d
        self.dtype = np.dtype(np.int16 if facts[2] < 2**15 else np.int32 if facts[2] < 2**31 else np.int64)
        full = F.concat("v", F.array_repeat(F.lit(0).cast("long"), F.lit(d) - F.size("v")))
        rows = rows.withColumn("v", F.when(F.size("v") < d, full).otherwise(F.col("v")))
        some = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).toArrow()  # at most ``sample`` rows
        self.sample = Rows(some["vec_id"].to_numpy(), some["label"].to_numpy(), matrix(some["v"].combine_chunks(), d).astype(self.dtype))
        self.tree = tree = fit(self.sample.v.astype(np.int64), self.total, leaf_size)

        def leaf(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tree.leaf_of(tree.distances(matrix(batch["v"], d))))], [*batch.schema.names, "leaf"])

        self.rows = cut(rows.mapInArrow(leaf, "vec_id long, label long, v array<long>, leaf long"))
        self.ranges = ranges(self.rows, tree, d)
        self.blocks = cut(self.packed(self.rows, BLOCK, by_leaf=True))

    def packed(self, rows: DataFrame, most: int, by_leaf: bool, windows: bool = False) -> DataFrame:
        """Rows in blocks of at most ``most``, in order of their leaves (``by_leaf``: of one leaf each)."""
        d, dtype = self.d, self.dtype
        parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        dealt = rows.repartitionByRange(parts, "leaf", "vec_id").sortWithinPartitions("leaf", "vec_id")
        names = ["block", "leaf", "ids", "labels", "v", *(["positives"] if windows else [])]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            number = TaskContext.get().partitionId() << 32
            for batch in batches:
                leaves = batch["leaf"].to_numpy()
                edges = np.flatnonzero(np.r_[True, leaves[1:] != leaves[:-1], True]) if by_leaf else np.array([0, len(leaves)])
                for low, high in zip(edges[:-1].tolist(), edges[1:].tolist()):
                    for a in range(low, high, most):
                        part = batch.slice(a, min(most, high - a))
                        data = [matrix(part["v"], d).astype(dtype)] + ([part["positives"].flatten().to_numpy()] if windows else [])
                        blobs = [pa.array([x.tobytes()], pa.binary()) for x in (part["vec_id"].to_numpy(), part["label"].to_numpy(), *data)]
                        yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([int(leaves[a])]), *blobs], names)
                        number += 1

        return dealt.mapInArrow(run, "block long, leaf long, ids binary, labels binary, v binary" + ", positives binary" * windows)

    def search(self, queries: DataFrame, windows: Callable[[dict, int], tuple[np.ndarray, np.ndarray]], other_label: bool, k: int) -> DataFrame:
        """(anchor_id, window, vec_id, score): the first k rows of every window, over all leaves."""
        d, dtype, tree, limits, sample = self.d, self.dtype, self.tree, self.ranges, self.sample

        def rows_of(row: dict, prefix: str = "") -> Rows:
            return Rows(np.frombuffer(row[prefix + "ids"], np.int64), np.frombuffer(row[prefix + "labels"], np.int64), np.frombuffer(row[prefix + "v"], dtype).reshape(-1, d).astype(np.int64))

        def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = Rows(sample.ids, sample.labels, sample.v.astype(np.int64))
            for batch in batches:
                for row in batch.to_pylist():
                    anchors = rows_of(row)
                    low, high = windows(row, len(anchors.ids))
                    low = first_bounds(anchors, known, low, high, other_label, k)
                    visits = np.flatnonzero(reachable(tree, limits, anchors.v, low, high).any(axis=0))
                    yield pa.RecordBatch.from_arrays([
                        pa.array([row["block"]]), *(pa.array([row[c]], pa.binary()) for c in ("ids", "labels", "v")),
                        pa.array([low.tobytes()], pa.binary()), pa.array([high.tobytes()], pa.binary()), pa.array([visits.tolist()], pa.list_(pa.int64())),
                    ], ["block", "ids", "labels", "v", "low", "high", "leaves"])

        planned = cut(queries.mapInArrow(plan, "block long, ids binary, labels binary, v binary, low binary, high binary, leaves array<long>"))
        visits = planned.select("block", F.explode("leaves").alias("leaf")).join(self.blocks.select("leaf", F.col("block").alias("c_block")), "leaf")
        candidates = self.blocks.select(F.col("block").alias("c_block"), *(F.col(c).alias(f"c_{c}") for c in ("ids", "labels", "v")))
        work = visits.select("block", "c_block").join(planned.drop("leaves"), "block").join(candidates, "c_block").drop("block", "c_block")

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    anchors, rows = rows_of(row), rows_of(row, "c_")
                    low, high = (np.frombuffer(row[c], np.int64).reshape(len(anchors.ids), -1) for c in ("low", "high"))
                    i, w, j, s = in_window(anchors, rows, low, high, other_label, k)
                    yield pa.RecordBatch.from_arrays([pa.array(anchors.ids[i]), pa.array(w.astype(np.int32)), pa.array(rows.ids[j]), pa.array(s)], ["anchor_id", "window", "vec_id", "score"])

        found = work.mapInArrow(scan, "anchor_id long, window int, vec_id long, score long")
        order = Window.partitionBy("anchor_id", "window").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(table: DataFrame, leaf_size: int = LEAF, sample: int = SAMPLE, every: int = ANCHOR_EVERY) -> DataFrame:
    """The hard negatives of every positive of every anchor: (anchor_id, positive_id, rank, negative_id, positive_score, negative_score)."""
    spark = table.sparkSession
    index = Index(table, leaf_size, sample)
    if not index.total:
        return spark.createDataFrame([], RESULT)
    anchors = index.rows.where(F.col("vec_id") % every == 0)

    def anything(row: dict, n: int) -> tuple[np.ndarray, np.ndarray]:
        return np.full((n, 1), NONE), np.full((n, 1), -NONE)

    positives = cut(index.search(cut(index.packed(anchors, ANCHORS, by_leaf=False)), anything, False, POSITIVES).select("anchor_id", "rank", "vec_id", "score"))
    # at most POSITIVES rows for each anchor; places without a positive have no window
    filler = F.array_repeat(F.lit(NONE).cast("long"), POSITIVES)
    lists = positives.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("p"))
    lists = lists.select("vec_id", F.slice(F.concat("p.score", filler), 1, POSITIVES).alias("positives"))

    def below(row: dict, n: int) -> tuple[np.ndarray, np.ndarray]:
        score = np.frombuffer(row["positives"], np.int64).reshape(n, POSITIVES)
        held = score > NONE
        exact = np.where(held, score, 0)
        low = -((-LOW * exact) // HIGH)  # rounded up
        return np.where(held, low, 1), np.where(held, exact, 0)

    dealt = cut(index.packed(anchors.join(lists, "vec_id"), ANCHORS, by_leaf=False, windows=True))
    found = index.search(dealt, below, True, NEGATIVES).withColumn("positive_rank", F.col("window") + 1)
    named = positives.select("anchor_id", F.col("rank").alias("positive_rank"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    joined = found.join(named, ["anchor_id", "positive_rank"])
    return joined.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
