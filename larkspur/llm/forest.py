"""Near copies among embeddings of one label: a forest of random-projection trees, leaves compared, links verified and united.

1. Equal vectors of a label are one *class* (its smallest id, and how many copies), by a 128-bit hash.
2. The forest is fitted on a bounded sample of classes (``SAMPLE``, those with the smallest hash of their id).  The root of a tree
   splits by label; every other node splits at a quantile near the middle of the projections on a random direction, and a class that
   lies within the *spill* of the place goes to both sides.  Trees are added until, of ``PAIRS`` made-up pairs that are exactly as far apart as the
   threshold allows, and of linked pairs in the sample, ``RECALL`` share a leaf.  Every class is indexed, in all its leaves.
3. *Balls* keep dense groups of near copies linear: around a pivot from the sample, all vectors within half the angle of the threshold are
   linked to each other, so a class in a ball needs no comparison with others of it.
4. All classes of a leaf are compared by exact cosine.  A leaf of more than ``CHUNK`` classes is dealt out as pairs of chunks, never whole and
   without the pairs inside a ball.  A pair is counted in the first leaf that both classes share only; tasks pass on counts
   and a spanning set of links, not pairs.
5. Links are united to components by joins.

Every link is exact; a pair that shares no leaf is missed.  Recall was measured against brute force (README).

Edge cases: vectors that are null, empty, zero or hold null or non-finite components, and rows without a label, link with nothing;
shorter vectors are filled up with zeros; of rows that repeat an id that with the smallest label and vector stands; rows with a
null id are left out; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from larkspur.llm import arrays as A
from larkspur.llm.components import components
from larkspur.llm.tables import cut, labelled_vectors

THRESHOLD = 0.93
SAMPLE = 32_768  # classes that the forest is fitted on
BALL_SAMPLE = 8_192  # of them, those that pivots are looked for in
BALL_LEAST = 16  # sampled classes that a ball holds at least
LEAF = 1_024  # classes a leaf should have
LEAF_SAMPLE = 8  # sampled classes that a node needs for another split
CHUNK = 4_096  # classes compared at once
DIRECTIONS = 256
SPILL = 0.4  # of the typical projected distance of a pair at the threshold, to each side
PAIRS, RECALL, MOST_TREES = 2_000, 0.999, 48
HOT_SHARE = 1_000  # a class with more than this part of all rows is hot; there are fewer than this many
RESULT = "vec_id long, n_links long, component_id long, kept boolean"
FOUND = "rep long, links long, label long"


def units(v: np.ndarray) -> np.ndarray:
    v = v.astype(np.float64)
    return v / np.sqrt(np.square(v).sum(axis=1, keepdims=True))


def matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


# --- the forest ---------------------------------------------------------------


@dataclass
class Forest:
    """All trees as node arrays.  A node with direction -1 is a leaf, numbered by ``leaf``; children are next to each other."""

    pool: np.ndarray
    direction: np.ndarray
    place: np.ndarray
    child: np.ndarray
    leaf: np.ndarray
    roots: list[dict[int, int]]  # of each tree, node by label
    spill: float

    def leaves(self, v: np.ndarray, labels: np.ndarray, trees: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of unit vectors, sorted by both.  A label that no tree knows has one leaf of its own, below zero."""
        at = v @ self.pool.T
        kinds, code = np.unique(labels, return_inverse=True)
        rows, found = [], []
        for t in range(len(self.roots)) if trees is None else trees:
            roots = np.array([self.roots[t].get(k, -1) for k in kinds.tolist()], np.int64)[code]
            row = np.flatnonzero(roots >= 0)
            node = roots[row]
            while len(row):
                ends = self.direction[node] < 0
                rows.append(row[ends])
                found.append(self.leaf[node[ends]])
                row, node = row[~ends], node[~ends]
                gap = at[row, self.direction[node]] - self.place[node]
                left, right = gap <= self.spill, gap > -self.spill
                row, node = np.r_[row[left], row[right]], np.r_[self.child[node[left]], self.child[node[right]] + 1]
        alone = np.array([not any(k in r for r in self.roots) for k in kinds.tolist()], bool)[code] if len(kinds) else np.zeros(0, bool)
        rows.append(np.flatnonzero(alone))
        found.append(-1 - (A.mix(labels[alone].astype(np.int64).view(A.U)) >> A.U(2)).astype(np.int64))
        row, leaf = np.concatenate(rows), np.concatenate(found)
        order = np.lexsort((leaf, row))
        return row[order], leaf[order]


def shares_leaf(n: int, a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Which of n rows have a leaf in both lists."""
    both = np.intersect1d(a[0] + n * a[1], b[0] + n * b[1])
    out = np.zeros(n, bool)
    out[both % n] = True
    return out


def fit(v: np.ndarray, labels: np.ndarray, total: int, threshold: float = THRESHOLD, leaf_size: int = LEAF, recall: float = RECALL, most: int = MOST_TREES) -> Forest:
    """Trees over sampled unit vectors that stand for ``total`` classes."""
    d, weight = v.shape[1], total / max(len(v), 1)
    pool = units(np.random.default_rng(1).normal(size=(DIRECTIONS, d)))
    spill = SPILL * math.sqrt((2 - 2 * threshold) / d)
    nodes: list[list[float]] = []  # direction, place, child, leaf
    forest = Forest(pool, *(np.zeros(0, np.int64),) * 4, [], spill)
    at = v @ pool.T
    by_label = {k: np.flatnonzero(labels == k) for k in np.unique(labels).tolist()}
    leaves = 0

    def grow(node: int, rows: np.ndarray, draw: np.random.Generator) -> None:
        nonlocal leaves
        if len(rows) * weight > leaf_size and len(rows) >= 2 * LEAF_SAMPLE:
            for _ in range(8):
                k = int(draw.integers(DIRECTIONS))
                p = at[rows, k]
                place = float(np.quantile(p, draw.uniform(0.4, 0.6)))
                left, right = rows[p <= place + spill], rows[p > place - spill]
                if max(len(left), len(right)) <= 0.9 * len(rows):
                    nodes[node][:3] = [k, place, len(nodes)]
                    nodes.extend([[-1, 0.0, -1, -1], [-1, 0.0, -1, -1]])
                    child = int(nodes[node][2])
                    grow(child, left, draw)
                    grow(child + 1, right, draw)
                    return
        nodes[node][3] = leaves
        leaves += 1

    # pairs at the threshold: the hardest ones that have to meet
    draw = np.random.default_rng(2)
    one = draw.integers(0, len(v), PAIRS)
    a = v[one]
    aside = draw.normal(size=a.shape)
    aside -= (aside * a).sum(axis=1, keepdims=True) * a
    size = np.sqrt(np.square(aside).sum(axis=1, keepdims=True))
    b = threshold * a + math.sqrt(1 - threshold**2) * aside / np.where(size > 0, size, 1)
    made_up = (a, b, labels[one], np.ones(PAIRS, bool))
    # and linked pairs of the sample, which lie where the rows are dense and nodes are split
    some = draw.choice(len(v), min(len(v), PAIRS // 4), replace=False)
    x, y = np.nonzero((v[some] @ v.T >= threshold) & (labels[some][:, None] == labels[None, :]) & (some[:, None] != np.arange(len(v))[None, :]))
    pick = draw.choice(len(x), min(len(x), PAIRS), replace=False)
    real = (v[some[x[pick]]], v[y[pick]], labels[some[x[pick]]], np.ones(len(pick), bool))
    while len(forest.roots) < most and max(made_up[3].mean(), real[3].mean() if len(pick) else 0.0) > 1 - recall:
        draw, roots = np.random.default_rng(100 + len(forest.roots)), {}
        for k, rows in by_label.items():
            roots[k] = len(nodes)
            nodes.append([-1, 0.0, -1, -1])
            grow(roots[k], rows, draw)
        forest.roots.append(roots)
        table = np.array(nodes)
        forest.direction, forest.place, forest.child, forest.leaf = table[:, 0].astype(np.int64), table[:, 1], table[:, 2].astype(np.int64), table[:, 3].astype(np.int64)
        newest = [len(forest.roots) - 1]
        for left, right, label, apart in (made_up, real):
            apart &= ~shares_leaf(len(left), forest.leaves(left, label, newest), forest.leaves(right, label, newest))
    return forest


@dataclass
class Balls:
    """Pivots with their labels; all vectors within ``reach`` of a pivot are linked to each other."""

    pivots: np.ndarray
    labels: np.ndarray
    reach: float  # least cosine to the pivot

    def of(self, v: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """The first ball of each row, or -1."""
        if not len(self.pivots):
            return np.full(len(v), -1)
        inside = (v @ self.pivots.T >= self.reach) & (labels[:, None] == self.labels[None, :])
        return np.where(inside.any(axis=1), inside.argmax(axis=1), -1)


def find_balls(v: np.ndarray, labels: np.ndarray, threshold: float = THRESHOLD, least: int = BALL_LEAST) -> Balls:
    """Pivots of dense groups among sampled unit vectors, densest first."""
    reach = math.cos(math.acos(threshold) / 2) + 1e-9
    pivots, owners = [], []
    for k in np.unique(labels).tolist():
        rest = v[labels == k]
        while len(rest) >= least:
            near = np.concatenate([(rest[a : a + 1024] @ rest.T >= reach).sum(axis=1) for a in range(0, len(rest), 1024)])
            if near.max() < least:
                break
            seed = rest[near.argmax()]
            pivot = units(rest[rest @ seed >= reach].mean(axis=0, keepdims=True))[0]
            pivot = max(pivot, seed, key=lambda p: int((rest @ p >= reach).sum()))
            pivots.append(pivot)
            owners.append(k)
            # those around the pivot are done; what lies alone will not be one either
            keep = (near >= least) & (rest @ pivot < reach)
            rest = rest[keep]
    return Balls(np.array(pivots).reshape(-1, v.shape[1]), np.array(owners, np.int64), reach)


# --- comparing ------------------------------------------------------------------


@dataclass
class Side:
    """Classes of a leaf: ids, copies, balls, unit vectors, and all leaves of each."""

    rep: np.ndarray
    copies: np.ndarray
    ball: np.ndarray
    v: np.ndarray
    leaves: np.ndarray
    first: np.ndarray

    @staticmethod
    def of(table: pa.Table | pa.RecordBatch, d: int) -> Side:
        whole = lambda c: c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c
        leaves = whole(table["leaves"])
        numbers = lambda name: whole(table[name]).to_numpy(zero_copy_only=False)
        first = np.r_[0, np.cumsum(leaves.value_lengths().to_numpy(zero_copy_only=False))].astype(np.int64)
        return Side(numbers("rep"), numbers("copies"), numbers("ball"), units(matrix(whole(table["v"]), d)), leaves.flatten().to_numpy(zero_copy_only=False), first)

    def earlier(self, rows: np.ndarray, leaf: int) -> tuple[np.ndarray, np.ndarray]:
        """(place in rows, leaf) of the leaves that come before."""
        counts = self.first[rows + 1] - self.first[rows]
        at, place = A.ranges(self.first[rows], counts), np.repeat(np.arange(len(rows)), counts)
        before = self.leaves[at] < leaf
        return place[before], self.leaves[at][before]


def met_before(a: Side, rows: np.ndarray, b: Side, columns: np.ndarray, leaf: int) -> np.ndarray:
    """Which pairs share a leaf that comes before."""
    (i, x), (j, y) = a.earlier(rows, leaf), b.earlier(columns, leaf)
    common = np.intersect1d(x, y)
    in_a, in_b = np.isin(x, common), np.isin(y, common)
    one, other = np.zeros((len(rows), len(common)), np.float32), np.zeros((len(columns), len(common)), np.float32)
    one[i[in_a], np.searchsorted(common, x[in_a])] = 1
    other[j[in_b], np.searchsorted(common, y[in_b])] = 1
    return one @ other.T > 0


def compare(a: Side, b: Side, leaf: int, threshold: float = THRESHOLD) -> pa.Table:
    """Linked copies of every class that has links, and the smallest id of its links' component, among these classes."""
    same = a is b
    rep, links, label = [], [], []
    linked = a.v @ b.v.T >= threshold
    linked &= (a.ball[:, None] != b.ball[None, :]) | (a.ball[:, None] < 0)
    if same:
        np.fill_diagonal(linked, False)
    rows, columns = np.flatnonzero(linked.any(axis=1)), np.flatnonzero(linked.any(axis=0))
    if len(rows):
        linked = linked[np.ix_(rows, columns)] & ~met_before(a, rows, b, columns, leaf)
        down, up = a.rep[rows].copy(), b.rep[columns].copy()
        far = np.iinfo(np.int64).max
        while True:  # smallest ids spread along the links
            new_down = np.minimum(down, np.where(linked, up[None, :], far).min(axis=1, initial=far))
            new_up = np.minimum(up, np.where(linked, new_down[:, None], far).min(axis=0, initial=far))
            if (new_down == down).all() and (new_up == up).all():
                break
            down, up = new_down, new_up
        for side, at, matrix_, other, own in ((a, rows, linked, b.copies[columns], down), (b, columns, linked.T, a.copies[rows], up)):
            has = matrix_.any(axis=1)
            rep.append(side.rep[at][has])
            links.append((matrix_[has] @ other.astype(np.float64)).astype(np.int64))
            label.append(own[has])
            if same:
                break
    join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return pa.table({"rep": pa.array(join(rep), pa.int64()), "links": pa.array(join(links), pa.int64()), "label": pa.array(join(label), pa.int64())})


def leaf_links(indexed: DataFrame, d: int, threshold: float, chunk: int) -> DataFrame:
    """What compare() says of all leaves; a class comes once for each part that has links of it."""
    entries = indexed.select(F.explode("leaves").alias("leaf"), "rep", "copies", "ball", "v", "leaves")
    sizes = cut(indexed.select(F.explode("leaves").alias("leaf"), "ball").groupBy("leaf", "ball").agg(F.count("*").alias("n")))
    large = sizes.groupBy("leaf").agg(F.sum("n").alias("n")).where(F.col("n") > chunk).select("leaf")

    def whole(table: pa.Table) -> pa.Table:
        side = Side.of(table, d)
        return compare(side, side, table["leaf"][0].as_py(), threshold)

    small = entries.join(large, "leaf", "left_anti").groupBy("leaf").applyInArrow(whole, FOUND)
    if large.isEmpty():
        return small
    # chunks of a ball (or of no ball) in a leaf, and the pairs of them that have to be compared
    parts = sizes.join(large, "leaf").select("leaf", "ball", F.ceil(F.col("n") / chunk).alias("parts"))
    chunks = parts.select("leaf", "ball", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    name = F.struct("ball", "part")
    left, right = chunks.select("leaf", name.alias("a")), chunks.select("leaf", name.alias("b"))
    pairs = left.join(right, "leaf").where("a <= b and (a.ball <> b.ball or a.ball < 0)")
    part = F.pmod(F.xxhash64("rep"), F.col("parts")).cast("long")
    packed = cut(
        entries.join(parts, ["leaf", "ball"]).groupBy("leaf", F.struct("ball", part.alias("part")).alias("chunk"))
        .agg(F.collect_list(F.struct("rep", "copies", "ball", "v", "leaves")).alias("rows"))
    )
    one, two = packed.select("leaf", F.col("chunk").alias("a"), F.col("rows").alias("one")), packed.select("leaf", F.col("chunk").alias("b"), F.col("rows").alias("two"))
    work = pairs.join(one, ["leaf", "a"]).join(two, ["leaf", "b"]).select("leaf", (F.col("a") == F.col("b")).alias("same"), "one", F.when(F.col("a") != F.col("b"), F.col("two")).alias("two"))

    def side_of(rows: pa.ListScalar) -> Side:
        return Side.of(pa.RecordBatch.from_struct_array(rows.values), d)

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                a = side_of(batch["one"][k])
                yield from compare(a, a if batch["same"][k].as_py() else side_of(batch["two"][k]), batch["leaf"][k].as_py(), threshold).to_batches()

    return small.union(work.mapInArrow(pair, FOUND))


# --- the table --------------------------------------------------------------------


def usable() -> Column:
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(F.col("label").isNotNull() & ~bad & F.exists("v", lambda x: x != 0), F.lit(False))


def near_copies(table: DataFrame, threshold: float = THRESHOLD, leaf_size: int = LEAF, chunk: int = CHUNK, sample: int = SAMPLE, ball_least: int = BALL_LEAST) -> DataFrame:
    """Links and component of every row: (vec_id, n_links, component_id, kept)."""
    spark = table.sparkSession
    marked = labelled_vectors(table).withColumn("ok", usable())
    alone = marked.where("not ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    keyed = marked.where("ok").withColumns({"k1": F.xxhash64("label", "v"), "k2": F.xxhash64("v", "label", F.lit(1))})
    classes = cut(keyed.groupBy("k1", "k2").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")))
    size = classes.agg(F.count("*"), F.sum("copies")).first()
    if not size[0]:
        return alone
    vectors = keyed.select(F.col("vec_id").alias("rep"), "label", "v").join(classes.select("rep", "copies"), "rep")
    d = vectors.agg(F.max(F.size("v"))).first()[0]
    element = vectors.schema["v"].dataType.elementType.simpleString()
    full = F.concat("v", F.array_repeat(F.lit(0).cast(element), F.lit(d) - F.size("v")))
    vectors = cut(vectors.withColumn("v", F.when(F.size("v") < d, full).otherwise(F.col("v"))))

    some = vectors.select("rep", "label", "v").orderBy(F.xxhash64("rep"), "rep").limit(sample).toArrow()  # at most ``sample`` rows
    sampled, labels = units(matrix(some["v"].combine_chunks(), d)), some["label"].to_numpy()
    forest = fit(sampled, labels, size[0], threshold, leaf_size)
    balls = find_balls(sampled[:BALL_SAMPLE], labels[:BALL_SAMPLE], threshold, ball_least)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v, label = units(matrix(batch["v"], d)), batch["label"].to_numpy()
            row, leaf = forest.leaves(v, label)
            first = np.searchsorted(row, np.arange(len(v) + 1)).astype(np.int32)
            leaves = pa.ListArray.from_arrays(pa.array(first), pa.array(leaf, pa.int64()))
            yield pa.RecordBatch.from_arrays([batch["rep"], batch["copies"], pa.array(balls.of(v, label).astype(np.int32)), batch["v"], leaves], ["rep", "copies", "ball", "v", "leaves"])

    indexed = cut(vectors.select("rep", "label", "copies", "v").mapInArrow(index, f"rep long, copies long, ball int, v array<{element}>, leaves array<long>"))
    found = cut(leaf_links(indexed, d, threshold, chunk))
    in_balls = indexed.where("ball >= 0").select("rep", "copies", "ball")
    # one row for each ball, of which the sample has at most BALL_SAMPLE / ball_least
    of_ball = F.broadcast(in_balls.groupBy("ball").agg(F.sum("copies").alias("all"), F.min("rep").alias("label")))
    inside = in_balls.join(of_ball, "ball").select("rep", (F.col("all") - F.col("copies")).alias("links"), "label")
    both = found.union(inside)
    links = both.groupBy("rep").agg(F.sum("links").alias("links"))
    labels_of = components(both.select(F.col("rep").alias("a"), F.col("label").alias("b"))).withColumnRenamed("node", "rep")
    done = cut(
        classes.join(links, "rep", "left").join(labels_of, "rep", "left")
        .select("k1", "k2", "copies", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "rep").alias("component_id"))
    )
    rows = keyed.select("vec_id", "k1", "k2")
    is_hot = F.col("copies") * HOT_SHARE > size[1]
    hot = F.broadcast(done.where(is_hot).drop("copies"))  # fewer than HOT_SHARE rows
    rest = rows.join(hot.select("k1", "k2"), ["k1", "k2"], "left_anti").join(done.where(~is_hot).drop("copies"), ["k1", "k2"])
    placed = rows.join(hot, ["k1", "k2"]).unionByName(rest)
    return placed.select("vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept")).union(alone)
