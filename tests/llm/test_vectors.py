"""Hard negatives, near copies and whitening of embeddings against brute force."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from larkspur.llm import forest, gnat, whiten

SCHEMA = "vec_id long, embedding array<double>, label int, leaf string, v int, home string"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if x is None else [None if c is None else float(c) for c in x], k, "l", 1, "h") for i, x, k in rows], SCHEMA).repartition(3)


#: Rows that take no part, and a short vector.
ODD = [(900, None, 1), (901, [1.0, None, 0.5], 1), (902, [float("nan")] * 3, 1), (903, [float("inf"), 0, 0], 1), (904, [], 2), (None, [0.1, 0.2], 2), (905, [0.3, 0.4], None)]


# --- hard negatives -------------------------------------------------------------


def expected_negatives(rows, every=100):
    d = max(len(x) for i, x, k in rows if usable(i, x) and k is not None)
    whole = {}
    for i, x, k in rows:
        if usable(i, x) and k is not None:
            whole[i] = ((k + 1) % 10 if i % 7 == 0 else k, [math.floor(256 * c) for c in x] + [0] * (d - len(x)))
    out = set()
    for a, (label, v) in whole.items():
        if a % every:
            continue
        score = {i: sum(p * q for p, q in zip(v, x)) for i, (_, x) in whole.items()}
        order = sorted((i for i in whole if i != a), key=lambda i: (-score[i], i))
        for p in [i for i in order if whole[i][0] == label][:5]:
            found = [i for i in order if whole[i][0] != label and 80 * score[p] <= 100 * score[i] <= 100 * score[p]][:5]
            out |= {(a, p, n, i, score[p], score[i]) for n, i in enumerate(found, 1)}
    return out


def usable(i, x):
    return i is not None and bool(x) and all(c is not None and math.isfinite(c) for c in x)


@pytest.mark.parametrize("leaf_size, sample", [(16, 200), (16, 1 << 14), (1 << 10, 50)])
def test_hard_negatives(spark, leaf_size, sample):
    draw = np.random.default_rng(3)
    centres = draw.normal(size=(12, 6))
    v = centres[draw.integers(0, 12, 700)] + 0.2 * draw.normal(size=(700, 6))
    v[300:330] = v[100]  # a hot vector, with ties
    v[400] = -v[0]
    rows = [(k, x.tolist(), int(k % 4)) for k, x in enumerate(v)] + ODD + [(1000, [0.5, 0.25], 1)]
    found = gnat.hard_negatives(frame(spark, rows), leaf_size, sample).collect()
    assert set(map(tuple, found)) == expected_negatives(rows) and len(found) == len(expected_negatives(rows)) > 50


def test_hard_negatives_of_few_rows(spark):
    assert gnat.hard_negatives(frame(spark, [])).count() == 0
    assert gnat.hard_negatives(frame(spark, ODD)).count() == 0
    few = [(100, [1.0, 0.0], 1), (101, [0.9, 0.0], 1), (102, [0.9, 0.1], 2), (103, [0.1, 0.0], 2)]
    found = gnat.hard_negatives(frame(spark, few)).collect()
    assert set(map(tuple, found)) == expected_negatives(few) == {(100, 101, 1, 102, 230 * 256, 230 * 256)}
    # of rows that repeat an id that with the smaller label stands
    again = gnat.hard_negatives(frame(spark, [*few, (101, [0.5, 0.0], 3), (101, [0.9, 0.0], 1)])).collect()
    assert set(map(tuple, again)) == expected_negatives(few)


def test_elimination_keeps_every_row_of_a_window():
    """And it does eliminate: close clusters leave most leaves unvisited."""
    draw = np.random.default_rng(5)
    v = np.round(100 * (5 * draw.normal(size=(20, 8))[draw.integers(0, 20, 3000)] + 0.1 * draw.normal(size=(3000, 8)))).astype(np.int64)
    tree = gnat.fit(v[:1000], len(v), 50)
    d2 = tree.distances(v)
    leaf = tree.leaf_of(d2)
    n = len(tree.points)
    limits = gnat.Ranges(np.full((n, gnat.FANOUT), np.inf), np.full((n, gnat.FANOUT), -np.inf), np.full(n, np.inf), np.full(n, -np.inf))
    for node, rows, nearest in tree.descend(d2):
        a, b = tree.first[node], tree.first[node + 1]
        for j in set(nearest.tolist()):
            mine = rows[nearest == j]
            limits.low[a:b, j], limits.high[a:b, j] = np.sqrt(d2[mine, a:b].min(axis=0)), np.sqrt(d2[mine, a:b].max(axis=0))
            limits.size_low[a + j], limits.size_high[a + j] = gnat.squares(v[mine]).min(), gnat.squares(v[mine]).max()
    anchors = v[::150]
    score = anchors @ v.T
    top = np.sort(score, axis=1)
    windows = np.stack([top[:, -40], top[:, -400]], axis=1), np.stack([top[:, -10], top[:, -380]], axis=1)
    alive = gnat.reachable(tree, limits, anchors, *windows)
    for w in range(2):
        hit = (score >= windows[0][:, w, None]) & (score <= windows[1][:, w, None])
        for a, row in zip(*np.nonzero(hit)):
            assert alive[a, leaf[row]]
    assert alive.mean() < 0.5


# --- near copies ---------------------------------------------------------------


def expected_copies(rows, threshold=0.93):
    d = max([len(x) for _, x, _ in rows if x], default=0)
    good = [(i, [*x, *[0.0] * (d - len(x))], k) for i, x, k in rows if usable(i, x) and k is not None and any(x)]
    out = {i: (0, i) for i, _, _ in rows if i is not None}
    for label in {k for _, _, k in good}:
        ids = np.array([i for i, _, k in good if k == label])
        v = np.array([x for _, x, k in good if k == label])
        v = v / np.sqrt(np.square(v).sum(axis=1, keepdims=True))
        linked = v @ v.T >= threshold
        np.fill_diagonal(linked, False)
        least = ids.copy()
        for _ in ids:
            new = np.minimum(least, np.where(linked, least[None, :], 1 << 60).min(axis=1))
            if (new == least).all():
                break
            least = new
        out |= {int(i): (int(n), int(c)) for i, n, c in zip(ids, linked.sum(axis=1), least)}
    return out


def around(draw, centre, cosine, n):
    """Vectors at a cosine from a unit centre."""
    side = draw.normal(size=(n, len(centre)))
    side -= (side @ centre)[:, None] * centre
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    return cosine * centre + math.sqrt(1 - cosine**2) * side


@pytest.mark.parametrize("leaf_size, chunk", [(32, 48), (32, 1 << 12), (1 << 10, 100)])
def test_near_copies(spark, leaf_size, chunk):
    """Copies, a dense group, a looser one that needs several balls, pairs near the threshold, and a chain."""
    draw = np.random.default_rng(7)
    unit = lambda n: forest.units(draw.normal(size=(n, 16)))
    base = unit(400)
    dense, loose = around(draw, base[0], 0.995, 150), around(draw, base[1], 0.96, 150)
    pairs = np.concatenate([around(draw, c, 0.945, 1) for c in base[100:160]])
    chain = [base[2]]
    for _ in range(12):
        chain.append(around(draw, chain[-1], 0.95, 1)[0])
    v = np.concatenate([base, dense, loose, pairs, np.array(chain), np.repeat(base[3:4], 40, axis=0) * 3.0, base[4:5] * 2])
    rows = [(k, x.tolist(), 1 if k % 10 else 2) for k, x in enumerate(v)] + [(5000 + k, base[3].tolist(), 3) for k in range(3)]
    rows += ODD + [(906, [0.0] * 16, 1), (907, v[1].tolist(), None), (908, [1.0, 0.5], 1), (909, [2.0, 1.0], 1)]
    found = {r.vec_id: (r.n_links, r.component_id) for r in forest.near_copies(frame(spark, rows), leaf_size=leaf_size, chunk=chunk, ball_least=8).collect()}
    expected = expected_copies(rows)
    assert set(found) == set(expected)
    links = sum(n for n, _ in expected.values())
    assert all(found[i][0] <= expected[i][0] for i in expected)
    assert sum(n for n, _ in found.values()) >= 0.995 * links
    assert sum(found[i][1] != expected[i][1] for i in expected) <= 3
    assert found[908] == (1, 908) and found[909] == (1, 908)


def test_near_copies_of_few_rows(spark):
    assert forest.near_copies(frame(spark, [])).count() == 0
    found = {r.vec_id: tuple(r)[1:] for r in forest.near_copies(frame(spark, ODD)).collect()}
    assert found == {i: (0, i, True) for i, _, _ in ODD if i is not None}
    repeated = [(1, [1.0, 0.0], 1), (1, [0.0, 1.0], 0), (2, [1.0, 0.01], 1), (3, [1.0, 0.0], 1), (3, [1.0, 0.0], 1)]
    found = {r.vec_id: tuple(r)[1:] for r in forest.near_copies(frame(spark, repeated)).collect()}
    assert found == {1: (0, 1, True), 2: (1, 2, True), 3: (1, 2, False)}


def test_recall_of_the_hardest_pairs():
    """Pairs at the threshold itself, other than those the trees were added for, in deep trees."""
    draw = np.random.default_rng(9)
    v = forest.units(draw.normal(size=(20_000, 32)))
    labels = draw.integers(0, 2, len(v))
    trees = forest.fit(v[:8000], labels[:8000], 1_000_000, leaf_size=1_024)
    other = np.concatenate([around(draw, x, 0.93, 1) for x in v[10_000:14_000]])
    met = forest.shares_leaf(4000, trees.leaves(v[10_000:14_000], labels[10_000:14_000]), trees.leaves(other, labels[10_000:14_000]))
    assert met.mean() >= 0.99


def test_pairs_are_counted_in_their_first_leaf():
    draw = np.random.default_rng(1)
    v = around(draw, forest.units(draw.normal(size=(1, 8)))[0], 0.99, 30)
    leaves = [sorted(draw.choice(12, 5, replace=False).tolist()) for _ in range(30)]
    total = np.zeros(30, np.int64)
    for leaf in range(12):
        rows = [k for k in range(30) if leaf in leaves[k]]
        table = pa.table({"rep": pa.array(rows), "copies": pa.array([1] * len(rows)), "ball": pa.array([-1] * len(rows)), "v": pa.array([v[k].tolist() for k in rows]), "leaves": pa.array([leaves[k] for k in rows])})
        side = forest.Side.of(table, 8)
        for r in forest.compare(side, side, leaf).to_pylist():
            total[r["rep"]] += r["links"]
    assert total.tolist() == [sum(bool(set(leaves[a]) & set(leaves[b])) for b in range(30) if b != a) for a in range(30)]


# --- whitening ------------------------------------------------------------------


def check_whitening(found, rows, most=16):
    d = max(len(x) for i, x, _ in rows if whole(x))
    x = [(i, [math.floor(64 * c) + 1_000_000 for c in v] + [1_000_000] * (d - len(v))) for i, v, _ in rows if whole(v)]
    fit = sorted({tuple(v) for _, v in x})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[(n * c - s) / n for c, s in zip(v, sums)] for v in fit])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors, k = values[::-1], vectors[:, ::-1], min(most, d)
    by_row = {}
    for r in found:
        by_row.setdefault((r.vec_id, r.deviation), []).append(r)
    assert len(found) == len(x) * k and {r.n for r in found} == {n}
    signs = {}
    for i, v in x:
        deviation = sum((n * c - s) ** 2 for c, s in zip(v, sums))
        mine = sorted(by_row[i, deviation], key=lambda r: r.component)[-k:] if len(by_row[i, deviation]) == k else None
        if mine is None:
            continue  # a repeated row
        row = np.array([(n * c - s) / n for c, s in zip(v, sums)])
        for c, r in enumerate(mine):
            assert r.component == c + 1
            assert r.explained == pytest.approx(values[c] / values.sum(), rel=1e-9) and r.identity_error < 1e-9
            expected = row @ vectors[:, c] / math.sqrt(values[c])
            if abs(expected) > 1e-3:
                signs.setdefault(c, set()).add(np.sign(r.whitened / expected))
            assert abs(r.whitened) == pytest.approx(abs(expected), rel=1e-6, abs=1e-8)
    assert all(len(s) == 1 for s in signs.values())


def whole(x):
    return bool(x) and all(c is not None and math.isfinite(c) for c in x)


@pytest.mark.parametrize("n, d", [(300, 24), (60, 5), (4000, 17)])
def test_whitening(spark, n, d):
    draw = np.random.default_rng(n)
    v = draw.normal(size=(n, d)) * np.linspace(1, 4, d)
    rows = [(k, x.tolist(), 1) for k, x in enumerate(v)] + [(10_000 + k, v[3].tolist(), None) for k in range(20)]
    rows += [r for r in ODD if r[0] is not None] + [(7000, [0.25, -0.5], 1)]
    rows = [r for r in rows if r[0] != 905] + [(905, v[5].tolist(), None)]
    check_whitening(whiten.whiten(frame(spark, rows)).collect(), rows)


def test_whitening_of_degenerate_tables(spark):
    assert whiten.whiten(frame(spark, [])).count() == 0
    assert whiten.whiten(frame(spark, [r for r in ODD if not whole(r[1])])).count() == 0
    same = whiten.whiten(frame(spark, [(1, [0.5, 0.5], 1), (1, [0.5, 0.5], 1), (None, [0.5, 0.5], 2)])).collect()
    assert sorted((str(r.vec_id), r.component) for r in same) == [("1", 1), ("1", 1), ("1", 2), ("1", 2), ("None", 1), ("None", 2)]
    assert all(r.n == 1 and r.deviation == 0 and r.whitened is None and r.explained is None and r.identity_error == 0 for r in same)
    line = whiten.whiten(frame(spark, [(k, [float(k), 2.0 * k, -float(k)], 1) for k in range(50)])).collect()  # rank one
    assert {r.whitened is None for r in line if r.component > 1} == {True}
    assert all(r.explained == pytest.approx(1.0 if r.component == 1 else 0.0, abs=1e-9) for r in line)


def test_deviations_are_exact():
    x = np.array([[10**6 + 3, 10**6], [10**6, 10**6]])
    assert whiten.deviations(x, 7, np.array([7 * 10**6, 7 * 10**6 + 1])).to_pylist() == [442, 1]
    assert whiten.deviations(np.array([[3_100_000_000, 0], [2_000_000_000, 2_000_000_000]]), 1, np.zeros(2, np.int64)).to_pylist() == [None, 8 * 10**18]


@pytest.mark.parametrize("kind", ["normal", "graded", "equal", "orthonormal", "two values", "rank", "few rows", "one", "two", "zero", "nearly equal", "wilkinson"])
def test_bidiagonal_solver(kind):
    draw = np.random.default_rng(4)
    turn, frame_ = np.linalg.qr(draw.normal(size=(40, 40)))[0], np.linalg.qr(draw.normal(size=(200, 40)))[0]
    pair = np.diag(np.abs(np.arange(41) - 20.0) + 5) + np.diag(np.ones(40), 1) + np.diag(np.ones(40), -1)
    rows = {
        "normal": lambda: draw.normal(size=(500, 40)), "graded": lambda: draw.normal(size=(500, 40)) * np.geomspace(1e-7, 1, 40), "equal": lambda: np.vstack([np.eye(40)] * 3),
        "orthonormal": lambda: frame_, "two values": lambda: frame_ * np.r_[np.ones(10), np.full(30, 2)] @ turn, "rank": lambda: draw.normal(size=(500, 7)) @ draw.normal(size=(7, 40)),
        "few rows": lambda: draw.normal(size=(5, 40)), "one": lambda: draw.normal(size=(9, 1)), "two": lambda: draw.normal(size=(9, 2)), "zero": lambda: np.zeros((9, 6)),
        "nearly equal": lambda: frame_ * np.r_[1 + 1e-10 * np.arange(20), np.linspace(0.1, 0.9, 20)] @ turn, "wilkinson": lambda: np.linalg.cholesky(pair).T,
    }[kind]()
    d = rows.shape[1]
    r = np.linalg.qr(rows, mode="r")
    r = np.vstack([r, np.zeros((d - len(r), d))])
    diagonal, upper, _ = whiten.bidiagonal(r)
    found = np.sort(np.concatenate([whiten.squared_singular_values(diagonal[p], upper[p.start : p.stop - 1]) for p in whiten.blocks(diagonal, upper)]))[::-1]
    expected = np.linalg.svd(r, compute_uv=False) ** 2
    assert found == pytest.approx(expected, rel=1e-8, abs=1e-14 * max(expected[0], 1e-300))
    values, vectors, trace = whiten.principal(r, len(rows))
    covariance = rows.T @ rows / len(rows)
    assert np.abs(covariance @ vectors - vectors * values).max() <= 1e-12 * max(values[0], 1e-300)
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12 and trace == pytest.approx(np.trace(covariance))


def test_vectors_of_one_length_only_are_read_by_all(spark):
    """Float columns, as the embeddings table has, give what doubles give."""
    draw = np.random.default_rng(2)
    v = draw.normal(size=(120, 6)).astype(np.float32)
    rows = [(k, [float(c) for c in x], k % 3) for k, x in enumerate(v)]
    floats = frame(spark, rows).withColumn("embedding", F.col("embedding").cast("array<float>"))
    for run in (gnat.hard_negatives, forest.near_copies):
        assert sorted(map(tuple, run(floats).collect())) == sorted(map(tuple, run(frame(spark, rows)).collect()))
