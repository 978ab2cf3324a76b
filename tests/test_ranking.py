"""The best partners by factors, against a plain sort."""

import numpy as np
import pytest

from larkspur.operators import ranking, recommend as rec


@pytest.mark.parametrize("blocks", [None, (1, 1), (3, 2)])
def test_best_partners(spark, monkeypatch, blocks):
    """Tiles of a few rows, ties, vectors of very different length, fewer partners than asked for in a block."""
    monkeypatch.setattr(ranking, "TILE_ROWS", 4)
    rng = np.random.default_rng(2)
    # small whole numbers: every product is exact in single precision
    x = rng.integers(-3, 4, (30, 3)).astype(float)
    y = np.concatenate([rng.integers(-2, 3, (20, 3)), 9 * rng.integers(-2, 3, (5, 3))]).astype(float)
    owners = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "id int, features array<float>")
    partners = spark.createDataFrame([(100 + k, v.tolist()) for k, v in enumerate(y)], "id int, features array<float>")
    want = []
    for k, v in enumerate(x):
        best = sorted((-float(v @ w), 100 + j) for j, w in enumerate(y))[:6]
        want += [(k, j, p, -s) for p, (s, j) in enumerate(best, 1)]
    got = sorted(map(tuple, ranking.best_partners(owners, partners, 6, blocks).collect()), key=lambda r: (r[0], r[2]))
    assert got == want


def test_far_partners_are_not_multiplied(monkeypatch):
    """With lengths that fall quickly, a task reads a few tiles of its partners, and all it finds is right."""
    monkeypatch.setattr(ranking, "TILE_ROWS", 10)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(10, 4)).astype(np.float32)
    y = (rng.normal(size=(500, 4)) * np.exp(-np.arange(500) / 20)[:, None]).astype(np.float32)

    class Counted(np.ndarray):
        tiles = 0

        def __array_ufunc__(self, ufunc, method, *inputs, **kwargs):
            Counted.tiles += ufunc is np.matmul
            return getattr(ufunc, method)(*(np.asarray(i) for i in inputs), **kwargs)

    (own, who, _), = ranking._best_in_block(np.arange(10), x.view(Counted), np.arange(500), y, 3)
    assert 0 < Counted.tiles < 25
    for k in range(10):
        assert set(who[own == k]) == set(np.argsort(-(x[k] @ y.T))[:3])


def test_lists_equal_those_of_the_library(spark):
    ratings = spark.range(3000).selectExpr("cast(id % 150 as int) as user", "cast(pmod(xxhash64(id), 100) as int) as item", "pmod(hash(id), 5) - 1.5 as rating")
    model = rec.als_fit(ratings, maxIter=2, blocks=2)

    def listed(df, owner, other):
        return sorted((r[owner], p, x[other], x["rating"]) for r in df.collect() for p, x in enumerate(r["recommendations"], 1))

    items = rec.recommend_item_users(model, ratings.select("item").where("item < 40"), 5)
    library = model.recommendForItemSubset(ratings.select("item").where("item < 40").distinct(), 5)
    assert sorted((r["item"], r["position"], r["user"], r["score"]) for r in items.collect()) == listed(library, "item", "user")
    users = rec.recommend_users(model, ratings.select("user"), 7)
    assert sorted((r["user"], r["position"], r["item"], r["score"]) for r in users.collect()) == listed(model.recommendForAllUsers(7), "user", "item")
