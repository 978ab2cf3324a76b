import random

import pytest

from larkspur.operators import recommend as rec


@pytest.fixture(scope="module")
def ratings(spark):
    draw = random.Random(4)
    rows = sorted({(draw.randrange(60), draw.randrange(40)) for _ in range(700)})
    return spark.createDataFrame([(u, i, float(draw.randrange(1, 6))) for u, i in rows], "user int, item int, rating double").cache()


@pytest.fixture
def made(monkeypatch):
    """The settings that fits are made with."""
    seen = []
    plain = rec.ALS
    monkeypatch.setattr(rec, "ALS", lambda **settings: seen.append(settings) or plain(**settings))
    return seen


def test_blocks_by_bytes_sent_and_ratings(spark, ratings, monkeypatch):
    most = max(10, spark.sparkContext.defaultParallelism)
    assert rec.als_blocks(ratings, 50, 10) == most
    monkeypatch.setattr(rec, "SENT_BYTES", 6 * 100 * 10 * (4 * 50 + 10))  # some 100 ids
    assert rec.als_blocks(ratings, 50, 10) in (5, 6)
    assert rec.als_blocks(ratings, 50, 40) == rec.LEAST_BLOCKS
    monkeypatch.setattr(rec, "BLOCK_RATINGS", 10)
    assert rec.als_blocks(ratings, 50, 40) == -(-ratings.count() // 10)
    assert rec.als_blocks(ratings.limit(0), 50, 10) == most


def test_many_factors_are_sent_to_few_blocks(ratings, made, monkeypatch):
    monkeypatch.setattr(rec, "SENT_BYTES", 1)
    rec.als_fit(ratings, implicit=True, rank=3, maxIter=2)
    assert (made[0]["numUserBlocks"], made[0]["numItemBlocks"]) == (rec.LEAST_BLOCKS, rec.LEAST_BLOCKS)


def test_checkpoints_leave_the_factors_alone(ratings, made):
    def factors(**more):
        model = rec.als_fit(ratings, True, maxIter=5, **more)
        return [sorted(map(tuple, f.collect())) for f in (model.userFactors, model.itemFactors)]

    assert factors() == factors(checkpointInterval=10)
    assert made[0]["checkpointInterval"] < 5


def test_grid_fits_share_the_cores(spark, ratings, made, monkeypatch):
    monkeypatch.setattr(rec, "SENT_BYTES", 1)
    train, test = ratings.where("(user + item) % 5 > 0"), ratings.where("(user + item) % 5 = 0")
    grid = {"rank": [2], "regParam": [0.1], "alpha": [1.0, 4.0]}
    found = rec.als_grid(train, test, ratings, grid, max_iter=2, parallelism=4)
    assert found.count() == 3
    assert {s["numUserBlocks"] for s in made} == {2}


def test_blocks_hold_some_million_ratings(spark):
    """What a task holds does not grow with the ratings; the ids are so many that few blocks are asked for."""
    ratings = spark.range(40_000_000).selectExpr("id % 5000000 as user", "id % 3999999 as item", "1.0D as rating")
    assert rec.als_blocks(ratings, 10, 10) == 5


def test_checkpoints_of_explicit_fits(ratings, made):
    def factors(**more):
        model = rec.als_fit(ratings, maxIter=5, **more)
        return [sorted(map(tuple, f.collect())) for f in (model.userFactors, model.itemFactors)]

    assert factors() == factors(checkpointInterval=10)
    assert made[0]["checkpointInterval"] < 5
