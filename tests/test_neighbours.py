"""The pruned neighbour join against the table of all pairs."""

import random

import numpy as np
import pytest

from conftest import SF_SMALL
from tunetrail.operators.recsys import interactions as ia
from tunetrail.operators.recsys import itemcf as cf
from tunetrail.sources import driver_tables as src


def rows(df):
    return sorted((r.item_i, r["rank"], r.item_j, r.sim) for r in df.collect())


@pytest.mark.parametrize("block_ratings", [2_000_000, 400, 30])  # one block; several; items in parts
def test_equals_all_pairs(spark, block_ratings):
    r = random.Random(4)
    ratings = {(u, i): r.randint(1, 5) for u in range(60) for i in r.sample(range(40), r.randint(1, 12))}
    ratings |= {(1000, i): r.randint(1, 5) for i in range(40)} | {(u, 777): 3 for u in range(60)}  # a user of all items, an item of most users
    util = spark.createDataFrame([(u, i, x) for (u, i), x in ratings.items()], "uid long, song_id long, rating int").checkpoint()
    want = rows(cf.neighbours(cf.item_similarity(util), 6))
    assert rows(cf.top_neighbours(util, 6, block_ratings, chunk_items=7)) == want


def test_carries_on_fewer_pairs(spark):
    util = ia.utility(ia.ratings(src.purchase_counts(spark, SF_SMALL))).checkpoint()
    every = cf.item_similarity(util).count()
    few = cf.neighbour_pairs(util, 10).count()
    assert few <= 10 * util.select("song_id").distinct().count() < every


def test_postings_are_skipped_once_bounds_are_low():
    r = np.random.default_rng(1)
    users, items = 64, 300
    own = np.sort(r.integers(1, 6, users).astype(float) * (np.arange(users) < 8) + 0.01)[::-1]
    first = np.arange(users) * 20
    column = np.concatenate([r.choice(items, 20, replace=False) for _ in range(users)])
    rating, norm = r.integers(1, 6, len(column)).astype(float), np.full(items, 4.0)
    top = np.array([rating[a:a + 20].max() / 4 for a in first])
    full = np.zeros(items)
    np.add.at(full, column, np.repeat(own, 20) * rating)
    got = cf._accumulate(np.argsort(-own * top), own, top, first, first + 20, column, rating, norm, 9.0, 5)
    best = np.argsort(-full)[:5]
    assert np.allclose(got[best], full[best]) and np.count_nonzero(got) < np.count_nonzero(full)


def test_no_ratings(spark):
    assert cf.top_neighbours(spark.createDataFrame([], "uid long, song_id long, rating int")).collect() == []


def _odd_ratings(spark):
    r = random.Random(8)
    ratings = {(u, i): r.randint(1, 5) for u in range(70) for i in r.sample(range(50), r.randint(1, 9))}
    ratings |= {(1000, i): r.randint(1, 5) for i in range(50)} | {(u, 777): 3 for u in range(70)} | {(None, i): 2 for i in range(6)} | {(3, None): 4}
    return spark.createDataFrame([(u, i, x) for (u, i), x in ratings.items()], "uid long, song_id long, rating int").checkpoint()


@pytest.mark.parametrize("blocks", [2, 7])
def test_blocks_of_items_give_the_same_similarities(spark, monkeypatch, blocks):
    u = _odd_ratings(spark)
    u = u.unionByName(spark.createDataFrame([(1, 900, None), (1, 901, 2), (2, 900, 3), (2, 901, None), (4, 902, None)], u.schema)).checkpoint()  # null ratings
    monkeypatch.setattr(cf, "PAIR_PRODUCTS", 60)  # slices, and items beyond one
    got = cf.item_similarity(u, blocks=blocks)
    plain = lambda df: list((r.item_i, r.item_j, r.sim if r.sim is None else round(r.sim, 12)) for r in df.collect())
    assert sorted(plain(got), key=str) == sorted(plain(cf.item_similarity(u)), key=str)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(item_i" not in plan and "hashpartitioning(pair_a#" in plan and f", {blocks * (blocks + 1) // 2})" in plan  # products are not exchanged


def test_parts_by_user_give_the_same_predictions(spark, monkeypatch):
    u = _odd_ratings(spark)
    n = cf.top_neighbours(u, 6).checkpoint()
    plain = lambda df: sorted((tuple(r) for r in df.collect()), key=str)
    pred, top = plain(cf.predict(u, n)), plain(cf.recommend(u, n, n=3))
    monkeypatch.setattr(cf, "LIST_ITEMS", 4)
    monkeypatch.setattr(cf, "USER_CONTRIBUTIONS", 8 * cf.NEIGHBOURS)  # some users are many tasks' work
    assert plain(cf.predict(u, n, parts=9)) == pred and plain(cf.recommend(u, n, n=3, parts=9)) == top
    assert any(r[0] is None for r in pred)
