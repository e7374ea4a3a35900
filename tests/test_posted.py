"""Similarity, neighbours and predictions from stored files: the same rows as by exchanges, without the exchanges."""

import random

import pytest

from tunetrail.operators.recsys import itemcf as cf
from tunetrail.operators.recsys import posted as po


def plain(df):
    return sorted((tuple(round(x, 12) if isinstance(x, float) else x for x in r) for r in df.collect()), key=str)


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange")


@pytest.fixture()
def odd(spark):
    """A user of all items, an item of most users, null ids, null ratings, a pair that comes twice."""
    r = random.Random(8)
    ratings = {(u, i): r.randint(1, 5) for u in range(70) for i in r.sample(range(50), r.randint(1, 9))}
    ratings |= {(1000, i): r.randint(1, 5) for i in range(50)} | {(u, 777): 3 for u in range(70)} | {(None, i): 2 for i in range(6)} | {(3, None): 4}
    rows = [(u, i, x) for (u, i), x in ratings.items()] + [(1, 900, None), (1, 901, 2), (2, 900, 3), (2, 901, None), (4, 902, None), (5, 777, 1)]
    return spark.createDataFrame(rows, "uid long, song_id long, rating int").checkpoint()


@pytest.fixture()
def small_blocks(monkeypatch):
    monkeypatch.setattr(po, "BLOCK_PRODUCTS", 60)  # many blocks, and sums that are added up in parts
    monkeypatch.setattr(po, "BLOCK_MEETS", 300)    # items in parts
    monkeypatch.setattr(po, "CONTRIBUTIONS", 30)
    monkeypatch.setattr(po, "OUT_ROWS", 50)


def test_same_similarities_without_an_exchange(spark, odd, small_blocks):
    found = cf.both_orders(po.gram(spark, po.lay_out(odd, 0)))
    assert plain(found) == plain(cf.item_similarity(odd))
    assert exchanges(found) == 0


def test_same_neighbours_without_an_exchange(spark, odd, small_blocks, monkeypatch):
    known = odd.where("rating is not null").checkpoint()
    posted = po.lay_out(known, 0)
    assert po._hot(spark, posted.files, po.BLOCK_MEETS)[-1][0] == 777
    want = plain(cf.neighbours(cf.item_similarity(known), 6).select("item_i", "item_j", "sim", "rank"))
    assert plain(po.top_neighbours(spark, posted, 6)) == want
    monkeypatch.setattr(po, "BLOCK_MEETS", 3000)
    found = po.top_neighbours(spark, posted, 6)
    assert plain(found) == want and exchanges(found) == 0


@pytest.mark.parametrize("digits", [6, 0, None])  # with 0 digits many predictions are equal
def test_same_predictions_without_an_exchange(spark, odd, small_blocks, digits):
    near = cf.top_neighbours(odd.where("rating is not null"), 6).checkpoint()
    posted, lists = po.lay_out(odd, 0), po.stored_neighbours(near.repartition(4, "item_i"))
    found = po.predict(spark, posted.files, lists, digits)
    assert plain(found) == plain(cf.predict(odd, near, digits)) and exchanges(found) == 0
    assert any(r[0] is None for r in plain(found))
    assert plain(po.recommend(spark, posted.files, lists, n=3, digits=digits)) == plain(cf.recommend(odd, near, n=3, digits=digits))
    chosen = odd.select("uid").distinct().where("uid % 10 = 0")
    files = po.by_user(odd.join(chosen, "uid", "left_semi"), 100)
    assert plain(po.recommend(spark, files, lists, n=3, digits=digits)) == plain(cf.recommend(odd, near, n=3, digits=digits, users=chosen))


def test_best_keeps_no_more_than_it_needs(spark, odd, small_blocks):
    near = cf.top_neighbours(odd.where("rating is not null"), 6).checkpoint()
    posted, lists = po.lay_out(odd, 0), po.stored_neighbours(near.coalesce(1))
    users = odd.select("uid").distinct().count()
    assert po.scored(spark, posted.files, lists, 3).count() <= 3 * users < po.scored(spark, posted.files, lists).count()


def test_small_tables_and_no_ratings(spark, odd):
    assert po.lay_out(odd) is None and po.lay_out(odd.limit(0)) is None
