"""Identities of the churn pipeline and the recommender on the driver's sf0.001 tables."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tunetrail.functions.dates import DRIVER_WINDOWS as W
from tunetrail.operators import features as fx
from tunetrail.operators import label as lb
from tunetrail.operators import metrics as mt
from tunetrail.operators import training as tr
from tunetrail.operators.recsys import interactions as ia
from tunetrail.operators.recsys import itemcf as cf
from tunetrail.sources import driver_tables as src

ACT = ("P",)


@pytest.fixture(scope="module")
def events(spark):
    return src.event_log(spark, SF_SMALL).cache()


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_fused_equals_chained(events):
    a = tr.training_table(events, W, ACT)
    b = tr.training_table_chained(events, W, ACT)
    assert a.columns == b.columns
    assert len(a.columns) == 2 + 3 * 4 + 3 + 4 + 4 + 1
    assert _rows(a) == _rows(b)


def test_label_forms_agree_and_binary(events):
    a = lb.churn_label(events, W, ACT)
    b = lb.churn_label_by_join(events, W, ACT)
    assert _rows(a) == _rows(b)
    assert {r.label for r in a.collect()} <= {0, 1}


def test_training_table_invariants(events):
    t = tr.training_table(events, W, ACT).cache()
    assert t.groupBy("uid").count().where("count > 1").count() == 0  # one row per uid (X11)
    assert t.where(F.col("uid").isNull()).count() == 0
    nulls = t.select([F.count_if(F.col(c).isNull()).alias(c) for c in t.columns]).first()
    assert all(v == 0 for v in nulls)
    for e in "PDS":
        for a, b in zip(W.sub_windows, W.sub_windows[1:]):
            assert t.where(F.col(fx.freq_name(e, a)) > F.col(fx.freq_name(e, b))).count() == 0
    # recency never points past the snapshot (no label leakage, X10)
    assert t.where((F.col("rec_P") < 0) | (F.col("rec_S") < 0) | (F.col("rec_D") < 0)).count() == 0
    pop = lb.model_population(events, W, ACT).count()
    assert t.count() == pop


def test_method1_equals_method2_after_fill(events):
    feat = events.where(F.col("date").between(W.feature_start, W.feature_end))
    m1 = fx.frequency_single(feat, "S", 3, W.snapshot)
    m2 = fx.frequency_windows(feat, "S", W).select("uid", "freq_S_last_3")
    joined = m2.join(m1.withColumnRenamed("freq_S_last_3", "m1"), "uid", "left").na.fill({"m1": 0})
    assert joined.where(F.col("m1") != F.col("freq_S_last_3")).count() == 0


def test_multi_device_detector_fires(events):
    plays = events.where(F.col("event") == "P")
    assert fx.users_multi_device(plays, W).count() > 0
    prof = fx.device_profile(plays, W)
    assert prof.groupBy("uid").count().where("count > 1").count() == 0


def _util(spark):
    return ia.utility(ia.ratings(src.purchase_counts(spark, SF_SMALL))).cache()


def test_similarity_matches_brute_force(spark):
    u = _util(spark)
    pdf = u.toPandas()
    users = {x: i for i, x in enumerate(sorted(pdf.uid.unique()))}
    items = {x: i for i, x in enumerate(sorted(pdf.song_id.unique()))}
    m = np.zeros((len(users), len(items)))
    for r in pdf.itertuples():
        m[users[r.uid], items[r.song_id]] = r.rating
    norms = np.sqrt((m * m).sum(axis=0))
    dense = (m.T @ m) / np.outer(norms, norms)
    sim = cf.item_similarity(u).collect()
    assert len(sim) == int((m.T @ m > 0).sum())
    for r in sim:
        assert math.isclose(r.sim, dense[items[r.item_i], items[r.item_j]], rel_tol=1e-12)
    diag = [r.sim for r in sim if r.item_i == r.item_j]
    assert all(math.isclose(x, 1.0) for x in diag)


def test_chunks_give_the_same_products(spark):
    u = _util(spark)
    whole = _rows(cf.cooccurrence(u, chunk_items=10 ** 9))
    assert whole == _rows(cf.cooccurrence(u, chunk_items=3)) == _rows(cf.cooccurrence(u, chunk_items=50))


def test_one_user_is_no_task(spark):
    """A user with 20,000 ratings among users with 40: no (user, chunk, chunk) key and no partition stands out."""
    hot = spark.range(20_000).select(F.lit(0).cast("long").alias("uid"), F.col("id").alias("song_id"), F.lit(1.0).alias("rating"))
    rest = spark.range(40 * 300).select((F.col("id") % 300 + 1).alias("uid"), F.col("id").alias("song_id"), F.lit(1.0).alias("rating"))
    rows = cf.chunk_pairs(hot.union(rest), 256)
    assert rows.groupBy("uid", "lo", "hi").count().agg(F.max("count")).first()[0] < 3 * 256
    sizes = [r["count"] for r in rows.repartition(16, "uid", "lo", "hi").groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 1.5 * sorted(sizes)[len(sizes) // 2]


def test_no_job_runs_while_a_plan_is_built(spark):
    u = _util(spark)
    u.count()
    tracker, seen = spark.sparkContext.statusTracker(), "plan-only"
    spark.sparkContext.setJobGroup(seen, seen)
    cf.recommend(u, cf.neighbours(cf.item_similarity(u)))
    assert not tracker.getJobIdsForGroup(seen)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_chosen_users_get_the_same_list(spark):
    u = _util(spark)
    n = cf.neighbours(cf.item_similarity(u), k=5).cache()
    every = [r for r in _rows(cf.recommend(u, n, n=3))]
    chosen = _rows(cf.recommend(u, n, n=3, users=u.select("uid").where("uid % 3 = 0")))
    assert chosen and set(chosen) <= set(every)


def test_neighbours_topk_and_prediction_bounds(spark):
    u = _util(spark)
    n = cf.neighbours(cf.item_similarity(u), k=5).cache()
    assert n.groupBy("item_i").count().where("count > 5").count() == 0
    pred = cf.predict(u, n)
    row = pred.agg(F.min("pred").alias("lo"), F.max("pred").alias("hi")).first()
    assert 1.0 <= row.lo and row.hi <= 5.0  # a weighted mean of 1..5 ratings
    top = cf.top_n(pred, u, n=3)
    rated = {(r.uid, r.song_id) for r in u.collect()}
    assert all((r.uid, r.song_id) not in rated for r in top.collect())
    assert top.groupBy("uid").count().where("count > 3").count() == 0


def test_auc_matches_pairwise_brute_force(spark):
    rng = np.random.default_rng(0)
    n = 400
    p = np.round(rng.random(n), 2)
    y = (rng.random(n) < p).astype(int)
    split = np.where(rng.random(n) < 0.3, "test", "train")
    df = spark.createDataFrame([(int(i), int(a), float(b), str(c)) for i, (a, b, c) in enumerate(zip(y, p, split))],
                               "uid long, label int, p double, split string")
    got = {r.split: r.auc for r in mt.roc_auc(df, parts=8).collect()}
    for s in ("train", "test"):
        ys, ps = y[split == s], p[split == s]
        pos, neg = ps[ys == 1], ps[ys == 0]
        want = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
        assert math.isclose(got[s], want, rel_tol=1e-12)
    cm = {r.split: r for r in mt.confusion_metrics(df).collect()}
    yhat = (p > 0.5).astype(int)
    for s in ("train", "test"):
        m = split == s
        tp = int(((yhat == 1) & (y == 1) & m).sum())
        assert cm[s].tp == tp


def test_metrics_zero_denominator(spark):
    df = spark.createDataFrame([(1, 0, 0.2, "test"), (2, 0, 0.5, "test")], "uid long, label int, p double, split string")
    r = mt.classification_report(df).first()
    assert r.precision == 0.0 and r.recall == 0.0 and r.f1 == 0.0 and r.auc == 0.0 and r.accuracy == 1.0


def test_shuffled_joins_equal_broadcast_joins(spark):
    u = _util(spark)
    n = cf.neighbours(cf.item_similarity(u), k=5).cache()
    a, ra = _rows(cf.predict(u, n)), _rows(cf.recommend(u, n, n=3))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert _rows(cf.predict(u, n)) == a and _rows(cf.recommend(u, n, n=3)) == ra
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_clustered_scores_are_dealt_over_tasks(spark):
    df = spark.range(4000).select(F.col("id").alias("uid"), (F.col("id") % 3 == 0).cast("int").alias("label"), (F.col("id") / 5e6).alias("p"), F.lit("all").alias("split"))
    parts = [r["count"] for r in mt.score_groups(df, "split", 8).groupBy("part").count().collect()]
    assert len(parts) > 4 and max(parts) < 1200
    assert math.isclose(mt.roc_auc(df, parts=8).first().auc, mt.roc_auc(df, parts=1).first().auc, rel_tol=1e-12)


def test_to_pandas_small_refuses_large(spark):
    from tunetrail.operators.explore import to_pandas_small

    assert len(to_pandas_small(spark.range(5), 10)) == 5
    with pytest.raises(ValueError):
        to_pandas_small(spark.range(50), 10)


def test_auc_matches_spark_evaluator(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    rng = np.random.default_rng(3)
    n = 500
    p = np.round(rng.random(n), 3)
    y = (rng.random(n) < p).astype(int)
    df = spark.createDataFrame([(int(i), int(a), float(b), "all") for i, (a, b) in enumerate(zip(y, p))],
                               "uid long, label int, p double, split string")
    ours = mt.roc_auc(df).first().auc
    ev = BinaryClassificationEvaluator(rawPredictionCol="p", labelCol="label", numBins=0)
    theirs = ev.evaluate(df.withColumn("label", F.col("label").cast("double")))
    assert math.isclose(ours, theirs, rel_tol=1e-9)
