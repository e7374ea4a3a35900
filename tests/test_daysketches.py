"""Day sketches against exact counts: ranges, retention, heavy keys; estimates beyond the exact size."""

import datetime as dt

from pyspark.sql import functions as F

from tunetrail.operators import daysketches as sk

D = dt.date(2024, 1, 1)


def day(k):
    return D + dt.timedelta(k)


def events(spark, n=6000, users=900):
    return spark.range(0, n, 1, 7).select((F.col("id") * F.col("id") % users).alias("uid"), F.expr("date_add(date'2024-01-01', int(id % 10))").alias("date"),
                                          F.when(F.col("id") % 3 == 0, "P").otherwise("S").alias("event"))


def test_ranges_and_retention_are_exact_below_the_size(spark, tmpdir_path):
    ev = events(spark).unionByName(spark.createDataFrame([(None, day(0), "P")], "uid long, date date, event string"))
    sk.write_day_sketches(ev.where(F.col("date") < day(5)), tmpdir_path)
    sk.write_day_sketches(ev.where(F.col("date") >= day(5)), tmpdir_path)  # later days are appended
    sketches = spark.read.parquet(tmpdir_path)
    rows = [(r.uid, r.date, r.event) for r in ev.collect()]
    got = {r.name: (r.n_events, r.n_users) for r in sk.distinct_users(sketches, [("a", day(0), day(2)), ("b", day(2), day(9)), ("none", day(50), day(60))]).collect()}
    for name, a, b in (("a", 0, 2), ("b", 2, 9)):
        of = [u for u, d, _ in rows if day(a) <= d <= day(b)]
        assert got[name] == (len(of), len(set(of) - {None}))
    assert got["none"] == (0, 0)
    for r in sk.retention(sketches, (day(0), day(3)), (day(8), day(9)), "event").collect():
        before = {u for u, d, e in rows if e == r.event and d <= day(3)} - {None}
        after = {u for u, d, e in rows if e == r.event and d >= day(8)}
        assert (r.n_users, r.n_back, r.n_left) == (len(before), len(before & after), len(before - after))


def test_estimates_beyond_the_size(spark):
    many = spark.range(200_000).select(F.col("id").alias("uid"), F.lit(D).alias("date"), F.lit("P").alias("event"))
    n = sk.distinct_users(sk.day_sketches(many, 12), [("a", D, D)], 12).first().n_users
    assert abs(n - 200_000) < 200_000 * 5 * 2 ** -6


def test_heavy_keys_equal_exact_counts(spark, tmpdir_path):
    """Few counters, many rare keys, one key on a third of the rows, a key that is heavy on one day only, null keys."""
    key = F.expr("case when id % 3 = 0 then 7 when id % 50 = 1 then 8 when id % 10 = 5 and id % 7 = 0 then 9 when id % 97 = 2 then null else 1000 + id end")
    df = spark.range(0, 20_000, 1, 9).select(key.alias("k"), F.expr("date_add(date'2024-01-01', int(id % 10))").alias("date"))
    share = 0.015
    sk.write_heavy_summaries(df, "k", tmpdir_path, share)
    summaries = spark.read.parquet(tmpdir_path)
    assert summaries.where("key is not null").groupBy("date").count().agg(F.max("count")).first()[0] <= sk.counters(share)
    for a, b in ((0, 9), (5, 5), (2, 4), (30, 31)):
        part = df.where(F.col("k").isNotNull() & F.col("date").between(F.lit(day(a)), F.lit(day(b))))
        n = part.count()
        want = {(r.k, r.n) for r in part.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > share * n).collect()}
        assert {(r.k, r.n) for r in sk.heavy_hitters(df, summaries, "k", day(a), day(b), share).collect()} == want
        assert n == 0 or want
    assert sk.heavy_summaries(df.limit(0), "k", share).collect() == []


def test_text_keys(spark):
    df = spark.createDataFrame([("x", D)] * 9 + [("y", D)] * 2 + [(None, D), ("z", None)], "k string, date date")
    s = sk.heavy_summaries(df, "k", 0.5)
    assert {(r.key, r["count"]) for r in s.collect()} == {("x", 9), ("y", 2), (None, 11)}
    assert [(r.k, r.n) for r in sk.heavy_hitters(df, s, "k", D, D, 0.5).collect()] == [("x", 9)]
