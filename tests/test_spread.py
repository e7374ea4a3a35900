"""What one task of the utility table holds doesn't grow with the table."""

from pyspark.sql import functions as F

from tunetrail import session
from tunetrail.operators.recsys import evaluate as ev
from tunetrail.operators.recsys import factors as fa
from tunetrail.plans import catalog
from tunetrail.sources import driver_tables as src


def _write(spark, path, orders=400):
    lines = spark.range(orders * 5).select((F.col("id") % orders).alias("l_orderkey"), (F.col("id") * 7 % 90).alias("l_partkey"), (F.col("id") % 23).cast("double").alias("l_quantity"))
    lines.write.parquet(f"{path}/lineitem.parquet")
    spark.range(orders).select(F.col("id").alias("o_orderkey"), (F.col("id") % 60).alias("o_custkey")).write.parquet(f"{path}/orders.parquet")
    parts = spark.range(80).select(F.col("id").alias("p_partkey"), F.concat(F.lit("n"), "id").alias("p_name"))
    parts.union(parts.limit(5)).write.parquet(f"{path}/part.parquet")  # parts without a name, parts that come twice


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _parts(df):
    """Tasks of the last stage, with sort merge joins as large tables have them."""
    spark = df.sparkSession
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return df.select("*").rdd.getNumPartitions()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_partitions_follow_the_rows(spark, tmpdir_path, monkeypatch):
    _write(spark, tmpdir_path)
    few, errors = _rows(catalog.util_table(spark, tmpdir_path)), _rows(ev.observed_with_item_mean(catalog.util_table(spark, tmpdir_path)))
    monkeypatch.setattr(session.spread, "__kwdefaults__", {"each": 50})
    u = catalog.util_table(spark, tmpdir_path)
    assert u.rdd.getNumPartitions() == 40  # 2,000 line items; the session has 8
    seen = ev.observed_with_item_mean(u)
    assert _rows(u) == few and _rows(seen) == errors and _parts(seen) == -(-len(few) // 50)
    seen = fa.reconstruct_observed(u, catalog.drawn_factors(u, signed=True))
    assert seen.count() == len(few) and _parts(seen) == -(-len(few) // 50)


def test_names_change_no_mean(spark, tmpdir_path):
    from tunetrail.operators.recsys import interactions as ia

    _write(spark, tmpdir_path)
    assert _rows(catalog.utility_of(spark, tmpdir_path)) == _rows(ia.utility(ia.ratings(src.purchase_counts(spark, tmpdir_path))))


def test_partitions_stay_when_the_session_has_more(spark):
    """Adaptive execution joins the session's partitions, whatever rows they hold; those of a spread table it leaves."""
    df = session.spread(spark.range(2000).withColumn("k", F.col("id") % 500), 2000, "k", each=300)
    assert df.rdd.getNumPartitions() == 7
    assert df.groupBy("k").count().rdd.getNumPartitions() == 7


def test_spread_product_sums_popular_ids_in_parts(spark, monkeypatch):
    x = spark.range(600).select((F.col("id") % 40).alias("uid"), (F.col("id") * F.col("id") % 7).alias("song_id"), (F.col("id") % 5).cast("double").alias("rating"))
    w = fa.md5_factors(x.select("uid").distinct(), "uid", 3, "u")
    got = lambda: sorted((r.song_id, *(round(v, 9) for v in r.f)) for r in fa.spread_product(x, w, "uid", "song_id").collect())
    whole = got()
    plain = x.join(w, "uid").groupBy("song_id").agg(*[F.sum(F.col("rating") * F.col("f")[i]).alias(f"f{i}") for i in range(3)])
    assert whole == sorted((r[0], *(round(v, 9) for v in r[1:])) for r in plain.collect())
    monkeypatch.setattr(fa, "PART_ROWS", 50)
    monkeypatch.setattr(session.spread, "__kwdefaults__", {"each": 50})
    assert got() == whole
