import datetime as dt

from pyspark.sql import functions as F

from tunetrail.functions.dates import DRIVER_WINDOWS, REFERENCE_WINDOWS, parse_yyyymmdd
from tunetrail.functions.exprs import device_type, hash_fraction_key, in_hash_sample, rating_bin, safe_ratio


def test_reference_windows():
    w = REFERENCE_WINDOWS
    assert w.label_start == dt.date(2017, 4, 29) and w.label_end == dt.date(2017, 5, 12)
    assert w.feature_start == dt.date(2017, 3, 30) and w.feature_end == dt.date(2017, 4, 28)
    assert DRIVER_WINDOWS.feature_start == dt.date(2024, 1, 14)
    assert DRIVER_WINDOWS.label_start == dt.date(2024, 1, 28)


def test_parse_yyyymmdd_traps(spark):
    rows = [(" 20170330 ",), ("20171330",), ("",), ("abc",), ("20170405xyz",), (None,), ("20170431",),
            ("\t20170501\r",), ("0",)]
    out = [r[0] for r in spark.createDataFrame(rows, "s string").select(parse_yyyymmdd("s")).collect()]
    assert out == [dt.date(2017, 3, 30), None, None, None, dt.date(2017, 4, 5), None, None,
                   dt.date(2017, 5, 1), None]


def test_rating_bins_right_closed(spark):
    counts = [0, 1, 10, 11, 20, 21, 30, 31, 40, 41, 34285, 34286]
    df = spark.createDataFrame([(c,) for c in counts], "c long")
    out = [r[0] for r in df.select(rating_bin("c")).collect()]
    assert out == [None, 1, 1, 2, 2, 3, 3, 4, 4, 5, 5, 5]


def test_device_type_null_is_two(spark):
    df = spark.createDataFrame([("ip",), ("ar",), (None,)], "d string")
    assert [r[0] for r in df.select(device_type("d")).collect()] == [1, 2, 2]


def test_hash_sample_repeatable_and_near_ratio(spark):
    df = spark.range(20000).withColumnRenamed("id", "uid")
    a = df.where(in_hash_sample("uid", 0.1)).repartition(7)
    b = df.repartition(3).where(in_hash_sample("uid", 0.1))
    assert sorted(r.uid for r in a.collect()) == sorted(r.uid for r in b.collect())
    share = a.count() / 20000
    assert 0.09 < share < 0.11
    assert df.select(F.max(hash_fraction_key("uid", "")).alias("m")).first().m < 10000


def test_safe_ratio_zero_denominator(spark):
    df = spark.createDataFrame([(5.0, 0.0), (5.0, 10.0), (None, 1.0)], "a double, b double")
    assert [r[0] for r in df.select(safe_ratio("a", "b")).collect()] == [None, 0.5, None]
