"""Day states and the bucketed event table give the fused training table."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tunetrail.functions.dates import Windows
from tunetrail.operators import daystates as ds
from tunetrail.operators import events as ev
from tunetrail.operators import training as tr
from tunetrail.sources import driver_tables as src


def _rows(df):
    return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect())


@pytest.fixture(scope="module")
def log(spark):
    e = src.event_log(spark, SF_SMALL)
    odd = e.limit(6).withColumn("uid", F.lit(-1).cast(e.schema["uid"].dataType)).withColumn("play_time", F.lit(None).cast("double"))  # plays without a time
    return e.unionByName(odd).unionByName(e.limit(3)).cache()


@pytest.mark.parametrize("activity", [("P",), None])
def test_snapshots_from_one_table_of_states(spark, log, tmpdir_path, activity):
    path = f"{tmpdir_path}/states"
    ds.write_day_states(log, path)
    states = spark.read.parquet(path)
    for end, label, feature, subs in (("2024-01-30", 3, 14, (1, 3, 7, 14)), ("2024-01-20", 2, 10, (1, 5, 10)), ("2024-01-09", 4, 5, (2,))):
        w = Windows.of(end, label, feature, subs)
        want = tr.training_table(log, w, activity, recency_fill=99)
        got = ds.training_table_from_states(states, w, activity, recency_fill=99)
        assert got.dtypes == want.dtypes and _rows(got) == _rows(want) and got.count() > 0


def test_days_arrive_one_by_one_and_again(spark, log, tmpdir_path):
    path, w = f"{tmpdir_path}/states", Windows.of("2024-01-20", 2, 3, (1, 3))
    for day in (17, 16, 18, 19, 20, 18):  # out of order, one twice
        ds.write_day_states(log.where(F.col("date") == F.lit(dt.date(2024, 1, day))), path)
    states = spark.read.parquet(path)
    assert _rows(ds.training_table_from_states(states, w)) == _rows(tr.training_table(log, w))
    assert states.groupBy("uid", "date").count().where("count > 1").count() == 0
    assert ds.training_table_from_states(states.limit(0), w).count() == 0


def test_bucketed_events_need_no_exchange(spark, log, tmpdir_path):
    w = Windows.of("2024-01-30", 3, 14, (1, 7))
    table = ev.write_bucketed(log, "events_" + uuid.uuid4().hex, f"{tmpdir_path}/bucketed", 6)
    got = tr.training_table(table, w, ("P",))
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    assert _rows(got) == _rows(tr.training_table(log, w, ("P",)))
