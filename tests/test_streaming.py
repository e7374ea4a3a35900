"""Incremental ingestion: each new daily file is appended exactly once."""

import os

from tunetrail.streaming.ingest import daily_counts, ingest, ingest_events, log_stream

T = "\t"


def _write(path, uids, date_bad=False):
    with open(path, "w") as f:
        for u in uids:
            f.write(T.join([str(u), "ip", "5", "0", "s", "x", "100", "200", "0"]) + "\n")


def test_available_now_ingest_is_incremental(spark, tmpdir_path):
    landing = os.path.join(tmpdir_path, "landing")
    os.makedirs(landing)
    table = os.path.join(tmpdir_path, "table")
    ckpt = os.path.join(tmpdir_path, "ckpt")
    _write(os.path.join(landing, "20170401_1_play.log"), [1, 2, 3])
    _write(os.path.join(landing, "20170301_1_play.log"), [9])          # before the first date: skipped
    with open(os.path.join(landing, "20170401_2_play.log"), "w") as f:  # a bad uid row is dropped
        f.write(T.join(["abc", "ip", "5", "0", "s", "x", "1", "2", "0"]) + "\n")
    q = ingest(spark, landing, "play", table, ckpt)
    q.awaitTermination(120)
    assert sorted(r.uid for r in spark.read.parquet(table).collect()) == [1, 2, 3]

    _write(os.path.join(landing, "20170402_1_play.log"), [4, 5])
    q = ingest(spark, landing, "play", table, ckpt)
    q.awaitTermination(120)
    rows = spark.read.parquet(table).collect()
    assert sorted(r.uid for r in rows) == [1, 2, 3, 4, 5]          # nothing read twice
    assert {str(r.date) for r in rows} == {"2017-04-01", "2017-04-02"}


def test_daily_counts_stream(spark, tmpdir_path):
    landing = os.path.join(tmpdir_path, "landing2")
    os.makedirs(landing)
    _write(os.path.join(landing, "20170401_1_play.log"), [1, 2])
    _write(os.path.join(landing, "20170402_1_play.log"), [3])
    q = (daily_counts(log_stream(spark, landing, "play")).writeStream.outputMode("complete")
         .format("memory").queryName("daily_counts_test").start())
    q.processAllAvailable()
    got = {str(r.date): r.n for r in spark.sql("SELECT * FROM daily_counts_test").collect()}
    q.stop()
    assert got == {"2017-04-01": 2, "2017-04-02": 1}


def test_event_log_stream_union(spark, tmpdir_path):
    land = {k: os.path.join(tmpdir_path, k) for k in ("play", "down", "search")}
    for d in land.values():
        os.makedirs(d)
    _write(os.path.join(land["play"], "20170401_1_play.log"), [1, 2])
    with open(os.path.join(land["down"], "20170401_1_down.log"), "wb") as f:
        f.write(T.join(["3", "ip", "77", "n", "s", "0"]).encode("latin-1") + b"\n")
    with open(os.path.join(land["search"], "20170402_1_search.log"), "wb") as f:
        f.write(T.join(["4", "ar", "1491100000", "caf\xe9"]).encode("latin-1") + b"\n")
    table = os.path.join(tmpdir_path, "events")
    q = ingest_events(spark, land, table, os.path.join(tmpdir_path, "ckpt_ev"))
    q.awaitTermination(120)
    rows = sorted((r.event, r.uid, r.song_id) for r in spark.read.parquet(table).collect())
    assert rows == [("D", 3, 77), ("P", 1, 5), ("P", 2, 5), ("S", 4, None)]
