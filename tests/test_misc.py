"""Smaller operators: CSV with doubled quotes, pivot demo, sinks, numpy parity of statistics."""

import csv
import os

import numpy as np

from tunetrail.operators import explore as ex
from tunetrail.operators import population as pop
from tunetrail.operators import training as tr
from tunetrail.operators.recsys import interactions as ia
from tunetrail.sources import logs


def test_read_clean_csv_doubled_quotes(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "play_ds.csv")
    with open(path, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(["uid", "device", "song_name", "song_id", "date", "play_time", "song_length"])
        w.writerow(["1", "ip", 'say "hi", you', "5", "2017-04-01", "10", "20"])
    df = logs.read_clean_csv(spark, path, "uid long, device string, song_name string, song_id long, "
                                          "date date, play_time double, song_length double")
    r = df.first()
    assert r.song_name == 'say "hi", you' and r.song_id == 5 and r.song_length == 20.0


def test_utility_pivot_small(spark):
    util = spark.createDataFrame([(1, 10, 2.0), (1, 11, 3.0), (2, 11, 1.0)], "uid long, song_id long, rating double")
    rows = {r.uid: r for r in ia.utility_pivot(util, [10, 11]).collect()}
    assert rows[1]["10"] == 2.0 and rows[1]["11"] == 3.0 and rows[2]["10"] == 0.0


def test_utility_averages_names(spark):
    rated = spark.createDataFrame([(1, 10, "a", 5, 1), (1, 10, "b", 25, 3)],
                                  "uid long, song_id long, song_name string, counts long, like int")
    assert ia.utility(rated).first().rating == 2.0   # X26: one cell per (uid, song), mean over names
    assert ia.song_names(rated).first().song_name == "a"


def test_statistics_match_numpy(spark):
    rng = np.random.default_rng(1)
    counts = rng.integers(1, 60000, 3000)
    df = spark.createDataFrame([(i, int(c)) for i, c in enumerate(counts)], "uid long, n_plays long")
    thr = pop.plays_percentile(df).first().threshold
    assert np.isclose(thr, np.percentile(counts, 99.9))
    kept = pop.bots_removed(df).count()
    assert kept == int((counts < np.percentile(counts, 99.9)).sum())
    s = ex.summary_stats(df, "n_plays").first()
    assert np.isclose(s.q25, np.percentile(counts, 25)) and np.isclose(s.std, counts.std(ddof=1))
    hist = {r.bin: r.n for r in pop.log_histogram(df).collect()}
    lg = np.log10(counts)
    want = np.bincount(np.minimum(np.floor(lg[lg <= 4.8] * 5).astype(int), 23), minlength=24)
    assert all(hist.get(b, 0) == want[b] for b in range(24))


def test_null_report_and_training_sink(spark, tmpdir_path):
    df = spark.createDataFrame([(1, None), (2, "x")], "uid long, device string")
    rep = {r.column_name: (r.n_non_null, r.n_null) for r in ex.null_report(df).collect()}
    assert rep == {"uid": (2, 0), "device": (1, 1)}
    out = os.path.join(tmpdir_path, "training")
    tr.write_training_table(df, out)
    assert spark.read.parquet(out).count() == 2
