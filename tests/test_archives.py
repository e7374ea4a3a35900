"""Archives as files: the sink's shards and commit, the streaming reader, encodings, incremental ingestion."""

import glob
import os
import tarfile

import pytest
from pyspark.sql import functions as F

from tunetrail.sources import logs
from tunetrail.sources.archive_sink import Written, ArchiveWriter, write_archives
from tunetrail.streaming.ingest import ingest

T = "\t"


def _line(uid):
    return T.join([str(uid), "ip", "5", "0", "caf\u00e9", "x", "100", "200", "0"])


def _lines(spark, rows):
    return spark.createDataFrame(rows, "day string, line string").repartition(3)


def test_archives_round_trip_in_bounded_shards(spark, tmpdir_path):
    rows = [("20170401", _line(7))] * 500 + [("20170402", _line(u)) for u in range(30)]  # a day of one line repeated
    write_archives(_lines(spark, rows), tmpdir_path, "play", lines_per_archive=50)
    names = sorted(os.path.basename(p) for p in glob.glob(f"{tmpdir_path}/*"))
    assert all(n.endswith("_play.log.tar.gz") for n in names) and len([n for n in names if n.startswith("20170401")]) == 10 and len([n for n in names if n.startswith("20170402")]) == 1
    read = logs.read_archive_lines(spark, tmpdir_path, "play", batch_lines=7)
    assert sorted(r.line for r in read.where("line IS NOT NULL").collect()) == sorted(x for _, x in rows)
    assert max(r.lines for r in logs.archive_report(read).collect()) < 100
    whole = logs.read_archive_lines(spark, tmpdir_path, "play", through_spark=True)
    assert read.exceptAll(whole).count() == 0 and whole.exceptAll(read).count() == 0
    rows = logs.read_archives(spark, tmpdir_path, "play").groupBy("date", "song_name").count().collect()
    assert sorted((str(r.date), r.song_name, r["count"]) for r in rows) == [("2017-04-01", "caf\u00e9", 500), ("2017-04-02", "caf\u00e9", 30)]


def test_contents_are_never_a_column(spark, tmpdir_path):
    write_archives(_lines(spark, [("20170401", _line(1))]), tmpdir_path, "play")
    files = logs.archive_files(spark.read, tmpdir_path, "play").select("path")
    scan = files._jdf.queryExecution().executedPlan().toString()
    assert "path" in scan and "content" not in scan.split("ReadSchema:")[1]


@pytest.mark.parametrize("kind, raw", [("down", "caf\u00e9".encode("latin-1")), ("play", "caf\u00e9".encode())])
def test_archives_hold_the_encoding_of_their_kind(spark, tmpdir_path, kind, raw):
    write_archives(_lines(spark, [("20170401", "caf\u00e9")]), tmpdir_path, kind)
    with tarfile.open(glob.glob(f"{tmpdir_path}/*")[0]) as tar:
        assert tar.extractfile(tar.getmembers()[0]).read() == raw + b"\n"
    assert [r.line for r in logs.read_archive_lines(spark, tmpdir_path, kind).where("line IS NOT NULL").collect()] == ["caf\u00e9"]


def test_nothing_written_and_nothing_left_by_an_abort(spark, tmpdir_path):
    write_archives(_lines(spark, []), tmpdir_path, "play")
    assert not glob.glob(f"{tmpdir_path}/*")
    w, out = ArchiveWriter(f"file:{tmpdir_path}", "play"), Written()
    w._close(out, ("20170401", 0), ["a"])
    assert not glob.glob(f"{tmpdir_path}/2*")  # hidden until the commit
    w.abort([out, None])
    assert not glob.glob(f"{tmpdir_path}/*")


def test_names_with_blanks_and_percent_signs(spark, tmpdir_path):
    folder = f"{tmpdir_path}/a b%20c"
    write_archives(_lines(spark, [("20170401", _line(3))]), folder, "play")
    assert [r.uid for r in logs.read_archives(spark, folder, "play").collect()] == [3]


def test_archives_are_ingested_once(spark, tmpdir_path):
    landing, table, ckpt = (os.path.join(tmpdir_path, x) for x in ("landing", "table", "ckpt"))
    write_archives(_lines(spark, [("20170401", _line(u)) for u in (1, 2)] + [("20170301", _line(9))]), landing, "play")  # one before the first date

    def run():
        ingest(spark, landing, "play", table, ckpt, archives=True).awaitTermination(120)
        return sorted(r.uid for r in spark.read.parquet(table).collect())

    assert run() == [1, 2] and run() == [1, 2]  # a restart reads nothing again
    write_archives(_lines(spark, [("20170331", _line(4))]), landing, "play")  # late, with an earlier name
    assert run() == [1, 2, 4]
    broken = os.path.join(landing, "20170405_0_play.log.tar.gz")
    with open(broken, "wb") as f:
        f.write(b"no archive")
    with pytest.raises(Exception, match="damaged archive"):
        run()
    os.remove(broken)
    write_archives(_lines(spark, [("20170405", _line(5))]), landing, "play")  # the same name, whole: its batch is read again
    assert run() == [1, 2, 4, 5]
