"""Raw-log ingestion: positional parse, traps, encodings, archives, file pruning."""

import datetime as dt
import io
import os
import tarfile

import pytest
from pyspark.sql import functions as F

from tunetrail.operators.events import unify, write_partitioned
from tunetrail.sources import logs

T = "\t"


def _play(uid, device="ar", song="505506", name="some song", pt="170", sl="182", paid="0"):
    return T.join([uid, device, song, "0", name, "singer", pt, sl, paid])


def _lines_df(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "line string")


def test_parse_lines_traps(spark):
    lines = [
        _play("168530895") + " \t 20170330",                       # kept
        _play("  42 ", device="ip", name='say "hi", you') + " \t 20170330",  # blanks stripped, quote kept
        _play("abc") + " \t 20170330",                             # non-integer uid
        _play("") + " \t 20170330",                                # empty uid
        _play("7") + " \t 20171330",                               # month 13
        _play("8") + " \t 20170331xyz",                            # trailing characters: kept
        T.join(["9", "ar", "1"]) + " \t 20170330",                 # too few fields: date slot empty
        _play("10", name="a" + T + "b") + " \t 20170330",          # extra tab: date slot holds paid_flag
        _play("11", pt="", sl="0") + " \t 20170401",               # empty play_time, zero length
        _play("12", pt="abc") + " \t 20170401",                    # non-numeric play_time
    ]
    out = logs.parse_lines(_lines_df(spark, lines), "play").orderBy("uid").collect()
    assert [r.uid for r in out] == [8, 11, 12, 42, 168530895]
    by = {r.uid: r for r in out}
    assert by[42].device == "ip" and by[42].song_name == 'say "hi", you'
    assert by[8].date == dt.date(2017, 3, 31)
    assert by[11].play_time is None and by[11].song_length == 0.0
    assert by[12].play_time is None
    assert by[168530895].song_id == 505506 and by[168530895].play_time == 170.0
    assert list(out[0].asDict()) == list(logs.OUTPUT["play"])


def test_file_name_rules(spark):
    names = ["20170330_1_play.log", "20170422_3_play.log (1).tar.gz", "20170301_1_play.log.tar.gz",
             "20170412_2_down.log.tar.gz", "20170412_2_play.log.tar.gz", "index.html"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    kept = [r.n for r in df.where(logs.keep_file(F.col("n"), "play")).collect()]
    assert kept == ["20170330_1_play.log", "20170412_2_play.log.tar.gz"]


def test_read_text_logs_encodings_and_pruning(spark, tmpdir_path):
    play_dir = os.path.join(tmpdir_path, "play")
    os.makedirs(play_dir)
    with open(os.path.join(play_dir, "20170330_1_play.log"), "wb") as f:
        f.write((_play("1") + "\n").encode())
        f.write(b"2\tar\t505506\t0\tcaf\xff\xfee\tsinger\t170\t182\t0\n")  # bad UTF-8 bytes in the name
        f.write((_play("3", name="x") + "\n").encode())
    with open(os.path.join(play_dir, "20170301_1_play.log"), "wb") as f:  # before the first date
        f.write((_play("4") + "\n").encode())
    with open(os.path.join(play_dir, "20170330_2_play.log (1)"), "wb") as f:  # browser duplicate
        f.write((_play("5") + "\n").encode())
    play = logs.read_text_logs(spark, play_dir, "play").orderBy("uid").collect()
    assert [r.uid for r in play] == [1, 2, 3]
    assert play[1].song_name == "cafe"  # undecodable bytes dropped
    assert all(r.date == dt.date(2017, 3, 30) for r in play)

    down_dir = os.path.join(tmpdir_path, "down")
    os.makedirs(down_dir)
    with open(os.path.join(down_dir, "20170402_1_down.log"), "wb") as f:
        f.write(T.join(["7", "ip", "99", "Beyonc\xe9", "s", "0"]).encode("latin-1") + b"\n")
    down = logs.read_text_logs(spark, down_dir, "down").collect()
    assert len(down) == 1 and down[0].uid == 7 and down[0].song_id == 99 and down[0].date == dt.date(2017, 4, 2)

    search_dir = os.path.join(tmpdir_path, "search")
    os.makedirs(search_dir)
    with open(os.path.join(search_dir, "20170402_1_search.log"), "wb") as f:
        f.write(T.join(["7", "ip", "1491100000", "caf\xe9"]).encode("latin-1") + b"\n")
    search = logs.read_text_logs(spark, search_dir, "search").collect()
    assert len(search) == 1 and search[0].uid == 7

    # Union with the search log's missing song_id, then a date-partitioned write (K2)
    ev = unify(logs.read_text_logs(spark, play_dir, "play"), logs.read_text_logs(spark, down_dir, "down"),
               logs.read_text_logs(spark, search_dir, "search"))
    rows = ev.orderBy("event", "uid").collect()
    assert [(r.event, r.uid) for r in rows] == [("D", 7), ("P", 1), ("P", 2), ("P", 3), ("S", 7)]
    assert rows[-1].song_id is None
    out = os.path.join(tmpdir_path, "events")
    write_partitioned(ev, out)
    back = spark.read.parquet(out)
    assert back.where(F.col("date") == dt.date(2017, 4, 2)).count() == 2
    assert back.count() == 5


def _tar_gz(path, member_name, text: bytes, cut: int | None = None):
    buf = io.BytesIO()
    with tarfile.open(fileobj=buf, mode="w:gz") as tar:
        info = tarfile.TarInfo(member_name)
        info.size = len(text)
        tar.addfile(info, io.BytesIO(text))
    data = buf.getvalue()
    with open(path, "wb") as f:
        f.write(data[:cut] if cut else data)


def test_read_archives(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "arch")
    os.makedirs(d)
    good = "\n".join(_play(str(u)) for u in range(1, 6)).encode() + b"\n"
    _tar_gz(os.path.join(d, "20170330_1_play.log.tar.gz"), "inner_name_ignored.log", good)
    _tar_gz(os.path.join(d, "20170331_1_play.log.tar.gz"), "x.log", good * 200, cut=200)  # cut short
    _tar_gz(os.path.join(d, "20170330_1_play.log (1).tar.gz"), "dup.log", good)        # duplicate
    _tar_gz(os.path.join(d, "20170301_1_play.log.tar.gz"), "old.log", good)            # too early
    lines = logs.read_archive_lines(spark, d, "play", allow_partial=True)
    report = {r.file_name: r for r in logs.archive_report(lines).collect()}
    assert set(report) == {"20170330_1_play.log.tar.gz", "20170331_1_play.log.tar.gz"}
    assert report["20170331_1_play.log.tar.gz"].damaged is True
    assert report["20170330_1_play.log.tar.gz"].lines == 5 and report["20170330_1_play.log.tar.gz"].damaged is False
    good_rows = logs.archive_rows(lines, "play").where(F.col("date") == dt.date(2017, 3, 30)).collect()
    assert sorted(r.uid for r in good_rows) == [1, 2, 3, 4, 5]
    days = {r.date: r for r in logs.archive_coverage(logs.archive_report(lines)).collect()}
    assert (days[dt.date(2017, 3, 30)].archives, days[dt.date(2017, 3, 30)].damaged, days[dt.date(2017, 3, 30)].lines) == (1, 0, 5)
    assert days[dt.date(2017, 3, 31)].damaged == 1
    with pytest.raises(Exception, match="damaged archive 20170331_1_play"):
        logs.read_archives(spark, d, "play").collect()  # by default nothing is lost in silence


@pytest.mark.parametrize("kind", ["play", "down", "search"])
def test_flipped_bytes_are_found(spark, tmpdir_path, kind):
    import random

    r = random.Random(3)
    text = "".join(f"{i}\tar\t{r.random()}\tx\n" for i in range(3000)).encode()
    path = os.path.join(tmpdir_path, f"20170401_1_{kind}.log.tar.gz")
    _tar_gz(path, "x.log", text)
    assert logs.archive_report(logs.read_archive_lines(spark, tmpdir_path, kind)).first().lines == 3000
    data = bytearray(open(path, "rb").read())
    data[len(data) // 2] ^= 0x55
    open(path, "wb").write(bytes(data))
    with pytest.raises(Exception, match="damaged archive"):
        logs.read_archives(spark, tmpdir_path, kind).collect()
    assert logs.archive_report(logs.read_archive_lines(spark, tmpdir_path, kind, allow_partial=True)).first().damaged


def test_separators_inside_lines_stay(spark, tmpdir_path):
    rows = {"play": _play("1", name="a\x01b\ufffdc"), "down": T.join(["1", "ar", "7", "a\x01b", "s\x01", "0"]), "search": T.join(["1\u00a0", "ar", "9", "q\x01r"])}
    for kind, line in rows.items():
        d = os.path.join(tmpdir_path, kind)
        os.makedirs(d)
        with open(os.path.join(d, f"20170402_1_{kind}.log"), "wb") as f:
            f.write(line.encode("utf-8" if kind == "play" else "latin-1") + b"\n")
        got = logs.read_text_logs(spark, d, kind).collect()
        assert len(got) == 1 and got[0].uid == 1 and got[0].date == dt.date(2017, 4, 2)
        if kind == "play":
            assert got[0].song_name == "a\x01b\ufffdc"  # a replacement character of the file itself stays


def test_unicode_blanks_are_stripped(spark):
    from tunetrail.functions.exprs import strip_blanks

    df = spark.createDataFrame([("\u3000 \u00a0x y\u3000\t",)], "s string")
    assert df.select(strip_blanks("s")).first()[0] == "x y"


def test_gzip_daily_logs(spark, tmpdir_path):
    import gzip

    d = os.path.join(tmpdir_path, "gz")
    os.makedirs(d)
    with gzip.open(os.path.join(d, "20170405_1_play.log.gz"), "wb") as f:
        f.write(("\n".join(_play(str(u)) for u in (11, 12)) + "\n").encode())
    rows = logs.read_text_logs(spark, d, "play").collect()
    assert sorted(r.uid for r in rows) == [11, 12] and all(r.date == dt.date(2017, 4, 5) for r in rows)
