"""Daily raw-log files derived from the driver's ``events``, written the way logs arrive (for the source and sink queries)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunetrail.session import shared_path
from tunetrail.sources import driver_tables as src
from tunetrail.sources.archive_sink import LINES_PER_ARCHIVE, write_archives
from tunetrail.sources.logs import ENCODING


#: Names that downloaded songs go by in turn: Latin-1, in which their bytes are no UTF-8.
DOWN_NAMES = ("caf\u00e9", "se\u00f1or \u00bd", "na\u00efve \u00a35")


def daily_lines(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """(day yyyymmdd, line) of one kind: tab-separated fields in the raw order, without the date."""
    log = {"play": src.play_log, "down": src.down_log, "search": src.search_log}[kind](spark, sf_dir)
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    fields = {"play": [text("uid"), text("device"), text("song_id"), F.lit("0"), F.lit("caf\u00e9"), F.lit("singer"), text("play_time"), text("song_length"), F.lit("0")],
              "down": [text("uid"), text("device"), text("song_id"), F.get(F.array(*map(F.lit, DOWN_NAMES)), (F.coalesce("song_id", F.lit(0)) % len(DOWN_NAMES)).cast("int")), F.lit("singer"), F.lit("0")],
              "search": [text("uid"), text("device"), F.lit("0"), F.lit("qu\u00eate")]}[kind]
    return log.select(F.date_format("date", "yyyyMMdd").alias("day"), F.concat_ws("\t", *fields).alias("line"))


def land_logs(spark: SparkSession, sf_dir: str, kind: str, codec: str = "none") -> str:
    """Write log files of each day, named YYYYMMDD_<shard>_<kind>.log[.gz], in the kind's encoding, into a fresh shared folder; its path."""
    path = shared_path(spark, f"landing-{kind}")
    lines = daily_lines(spark, sf_dir, kind)
    if ENCODING[kind] == "latin-1":
        lines = lines.withColumn("line", F.encode("line", "ISO-8859-1").cast("string"))  # the text writer writes the bytes as they are
    lines.hint("rebalance", "day").write.option("compression", codec).partitionBy("day").text(f"{path}/by-day")
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    fs = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(conf)
    fs.mkdirs(jvm.org.apache.hadoop.fs.Path(f"{path}/logs"))
    for folder in fs.listStatus(jvm.org.apache.hadoop.fs.Path(f"{path}/by-day")):  # a few files a day: names only
        day = folder.getPath().getName().removeprefix("day=")
        for shard, file in enumerate(fs.listStatus(folder.getPath()) if folder.isDirectory() else []):
            end = ".gz" if file.getPath().getName().endswith(".gz") else ""
            fs.rename(file.getPath(), jvm.org.apache.hadoop.fs.Path(f"{path}/logs/{day}_{shard}_{kind}.log{end}"))
    return f"{path}/logs"


def land_archives(spark: SparkSession, sf_dir: str, kind: str, lines_per_archive: int = LINES_PER_ARCHIVE) -> str:
    """Write each day's lines as tar.gz archives, in the kind's encoding, into a fresh shared folder; its path."""
    path = shared_path(spark, f"archives-{kind}")
    write_archives(daily_lines(spark, sf_dir, kind), path, kind, lines_per_archive)
    return path
