"""Incremental ingestion of daily log files with Structured Streaming.

The logs arrive as new daily files.  A file-source stream over the landing
folder parses each new file with the same positional rule as the batch
reader (:func:`tunetrail.sources.logs.parse_lines`) and appends the typed
rows to a date-partitioned parquet table.  The checkpoint records which
files were consumed, so a rerun -- or a restart after a lost executor or
driver -- processes each file exactly once.  ``trigger(availableNow=True)``
turns a scheduled job into "ingest whatever arrived since last time".
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tunetrail.operators.events import unify
from tunetrail.sources.logs import FIRST_DATE, archive_files, archive_rows, decoded, expand_archives, file_date, keep_file, parse_lines


def log_stream(spark: SparkSession, landing_dir: str, kind: str, first_date: str = FIRST_DATE,
               max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of cleaned rows of one log kind from a landing folder."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.load(landing_dir).select(decoded(F.col("value"), kind).alias("line"), F.col("_metadata.file_name").alias("_file"))
    raw = raw.where(keep_file(F.col("_file"), kind, first_date))
    return parse_lines(raw, kind, date_text=file_date(F.col("_file")))


def archive_stream(spark: SparkSession, landing_dir: str, kind: str, first_date: str = FIRST_DATE,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """The same from ``tar.gz`` archives: Spark notes which have been read, tasks open new ones by path and stream them.  A damaged archive fails its batch."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return archive_rows(expand_archives(archive_files(reader, landing_dir, kind, first_date).select("path"), kind), kind)


def ingest(spark: SparkSession, landing_dir: str, kind: str, table_dir: str, checkpoint_dir: str,
           first_date: str = FIRST_DATE, available_now: bool = True, archives: bool = False) -> StreamingQuery:
    """Append new files of ``kind`` (text logs, or ``archives``) to a date-partitioned parquet table (exactly once per file)."""
    stream = (archive_stream if archives else log_stream)(spark, landing_dir, kind, first_date)
    writer = (stream.writeStream.format("parquet").outputMode("append")
                    .option("checkpointLocation", checkpoint_dir).partitionBy("date"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start(table_dir)


def daily_counts(stream: DataFrame) -> DataFrame:
    """Rows per day of a log stream (K4's daily count), maintained incrementally in complete mode."""
    return stream.groupBy("date").agg(F.count(F.lit(1)).alias("n"))


def ingest_events(spark: SparkSession, landing: dict, table_dir: str, checkpoint_dir: str,
                  first_date: str = FIRST_DATE, available_now: bool = True) -> StreamingQuery:
    """U2 incrementally: the three kinds' new files, unioned into the unified event log table.

    ``landing`` maps 'play' / 'down' / 'search' to their landing folders.
    """
    ev = unify(log_stream(spark, landing["play"], "play", first_date),
               log_stream(spark, landing["down"], "down", first_date),
               log_stream(spark, landing["search"], "search", first_date))
    writer = (ev.writeStream.format("parquet").outputMode("append")
                .option("checkpointLocation", checkpoint_dir).partitionBy("date"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start(table_dir)
