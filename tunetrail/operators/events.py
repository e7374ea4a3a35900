"""Unified event log from the three cleaned logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunetrail.functions.exprs import DOWNLOAD, PLAY, SEARCH

EVENT_COLUMNS = ("uid", "event", "song_id", "date")


def tag(log: DataFrame, code: str) -> DataFrame:
    """Append the constant event code."""
    return log.withColumn("event", F.lit(code))


def unify(play: DataFrame, down: DataFrame, search: DataFrame) -> DataFrame:
    """UNION ALL by name of the tagged logs; search has no song_id, which becomes null."""
    parts = [tag(play.select("uid", "song_id", "date"), PLAY),
             tag(down.select("uid", "song_id", "date"), DOWNLOAD),
             tag(search.select("uid", "date"), SEARCH)]
    out = parts[0].unionByName(parts[1]).unionByName(parts[2], allowMissingColumns=True)
    return out.select(*EVENT_COLUMNS)


def write_partitioned(df: DataFrame, path: str, mode: str = "overwrite",
                      max_records_per_file: int = 5_000_000) -> None:
    """K1/K2: parquet partitioned by date, so date predicates prune whole folders.

    A rebalance on date brings the rows of a day together, in as many parts
    as its size needs (AQE splits the large ones), so there are few files and
    no day is one task.  ``max_records_per_file`` bounds a file.
    """
    (df.hint("rebalance", "date").sortWithinPartitions("date").write.mode(mode)
       .option("maxRecordsPerFile", max_records_per_file).partitionBy("date").parquet(path))


def write_bucketed(df: DataFrame, table: str, path: str, buckets: int) -> DataFrame:
    """K2: the events as an external table at ``path``, hashed by uid into ``buckets`` sorted buckets; the table, read back.

    Whatever is then grouped by uid (label, features, training table) reads a user's rows in one task and needs no
    exchange.  The exchange is paid once, here; a bucket holds all of a user's rows, so a user with a large share of
    the log makes a large bucket, which is streamed through a partial aggregate.
    """
    (df.repartition(buckets, "uid").write.mode("overwrite").bucketBy(buckets, "uid").sortBy("uid")
       .option("path", path).format("parquet").saveAsTable(table))
    return df.sparkSession.table(table)
