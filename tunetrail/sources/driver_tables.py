"""Map the driver's parquet tables onto the player-log data model.

``events`` stands in for the three logs: purchase -> play (P), click ->
download (D), view -> search (S); the integer ``k`` of ``props`` is the song,
``value`` the seconds played, ``k`` also the song length, and the parity of
``k`` the device.  ``orders`` x ``lineitem`` gives a rated user-song table
(customer, part, summed quantity) and ``part.p_name`` the song names.

Every reader returns a lazy DataFrame over the parquet scan, so column
pruning and date predicates reach the files.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunetrail.functions.exprs import DOWNLOAD, PLAY, SEARCH
from tunetrail.session import spread

# event_type -> event code.
EVENT_TYPE_CODES = {"purchase": PLAY, "click": DOWNLOAD, "view": SEARCH}

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _song_key() -> F.Column:
    return F.get_json_object("props", "$.k").try_cast("bigint")


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unified event log: uid, event, song_id, date, device, play_time, song_length.

    song_id is null for searches (the search log has none); play_time and
    song_length exist for plays only.
    """
    ev = table(spark, sf_dir, "events")
    code = F.lit(None).cast("string")
    for etype, c in EVENT_TYPE_CODES.items():
        code = F.when(F.col("event_type") == etype, F.lit(c)).otherwise(code)
    k = _song_key()
    is_play = F.col("event_type") == "purchase"
    return (ev.where(F.col("event_type").isin(list(EVENT_TYPE_CODES)))
              .select(F.col("user_id").alias("uid"),
                      code.alias("event"),
                      F.when(F.col("event_type") != "view", k).alias("song_id"),
                      F.col("ts").cast("date").alias("date"),
                      F.when(k % 2 == 0, "ip").otherwise("ar").alias("device"),
                      F.when(is_play, F.col("value")).alias("play_time"),
                      F.when(is_play, k.cast("double")).alias("song_length")))


def play_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned play table: uid, device, song_id, date, play_time, song_length."""
    return (event_log(spark, sf_dir).where(F.col("event") == PLAY)
            .select("uid", "device", "song_id", "date", "play_time", "song_length"))


def down_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (event_log(spark, sf_dir).where(F.col("event") == DOWNLOAD)
            .select("uid", "device", "song_id", "date"))


def search_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (event_log(spark, sf_dir).where(F.col("event") == SEARCH)
            .select("uid", "device", "date"))


def song_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """song_id -> song_name from ``part``."""
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("song_id"),
                                               F.col("p_name").alias("song_name"))


def song_touches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Small recommender source: every event with its song k (any type), named from ``part``.

    On the driver's data plays alone are too sparse for the active-user rule
    (more than 5 plays in 6 days), so each event touching a song counts as a
    listen, as in SURVEY §7.4.
    """
    ev = table(spark, sf_dir, "events").select(F.col("user_id").alias("uid"), _song_key().alias("song_id"),
                                               F.col("ts").cast("date").alias("date"))
    return ev.join(song_names(spark, sf_dir), "song_id", "left")


def pair_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(uid, song_id, counts) = customer, part, summed quantity.

    The order join and the sum run in as many partitions as the line items need (their number comes from the files'
    footers), so the sort and the hash table of a task don't grow with the table.
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    rows = li.count()
    bought = (spread(li, rows, "l_orderkey").join(od, F.col("l_orderkey") == F.col("o_orderkey"))
              .select(F.col("o_custkey").alias("uid"), F.col("l_partkey").alias("song_id"), "l_quantity"))
    return spread(bought, rows, "uid", "song_id").groupBy("uid", "song_id").agg(F.sum("l_quantity").cast("bigint").alias("counts"))


def purchase_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rated source: (uid, song_id, song_name, counts).

    The part name is joined after the aggregate so that the wide name column is not shuffled
    with every line item.
    """
    return (pair_counts(spark, sf_dir).join(song_names(spark, sf_dir), "song_id", "left")
            .select("uid", "song_id", "song_name", "counts"))
