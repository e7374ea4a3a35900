"""Interaction set and implicit ratings."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunetrail.functions.exprs import rating_bin

# The reference's recommender window (after 2017-05-06, up to
# 2017-05-12), active user (> 5 plays) and popular song (> 30 plays).
REC_AFTER = dt.date(2017, 5, 6)
REC_UNTIL = dt.date(2017, 5, 12)
MIN_USER_PLAYS = 5
MIN_SONG_PLAYS = 30


def window_plays(plays: DataFrame, after, until) -> DataFrame:
    """F11 + F10: rows with all of uid, song_id, song_name, date; date in (after, until]."""
    cols = ["uid", "song_id", "song_name", "date"]
    return (plays.select(*cols).na.drop("any")
                 .where((F.col("date") > F.lit(after)) & (F.col("date") <= F.lit(until))))


def active_users(plays: DataFrame, min_plays: int = MIN_USER_PLAYS) -> DataFrame:
    """Users with more than ``min_plays`` plays."""
    return (plays.groupBy("uid").agg(F.count(F.lit(1)).alias("plays"))
                 .where(F.col("plays") > min_plays))


def popular_songs(plays: DataFrame, min_plays: int = MIN_SONG_PLAYS) -> DataFrame:
    """Songs with more than ``min_plays`` plays."""
    return (plays.groupBy("song_id").agg(F.count(F.lit(1)).alias("plays"))
                 .where(F.col("plays") > min_plays))


def interactions(plays: DataFrame, after=REC_AFTER, until=REC_UNTIL, min_user_plays: int = MIN_USER_PLAYS,
                 min_song_plays: int = MIN_SONG_PLAYS) -> DataFrame:
    """G1: window, active users (J6), then popular songs counted AFTER the user cut."""
    w = window_plays(plays, after, until)
    kept = _kept_counts(w, min_user_plays, min_song_plays)
    return w.join(kept.select("uid", "song_id").distinct(), ["uid", "song_id"], "left_semi").select("uid", "song_id", "song_name", "date")


def _kept_counts(w: DataFrame, min_user_plays: int, min_song_plays: int) -> DataFrame:
    """(uid, song_id, song_name, counts) of the windowed plays that pass both cuts: the log is aggregated first, and the
    users' and the songs' cuts are made on that small table."""
    c = play_counts(w)
    users = c.groupBy("uid").agg(F.sum("counts").alias("n")).where(F.col("n") > min_user_plays)
    by_user = c.join(users.select("uid"), "uid", "left_semi")
    songs = by_user.groupBy("song_id").agg(F.sum("counts").alias("n")).where(F.col("n") > min_song_plays)
    return by_user.join(songs.select("song_id"), "song_id", "left_semi").select("uid", "song_id", "song_name", "counts")


def interaction_counts(plays: DataFrame, after=REC_AFTER, until=REC_UNTIL, min_user_plays: int = MIN_USER_PLAYS,
                       min_song_plays: int = MIN_SONG_PLAYS) -> DataFrame:
    """G1 + A18 without going back to the log: plays per (uid, song_id, song_name) of the interaction set."""
    return _kept_counts(window_plays(plays, after, until), min_user_plays, min_song_plays)


def play_counts(inter: DataFrame) -> DataFrame:
    """Plays per (uid, song_id, song_name)."""
    return inter.groupBy("uid", "song_id", "song_name").agg(F.count(F.lit(1)).alias("counts"))


def ratings(counts: DataFrame) -> DataFrame:
    """Counts -> like in 1..5 by right-closed bins."""
    return counts.withColumn("like", rating_bin("counts"))


def utility(rated: DataFrame) -> DataFrame:
    """A19 (X26 fixed) long form: mean like per (uid, song_id) -- the utility matrix without a pivot."""
    return rated.groupBy("uid", "song_id").agg(F.avg("like").alias("rating"))


def utility_pivot(util: DataFrame, song_ids: list) -> DataFrame:
    """A19 wide form for a small, explicit list of songs (demo / export only; fill 0)."""
    return (util.groupBy("uid").pivot("song_id", song_ids).agg(F.first("rating")).na.fill(0.0))


def song_names(rated: DataFrame) -> DataFrame:
    """One deterministic name per song (the smallest)."""
    return rated.groupBy("song_id").agg(F.min("song_name").alias("song_name"))
