"""Per-user behaviour features over trailing windows.

Two forms are offered:

* the reference's shape -- one small aggregate per (event, window) or per
  family, later left-joined one by one (``chained_*``), kept for parity
  tests;
* the fused form (:func:`feature_columns`) -- every frequency, recency,
  play-time, play-ratio and device column as a conditional aggregate of a
  single ``groupBy('uid')``.  Catalyst does not merge aggregates over
  different filters, so this is done here: one scan of the event log and
  one shuffle on uid, with map-side partial aggregation (a hot user
  collapses to one partial row per task before the exchange).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunetrail.functions.dates import Windows, in_range, trailing
from tunetrail.functions.exprs import EVENT_CODES, PLAY, device_type, safe_ratio

# Fixed value: a song counts as "played enough" above this share of its length.
PLAYED_ENOUGH = 0.8
# Fixed value: recency columns come in this order.
RECENCY_ORDER = ("S", "D", "P")


def freq_name(event: str, w: int) -> str:
    return f"freq_{event}_last_{w}"


def rec_name(event: str) -> str:
    return f"rec_{event}"


def time_name(w: int) -> str:
    return f"total_time_last_{w}"


def perc_name(w: int) -> str:
    return f"play_perc_in_last{w}"


# ---------------------------------------------------------------- fused form

def frequency_aggs(w: Windows, events: Sequence[str] = EVENT_CODES) -> list[Column]:
    """Count of each event in each trailing window (zero, not null, when none)."""
    s = w.snapshot
    return [F.count_if((F.col("event") == e) & trailing("date", s, n)).alias(freq_name(e, n))
            for e in events for n in w.sub_windows]


def recency_aggs(w: Windows, events: Sequence[str] = RECENCY_ORDER) -> list[Column]:
    """A13 (X10 fixed): days from the last event of each kind inside the feature window to the snapshot."""
    feat = in_range("date", w.feature_start, w.feature_end)
    return [F.datediff(F.lit(w.snapshot), F.max(F.when((F.col("event") == e) & feat, F.col("date"))))
            .alias(rec_name(e)) for e in events]


def play_time_aggs(w: Windows) -> list[Column]:
    """Seconds played per trailing window (null when no play; filled later)."""
    return [F.sum(F.when((F.col("event") == PLAY) & trailing("date", w.snapshot, n), F.col("play_time")))
            .alias(time_name(n)) for n in w.sub_windows]


def play_ratio_aggs(w: Windows) -> list[Column]:
    """A15 (X13 fixed): plays longer than 80 % of the song per trailing window."""
    enough = safe_ratio("play_time", "song_length") > PLAYED_ENOUGH
    return [F.count_if((F.col("event") == PLAY) & trailing("date", w.snapshot, n) & enough)
            .alias(perc_name(n)) for n in w.sub_windows]


def device_agg(w: Windows) -> Column:
    """M4 (X11 fixed): one device_type per user: 1 if any play on 'ip' in the feature window, else 2."""
    feat = in_range("date", w.feature_start, w.feature_end)
    return F.min(F.when((F.col("event") == PLAY) & feat, device_type("device"))).alias("device_type")


def feature_columns(w: Windows) -> list[str]:
    cols = [freq_name(e, n) for e in EVENT_CODES for n in w.sub_windows]
    cols += [rec_name(e) for e in RECENCY_ORDER]
    cols += [time_name(n) for n in w.sub_windows]
    cols += [perc_name(n) for n in w.sub_windows]
    return cols + ["device_type"]


def frequency_single(events: DataFrame, event: str, window: int, snapshot) -> DataFrame:
    """A11 (method 1): users with at least one ``event`` in the window and their count."""
    return (events.where((F.col("event") == event) & trailing("date", snapshot, window))
                  .groupBy("uid").agg(F.count("uid").alias(freq_name(event, window))))


def frequency_windows(events: DataFrame, event: str, w: Windows) -> DataFrame:
    """A12 (method 2): users having ``event`` in the feature window, a column per window."""
    ev = events.where((F.col("event") == event) & in_range("date", w.feature_start, w.feature_end))
    return ev.groupBy("uid").agg(*frequency_aggs(w, [event]))


def recency(events: DataFrame, event: str, w: Windows) -> DataFrame:
    ev = events.where((F.col("event") == event) & in_range("date", w.feature_start, w.feature_end))
    return ev.groupBy("uid").agg(F.datediff(F.lit(w.snapshot), F.max("date")).alias(rec_name(event)))


def last_event(events: DataFrame, event: str, w: Windows) -> DataFrame:
    """Kinds of events a user had (a set of at most three) and the latest date of ``event``.

    The reference collects every date into a list and sorts it; the latest
    element of a sorted list is ``max``, which aggregates partially instead of
    gathering a user's whole history into one task.
    """
    ev = events.where(in_range("date", w.feature_start, w.feature_end))
    return (ev.groupBy("uid")
              .agg(F.sort_array(F.collect_set("event")).alias("events"),
                   F.max(F.when(F.col("event") == event, F.col("date"))).alias("last_date"))
              .withColumn(rec_name(event), F.datediff(F.lit(w.snapshot), F.col("last_date"))))


def total_play_time(plays: DataFrame, window: int, snapshot) -> DataFrame:
    return (plays.where(trailing("date", snapshot, window))
                 .groupBy("uid").agg(F.sum("play_time").alias(time_name(window))))


def play_ratio(plays: DataFrame, window: int, snapshot) -> DataFrame:
    enough = safe_ratio("play_time", "song_length") > PLAYED_ENOUGH
    return (plays.where(trailing("date", snapshot, window))
                 .groupBy("uid").agg(F.count_if(enough).alias(perc_name(window))))


def distinct_user_device(plays: DataFrame, w: Windows) -> DataFrame:
    """The reference's profile base: distinct (uid, device) in the feature window (several rows per multi-device user)."""
    return plays.where(in_range("date", w.feature_start, w.feature_end)).select("uid", "device").distinct()


def device_profile(plays: DataFrame, w: Windows) -> DataFrame:
    """M4: one row per uid."""
    return (plays.where(in_range("date", w.feature_start, w.feature_end))
                 .groupBy("uid").agg(F.min(device_type("device")).alias("device_type")))


def users_multi_device(plays: DataFrame, w: Windows) -> DataFrame:
    """X11 detector: users with more than one device in the feature window."""
    return (distinct_user_device(plays, w).groupBy("uid").agg(F.count(F.lit(1)).alias("n_devices"))
            .where(F.col("n_devices") > 1))


def device_profile_fanout(population: DataFrame, plays: DataFrame, w: Windows) -> DataFrame:
    """The reference's profile join: population LEFT JOIN distinct (uid, device_type); counts per type.

    A user with two devices contributes two rows -- the defect the one-row
    profile fixes; this query measures it.
    """
    prof = distinct_user_device(plays, w).select("uid", device_type("device").alias("device_type"))
    return (population.select("uid").join(prof, "uid", "left")
            .groupBy("device_type").agg(F.count(F.lit(1)).alias("n")))
