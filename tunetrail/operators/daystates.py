"""Mergeable day states: one partial state per (uid, day), from which every window of every snapshot is merged.

The fused training table reads the raw events of its whole range at each
snapshot.  Here a day's events are aggregated once, when the day arrives; a
snapshot merges at most one small row per user and day.  Counts and sums add,
the device type is a minimum, recency is the latest day with an event of its kind, so merged
states give what the events would.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunetrail.functions.dates import Windows, in_range, trailing
from tunetrail.functions.exprs import EVENT_CODES, PLAY, device_type, safe_ratio
from tunetrail.operators import features as fx
from tunetrail.operators.training import fill_features, table_columns


def day_states(events: DataFrame) -> DataFrame:
    """(uid, date, n_any, n_<event>..., seconds, n_enough, device_type): rows without a uid or date keep a state of their own."""
    play = F.col("event") == PLAY
    return events.groupBy("uid", "date").agg(
        F.count(F.lit(1)).alias("n_any"), *[F.count_if(F.col("event") == e).alias(f"n_{e}") for e in EVENT_CODES],
        F.sum(F.when(play, F.col("play_time"))).alias("seconds"),
        F.count_if(play & (safe_ratio("play_time", "song_length") > fx.PLAYED_ENOUGH)).alias("n_enough"),
        F.min(F.when(play, device_type("device"))).alias("device_type"))


def write_day_states(events: DataFrame, path: str) -> None:
    """Write the states of the days in ``events``, partitioned by date.  A day written again replaces that day only, so a
    repeated or late run changes nothing else; ``events`` has to hold whole days."""
    (day_states(events).hint("rebalance", "date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("date").parquet(path))


def _count(name: str, snapshot, days: int) -> Column:
    return F.coalesce(F.sum(F.when(trailing("date", snapshot, days), F.col(name))), F.lit(0)).cast("long")


def training_table_from_states(states: DataFrame, w: Windows, activity_events: Sequence[str] | None = None,
                               recency_fill: int | None = None) -> DataFrame:
    """M5 for any windows ``w``, merged from the states of the days in its range; the rows of :func:`training.training_table`."""
    active = sum((F.col(f"n_{e}") for e in activity_events), F.lit(0)) > 0 if activity_events else F.col("n_any") > 0
    feat, lab = in_range("date", w.feature_start, w.feature_end), in_range("date", w.label_start, w.label_end)
    s, subs = w.snapshot, w.sub_windows
    merged = (states.where(in_range("date", w.feature_start, w.label_end)).groupBy("uid")
              .agg(F.max((active & feat).cast("int")).alias("_in_feature"), F.max((active & lab).cast("int")).alias("_in_label"),
                   *[_count(f"n_{e}", s, n).alias(fx.freq_name(e, n)) for e in EVENT_CODES for n in subs],
                   *[F.datediff(F.lit(s), F.max(F.when(feat & (F.col(f"n_{e}") > 0), F.col("date")))).alias(fx.rec_name(e)) for e in fx.RECENCY_ORDER],
                   *[F.sum(F.when(trailing("date", s, n), F.col("seconds"))).alias(fx.time_name(n)) for n in subs],
                   *[_count("n_enough", s, n).alias(fx.perc_name(n)) for n in subs],
                   F.min(F.when(feat, F.col("device_type"))).alias("device_type"))
              .where(F.col("_in_feature") == 1)
              .withColumn("label", (F.lit(1) - F.col("_in_label")).cast("int")))
    return fill_features(merged.select(*table_columns(w)), w, recency_fill)
