"""Modelled population and churn label."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunetrail.functions.dates import Windows, in_range


def _activity(events: DataFrame, activity_events: Sequence[str] | None) -> DataFrame:
    return events if not activity_events else events.where(F.col("event").isin(list(activity_events)))


def model_population(events: DataFrame, w: Windows, activity_events: Sequence[str] | None = None) -> DataFrame:
    """M3: distinct users active in the feature window."""
    return (_activity(events, activity_events)
            .where(in_range("date", w.feature_start, w.feature_end))
            .select("uid").distinct())


def active_in_label_window(events: DataFrame, w: Windows,
                           activity_events: Sequence[str] | None = None) -> DataFrame:
    return (_activity(events, activity_events)
            .where(in_range("date", w.label_start, w.label_end))
            .select("uid").distinct().withColumn("label", F.lit(0)))


def churn_label(events: DataFrame, w: Windows, activity_events: Sequence[str] | None = None) -> DataFrame:
    """M2: population left-joined with label-window actives; absent -> churned (1).

    Expressed as one aggregate over both windows: a single scan and a single
    shuffle on uid with map-side partial aggregation, so a user holding a
    large share of rows costs one partial row per task.
    """
    ev = _activity(events, activity_events).where(in_range("date", w.feature_start, w.label_end))
    return (ev.groupBy("uid")
              .agg(F.max(in_range("date", w.feature_start, w.feature_end).cast("int")).alias("in_feature"),
                   F.max(in_range("date", w.label_start, w.label_end).cast("int")).alias("in_label"))
              .where(F.col("in_feature") == 1)
              .select("uid", (F.lit(1) - F.col("in_label")).cast("int").alias("label")))


def churn_label_by_join(events: DataFrame, w: Windows,
                        activity_events: Sequence[str] | None = None) -> DataFrame:
    """M2 as the reference writes it: distinct population LEFT JOIN distinct actives, fill 1."""
    pop = model_population(events, w, activity_events)
    act = active_in_label_window(events, w, activity_events)
    return (pop.join(act, "uid", "left").na.fill({"label": 1})
               .select("uid", F.col("label").cast("int").alias("label")))


def label_balance(label: DataFrame) -> DataFrame:
    """A8 on the label."""
    return label.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
