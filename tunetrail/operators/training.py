"""Training table assembly."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunetrail.functions.dates import Windows, in_range
from tunetrail.functions.exprs import EVENT_CODES, PLAY, in_hash_sample
from tunetrail.operators import features as fx
from tunetrail.operators.label import churn_label_by_join


def table_columns(w: Windows) -> list[str]:
    return ["uid", "label", *fx.feature_columns(w)]


def training_table(events: DataFrame, w: Windows, activity_events: Sequence[str] | None = None,
                   recency_fill: int | None = None) -> DataFrame:
    """M5, fused: label and every feature from ONE aggregate over the label+feature range.

    Physical plan: one parquet scan with the date range pushed, one partial
    HashAggregate, one exchange on uid, one final HashAggregate.  Missing
    features are 0 (the reference's intended ``fillna(0)``); ``recency_fill``
    may give a never-seen event another default (X37).
    """
    act = F.col("event").isin(list(activity_events)) if activity_events else F.lit(True)
    feat = in_range("date", w.feature_start, w.feature_end)
    lab = in_range("date", w.label_start, w.label_end)
    ev = events.where(in_range("date", w.feature_start, w.label_end))
    # Rows outside the feature window only feed the label flag; the feature
    # aggregates below all test a trailing window ending at the snapshot.
    agg = (ev.groupBy("uid")
             .agg(F.max((act & feat).cast("int")).alias("_in_feature"),
                  F.max((act & lab).cast("int")).alias("_in_label"),
                  *fx.frequency_aggs(w), *fx.recency_aggs(w), *fx.play_time_aggs(w),
                  *fx.play_ratio_aggs(w), fx.device_agg(w))
             .where(F.col("_in_feature") == 1)
             .withColumn("label", (F.lit(1) - F.col("_in_label")).cast("int")))
    return fill_features(agg.select(*table_columns(w)), w, recency_fill)


def fill_features(df: DataFrame, w: Windows, recency_fill: int | None) -> DataFrame:
    fill = {c: 0 for c in fx.feature_columns(w)}
    if recency_fill is not None:
        fill.update({fx.rec_name(e): recency_fill for e in fx.RECENCY_ORDER})
    return df.na.fill(fill)


def left_join_features(master: DataFrame, *feature_lists: Sequence[DataFrame]) -> DataFrame:
    """Fold LEFT JOINs of many per-user feature tables onto ``master``."""
    return reduce(lambda acc, f: acc.join(f, "uid", "left"), [f for fl in feature_lists for f in fl], master)


def training_table_chained(events: DataFrame, w: Windows, activity_events: Sequence[str] | None = None,
                           recency_fill: int | None = None) -> DataFrame:
    """M5 as the reference builds it: label, then 3 + 3 + n + n + 1 left joins, then fill.

    Same rows as :func:`training_table`; kept as a parity check.  Its plan
    holds one aggregate and one join per feature table, so it is not the
    production path.
    """
    label = churn_label_by_join(events, w, activity_events)
    feat_events = events.where(in_range("date", w.feature_start, w.feature_end))
    plays = feat_events.where(F.col("event") == PLAY)
    freq = [fx.frequency_windows(feat_events, e, w) for e in EVENT_CODES]
    rec = [fx.recency(feat_events, e, w) for e in fx.RECENCY_ORDER]
    tt = [fx.total_play_time(plays, n, w.snapshot) for n in w.sub_windows]
    pp = [fx.play_ratio(plays, n, w.snapshot) for n in w.sub_windows]
    table = left_join_features(label, freq, rec, tt, pp)
    table = table.join(fx.device_profile(plays, w), "uid", "left")
    return fill_features(table.select(*table_columns(w)), w, recency_fill)


def device_dummies(table: DataFrame) -> DataFrame:
    """P10: device_type -> device_type_1, device_type_2 (null gives 0, 0)."""
    return (table.withColumn("device_type_1", F.when(F.col("device_type") == 1, 1).otherwise(0))
                 .withColumn("device_type_2", F.when(F.col("device_type") == 2, 1).otherwise(0)))


def model_feature_names(table: DataFrame) -> list[str]:
    """Every column but uid, label and device_type, plus the two dummies."""
    with_d = device_dummies(table)
    return [c for c in with_d.columns if c not in ("uid", "label", "device_type", "split")]


# Share of users held out, and the salt of the split draw.
TEST_SHARE = 0.2
SPLIT_SALT = "split"


def train_test_split(table: DataFrame, test_share: float = TEST_SHARE, salt: str = SPLIT_SALT) -> DataFrame:
    """M6: deterministic 80/20 split on a hash of uid (stable under any partitioning)."""
    return table.withColumn("split", F.when(in_hash_sample("uid", test_share, salt), "test").otherwise("train"))


def model_input(table: DataFrame, features_col: str = "features") -> DataFrame:
    """Dummies + VectorAssembler -> (uid, label, features)."""
    from pyspark.ml.feature import VectorAssembler

    names = model_feature_names(table)
    casted = device_dummies(table).select("uid", F.col("label").cast("double").alias("label"),
                                          *[F.col(c).cast("double").alias(c) for c in names],
                                          *(["split"] if "split" in table.columns else []))
    return VectorAssembler(inputCols=names, outputCol=features_col).transform(casted)


def write_training_table(table: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K3: written by the executors as parquet -- never through the driver."""
    table.write.mode(mode).parquet(path)
