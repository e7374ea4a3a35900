"""Classification metrics on a scored table (uid, label, p, split).

Exact ROC AUC uses the Mann-Whitney form with mid-ranks.  Ranks need a
prefix count over the score order; instead of one window over every score
of a split (one task), scores are reduced to distinct values and dealt by
ranges; see :func:`score_groups`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunetrail.session import cut_lineage

# Fixed value: a score above this is the positive class.
THRESHOLD = 0.5


def predicted_class(p: str = "p", threshold: float = THRESHOLD):
    """F13."""
    return (F.col(p) > F.lit(threshold)).cast("int")


def confusion_metrics(scored: DataFrame, threshold: float = THRESHOLD, by: str = "split") -> DataFrame:
    """Accuracy, precision, recall, F1 per split; a zero denominator gives 0."""
    yhat = predicted_class("p", threshold)
    y = F.col("label")
    agg = scored.groupBy(by).agg(
        F.count_if((yhat == 1) & (y == 1)).alias("tp"), F.count_if((yhat == 1) & (y == 0)).alias("fp"),
        F.count_if((yhat == 0) & (y == 1)).alias("fn"), F.count_if((yhat == 0) & (y == 0)).alias("tn"))

    def ratio(n, d):
        return F.coalesce(F.try_divide(n.cast("double"), d.cast("double")), F.lit(0.0))

    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return agg.select(by, "tp", "fp", "fn", "tn",
                      ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
                      ratio(tp, tp + fp).alias("precision"),
                      ratio(tp, tp + fn).alias("recall"),
                      ratio(2 * tp, 2 * tp + fp + fn).alias("f1"))


def score_groups(scored: DataFrame, by: str, parts: int | None = None) -> DataFrame:
    """Distinct scores per split with positive/negative counts, their range partition and their number of strictly
    lower-scored rows (neg_below/pos_below).

    The distinct scores are dealt by ranges of (split, score), whatever their distribution, and written with their
    partition; a window inside each partition gives the prefix, a window over the partitions' totals the offset.
    """
    g = (scored.groupBy(by, "p").agg(F.count_if(F.col("label") == 1).alias("pos"),
                                      F.count_if(F.col("label") != 1).alias("neg")))
    n = parts or int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    g = cut_lineage(g.repartitionByRange(n, by, "p").withColumn("part", F.spark_partition_id()))
    tot = g.groupBy(by, "part").agg(F.sum("pos").alias("bpos"), F.sum("neg").alias("bneg"))
    wb = Window.partitionBy(by).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    tot = tot.select(by, "part", F.coalesce(F.sum("bpos").over(wb), F.lit(0)).alias("opos"),
                     F.coalesce(F.sum("bneg").over(wb), F.lit(0)).alias("oneg"))
    wi = Window.partitionBy(by, "part").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    g = g.select(by, "p", "pos", "neg", "part",
                 F.coalesce(F.sum("pos").over(wi), F.lit(0)).alias("ipos"),
                 F.coalesce(F.sum("neg").over(wi), F.lit(0)).alias("ineg"))
    return (g.join(tot, [by, "part"])
             .select(by, "p", "pos", "neg", "part", (F.col("ipos") + F.col("opos")).alias("pos_below"),
                     (F.col("ineg") + F.col("oneg")).alias("neg_below")))


def roc_auc(scored: DataFrame, by: str = "split", parts: int | None = None) -> DataFrame:
    """AUC = P(score of a positive > score of a negative) + P(tie) / 2."""
    g = score_groups(scored, by, parts)
    return (g.groupBy(by)
             .agg(F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") / 2.0)).alias("u"),
                  F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))
             .select(by, F.coalesce(F.try_divide(F.col("u"), (F.col("n_pos") * F.col("n_neg")).cast("double")),
                                    F.lit(0.0)).alias("auc")))


def roc_curve(scored: DataFrame, by: str = "split", parts: int | None = None) -> DataFrame:
    """One point per distinct score: rates of rows scoring at least that threshold."""
    g = score_groups(scored, by, parts)
    tot = g.groupBy(by).agg(F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))
    g = g.join(tot, by)
    tp = F.col("n_pos") - F.col("pos_below")
    fp = F.col("n_neg") - F.col("neg_below")
    return g.select(by, F.col("p").alias("threshold"),
                    F.coalesce(F.try_divide(tp.cast("double"), F.col("n_pos").cast("double")), F.lit(0.0)).alias("tpr"),
                    F.coalesce(F.try_divide(fp.cast("double"), F.col("n_neg").cast("double")), F.lit(0.0)).alias("fpr"))


def classification_report(scored: DataFrame, threshold: float = THRESHOLD, by: str = "split") -> DataFrame:
    """A25 + W4 side by side for each split (the reference's train/test table)."""
    return confusion_metrics(scored, threshold, by).join(roc_auc(scored, by), by)
