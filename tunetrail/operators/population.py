"""Plays per user, bot cut and repeatable user sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunetrail.functions.exprs import in_hash_sample

# Bot cut at the 99.9th percentile of plays per user (kept
# strictly below it), and a 10 % sample of users.
BOT_PERCENTILE = 0.999
SAMPLE_RATIO = 0.1
SAMPLE_SALT = ""


def plays_per_user(plays: DataFrame) -> DataFrame:
    """A1/K5: (uid, n_plays).  One shuffle on uid with map-side partial counts."""
    return plays.where(F.col("uid").isNotNull()).groupBy("uid").agg(F.count(F.lit(1)).alias("n_plays"))


def plays_percentile(per_user: DataFrame, q: float = BOT_PERCENTILE) -> DataFrame:
    """A4: exact percentile with linear interpolation (numpy's default) as a one-row table.

    The aggregate state is a value -> frequency map, bounded by the number
    of distinct play counts rather than by the number of users.
    """
    return per_user.agg(F.percentile("n_plays", q).alias("threshold"))


def bots_removed(per_user: DataFrame, q: float = BOT_PERCENTILE) -> DataFrame:
    """users strictly below the percentile (null uid dropped).

    The threshold is a scalar subquery: Spark evaluates the one-row
    aggregate once and filters with its value, nothing passes through the
    driver and no join is planned.
    """
    thr = plays_percentile(per_user, q)
    return per_user.where(F.col("uid").isNotNull() & (F.col("n_plays") < thr.scalar()))


def log_histogram(per_user: DataFrame, width: float = 0.2, top: float = 4.8) -> DataFrame:
    """A5: histogram of log10(plays) with bins of ``width`` on [0, top], last bin closed."""
    per_unit = int(round(1 / width))  # bins per decade, an integer so the product is exact
    last = int(round(top * per_unit)) - 1
    lg = F.log10(F.col("n_plays").cast("double"))
    return (per_user.where((lg >= 0) & (lg <= top))
                    .select(F.least(F.floor(lg * F.lit(per_unit)), F.lit(last)).cast("int").alias("bin"))
                    .groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
                    .withColumn("bin_start", F.round(F.col("bin") / F.lit(float(per_unit)), 6)))


def hash_sample(users: DataFrame, ratio: float = SAMPLE_RATIO, salt: str = SAMPLE_SALT) -> DataFrame:
    """F5 (X1 fixed): repeatable sample of users by a hash of uid."""
    return users.where(in_hash_sample("uid", ratio, salt))


def sampled_users(plays: DataFrame, ratio: float = SAMPLE_RATIO, q: float = BOT_PERCENTILE,
                  salt: str = SAMPLE_SALT) -> DataFrame:
    """Bot cut then sample: the id subset of the reference, as a table."""
    return hash_sample(bots_removed(plays_per_user(plays), q), ratio, salt).select("uid")


def sample_by_users(log: DataFrame, users: DataFrame, ratio: float = SAMPLE_RATIO,
                    salt: str = SAMPLE_SALT) -> DataFrame:
    """Keep log rows of sampled users.

    The hash draw is applied row-wise first (no join needed for it, and it
    drops ~90 % of rows before any exchange); the semi join against the kept
    users then enforces the bot cut.  Spark chooses the join by its byte
    threshold and at run time (AQE, with skew splitting); there is no hint.
    """
    return log.where(in_hash_sample("uid", ratio, salt)).join(users, "uid", "left_semi")
