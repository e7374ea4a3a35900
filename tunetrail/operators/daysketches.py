"""One sketch per day for questions over any range of days (A7, A17): written once a day, merged at the question.

Distinct users: a theta sketch for each (date, event kind).  Sketches unite over
days, intersect and subtract, so users of a range, users who came back and users
who left need no log.  Up to ``2**LOG_ENTRIES`` users a sketch holds them all
and the numbers are exact; beyond, an estimate's relative standard error is about
``2 ** (-LOG_ENTRIES / 2)``.

Heavy keys: Misra-Gries counters, ``1 / share * SPARE`` a day at most.  A summary
of n rows and m counters counts a key too low by at most n / (m + 1), and so does the
sum of summaries over their rows together; so every key of more than ``share`` of a range's rows is
a candidate, and candidates are counted exactly.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunetrail.functions.dates import in_range

LOG_ENTRIES = 16  # a sketch holds up to 2**16 hashes: half a MB
SPARE = 4         # counters of a day, in multiples of the least number that finds every heavy key

Range = tuple[dt.date, dt.date]


def day_sketches(events: DataFrame, log_entries: int = LOG_ENTRIES) -> DataFrame:
    """(date, event, n, users): rows and a theta sketch of the users of each day and event kind; null users are in n only."""
    return events.groupBy("date", "event").agg(F.count(F.lit(1)).alias("n"), F.theta_sketch_agg("uid", log_entries).alias("users"))


def write_day_sketches(events: DataFrame, path: str, log_entries: int = LOG_ENTRIES, mode: str = "append") -> None:
    """The sketches of the days in ``events``; a new day is appended.  A day must be written whole and once."""
    day_sketches(events, log_entries).write.mode(mode).partitionBy("date").parquet(path)


def _united(sketches: DataFrame, within: Column, log_entries: int) -> Column:
    return F.theta_union_agg(F.when(within, F.col("users")), log_entries)


def _number(sketch: Column) -> Column:
    return F.coalesce(F.theta_sketch_estimate(sketch), F.lit(0)).cast("bigint")


def distinct_users(sketches: DataFrame, ranges: Sequence[tuple[str, dt.date, dt.date]], log_entries: int = LOG_ENTRIES) -> DataFrame:
    """(name, n_events, n_users) for each named range of days, both ends included; ranges without a day have zeros."""
    named = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.lit(a).cast("date").alias("first"), F.lit(b).cast("date").alias("last")) for n, a, b in ranges]))
    first, last = min(a for _, a, _ in ranges), max(b for _, _, b in ranges)
    days = sketches.where(in_range("date", first, last)).withColumn("r", named).where(F.col("date").between(F.col("r.first"), F.col("r.last")))
    found = days.groupBy(F.col("r.name").alias("name")).agg(F.sum("n").alias("n_events"), F.theta_union_agg("users", log_entries).alias("u"))
    names = sketches.sparkSession.createDataFrame([(n,) for n, _, _ in ranges], "name string")
    return names.join(found, "name", "left").select("name", F.coalesce("n_events", F.lit(0)).cast("bigint").alias("n_events"), _number(F.col("u")).alias("n_users"))


def retention(sketches: DataFrame, before: Range, after: Range, *keys: str, log_entries: int = LOG_ENTRIES) -> DataFrame:
    """M2 in numbers: by ``keys``, users of the days of ``before``, those of them seen in ``after``, and those not seen there."""
    in_before, in_after = in_range("date", *before), in_range("date", *after)
    both = sketches.where(in_before | in_after).groupBy(*keys).agg(_united(sketches, in_before, log_entries).alias("a"), _united(sketches, in_after, log_entries).alias("b"))
    return both.select(*keys, _number(F.col("a")).alias("n_users"), _number(F.theta_intersection("a", "b")).alias("n_back"), _number(F.theta_difference("a", "b")).alias("n_left"))


def counters(share: float, spare: int = SPARE) -> int:
    return int(spare / share) + 1


def _misra_gries(m: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[object, pd.Series] = {}
        rows: dict[object, int] = {}
        for pdf in frames:
            for day, part in pdf.groupby("date", dropna=True, sort=False):
                counts = part["key"].value_counts()
                rows[day] = rows.get(day, 0) + int(counts.sum())
                if day in held:
                    counts = held[day].add(counts, fill_value=0).sort_values(ascending=False)
                held[day] = _cut(counts, m)
        for day, counts in held.items():
            yield pd.DataFrame({"date": day, "key": counts.index, "count": counts.to_numpy().astype("int64")})
            yield pd.DataFrame({"date": [day], "key": [None], "count": [rows[day]]}).astype({"key": "object"})
    return run


def _cut(counts: pd.Series, m: int) -> pd.Series:
    """At most m counters: the (m + 1)-th count is taken from all, which cancels that many rows of m + 1 keys."""
    if len(counts) <= m:
        return counts
    counts = counts - counts.iloc[m]
    return counts[counts > 0]


def heavy_summaries(df: DataFrame, key: str, share: float, spare: int = SPARE) -> DataFrame:
    """(date, key, count): Misra-Gries counters of each day; the row without a key has the day's rows.

    Tasks keep ``counters(share)`` counters for each day that they meet, and so does a day after its tasks' counters are
    summed.  Null keys and rows without a day don't count.
    """
    m, kind = counters(share, spare), df.schema[key].dataType.simpleString()
    parts = df.select("date", F.col(key).alias("key")).where("date is not null and key is not null").mapInPandas(_misra_gries(m), f"date date, key {kind}, count long")
    summed = parts.groupBy("date", "key").agg(F.sum("count").alias("count"))
    kept = summed.where("key is not null")
    cut = F.coalesce(F.nth_value("count", m + 1).over(Window.partitionBy("date").orderBy(F.desc("count"), "key").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)), F.lit(0))
    kept = kept.withColumn("count", F.col("count") - cut).where("count > 0")
    return kept.unionByName(summed.where("key is null"))


def write_heavy_summaries(df: DataFrame, key: str, path: str, share: float, spare: int = SPARE, mode: str = "append") -> None:
    heavy_summaries(df, key, share, spare).write.mode(mode).partitionBy("date").parquet(path)


def heavy_hitters(df: DataFrame, summaries: DataFrame, key: str, first: dt.date, last: dt.date, share: float, spare: int = SPARE) -> DataFrame:
    """(key, n) of the keys with more than ``share`` of the rows from ``first`` to ``last``, n exact.

    ``summaries`` must hold those days, made with the same ``share`` or a smaller one.  The candidates are 1 / share times
    a small number at most, whatever the range, so they are broadcast.
    """
    days = summaries.where(in_range("date", first, last))
    total = days.where("key is null").agg(F.sum("count")).first()[0] or 0
    low = share * total - 2 * total / (counters(share, spare) + 1)  # tasks and days each count too low by half of that, at most
    candidates = days.where("key is not null").groupBy(F.col("key").alias(key)).agg(F.sum("count").alias("least")).where(F.col("least") > low).select(key)
    counted = df.where(in_range("date", first, last)).join(F.broadcast(candidates), key, "left_semi").groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") > F.lit(share) * F.lit(total))
