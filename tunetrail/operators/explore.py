"""Profiling and exploration queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tunetrail.operators.quantiles import exact_quantiles

QUARTILES = (0.25, 0.5, 0.75)


def row_count(df: DataFrame) -> DataFrame:
    """A6 as a one-row DataFrame."""
    return df.agg(F.count(F.lit(1)).alias("n"))


def distinct_count(df: DataFrame, col: str = "uid", approx: bool = False) -> DataFrame:
    """A7; ``approx`` uses HyperLogLog++ (bounded memory) instead of an exact distinct."""
    f = F.approx_count_distinct(col) if approx else F.count_distinct(col)
    return df.agg(f.alias(f"distinct_{col}"))


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    """Group count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def multi_agg(df: DataFrame, key: str, value: str) -> DataFrame:
    """A9 (X7 fixed): count, max, min, avg of a numeric column per key."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"),
                               F.max(value).alias(f"max_{value}"),
                               F.min(value).alias(f"min_{value}"),
                               F.avg(value).alias(f"avg_{value}"))


def null_report(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """For every column its non-null and null counts, in one pass over the data."""
    cols = list(cols or df.columns)
    wide = df.agg(F.count(F.lit(1)).alias("_rows"),
                  *[F.count_if(F.col(c).isNull()).alias(f"_n_{i}") for i, c in enumerate(cols)])
    stack = ", ".join(f"'{c}', _n_{i}" for i, c in enumerate(cols))
    return (wide.selectExpr(f"stack({len(cols)}, {stack}) AS (column_name, n_null)", "_rows")
                .select("column_name", (F.col("_rows") - F.col("n_null")).alias("n_non_null"), "n_null"))


def info(df: DataFrame) -> DataFrame:
    """A2: for every column its type, non-null and null counts."""
    kinds = F.create_map(*[F.lit(x) for pair in df.dtypes for x in pair])
    return null_report(df).withColumn("type", kinds[F.col("column_name")]).select("column_name", "type", "n_non_null", "n_null")


def value_counts(df: DataFrame, *keys: str) -> DataFrame:
    """Rows per key, most frequent first, ties by key."""
    return count_by(df, *keys).orderBy(F.col("n").desc(), *keys)


def describe(df: DataFrame) -> DataFrame:
    """A3 for every numeric column: one row each.  Quantiles are exact in bounded memory (:mod:`quantiles`); their passes over
    ``df`` run at the call.  NaN counts in the moments but in no quantile."""
    cols = numeric_columns(df)
    if not cols:
        return df.sparkSession.createDataFrame([], "column_name string, count long, mean double, std double, min double, q25 double, q50 double, q75 double, max double")
    quantile = exact_quantiles(df, cols, QUARTILES)
    wide = df.agg(*[f.alias(f"{name}_{i}") for i, c in enumerate(cols) for name, f in _moments(F.col(c)).items()])
    rows = [F.struct(F.lit(c).alias("column_name"), *[F.col(f"{m}_{i}").alias(m) for m in ("count", "mean", "std", "min")],
                     *[F.lit(quantile[c, p]).cast("double").alias(f"q{round(100 * p)}") for p in QUARTILES], F.col(f"max_{i}").alias("max")) for i, c in enumerate(cols)]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _moments(c) -> dict:
    return {"count": F.count(c), "mean": F.avg(c).cast("double"), "std": F.stddev_samp(c), "min": F.min(c).cast("double"), "max": F.max(c).cast("double")}


def summary_stats(df: DataFrame, col: str) -> DataFrame:
    """A3 with exact quantiles (linear interpolation, as numpy): count, mean, std, min, 25/50/75 %, max.

    ``percentile`` keeps a value -> frequency map per partition and merges
    them, so its state is bounded by the number of distinct values, not rows.
    """
    c = F.col(col)
    return df.agg(F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
                  F.min(c).cast("double").alias("min"),
                  F.percentile(c, 0.25).alias("q25"), F.percentile(c, 0.5).alias("q50"),
                  F.percentile(c, 0.75).alias("q75"), F.max(c).cast("double").alias("max"))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def preview(df: DataFrame, order: Sequence[str], n: int = 20) -> DataFrame:
    """O3: a limit with an explicit total order (a top-n, planned as TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(n)


def to_pandas_small(df: DataFrame, max_rows: int = 100_000):
    """K4: bring a small result (an aggregate) to the driver, refusing anything larger than ``max_rows``."""
    n = df.limit(max_rows + 1).count()
    if n > max_rows:
        raise ValueError(f"result has more than {max_rows} rows; write it with the executors instead")
    return df.toPandas()
