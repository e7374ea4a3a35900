"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tunetrail.session import cut_lineage, shared_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; the path is handed to Spark's reader as it is, whatever its scheme."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and go on from there (survives lost executors)."""
    return cut_lineage(df)


def compact(df: DataFrame, rows: int) -> DataFrame:
    """A checkpointed table in as many partitions as its rows need, ``rows`` each; small tables then make few shuffle files."""
    return df.coalesce(max(1, -(-df.count() // rows)))


def stored(df: DataFrame, path: str | None = None) -> DataFrame:
    """``df`` written as Parquet at ``path`` (a new folder in the shared checkpoint folder, if None), and read again."""
    path = path or shared_path(df.sparkSession, "stored")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete_stored(spark: SparkSession, path: str) -> None:
    """Delete what :func:`stored` wrote at ``path``, once nothing that is still to be computed reads it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def exclusive(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Only the named columns, so that other columns of the caller's table can't clash with ours."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def batches(rows: Iterable[tuple], schema: pa.Schema, size: int = 2000) -> Iterator[pa.RecordBatch]:
    """Tuples to Arrow batches of at most ``size`` rows."""
    out: list[tuple] = []
    for row in rows:
        out.append(row)
        if len(out) >= size:
            yield _batch(out, schema)
            out = []
    if out:
        yield _batch(out, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def crc_bucket(id_column: Column, n: int) -> Column:
    """crc32 of the id written as text, mod n; null for a null id."""
    return F.crc32(id_column.cast("string").cast("binary")) % F.lit(n)
