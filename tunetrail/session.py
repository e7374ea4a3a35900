"""SparkSession construction and shared-folder helpers.

Cluster jobs read ``spark.checkpoint.dir`` from the session (the shared folder
the cluster names).  Only a local master without that setting gets a fresh
scratch folder; a cluster without it is an error, since a folder of the
driver's machine is not seen by the executors.
"""

from __future__ import annotations

import gc
import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpoint files go when nothing refers to their table any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tunetrail", extra: dict | None = None) -> SparkSession:
    """Session for local runs and tests; on a cluster, pass no master."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; a scratch one only for a local master that names none."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        current = spark.conf.get("spark.checkpoint.dir", None)
        if not current:
            if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
                raise RuntimeError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
            current = tempfile.mkdtemp(prefix="tunetrail-ckpt-")
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir()


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


# Tunable: rows of a partition of a large table, about.
PART_ROWS = 500_000


def spread(df: DataFrame, rows: int, *keys: str, each: int = PART_ROWS) -> DataFrame:
    """``df`` (of about ``rows`` rows) by ``keys`` in partitions of about ``each``, one a core at least; a table of one such
    partition is left as it is.  What a task then holds doesn't grow with the table: the number is fixed here, as adaptive
    execution joins a session's shuffle partitions until about one a core is left, however many rows they hold."""
    parts = -(-rows // each)
    return df if parts <= 1 else df.repartition(max(parts, df.sparkSession.sparkContext.defaultParallelism), *keys)


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


# Tunable: bytes of a written table from which the shuffles behind it are let go at once.
LARGE_BYTES = 16_000_000


def store(df: DataFrame, name: str = "table") -> tuple[DataFrame, list[str]]:
    """``df`` as Parquet in the shared folder, read again, and its files.

    A compressed table takes a small part of the disk of a checkpoint's plain rows; the shuffle files behind a large one go now, not
    when the driver happens to collect its garbage.  What reads the files in tasks (:func:`readable`) needs no shuffle."""
    spark, path = df.sparkSession, shared_path(df.sparkSession, name)
    schema = df.schema
    df.write.parquet(path)
    del df
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength() > LARGE_BYTES:
        let_go(spark)
    out = spark.read.schema(schema).parquet(path)
    return out, sorted(out.inputFiles())


def let_go(spark: SparkSession) -> None:
    """Shuffle files and checkpoints that no table refers to any more go (Spark's cleaner follows the garbage collector)."""
    gc.collect()
    spark._jvm.System.gc()


def drop(spark: SparkSession, path: str) -> None:
    """Deletes a folder of the shared one, once nothing that is still to be computed reads it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def readable(spark: SparkSession) -> bool:
    """Whether tasks can open the shared folder's files by path (Arrow's file systems); if not, tables have to be shuffled."""
    from tunetrail.sources.logs import file_system

    try:
        system, name = file_system(ensure_checkpoint_dir(spark))
        return system.get_file_info(name).type.name == "Directory"
    except (OSError, ValueError, ImportError, NotImplementedError):
        return False
