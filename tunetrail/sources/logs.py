"""Raw player-log ingestion (S1-S5, S2 pruning, P3, P4, F1, F2, D1, U1).

A raw log line is tab separated with no header and no quoting.  The
reference's shell step appends the file's date (``YYYYMMDD_<shard>_<kind>``)
as one more field, then a positional reader takes field *n* as the date:
a line with too few fields leaves the date slot empty, one with an extra
tab puts another field there -- both rows are then dropped because the
date does not parse.  :func:`parse_lines` keeps exactly that positional
rule, whatever the reader:

* :func:`read_text_logs` -- plain or gzip text files (splittable when plain),
  read as bytes and decoded as UTF-8 (bad bytes dropped) or Latin-1;
* :func:`read_archives` -- ``tar.gz`` shards (tar is no Spark codec): Spark
  lists and prunes the files by name and deals them to tasks, which open
  them by path and stream their lines out in bounded batches, so no archive
  is ever one value in memory.  The same expansion serves batch and stream.
"""

from __future__ import annotations

import gzip
import io
import tarfile
import zlib
from collections.abc import Iterator, Sequence
from urllib.parse import quote

import pandas as pd
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tunetrail.functions.dates import parse_yyyymmdd
from tunetrail.functions.exprs import strip_blanks, to_bigint, to_double

# Field order of each raw log (the date is the appended last field).
FIELDS = {
    "play": ("uid", "device", "song_id", "song_type", "song_name", "singer", "play_time",
             "song_length", "paid_flag", "date"),
    "down": ("uid", "device", "song_id", "song_name", "singer", "paid_flag", "date"),
    "search": ("uid", "device", "time_stamp", "search_query", "date"),
}
# Columns kept in each cleaned table, in the reference's order.
OUTPUT = {
    "play": ("uid", "device", "song_name", "song_id", "date", "play_time", "song_length"),
    "down": ("uid", "device", "song_id", "date"),
    "search": ("uid", "device", "date"),
}
# Text encodings (play is UTF-8 with undecodable bytes dropped).
ENCODING = {"play": "utf-8", "down": "latin-1", "search": "latin-1"}
# Fixed value: first file date kept.
FIRST_DATE = "20170330"
# Archive / file names: YYYYMMDD_<shard>_<kind>.log[.tar.gz]; browser copies
# such as "... (1).tar.gz" do not match and are excluded.
FILE_NAME_RE = r"^([0-9]{8})_[0-9]+_(play|down|search)\.log(\.tar\.gz|\.gz)?$"

# Stands for a U+FFFD of the file while undecodable bytes are dropped.
_REPLACEMENT = "\ue000fffd\ue000"

_TYPED = {"uid": to_bigint, "song_id": to_bigint, "play_time": to_double, "song_length": to_double}


def file_date(file_name: Column) -> Column:
    """The YYYYMMDD prefix of a well-formed log file name, else null."""
    return F.when(file_name.rlike(FILE_NAME_RE), F.regexp_extract(file_name, FILE_NAME_RE, 1))


def file_kind(file_name: Column) -> Column:
    return F.regexp_extract(file_name, FILE_NAME_RE, 2)


def keep_file(file_name: Column, kind: str, first_date: str = FIRST_DATE) -> Column:
    """S2 (X33 fixed): right kind, well-formed name, date on or after ``first_date``."""
    return (file_kind(file_name) == kind) & (file_date(file_name) >= F.lit(first_date))


def decoded(raw: Column, kind: str) -> Column:
    """Text of a line read as raw bytes, in the kind's encoding; bytes that aren't UTF-8 are dropped, a U+FFFD of the file stays."""
    if ENCODING[kind] == "latin-1":
        return F.decode(raw.cast("binary"), "ISO-8859-1")
    marked = F.replace(raw, F.lit("\ufffd"), F.lit(_REPLACEMENT))
    valid = F.replace(F.replace(F.make_valid_utf8(marked), F.lit("\ufffd"), F.lit("")), F.lit(_REPLACEMENT), F.lit("\ufffd"))
    return F.when(F.is_valid_utf8(raw), raw).otherwise(valid)


def parse_lines(lines: DataFrame, kind: str, line_col: str = "line",
                date_text: Column | None = None) -> DataFrame:
    """Positional parse + cleaning of raw lines into the typed cleaned table.

    ``date_text`` (e.g. from the file name) is appended as the last field the
    way the shell step does; without it the line must already end with it.
    Rows whose uid is not an integer (F1) or whose date slot does not parse
    (F2) are dropped; every kept field is stripped (P4) and typed once.
    """
    fields = FIELDS[kind]
    line = F.col(line_col)
    if date_text is not None:
        line = F.concat(line, F.lit(" \t "), date_text)
    # Staged projections: split once, strip once, then type -- each later
    # expression refers to a column, not to a copy of the whole line logic.
    staged = lines.select(F.split(line, "\t", -1).alias("_f"))
    staged = staged.select(*[strip_blanks(F.get(F.col("_f"), i)).alias(f"_{f}")
                             for i, f in enumerate(fields) if f in OUTPUT[kind]])
    cols = {}
    for f in OUTPUT[kind]:
        raw = F.col(f"_{f}")
        if f == "date":
            cols[f] = parse_yyyymmdd(raw)
        elif f in _TYPED:
            cols[f] = _TYPED[f](raw)
        else:
            cols[f] = raw
    out = staged.select(*[c.alias(f) for f, c in cols.items()])
    return out.where(F.col("uid").isNotNull() & F.col("date").isNotNull())


def read_text_lines(spark: SparkSession, paths: str | Sequence[str], kind: str) -> DataFrame:
    """(line, _file) of text (or .gz) files, read as bytes and decoded in the plan, so no character can part a line."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.text(paths).select(decoded(F.col("value"), kind).alias("line"), F.col("_metadata.file_name").alias("_file"))


def read_text_logs(spark: SparkSession, paths: str | Sequence[str], kind: str,
                   date_from_file_name: bool = True, first_date: str = FIRST_DATE) -> DataFrame:
    """One multi-path scan of text (or .gz) logs of one kind.

    File pruning (S2) is a predicate on ``_metadata.file_name`` so skipped
    files are never opened.
    """
    df = read_text_lines(spark, paths, kind)
    if date_from_file_name:
        df = df.where(keep_file(F.col("_file"), kind, first_date))
        return parse_lines(df, kind, date_text=file_date(F.col("_file")))
    return parse_lines(df, kind)


def raw_field(kind: str, name: str, line_col: str = "line") -> Column:
    """A field of a raw line by its place, stripped; also one that the cleaned table leaves out.  Null where the line is too short."""
    return strip_blanks(F.get(F.split(F.col(line_col), "\t", -1), FIELDS[kind].index(name)))


ARCHIVE_SCHEMA = "file_name string, line string, file_lines long, damaged boolean"


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path as Spark names it (``file:/...``, ``hdfs://...``, ``s3://...``, or plain), and the path in it."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[len("file:"):].lstrip("/")
    if "://" not in path:
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(quote(path, safe=":/@%"))


def _opened(path: str):
    system, name = file_system(path)
    return system.open_input_stream(name, compression=None, buffer_size=1 << 20)


def _untar_batches(kind: str, batch_lines: int, allow_partial: bool):
    encoding = ENCODING[kind]
    errors = "ignore" if encoding == "utf-8" else "strict"

    def frame(name: str, lines: list) -> pd.DataFrame:
        return pd.DataFrame({"file_name": [name] * len(lines), "line": lines, "file_lines": None, "damaged": None})

    def expand(path: str, stream) -> Iterator[pd.DataFrame]:
        name, n, damaged, buf = path.rsplit("/", 1)[-1], 0, False, []
        try:
            with gzip.GzipFile(fileobj=stream) as gz:
                with tarfile.open(fileobj=gz, mode="r|") as tar:
                    for member in tar:
                        if not member.isfile():
                            continue
                        for raw in tar.extractfile(member):
                            buf.append(raw.rstrip(b"\r\n").decode(encoding, errors=errors))
                            n += 1
                            if len(buf) >= batch_lines:
                                yield frame(name, buf)
                                buf = []
                while gz.read(1 << 20):  # to the end, where the checksum is
                    pass
        except (tarfile.TarError, EOFError, gzip.BadGzipFile, zlib.error) as e:
            if not allow_partial:
                raise ValueError(f"damaged archive {name} after {n} lines: {e}") from e
            damaged = True
        if buf:
            yield frame(name, buf)
        yield pd.DataFrame({"file_name": [name], "line": [None], "file_lines": [n], "damaged": [damaged]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            held = pdf["content"] if "content" in pdf else [None] * len(pdf)
            for path, content in zip(pdf["path"], held):
                with _opened(path) if content is None else io.BytesIO(content) as stream:
                    yield from expand(str(path), stream)
    return run


# Spark's own schema of the binary file source; only ``path`` is ever selected unless the content is asked for.
FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def archive_files(reader, path: str, kind: str, first_date: str = FIRST_DATE) -> DataFrame:
    """(path, content): the archives of one kind, chosen by name and date; ``reader`` is ``spark.read`` or ``spark.readStream``."""
    return (reader.format("binaryFile").schema(FILE_SCHEMA).option("pathGlobFilter", f"*_{kind}.log.tar.gz").option("recursiveFileLookup", "true").load(path)
                  .where(keep_file(F.col("_metadata.file_name"), kind, first_date)).select("path", "content"))


def read_archive_lines(spark: SparkSession, path: str, kind: str, first_date: str = FIRST_DATE, batch_lines: int = 50_000,
                       partitions: int | None = None, allow_partial: bool = False, through_spark: bool = False) -> DataFrame:
    """Lines of the ``tar.gz`` shards of one kind, and one row for each archive with its number of lines.

    Files are chosen by a predicate on ``_metadata.file_name``, so others are
    never opened and no list of paths passes the driver.  An archive is never split: it is
    streamed by one task, whose lines leave in batches of ``batch_lines`` and are
    dealt out anew, so later stages don't inherit one task for each archive.
    Tasks open archives by path with Arrow's file systems; ``through_spark`` reads
    them as whole values with Spark's reader, for storage that Arrow can't open.
    A damaged archive (cut short, flipped bytes: the checksum is always read)
    fails the job.  With ``allow_partial`` what decoded before the damage is
    returned, and the archive's row, in the same pass, has ``damaged`` true; a file that can't be
    opened or read at all is an error in either case.
    """
    files = archive_files(spark.read, path, kind, first_date)
    return expand_archives(files if through_spark else files.select("path"), kind, batch_lines, allow_partial).repartition(partitions or spark.sparkContext.defaultParallelism)


def expand_archives(files: DataFrame, kind: str, batch_lines: int = 50_000, allow_partial: bool = False) -> DataFrame:
    """The rows of :func:`read_archive_lines` from (path), opened by the tasks, or from (path, content)."""
    return files.mapInPandas(_untar_batches(kind, batch_lines, allow_partial), ARCHIVE_SCHEMA)


def archive_rows(lines: DataFrame, kind: str) -> DataFrame:
    """Cleaned typed table from :func:`read_archive_lines` (date from the archive name, X35)."""
    return parse_lines(lines.where(F.col("file_lines").isNull()), kind, date_text=file_date(F.col("file_name")))


def read_archives(spark: SparkSession, path: str, kind: str, first_date: str = FIRST_DATE) -> DataFrame:
    """S1 + parse: cleaned typed table straight from the archives.  A damaged archive is an error; to go on
    without it, use ``read_archive_lines(..., allow_partial=True)`` with its ``archive_report``."""
    return archive_rows(read_archive_lines(spark, path, kind, first_date), kind)


def archive_report(lines: DataFrame) -> DataFrame:
    """Lines of each archive and whether it was damaged, from the rows of the reading pass."""
    return lines.where(F.col("file_lines").isNotNull()).select("file_name", F.col("file_lines").alias("lines"), "damaged")


def archive_coverage(report: DataFrame) -> DataFrame:
    """Archives, damaged archives and lines of each day."""
    day = parse_yyyymmdd(file_date(F.col("file_name"))).alias("date")
    return report.groupBy(day).agg(F.count(F.lit(1)).alias("archives"), F.count_if("damaged").alias("damaged"), F.sum("lines").alias("lines"))


def read_clean_csv(spark: SparkSession, path: str | Sequence[str], schema: str | None = None, infer: bool = False, multi_line: bool = False) -> DataFrame:
    """CSV with a header; quotes escaped by doubling (X5).  With ``multi_line`` a quoted field may hold line breaks, at a
    price: a file is then one task, where it is split otherwise.

    With ``schema`` its types; without, all columns are strings, or with ``infer`` of the types that Spark finds in one
    more pass over the files (S6).  An empty field is null.
    """
    reader = spark.read.option("header", "true").option("escape", '"').option("multiLine", str(multi_line).lower())
    return (reader.schema(schema) if schema else reader.option("inferSchema", str(infer).lower())).csv(path)


def write_clean_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K1 as CSV: a header in each file, the columns in their order, quotes doubled; written by the tasks."""
    df.write.mode(mode).option("header", "true").option("escape", '"').csv(path)
