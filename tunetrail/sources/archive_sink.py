"""A sink of daily ``tar.gz`` archives as a Python data source: (day, shard, line) rows become YYYYMMDD_<shard>_<kind>.log.tar.gz.

Tasks write under hidden names and the commit renames them, so a failed,
repeated or speculative task adds no archive and none is seen half written (a lost
executor may leave a hidden file, which no reader takes).
"""

from __future__ import annotations

import io
import tarfile
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from tunetrail.sources.logs import ENCODING, file_system

LINES_PER_ARCHIVE = 200_000


@dataclass
class Written(WriterCommitMessage):
    moves: list = field(default_factory=list)  # (hidden path, final path)


class ArchiveWriter(DataSourceArrowWriter):
    def __init__(self, path: str, kind: str):
        self.path, self.kind = path.rstrip("/"), kind

    def write(self, iterator):
        out, key, buf = Written(), None, []
        for batch in iterator:
            for day, shard, line in zip(batch["day"].to_pylist(), batch["shard"].to_pylist(), batch["line"].to_pylist()):
                if (day, shard) != key:
                    self._close(out, key, buf)
                    key, buf = (day, shard), []
                buf.append(line)
        self._close(out, key, buf)
        return out

    def _close(self, out: Written, key, lines: list) -> None:
        if key is None:
            return
        text = "".join(f"{x}\n" for x in lines).encode(ENCODING[self.kind])
        system, root = file_system(self.path)
        final = f"{root}/{key[0]}_{key[1]}_{self.kind}.log.tar.gz"
        hidden = f"{root}/_{uuid.uuid4().hex}.tmp"
        system.create_dir(root)
        with system.open_output_stream(hidden, compression=None) as f, tarfile.open(fileobj=f, mode="w|gz") as tar:
            info = tarfile.TarInfo(f"{key[0]}_{key[1]}_{self.kind}.log")
            info.size = len(text)
            tar.addfile(info, io.BytesIO(text))
        out.moves.append((hidden, final))

    def commit(self, messages) -> None:
        system, _ = file_system(self.path)
        for m in messages:
            for hidden, final in m.moves if m else []:
                system.move(hidden, final)

    def abort(self, messages) -> None:
        system, _ = file_system(self.path)
        for m in messages:
            for hidden, _ in m.moves if m else []:
                system.delete_file(hidden)


class ArchiveSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tunetrail_archives"

    def writer(self, schema, overwrite: bool):
        return ArchiveWriter(self.options["path"], self.options["kind"])


def write_archives(lines: DataFrame, path: str, kind: str, lines_per_archive: int = LINES_PER_ARCHIVE) -> None:
    """Write (day, line) as archives of about ``lines_per_archive`` lines; a day has as many as its lines need.

    Lines are dealt by their place, not their text, so equal lines spread over a day's shards.  Rows without a day are an error
    of the caller: they are not written.  An empty table writes nothing.
    """
    sized = lines.groupBy("day").agg(F.ceil(F.count(F.lit(1)) / lines_per_archive).cast("int").alias("shards"))
    dealt = (lines.withColumn("_place", F.monotonically_increasing_id()).join(sized, "day")
                  .select("day", F.pmod(F.xxhash64("line", "_place"), "shards").cast("int").alias("shard"), "line"))
    lines.sparkSession.dataSource.register(ArchiveSink)
    (dealt.repartition("day", "shard").sortWithinPartitions("day", "shard")
          .write.format(ArchiveSink.name()).option("kind", kind).mode("append").save(path))
