"""Best-fit packing of documents into token sequences.

Documents become token pieces of at most ``capacity`` tokens, and the pieces
are packed by best-fit decreasing: longest first, each into the open sequence
with the least room that still holds it.

Best-fit decreasing sees nothing of a piece but its length, so the plan is made
from the histogram of lengths (at most ``capacity`` rows, whatever the corpus
size).  A segment tree over remaining capacities answers "tightest open
sequence with room for L" in O(log capacity); pieces of one length and
sequences of one remaining room are moved together, which gives exactly the
sequences that one search per piece would give.  The plan says for each length
which ranks go to which sequences and offsets.  Ranks are numbered on Spark, in
hash buckets, so that a length which many pieces share is no single task.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunetrail.llm.common import batches, checkpointed

CAPACITY = 2048
SEPARATOR = 0
#: Ranks of one length are numbered in hash buckets of about this many pieces of the corpus, and in this many at least.
BUCKET_ROWS, LEAST_BUCKETS = 65_536, 256


# --------------------------------------------------------------- tokens

def vocabulary(path: str) -> str:
    """Content of a tokenizer file; read on the driver and sent with the tasks, so executors need no file."""
    with open(path, encoding="utf-8") as f:
        return f.read()


_ENCODERS: dict[int, Callable[[str], list[int]]] = {}


def _byte_of_symbol() -> dict[str, int]:
    """Byte-level BPE writes printable Latin-1 bytes as themselves and the others as code points from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def encoder(content: str):
    """text -> list of ids, by the given byte-level BPE vocabulary (kept per Python worker).

    The ids are those of ``tokenizers`` (add_special_tokens=False; a special token's string in a text is that token).
    A vocabulary of the plain byte-level kind runs its merges in ``tiktoken``, several times faster with the same ids
    (a test compares both on every code point); any other kind runs in ``tokenizers`` itself, and so does a text that
    ``tiktoken`` can't take: its regex engine backtracks over runs of white space and gives up on very long ones.
    """
    key = hash(content)
    if key not in _ENCODERS:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core a task
        fast, made = _fast(content), []

        def exact(text: str) -> list[int]:
            if not made:  # few workers ever need it beside ``tiktoken``
                from tokenizers import Tokenizer

                made.append(Tokenizer.from_str(content))
            return made[0].encode(text, add_special_tokens=False).ids

        def encode(text: str) -> list[int]:
            if len(text) > SAFE_RUN and _LONG_RUN.search(text):
                return exact(text)
            try:
                return fast.encode(text, allowed_special="all")
            except ValueError:
                return exact(text)

        _ENCODERS.clear()
        _ENCODERS[key] = encode if fast else exact
    return _ENCODERS[key]


#: A longer run of white space is never handed to ``tiktoken``, which fails somewhere between 700,000 and 1,000,000.
SAFE_RUN = 100_000
_LONG_RUN = re.compile(rf"\s{{{SAFE_RUN + 1}}}")
#: The pattern by which this family of vocabularies splits a text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _fast(content: str):
    spec = json.loads(content)
    pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
    if spec.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
        return None
    import tiktoken

    symbols = _byte_of_symbol()
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    ranks = {bytes(symbols[c] for c in word): i for word, i in model["vocab"].items() if word not in special}
    return tiktoken.Encoding("merges", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)


def token_pieces(docs: DataFrame, vocabulary_json: str, capacity: int = CAPACITY, separator: int = SEPARATOR,
                 id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Pieces of each document: id, piece, start, length, ids_crc32 (and ids, if asked for).

    A document is its token ids, then ``separator``.  Up to ``capacity`` ids are one piece.  A longer document is cut
    into full pieces, after a first piece with what is left over.  A null text is empty (one id, the separator); an id
    may be null or repeated: every row gives its own pieces.  Bytes that aren't UTF-8 are read as U+FFFD.
    """
    docs = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("binary").alias("_text"))
    id_type = docs.schema[id_col].dataType
    schema = f"{id_col} {id_type.simpleString()}, piece int, start long, length long, ids_crc32 long"
    fields = [pa.field("piece", pa.int32()), pa.field("start", pa.int64()), pa.field("length", pa.int64()), pa.field("ids_crc32", pa.int64())]
    if with_ids:
        schema += ", ids array<int>"
        fields.append(pa.field("ids", pa.list_(pa.int32())))

    def cut(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary_json)
        for batch in it:
            def rows(batch=batch):
                for doc, text in zip(batch.column(0), batch.column(1)):
                    ids = np.array([*encode((text.as_py() or b"").decode("utf-8", "replace")), separator], dtype="<u4")
                    first = (len(ids) - 1) % capacity + 1
                    edges = [0, *range(first, len(ids) + 1, capacity)]
                    for k, (a, b) in enumerate(zip(edges, edges[1:])):
                        part = ids[a:b]
                        out = (doc.as_py(), k, a, b - a, zlib.crc32(part.tobytes()))
                        yield (*out, part.tolist()) if with_ids else out
            yield from batches(rows(), pa.schema([pa.field(id_col, batch.schema.field(0).type), *fields]), 500 if with_ids else 5000)

    return docs.mapInArrow(cut, schema)


# --------------------------------------------------------------- plan

class RoomTree:
    """Segment tree over remaining capacities 0..n: which of them some open sequence has."""

    def __init__(self, n: int) -> None:
        self.size = 1 << n.bit_length()
        self.some = bytearray(2 * self.size)

    def put(self, room: int, some: bool) -> None:
        i = room + self.size
        self.some[i] = some
        while i > 1:
            i >>= 1
            self.some[i] = self.some[2 * i] | self.some[2 * i + 1]

    def tightest(self, length: int) -> int | None:
        """The least remaining capacity of length or more that an open sequence has."""
        i = length + self.size
        if self.some[i]:
            return length
        while i > 1 and (i & 1 or not self.some[i + 1]):  # up, to the first right neighbour with an open sequence
            i >>= 1
        if i <= 1:
            return None
        i += 1
        while i < self.size:
            i = 2 * i if self.some[2 * i] else 2 * i + 1
        return i - self.size


def plan_best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over a histogram of lengths.

    Rows (length, first rank, first sequence, pieces per sequence, offset of the first piece), by length and first
    rank: rank r of that length, from the row's first rank to the next row's, is piece (r - first) % per of sequence
    first + (r - first) // per.
    """
    tree, open_ = RoomTree(capacity), {}
    plan, sequences = [], 0

    def leave(room: int, first: int, n: int) -> None:
        if room and n:
            if room not in open_:
                open_[room] = []
                tree.put(room, True)
            open_[room].append([first, n])

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = tree.tightest(length)
            if room is None:  # none has room: open as many as this length fills, then one for the rest
                room, (first, n) = capacity, (sequences, -(-left // (capacity // length)))
                sequences += n
            else:
                first, n = open_[room].pop(0)
                if not open_[room]:
                    del open_[room]
                    tree.put(room, False)
            per = room // length  # the sequence just added to stays the tightest while it has room
            full = min(n, left // per)
            if full:
                plan.append((length, rank, first, per, capacity - room))
                rank, left = rank + full * per, left - full * per
                leave(room - per * length, first, full)
            if full < n and 0 < left < per:
                plan.append((length, rank, first + full, per, capacity - room))
                leave(room - left * length, first + full, 1)
                rank, left, full = rank + left, 0, full + 1
            leave(room, first + full, n - full)
    return sorted(plan)


# --------------------------------------------------------------- operator

def pack_best_fit(pieces: DataFrame, capacity: int = CAPACITY, length_col: str = "length", order_cols: tuple[str, ...] = ("doc_id", "piece", "ids_crc32")) -> DataFrame:
    """The rows of ``pieces`` with ``sequence_id`` and ``offset``: best-fit decreasing into sequences of ``capacity``.

    Lengths are from 1 to ``capacity``.  Rows alike in ``order_cols`` are interchangeable.  ``pieces`` is read more
    than once; hand in a checkpointed or stored table.  No rows give no rows.
    """
    counts = {r[0]: r[1] for r in pieces.groupBy(length_col).count().collect()}  # at most ``capacity`` rows
    if any(k is None or not 0 < k <= capacity for k in counts):
        raise ValueError(f"piece lengths must be from 1 to {capacity}")
    plan = plan_best_fit(counts, capacity)
    step = max(counts.values(), default=0) + 1
    starts = np.array([p[0] * step + p[1] for p in plan], dtype=np.int64)
    columns = [np.array([p[i] for p in plan], dtype=np.int64) for i in range(1, 5)]

    buckets = max(LEAST_BUCKETS, sum(counts.values()) // BUCKET_ROWS)
    dealt = pieces.withColumn("_bucket", F.pmod(F.xxhash64(*[F.col(c) for c in order_cols]), F.lit(buckets)))
    before = (dealt.groupBy(F.col(length_col).alias("_length"), F.col("_bucket").alias("_of")).agg(F.count(F.lit(1)).alias("_n"))
              .withColumn("_before", F.sum("_n").over(Window.partitionBy("_length").orderBy("_of").rowsBetween(Window.unboundedPreceding, -1))))
    within = Window.partitionBy(length_col, "_bucket").orderBy(*order_cols)
    ranked = (dealt.withColumn("_rank", F.row_number().over(within) - 1)
              .join(before, (F.col(length_col) == F.col("_length")) & (F.col("_bucket") == F.col("_of")))
              .withColumn("sequence_id", F.col("_rank") + F.coalesce("_before", F.lit(0)))
              .withColumn("offset", F.lit(0).cast("long"))
              .select(*pieces.columns, F.col("sequence_id").cast("long"), "offset"))

    def place(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            length = batch.column(batch.schema.get_field_index(length_col)).to_numpy(zero_copy_only=False)
            rank = batch.column(batch.num_columns - 2).to_numpy(zero_copy_only=False)
            k = np.searchsorted(starts, length * step + rank, side="right") - 1
            first_rank, sequence, per, offset = (c[k] for c in columns)
            nth = rank - first_rank
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(sequence + nth // per), pa.array(offset + nth % per * length)], schema=batch.schema)

    return ranked.mapInArrow(place, ranked.schema)


def pack_documents(docs: DataFrame, vocabulary_json: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenize, cut and pack: id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = checkpointed(token_pieces(docs, vocabulary_json, capacity, id_col=id_col, text_col=text_col))
    return pack_best_fit(pieces, capacity, order_cols=(id_col, "piece", "ids_crc32"))
