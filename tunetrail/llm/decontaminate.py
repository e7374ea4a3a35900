"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The patterns are all windows of ``window`` consecutive words of the benchmark
items (an item of fewer words is one window).  Shift tables over blocks of up
to three words skip positions where no pattern can end; where the shift is
zero, the bucket of that suffix block, split by the block that begins a
pattern, selects the patterns, and comparing the words confirms an occurrence.

A benchmark of at most ``BLOCK_BYTES`` is sent to the tasks, which hold its
tables and search their documents; documents are not shuffled.  A larger one
stays a table on Spark: only hashed shift tables of fixed size, one for each
pattern length, go to the tasks; the positions that they let through meet the
patterns of their suffix bucket in a join, which compares the words.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunetrail.llm.common import batches, checkpointed

WINDOW = 13
#: A document is contaminated if at least one in this many of its words is hit.
SHARE = 20
#: UTF-8 bytes of a benchmark that is searched inside the tasks, at most; the patterns of a larger one are joined.
BLOCK_BYTES = 2_000_000
#: Slots, a byte each, of a hashed shift table: no benchmark makes it larger, but one of far more words lets more positions through to the join.
SLOTS = 1 << 21
#: Slots of a shift table that travel in one row.
_RUN = 1 << 12

#: ASCII upper case becomes lower case; ASCII bytes but letters and digits part words; all other bytes belong to words.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words(text: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text; null has none."""
    return text.translate(_FOLD).split() if text else []


class Searcher:
    """Wu-Manber tables for patterns (tuples of words) of ``least`` words or more, each with the items it stands in."""

    def __init__(self, patterns: dict[tuple, set[str]]) -> None:
        self.least = min(map(len, patterns))
        self.block = min(3, self.least)
        self.default = self.least - self.block + 1
        self.shift: dict[tuple, int] = {}
        self.buckets: dict[tuple, dict[tuple, list[tuple]]] = {}
        self.items = patterns
        for p in patterns:
            for end in range(self.block, self.least + 1):
                key = p[end - self.block:end]
                self.shift[key] = min(self.shift.get(key, self.default), self.least - end)
            self.buckets.setdefault(p[self.least - self.block:self.least], {}).setdefault(p[:self.block], []).append(p)

    def occurrences(self, text: list[bytes]) -> Iterator[tuple[int, int, set[str]]]:
        """(first word, end, items) of every occurrence, by first word."""
        block, least, default, shift, buckets = self.block, self.least, self.default, self.shift, self.buckets
        end, n = least, len(text)
        while end <= n:
            key = tuple(text[end - block:end])
            skip = shift.get(key, default)
            if skip:
                end += skip
                continue
            begin = end - least
            for p in buckets[key].get(tuple(text[begin:begin + block]), ()):
                if tuple(text[begin:begin + len(p)]) == p:
                    yield begin, begin + len(p), self.items[p]
            end += 1


def searchers(items: list[tuple[str, bytes]], window: int = WINDOW) -> list[Searcher]:
    """One searcher for the full windows, one for the items that are shorter (their shifts are less)."""
    full: dict[tuple, set[str]] = {}
    short: dict[tuple, set[str]] = {}
    for item, text in items:
        w = words(text)
        if len(w) >= window:
            for i in range(len(w) - window + 1):
                full.setdefault(tuple(w[i:i + window]), set()).add(item)
        elif w:
            short.setdefault(tuple(w), set()).add(item)
    return [Searcher(p) for p in (full, short) if p]


_TABLES: dict[str, list[Searcher]] = {}


def _tables(key: str, items: list[tuple[str, bytes]], window: int) -> list[Searcher]:
    if key not in _TABLES:
        if len(_TABLES) >= 2:
            _TABLES.clear()
        _TABLES[key] = searchers(items, window)
    return _TABLES[key]


def _merged(spans: list[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def _suffix_slot(w: list[bytes], end: int, block: int, slots: int) -> int:
    return xxhash.xxh3_64_intdigest(b" ".join(w[end - block:end])) % slots


def benchmark_patterns(items: DataFrame, window: int = WINDOW, slots: int = SLOTS) -> DataFrame:
    """(n, bucket, pattern, item): each distinct pattern of n words, its words joined by blanks, with the slot of its last block."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("n", pa.int32()), ("bucket", pa.int32()), ("pattern", pa.binary()), ("item", pa.string())])

        def rows() -> Iterator[tuple]:
            for batch in it:
                for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    w = words(text)
                    n = min(window, len(w))
                    for end in range(n, len(w) + 1) if n else ():
                        yield n, _suffix_slot(w, end, min(3, n), slots), b" ".join(w[end - n:end]), item

        yield from batches(rows(), schema)

    return items.mapInArrow(run, "n int, bucket int, pattern binary, item string").distinct()


def hashed_shifts(patterns: DataFrame, slots: int = SLOTS) -> dict[int, np.ndarray]:
    """Pattern length -> shift table on hashed blocks; of blocks that share a slot the least shift counts, so no occurrence is skipped."""
    def shifts(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("n", pa.int32()), ("slot", pa.int32()), ("shift", pa.int32())])
        tables: dict[int, np.ndarray] = {}
        for batch in it:
            for n, pattern in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                w, block = pattern.split(b" "), min(3, n)
                t = tables.setdefault(n, np.full(slots, n - block + 1, dtype=np.int32))
                for end in range(block, n + 1):
                    slot = _suffix_slot(w, end, block, slots)
                    t[slot] = min(t[slot], n - end)
        for n, t in tables.items():
            used = np.flatnonzero(t <= n - min(3, n)).astype(np.int32)
            for k in range(0, len(used), 10_000):
                part = used[k:k + 10_000]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), n, dtype=np.int32)), pa.array(part), pa.array(t[part])], schema=schema)

    def run_of_slots(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        n, run = int(key[0]), int(key[1])
        t = np.full(_RUN, n - min(3, n) + 1, dtype=np.uint8)
        t[pdf["slot"].to_numpy() - run * _RUN] = pdf["shift"].to_numpy()
        return pd.DataFrame({"n": [n], "run": [run], "shifts": [t.tobytes()]})

    least = patterns.select("n", "pattern").mapInArrow(shifts, "n int, slot int, shift int").groupBy("n", "slot").agg(F.min("shift").alias("shift"))
    packed = least.groupBy("n", F.expr(f"int(slot div {_RUN})").alias("run")).applyInPandas(run_of_slots, "n int, run int, shifts binary")
    out: dict[int, np.ndarray] = {}
    for n, run, part in packed.collect():  # at most window x slots bytes
        t = out.setdefault(n, np.full(slots, n - min(3, n) + 1, dtype=np.uint8))
        t[run * _RUN:(run + 1) * _RUN] = np.frombuffer(bytes(part), dtype=np.uint8)[:slots]
    return out


def _joined_search(docs: DataFrame, items: DataFrame, window: int, slots: int) -> DataFrame:
    """``docs`` with ``_spans`` and ``_items`` in place of their empty ones, by a join of open positions with the patterns.

    What is found depends on the text alone, so copies of a text are one in the join, and a text's places of one pattern are one row."""
    patterns = checkpointed(benchmark_patterns(items, window, slots))
    tables = docs.sparkSession.sparkContext.broadcast(hashed_shifts(patterns, slots))

    def open_positions(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("key", pa.string()), ("n", pa.int32()), ("bucket", pa.int32()), ("pattern", pa.binary()), ("places", pa.list_(pa.int32()))])

        def rows() -> Iterator[tuple]:
            for batch in it:
                for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    w = words(text)
                    for n, table in tables.value.items():
                        found: dict[tuple[int, bytes], list[int]] = {}
                        block, end = min(3, n), n
                        while end <= len(w):
                            slot = _suffix_slot(w, end, block, slots)
                            if skip := int(table[slot]):
                                end += skip
                                continue
                            found.setdefault((slot, b" ".join(w[end - n:end])), []).append(end - n)
                            end += 1
                        for (slot, pattern), places in found.items():
                            yield key, n, slot, pattern, places

        yield from batches(rows(), schema)

    def merge(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            spans = [[x for s in _merged([(a, a + n) for n, places in zip(ns, lists) for a in places]) for x in s] for ns, lists in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.list_(pa.int32()))], names=["key", "spans"])

    key = F.coalesce(F.sha2("_text", 256), F.xxhash64("_0").cast("string")).alias("key")
    found = docs.where("_text is not null").select(key, "_text").mapInArrow(open_positions, "key string, n int, bucket int, pattern binary, places array<int>")
    found = found.groupBy("key", "bucket", "pattern").agg(F.first("n").alias("n"), F.first("places").alias("places"))
    hits = checkpointed(found.join(patterns.select("bucket", "pattern").distinct(), ["bucket", "pattern"], "left_semi"))
    spans = hits.groupBy("key").agg(F.collect_list(F.struct("n", "places")).alias("found")).select("key", "found.n", "found.places").mapInArrow(merge, "key string, spans array<int>")
    names = hits.join(patterns, ["bucket", "pattern"]).select("key", "item").distinct().groupBy("key").agg(F.array_sort(F.collect_list("item")).alias("names"))
    found = checkpointed(spans.join(names, "key"))
    kept = [c for c in docs.columns if c not in ("_spans", "_items")]
    return docs.select(key, *kept).join(found, "key", "left").select(*kept, F.col("spans").alias("_spans"), F.col("names").alias("_items"))


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = SHARE, id_col: str = "doc_id", text_col: str = "text",
                       item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES, slots: int = SLOTS, keep: tuple[str, ...] = ()) -> DataFrame:
    """Per document: id, the columns in ``keep``, n_words, n_hit, hit_spans (word ranges), n_items, item_ids (sorted as strings), items_sha256, contaminated.

    A word inside any occurrence of a window is hit; a document is contaminated if it has a hit and ``share`` times its
    hits are at least its words.  Every input row gives one output row, repeated and null ids too; a null or empty
    text has no words, and an empty benchmark hits nothing.  Items with a null id or null text are left out.  A benchmark
    of more than ``block_bytes`` is searched by a join with its patterns; the rows are the same.
    """
    carry = [id_col, *keep]
    state = docs.select(*[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(carry)], F.col(f"`{text_col}`").cast("binary").alias("_text"),
                        F.lit(None).cast("array<int>").alias("_spans"), F.lit(None).cast("array<string>").alias("_items"))

    out_schema = ", ".join(f"_{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(carry)) + ", n_words long, n_hit long, hit_spans array<int>, item_ids array<string>"

    def search(block: list[tuple[str, bytes]]):
        """Adds what the items in ``block`` hit, and counts: one pass, so a task has one Python worker."""
        key = uuid.uuid4().hex

        def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tables = _tables(key, block, window) if block else []
            for batch in it:
                k, n_words = batch.num_columns - 3, []
                spans, items = batch.column(k + 1).to_pylist(), batch.column(k + 2).to_pylist()
                for i, text in enumerate(batch.column(k).to_pylist()):
                    w = words(text)
                    n_words.append(len(w))
                    found = [x for t in tables for x in t.occurrences(w)]
                    if found:
                        old = spans[i] or []
                        spans[i] = [x for s in _merged([*zip(old[::2], old[1::2]), *((a, b) for a, b, _ in found)]) for x in s]
                        items[i] = sorted({*(items[i] or ())}.union(*(x for _, _, x in found)))
                n_hit = [sum(s[1::2]) - sum(s[::2]) if s else 0 for s in spans]
                arrays = [*batch.columns[:k], pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(spans, batch.schema.field(k + 1).type), pa.array(items, batch.schema.field(k + 2).type)]
                yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names[:k], "n_words", "n_hit", "hit_spans", "item_ids"])

        return run

    items = benchmark.select(F.col(f"`{item_col}`").cast("string").alias("item"), F.col(f"`{item_text_col}`").cast("binary").alias("text")).where("item is not null and text is not null")
    total = items.agg(F.sum(F.length("text") + F.length("item"))).first()[0] or 0
    if total > block_bytes:
        state = _joined_search(state, items, window, slots)
    out = state.mapInArrow(search([(r[0], bytes(r[1])) for r in items.collect()] if 0 < total <= block_bytes else []), out_schema)
    named = F.coalesce("item_ids", F.array().cast("array<string>"))
    return out.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(carry)], "n_words", "n_hit",
                      F.coalesce("hit_spans", F.array().cast("array<int>")).alias("hit_spans"),
                      F.size(named).cast("long").alias("n_items"), named.alias("item_ids"),
                      F.sha2(F.array_join(named, ",").cast("binary"), 256).alias("items_sha256"),
                      ((F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))
