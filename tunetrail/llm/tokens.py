"""Tokens of a batch of texts as arrays: bytes are classed by a table, runs of word bytes are the tokens."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard

#: Bytes of text that are tokenized together, about, and rows at most; a longer text is taken alone.
SLICE_BYTES, SLICE_ROWS = 12 << 20, 1 << 20

WORD, BLANK, BREAK = 0, 1, 2
#: A-Z in lower case, other bytes as they are.
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)


def byte_classes(blanks: bytes, breaks: bytes = b"") -> np.ndarray:
    """A class for each byte: BLANK parts words, BREAK parts pieces, all others make up words."""
    out = np.zeros(256, dtype=np.uint8)
    out[list(blanks)] = BLANK
    out[list(breaks)] = BREAK
    return out


@dataclass
class Tokens:
    """Tokens in order: ``ids`` into ``words``, and for each the number of its text and of its piece (counted over the batch)."""

    ids: np.ndarray
    words: pa.Array
    text: np.ndarray
    piece: np.ndarray


def slices(batch: pa.RecordBatch, column: int, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about ``size`` bytes of text."""
    lengths = batch.column(column).cast(pa.large_binary()).fill_null(b"")
    ends = np.cumsum(np.diff(np.frombuffer(lengths.buffers()[1], dtype=np.int64, count=lengths.offset + len(lengths) + 1)[lengths.offset:]))
    begin = 0
    while begin < batch.num_rows:
        done = ends[begin - 1] if begin else 0
        end = min(begin + SLICE_ROWS, max(begin + 1, int(np.searchsorted(ends, done + size, side="right"))))
        yield batch.slice(begin, end - begin)
        begin = end


def tokenize(texts: pa.Array, classes: np.ndarray) -> Tokens:
    """Tokens of UTF-8 texts, A-Z in lower case; a null text is empty."""
    texts = pa.concat_arrays([texts.cast(pa.large_binary()).fill_null(b"")])
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64, count=texts.offset + len(texts) + 1)[texts.offset:]
    raw = texts.buffers()[2]
    data = LOWER[np.frombuffer(raw, dtype=np.uint8)[offsets[0]:offsets[-1]]] if raw is not None and len(texts) else np.empty(0, np.uint8)
    offsets = offsets - offsets[0]
    kind = classes[data]
    word = kind == WORD
    border = np.zeros(len(data) + 1, dtype=bool)  # a text begins here
    border[offsets] = True
    before = np.empty(len(data), dtype=bool)
    before[:1], before[1:] = False, word[:-1]
    starts = np.flatnonzero(word & (~before | border[:-1]))
    before[:-1], before[-1:] = word[1:], False
    ends = np.flatnonzero(word & (~before | border[1:])) + 1
    places = np.zeros(len(starts) + 1, dtype=np.int64)
    np.cumsum(ends - starts, out=places[1:])
    found = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(places), pa.py_buffer(data[word])])
    coded = found.dictionary_encode()
    breaks = np.flatnonzero(kind == BREAK)
    return Tokens(coded.indices.to_numpy(zero_copy_only=False), coded.dictionary, np.searchsorted(offsets, starts, side="right") - 1, np.searchsorted(breaks, starts))


def hashes(words: pa.Array, prefix: bytes = b"") -> np.ndarray:
    """64-bit hashes of the words, each after ``prefix``."""
    said = words.to_pylist()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, [prefix + w for w in said] if prefix else said), dtype=np.uint64, count=len(said))


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """64-bit hashes of pairs of 64-bit values."""
    x = (a ^ (a >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + b
    for _ in range(2):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def packed(values: np.ndarray) -> bytes:
    """Non-negative integers in the narrowest unsigned type that holds them, byte by byte of all, compressed; the width is the first byte."""
    most = int(values.max(initial=0))
    width = next(w for w in (1, 2, 4, 8) if most < 1 << 8 * w)
    planes = values.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T
    return bytes([width]) + zstandard.ZstdCompressor(1).compress(planes.tobytes())


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), np.uint8).reshape(data[0], -1)
    return np.ascontiguousarray(planes.T).view(f"<u{data[0]}").ravel().astype(np.int64)


def packed_keys(keys: np.ndarray) -> bytes:
    """64-bit values in rising order: the steps of their upper 24 bits compressed, the other five bytes as they are."""
    high = packed(np.diff(keys >> np.uint64(40), prepend=np.uint64(0)).astype(np.int64))
    low = np.ascontiguousarray(keys).view(np.uint8).reshape(-1, 8)[:, :5]
    return len(high).to_bytes(8, "little") + high + low.tobytes()


def unpacked_keys(data: bytes) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    high = np.cumsum(unpacked(data[8:8 + size])).astype(np.uint64)
    low = np.zeros((len(high), 8), dtype=np.uint8)
    low[:, :5] = np.frombuffer(data, np.uint8, offset=8 + size).reshape(-1, 5) if len(high) else 0
    return high << np.uint64(40) | low.view(np.uint64).ravel()


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """A number below ``buckets`` (at most 2**31) for each 64-bit hash; rises with the hash."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
