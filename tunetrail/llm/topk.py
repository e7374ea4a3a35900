"""Exact top-k inner products by Fagin's threshold algorithm.

Candidates are dealt into chunks of bounded size.  In a chunk, each dimension
has its list of candidates sorted by value.  A query walks the lists of its
non-zero dimensions from the end that serves it, scores every candidate that
it meets for the first time, and stops when the threshold, what a candidate not
yet met could score at most, can't beat its k-th best score.  Queries are
walked in blocks, with lists read in growing steps, so scoring is a matrix
product.  The k best of every chunk meet in a windowed top-k.

A query's k-th score in a first chunk is a bound for all others: there it stops as soon as the threshold is below it.

Every query meets every chunk, in blocks of queries by chunks of candidates: a
stated query set against all rows.  No chunk or block is beyond its size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunetrail.llm.common import checkpointed

K = 20
QUERY_EVERY = 20
#: Components are multiplied by this and rounded down.
SCALE = 64
#: Rows of a chunk of candidates and of a block of queries, about; queries of a block that walk the lists together.
CHUNK_ROWS, BLOCK_ROWS, TOGETHER = 8192, 4096, 256
#: Depth to which the lists are read first; each later step reads as many more as were read before.
FIRST_STEP = 32


def integers(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(id, x): components times ``scale``, rounded down; without null vectors, and those with null or non-finite components or a null id."""
    x = F.col(f"`{vector_col}`").cast("array<double>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return vectors.select(F.col(f"`{id_col}`").alias("id"), x.alias("x")).where(F.col("id").isNotNull() & F.col("x").isNotNull() & ~bad).select("id", F.transform("x", lambda c: F.floor(c * scale)).alias("x"))


class Chunk:
    """Candidates with their sorted lists."""

    def __init__(self, ids: np.ndarray, x: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.x = ids[order], x[order]
        self.lists = np.argsort(self.x, axis=0, kind="stable")  # a column for each dimension, least value first
        self.largest = float(np.abs(self.x).max(initial=0))
        self.scored = 0  # pairs of query and candidate

    def top(self, query_ids: np.ndarray, q: np.ndarray, k: int, least: np.ndarray | None = None) -> Iterator[tuple[int, int, int]]:
        """(place of the query, id, score) of each query's k best in this chunk, ties to smaller ids; candidates of the query's own
        id don't count.  Candidates below the query's ``least`` score may be left out."""
        n, dims = self.x.shape
        # doubles are exact below 2**53; beyond, 64-bit integers
        kind = np.float64 if self.largest * float(np.abs(q).max(initial=0)) * max(1, dims) < 2**53 else np.int64
        x, q = self.x.astype(kind), q.astype(kind)
        lowest = -np.inf if kind is np.float64 else np.iinfo(np.int64).min
        scores = np.full((len(q), n), lowest, dtype=kind)
        met = np.zeros(n, dtype=bool)
        going = np.arange(len(q))
        own = np.stack([np.searchsorted(self.ids, query_ids, side=side) for side in ("left", "right")], axis=1)
        depth, step = 0, min(FIRST_STEP, n)
        kth = np.full(len(q), -np.inf) if least is None else least.astype(np.float64)
        while len(going) and not met.all():
            depth, step = min(n, depth + step), depth + step
            if dims and depth < n:
                up, down = (q[going] > 0).any(axis=0), (q[going] < 0).any(axis=0)
                near = np.zeros(n, dtype=bool)
                near[self.lists[n - depth:, up]] = True
                near[self.lists[:depth, down]] = True
            else:
                near = np.ones(n, dtype=bool)
            new = np.flatnonzero(near & ~met)
            met |= near
            scores[np.ix_(going, new)] = q[going] @ x[new].T
            self.scored += len(going) * len(new)
            for i in going[own[going, 0] < own[going, 1]]:
                scores[i, own[i, 0]:own[i, 1]] = lowest
            if depth >= n:
                break
            if k <= met.sum():  # a query's own rows are at the bottom, so they can't stand for others
                best = -np.partition(-scores[going].astype(np.float64), k - 1, axis=1)[:, k - 1]
                kth[going] = np.maximum(kth[going], np.where(best > float(lowest), best, -np.inf))
            high, low = x[self.lists[n - depth - 1], np.arange(dims)], x[self.lists[depth], np.arange(dims)]
            bound = np.where(q[going] > 0, q[going] * high, q[going] * low).astype(np.float64).sum(axis=1)
            slack = 0 if kind is np.float64 else 1e-9 * np.abs(bound)  # wide integers are rounded here
            going = going[bound + slack >= kth[going]]  # an equal score could still win by its id
        for i in range(len(q)):
            seen = np.flatnonzero(scores[i] > lowest)
            s = scores[i, seen]
            if len(s) > k:
                keep = s >= np.partition(s, len(s) - k)[len(s) - k]
                seen, s = seen[keep], s[keep]
            for j in np.lexsort((self.ids[seen], -s))[:k]:
                yield i, int(self.ids[seen[j]]), int(s[j])


def top_k(queries: DataFrame, candidates: DataFrame, k: int = K, chunk_rows: int = CHUNK_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, rank from 1, id, score): each query row's k candidates of the highest integer inner product, ties to the smaller id.

    Both tables are (id long, x array<long>).  Candidates with the query's id aren't its partners; a repeated id is a
    partner once for each of its rows, and every query row has its own k rows, also if it repeats an id or a whole row.
    Vectors of different lengths meet on their common components.  Fewer than k candidates give fewer rows; none give
    none.  Products are 64-bit integers and wrap beyond.
    """
    n = candidates.count()
    # equal rows are walked once; the key tells apart different vectors of one id
    asked = checkpointed(queries.groupBy("id", "x").agg(F.count(F.lit(1)).alias("times")).withColumn("key", F.monotonically_increasing_id()))
    chunks, blocks = max(1, -(-n // chunk_rows)), max(1, -(-asked.count() // block_rows))
    deal = lambda parts: F.pmod(F.xxhash64(F.col("id"), F.col("x")), F.lit(parts)).cast("int")
    # of equal rows no more than k can be among the k best, so a row that fills a third of the table fills no chunk
    c = (candidates.withColumn("chunk", deal(chunks)).groupBy("chunk", "id", "x").agg(F.count(F.lit(1)).alias("times"))
         .select("chunk", "id", "x", F.explode(F.sequence(F.lit(1).cast("long"), F.least("times", F.lit(k).cast("long"))))).drop("col"))
    q = asked.select("key", "id", "x", deal(blocks).alias("block"))

    def walk(left: pa.Table, right: pa.Table) -> pa.Table:
        rows: list[tuple[int, int, int]] = []
        if left.num_rows and right.num_rows:
            width = max(max(map(len, t.column("x").to_pylist())) for t in (left, right))
            a, (ids, x) = _table(left, width), _table(right, width)
            chunk, keys, least = Chunk(*a), right.column("key").to_numpy(), np.array([-np.inf if v is None else v for v in right.column("least").to_pylist()])
            for i in range(0, len(ids), TOGETHER):
                part = slice(i, i + TOGETHER)
                rows += [(keys[i + j], found, score) for j, found, score in chunk.top(ids[part], x[part], k, least[part])]
        return pa.table({name: pa.array([r[i] for r in rows], pa.int64()) for i, name in enumerate(("key", "id", "score"))})

    def best(of: DataFrame, queries: DataFrame, begin: int) -> DataFrame:
        """The k best of each query in each of the chunks ``begin`` and up."""
        meet = of.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).groupBy("chunk", "block")
        walked = queries.withColumn("chunk", F.explode(F.sequence(F.lit(begin), F.lit(chunks - 1 if begin else 0)))).groupBy("chunk", "block")
        return meet.cogroup(walked).applyInArrow(walk, "key long, id long, score long")

    part = best(c.where("chunk = 0"), q.withColumn("least", F.lit(None).cast("long")), 0)
    if chunks > 1:
        part = checkpointed(part)
        least = part.groupBy("key").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("least"))
        part = part.union(best(c.where("chunk > 0"), q.join(least, "key", "left"), 1))
    w = Window.partitionBy("key").orderBy(F.col("score").desc(), "id")
    ranked = part.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return (ranked.join(asked.select("key", F.col("id").alias("query_id"), "times"), "key").withColumn("_each", F.explode(F.sequence(F.lit(1), F.col("times"))))
            .select("query_id", "rank", "id", "score"))


def _table(t: pa.Table, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids, and the vectors filled with zeros to ``width``."""
    x = np.zeros((t.num_rows, width), dtype=np.int64)
    flat = t.column("x").combine_chunks()
    lengths = np.asarray(flat.value_lengths().fill_null(0))
    values = np.asarray(flat.flatten())
    if (lengths == width).all():
        x[:] = values.reshape(-1, width)
    else:
        x[np.arange(width) < lengths[:, None]] = values
    return np.asarray(t.column("id").combine_chunks()), x
