"""Item-item similarity, neighbours and predictions of large tables, from files that tasks read by path.

Any exchange of products, of contributions, or of a user's ratings once for each block of items it meets is many times the
ratings.  Here the ratings lie once in files by user, sorted; a task has a block of items, goes through the files one at a time and
keeps what its items meet.  Predictions go the other way: a task has the ratings of one file and goes through the stored neighbour
lists, block of items by block.  What is exchanged doesn't grow with the number of blocks, and a task holds one file and its block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tunetrail.operators.recsys import itemcf as cf
from tunetrail.session import PART_ROWS, readable, spread, store
from tunetrail.sources.logs import file_system

# Tunables: products of a block of items, ratings that a block meets, contributions that are added up at a time; about.
BLOCK_PRODUCTS, BLOCK_MEETS, CONTRIBUTIONS = 2_000_000, 4_000_000, 1_000_000
OUT_ROWS = 200_000  # rows of a batch of results


@dataclass
class Postings:
    files: list[str]    # (uid, song_id, rating, n2), sorted by uid and song_id; a user's ratings are in one file
    products: float     # pairs of ratings of the same user, either order once
    meets: float        # ratings that the users of each item have, over all items


def lay_out(util: DataFrame, from_products: float = cf.PAIR_PRODUCTS) -> Postings | None:
    """The ratings by user, with their items' norms; None for a small table, or if tasks can't open the shared folder."""
    counts = util.where("uid is not null and song_id is not null").groupBy("uid").agg(F.count(F.lit(1)).cast("double").alias("n"))
    met = counts.agg(F.sum(F.col("n") * (F.col("n") + 1) / 2).alias("products"), F.sum(F.col("n") * F.col("n")).alias("meets")).first()
    if (met.products or 0.0) <= from_products or not readable(util.sparkSession):
        return None
    rows = util.count()
    plain = util.where("song_id is not null").select("uid", "song_id", F.col("rating").cast("double").alias("rating"))
    norms = cf.item_norms(util).withColumn("n2", F.col("n2").cast("double"))
    rated = spread(plain, rows, "song_id").join(spread(norms, rows, "song_id"), "song_id")
    return Postings(by_user(rated.select("uid", "song_id", "rating", "n2"), rows), met.products, met.meets)


def by_user(rated: DataFrame, rows: int) -> list[str]:
    """Files of ratings by user, sorted by user and song."""
    parts = max(rated.sparkSession.sparkContext.defaultParallelism, -(-rows // PART_ROWS))
    return store(rated.repartition(parts, "uid").sortWithinPartitions("uid", "song_id"), "ratings")[1]


def _columns(file: str, *names: str) -> list[pa.Array]:
    system, name = file_system(file)
    with system.open_input_file(name) as f:
        t = pq.read_table(f, columns=list(names), use_threads=False)
    return [t.column(c).combine_chunks() if t.num_rows else pa.array([], t.schema.field(c).type) for c in names]


def _numbers(a: pa.Array, null: float | int = 0) -> np.ndarray:
    return (a if not a.null_count else a.fill_null(null)).to_numpy(zero_copy_only=False)


class Ratings:
    """A file's rows of known users, with the range of each row's user."""

    def __init__(self, file: str, known_only: bool = False) -> None:
        uid, song, rating, n2 = _columns(file, "uid", "song_id", "rating", "n2")
        keep = uid.is_valid().to_numpy(zero_copy_only=False)
        self.uid, self.song, self.rating, self.n2 = _numbers(uid), _numbers(song), _numbers(rating, math.nan), _numbers(n2, math.nan)
        if known_only:
            keep &= ~np.isnan(self.rating)
        if not keep.all():
            self.uid, self.song, self.rating, self.n2 = (x[keep] for x in (self.uid, self.song, self.rating, self.n2))
        self.starts = np.append(np.flatnonzero(_new(self.uid)), len(self.uid))

    def user(self, rows: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, rows, side="right") - 1


def _new(*sorted_columns: np.ndarray) -> np.ndarray:
    """Where a row of sorted columns differs from the one before."""
    out = np.zeros(len(sorted_columns[0]), dtype=bool)
    out[:1] = True
    for x in sorted_columns:
        out[1:] |= x[1:] != x[:-1]
    return out


def _ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first, first + 1, ... of each range, one range after the other."""
    ends = np.cumsum(count)
    return np.repeat(first - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)


def _block(song: np.ndarray, blocks: int) -> np.ndarray:
    x = song.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((x >> np.uint64(33)) % np.uint64(blocks)).astype(np.int64)


def _tasks(spark: SparkSession, n: int) -> DataFrame:
    return spark.range(0, n, 1, n)


def _batches(columns: dict[str, np.ndarray], schema: pa.Schema, nulls: dict[str, np.ndarray] | None = None) -> Iterator[pa.RecordBatch]:
    arrays = [pa.array(columns[f.name], f.type, mask=(nulls or {}).get(f.name)) for f in schema]
    yield from pa.table(arrays, schema=schema).to_batches(max_chunksize=OUT_ROWS)


# ------------------------------------------------------------- similarity

def _slices(count: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose counts are at most ``most`` in all; a row with more is alone."""
    at, x = np.append(0, np.cumsum(count)), 0
    while x < len(count):
        y = max(x + 1, int(np.searchsorted(at, at[x] + most, side="right")) - 1)
        yield x, y
        x = y


class _Sums:
    """Sums by (i, j); adds its parts up whenever they are ``most`` rows more than before."""

    def __init__(self, most: int) -> None:
        self.most, self.parts, self.rows, self.base = most, [], 0, 0

    def add(self, i: np.ndarray, j: np.ndarray, n2_i: np.ndarray, n2_j: np.ndarray, p: np.ndarray, known: np.ndarray) -> None:
        self.parts.append((i, j, n2_i, n2_j, p, known))
        self.rows += len(i)
        if self.rows >= self.base + self.most:
            self.added()
            self.base = self.rows

    def added(self) -> tuple[np.ndarray, ...]:
        if len(self.parts) != 1 or self.rows > self.base:
            i, j, n2_i, n2_j, p, known = (np.concatenate(x) for x in zip(*self.parts)) if self.parts else (np.empty(0, t) for t in (np.int64, np.int64, float, float, float, bool))
            order = np.lexsort((j, i))
            i, j = i[order], j[order]
            new = np.flatnonzero(_new(i, j))
            first = order[new]
            self.parts = [(i[new], j[new], n2_i[first], n2_j[first], np.add.reduceat(p[order], new) if len(new) else p, np.logical_or.reduceat(known[order], new) if len(new) else known)]
            self.rows = len(new)
        return self.parts[0]


def gram(spark: SparkSession, postings: Postings) -> DataFrame:
    """(item_i <= item_j, dot, n2_i, n2_j) over co-rated item pairs.  A task has a block of items and makes, of each of their ratings, the
    products with the same user's ratings of items not smaller.  A null rating adds nothing; a pair without any other has a null sum."""
    files, most = postings.files, BLOCK_PRODUCTS
    blocks = max(1, math.ceil(postings.products / most))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (x for batch in batches for x in batch.column(0).to_pylist()):
            sums = _Sums(most)
            for file in files:
                r = Ratings(file)
                own = np.flatnonzero(_block(r.song, blocks) == b)
                if not len(own):
                    continue
                same = np.flatnonzero(_new(r.uid, r.song))  # a pair of a user may come more than once
                first = same[np.searchsorted(same, own, side="right") - 1]
                count = r.starts[r.user(own) + 1] - first
                for x, y in _slices(count, most):
                    rows, k = np.repeat(own[x:y], count[x:y]), _ranges(first[x:y], count[x:y])
                    p = r.rating[rows] * r.rating[k]
                    known = ~np.isnan(p)
                    sums.add(r.song[rows], r.song[k], r.n2[rows], r.n2[k], np.nan_to_num(p), known)
            i, j, n2_i, n2_j, dot, known = sums.added()
            yield from _batches({"item_i": i, "item_j": j, "dot": dot, "n2_i": n2_i, "n2_j": n2_j}, cf.PAIRS, {"dot": ~known})

    return _tasks(spark, blocks).mapInArrow(run, "item_i long, item_j long, dot double, n2_i double, n2_j double")


# ------------------------------------------------------------- neighbours

def _hot(spark: SparkSession, files: list[str], most: int) -> list[tuple[int, int]]:
    """Items that alone meet more than ``most`` ratings, and in how many parts they go."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for f in (x for batch in batches for x in batch.column(0).to_pylist()):
            r = Ratings(files[f], known_only=True)
            order = np.argsort(r.song, kind="stable")
            new = np.flatnonzero(_new(r.song[order]))
            n = np.repeat(np.diff(r.starts), np.diff(r.starts))[order].astype(float)
            yield pa.RecordBatch.from_arrays([pa.array(r.song[order][new]), pa.array(np.add.reduceat(n, new) if len(new) else n)], names=["song_id", "meets"])

    met = _tasks(spark, len(files)).mapInArrow(run, "song_id long, meets double").groupBy("song_id").agg(F.sum("meets").alias("meets"))
    found = met.where(F.col("meets") > most).collect()  # no more items than there are blocks
    return sorted((r.song_id, min(len(files), math.ceil(r.meets / most))) for r in found)


def top_neighbours(spark: SparkSession, postings: Postings, k: int = cf.NEIGHBOURS) -> DataFrame:
    """The rows of :func:`itemcf.top_neighbours`; those of an item are in one partition.

    A task has a block of items with all their users, so their ranks are final there.  Of an item that alone meets more
    than a block's ratings, tasks have the users of some files each, and its pairs are added up after them."""
    files, blocks = postings.files, max(1, math.ceil(postings.meets / BLOCK_MEETS))
    hot = _hot(spark, files, BLOCK_MEETS)
    parts = [(song, part, n) for song, n in hot for part in range(n)]
    hot_songs = np.array([song for song, _ in hot], dtype=np.int64)

    def pairs(files: list[str], mine) -> pa.Table:
        got: list[tuple] = []
        base = 0
        for file in files:
            r = Ratings(file, known_only=True)
            own = np.flatnonzero(mine(r.song))
            if not len(own):
                continue
            user, place = np.unique(r.user(own), return_inverse=True)
            begin, count = r.starts[user], np.diff(r.starts)[user]
            at = _ranges(begin, count)
            ends = base + np.cumsum(count)
            top = np.maximum.reduceat(r.rating[at] / np.sqrt(r.n2[at]), ends - count - base)
            got.append((r.song[own], r.rating[own], top[place], r.n2[own], (ends - count)[place], ends[place], r.song[at], r.rating[at], r.n2[at]))
            base = int(ends[-1])
        if not got:
            return pa.Table.from_batches([], cf.PAIRS)
        song, own, top, n2, first, last, *posted = (np.concatenate(x) for x in zip(*got))
        order = np.argsort(song, kind="stable")
        return cf.best_pairs(*(x[order] for x in (song, own, top, n2, first, last)), *posted, k, len(files) == len(postings.files))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (x for batch in batches for x in batch.column(0).to_pylist()):
            found = pairs(files, lambda song: (_block(song, blocks) == b) & ~np.isin(song, hot_songs))
            i, j, dot, n2_i, n2_j = (found.column(c).to_numpy() for c in cf.PAIRS.names)
            sim = dot / np.sqrt(n2_i * n2_j)
            order = np.lexsort((~j, -sim, i))
            order = order[sim[order] > 0]
            i, j, sim = i[order], j[order], sim[order]
            first = np.flatnonzero(_new(i))
            rank = np.arange(len(i)) - np.repeat(first, np.diff(np.append(first, len(i)))) + 1
            yield from _batches({"item_i": i, "item_j": j, "sim": sim, "rank": rank}, pa.schema([("item_i", pa.int64()), ("item_j", pa.int64()), ("sim", pa.float64()), ("rank", pa.int32())]))

    def run_hot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in (x for batch in batches for x in batch.column(0).to_pylist()):
            song, part, n = parts[t]
            yield from pairs(files[part::n] if n > 1 else files, lambda x: x == song).to_batches(max_chunksize=OUT_ROWS)

    out = _tasks(spark, blocks).mapInArrow(run, "item_i long, item_j long, sim double, rank int")
    if parts:
        some = _tasks(spark, len(parts)).mapInArrow(run_hot, "item_i long, item_j long, dot double, n2_i double, n2_j double")
        out = out.unionByName(cf.neighbours(cf.similarity_of_pairs(some), k))
    return out


# ------------------------------------------------------------ predictions

def stored_neighbours(neigh: DataFrame) -> list[str]:
    """Files of neighbour lists sorted by ``item_j``.  All rows of an ``item_i`` have to be in one partition."""
    return store(neigh.select("item_i", "item_j", "sim").sortWithinPartitions("item_j"), "neighbours")[1]


def scored(spark: SparkSession, files: list[str], lists: list[str], n: int | None = None, digits: int | None = 6) -> DataFrame:
    """(uid, song_id, num, den) as of :func:`itemcf._scored`: of all items with a neighbour that the user rated; or, with ``n``, of
    those that the user hasn't rated, and of these only what can be among the n best by prediction, then larger id."""
    most = CONTRIBUTIONS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for f in (x for batch in batches for x in batch.column(0).to_pylist()):
            ids, song, rating = _columns(files[f], "uid", "song_id", "rating")
            none, uid, song, rating = ids.is_null().to_numpy(zero_copy_only=False), _numbers(ids), _numbers(song), _numbers(rating, math.nan)
            if not len(uid):
                continue
            start = _new(none, uid)
            user = np.cumsum(start) - 1
            uid, none = uid[start], none[start]
            order = np.argsort(song, kind="stable")
            song, rating, user = song[order], rating[order], user[order]
            first = np.flatnonzero(_new(song))
            many, rated = np.diff(np.append(first, len(song))), song[first]

            def met(j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
                place = np.minimum(np.searchsorted(rated, j), len(rated) - 1)
                at = np.flatnonzero(rated[place] == j)
                return at, place[at]

            best = _Best(len(uid), n, digits) if n is not None else None
            for file in lists:
                j, i, sim = (_numbers(x) for x in _columns(file, "item_j", "item_i", "sim"))
                at, place = met(j)
                if not len(at):
                    continue
                j, i, sim, at, count = j[at], i[at], sim[at], first[place], many[place]
                code, item = pd.factorize(i)
                sums: list[tuple] = []
                for x, y in _slices(count, most):
                    e, k = np.repeat(np.arange(x, y), count[x:y]), _ranges(at[x:y], count[x:y])
                    p = rating[k] * sim[e]
                    known = ~np.isnan(p)
                    sums.append(_by_key(user[k] * len(item) + code[e], np.nan_to_num(p), sim[e], known))
                key, num, den, known = sums[0] if len(sums) == 1 else _by_key(*(np.concatenate(x) for x in zip(*sums)))
                who, what = np.divmod(key, len(item))
                if best is None:
                    yield from _batches({"uid": uid[who], "song_id": item[what], "num": num, "den": den}, SCORED, {"uid": none[who], "num": ~known})
                    continue
                own = np.argsort(item, kind="stable")
                at, place = met(item[own])
                has = np.repeat(own[at], many[place])
                mine = user[_ranges(first[place], many[place])] * len(item) + has
                new = ~np.isin(key, mine)
                best.add(who[new], item[what[new]], num[new], den[new], known[new])
            if best is not None:
                who, what, num, den, known = best.left()
                yield from _batches({"uid": uid[who], "song_id": what, "num": num, "den": den}, SCORED, {"uid": none[who], "num": ~known})

    return _tasks(spark, len(files)).mapInArrow(run, "uid long, song_id long, num double, den double")


SCORED = pa.schema([("uid", pa.int64()), ("song_id", pa.int64()), ("num", pa.float64()), ("den", pa.float64())])


def _by_key(key: np.ndarray, num: np.ndarray, den: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, ...]:
    order = np.argsort(key, kind="stable")
    key = key[order]
    new = np.flatnonzero(_new(key))
    return key[new], np.add.reduceat(num[order], new), np.add.reduceat(den[order], new), np.logical_or.reduceat(known[order], new)


class _Best:
    """Of each user what can be among the n best by the rounded prediction, then by larger song.

    Which way a prediction near a half is rounded is left to Spark: it counts with the lower of both until n others are surely better."""

    def __init__(self, users: int, n: int, digits: int | None) -> None:
        self.n, self.digits, self.parts, self.rows, self.base = n, digits, [], 0, 0
        self.least = np.full(users, -np.inf)  # what a user's n-th is at least

    def add(self, who: np.ndarray, what: np.ndarray, num: np.ndarray, den: np.ndarray, known: np.ndarray) -> None:
        pred = np.where(known & (den != 0), num / np.where(den != 0, den, 1.0), 0.0)
        if self.digits is None:
            low = high = pred
        else:
            x = pred * 10.0 ** self.digits + 0.5
            slack = 1e-3 + np.abs(x) * 1e-14
            low, high = np.floor(x - slack), np.floor(x + slack)
        keep = high >= self.least[who]
        self.parts.append(tuple(x[keep] for x in (who, what, num, den, known, low, high)))
        self.rows += int(keep.sum())
        if self.rows > self.base + max(500_000, 4 * self.n * len(self.least)):
            self._cut()

    def _cut(self) -> None:
        who, what, num, den, known, low, high = (np.concatenate(x) for x in zip(*self.parts))
        order = np.lexsort((~what, -low, who))
        who, what, num, den, known, low, high = (x[order] for x in (who, what, num, den, known, low, high))
        first = np.flatnonzero(_new(who))
        many = np.diff(np.append(first, len(who)))
        nth = first + np.minimum(many, self.n) - 1
        full = np.repeat(many >= self.n, many)
        least, song = np.repeat(low[nth], many), np.repeat(what[nth], many)
        keep = ~full | (high > least) | ((high == least) & (what >= song))
        self.least[who[first[many >= self.n]]] = low[nth[many >= self.n]]
        self.parts = [tuple(x[keep] for x in (who, what, num, den, known, low, high))]
        self.rows = self.base = int(keep.sum())

    def left(self) -> tuple[np.ndarray, ...]:
        if not self.parts:
            return tuple(np.empty(0, t) for t in (np.int64, np.int64, float, float, bool))
        self._cut()
        return self.parts[0][:5]


def predict(spark: SparkSession, files: list[str], lists: list[str], digits: int | None = 6) -> DataFrame:
    """The rows of :func:`itemcf.predict`."""
    return scored(spark, files, lists).where(F.col("den") > 0).select("uid", "song_id", cf._pred(digits).alias("pred"))


def recommend(spark: SparkSession, files: list[str], lists: list[str], names: DataFrame | None = None, n: int = cf.TOP_N, digits: int | None = 6) -> DataFrame:
    """The rows of :func:`itemcf.recommend` for the users of ``files``."""
    w = Window.partitionBy("uid").orderBy(F.desc("pred"), F.desc("song_id"))
    cand = scored(spark, files, lists, n, digits).where(F.col("den") > 0).select("uid", "song_id", cf._pred(digits).alias("pred"))
    out = cand.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
    return out if names is None else out.join(names, "song_id", "left")
