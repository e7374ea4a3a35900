"""Item-item collaborative filtering on the long utility table.

Cosine similarity between item columns of the user x item matrix is
``dot(i, j) / sqrt(|i|^2 |j|^2)`` where ``dot(i, j) = sum_u r_ui r_uj``.
The dot products are a sparse Gram matrix: a self join of each user's
ratings.  A user's items are cut by hash into chunks of about CHUNK_ITEMS,
and the join is on (user, chunk, chunk), so no key holds more than two
chunks, whatever a user's number of ratings; the products are partially
aggregated by (i, j) before the exchange.  Nothing runs while the plan is
built, and how the joins run is left to Spark's size threshold and AQE.

The neighbourhood is a top-k window whose ``row_number() <= k`` filter Spark
turns into a partial per-task limit before the shuffle.  :func:`top_neighbours`
gets it without the table of all pairs: blocks of items meet the ratings of
their users, and only what can still be among an item's k best is carried on.

Large tables go through :mod:`posted`: there no block is sent its users' ratings.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunetrail.functions.exprs import nan_to_zero
from tunetrail.session import spread

# Neighbourhood size 75, list length 10.
NEIGHBOURS = 75
TOP_N = 10
# Tunables: items of one user in a chunk, about; ratings that a block of items meets, about.
CHUNK_ITEMS = 256
BLOCK_RATINGS = 2_000_000
# Products of two blocks of items; contributions that a task sums to predictions; entries of a list of them; contributions
# of a user that is summed by many tasks; about.
PAIR_PRODUCTS, TASK_CONTRIBUTIONS, LIST_ITEMS, USER_CONTRIBUTIONS = 4_000_000, 2_000_000, 256, 1_000_000


def item_norms(util: DataFrame) -> DataFrame:
    return util.groupBy("song_id").agg(F.sum(F.col("rating") * F.col("rating")).alias("n2"))


def chunk_pairs(util: DataFrame, chunk_items: int = CHUNK_ITEMS) -> DataFrame:
    """(uid, lo, hi, c, song_id, rating): each rating once for each pair of chunks of its user that it takes part in.

    The ratings that meet under one (uid, lo, hi) are at most two chunks."""
    per_user = util.groupBy("uid").agg(F.ceil(F.count(F.lit(1)) / chunk_items).cast("int").alias("chunks"))
    return (util.select("uid", "song_id", "rating").join(per_user, "uid")
                .withColumn("c", F.pmod(F.xxhash64("song_id"), F.col("chunks")).cast("int"))
                .withColumn("k", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
                .select("uid", F.least("c", "k").alias("lo"), F.greatest("c", "k").alias("hi"), "c", "song_id", "rating"))


def cooccurrence(util: DataFrame, chunk_items: int = CHUNK_ITEMS) -> DataFrame:
    """Sparse Gram matrix (item_i <= item_j, dot) over co-rated item pairs, diagonal included.

    Under two different chunks only items of different chunks are paired, so each pair of a user meets once."""
    rows = chunk_pairs(util, chunk_items)
    a = rows.select("uid", "lo", "hi", F.col("c").alias("c_i"), F.col("song_id").alias("item_i"), F.col("rating").alias("r_i"))
    b = rows.select("uid", "lo", "hi", F.col("c").alias("c_j"), F.col("song_id").alias("item_j"), F.col("rating").alias("r_j"))
    pairs = a.join(b, ["uid", "lo", "hi"]).where((F.col("item_i") <= F.col("item_j")) & ((F.col("lo") == F.col("hi")) | (F.col("c_i") != F.col("c_j"))))
    return pairs.select("item_i", "item_j", (F.col("r_i") * F.col("r_j")).alias("p")).groupBy("item_i", "item_j").agg(F.sum("p").alias("dot"))


def similarity_blocks(util: DataFrame) -> int:
    """Blocks of items for :func:`item_similarity`: so many that two of them make about PAIR_PRODUCTS products; one for a small table."""
    n = util.groupBy("uid").agg(F.count(F.lit(1)).alias("n"))
    products = n.agg(F.sum(F.col("n").cast("double") * (F.col("n") + 1) / 2)).first()[0] or 0.0
    return max(1, math.ceil(math.sqrt(2 * products / PAIR_PRODUCTS)))


def _sums(a: pa.Table, b: pa.Table, most: int) -> pa.Table:
    """Summed products of each item of ``a`` with each of ``b`` over their users; ``most`` products are held at once, about.

    The items of ``a`` go in slices, each with all its products; those of an item with more than ``most`` are added up part by
    part.  A null rating adds nothing, and a pair without any product but null ones has a null sum."""
    a, b = a.sort_by([("a", "ascending"), ("a_uid", "ascending")]), b.sort_by("b_uid")
    a_uid, a_item, a_r, a_n2 = (a.column(c).to_numpy() for c in ("a_uid", "a", "r_a", "n2_a"))
    b_uid, b_item, b_r, b_n2 = (b.column(c).to_numpy() for c in ("b_uid", "b", "r_b", "n2_b"))
    partner, column = np.unique(b_item, return_inverse=True)
    n2 = np.zeros(len(partner))
    n2[column] = b_n2
    begin = np.searchsorted(b_uid, a_uid, side="left")
    count = np.searchsorted(b_uid, a_uid, side="right") - begin
    at = np.append(0, np.cumsum(count))  # products before each row of a
    cuts = np.append(np.flatnonzero(np.append(True, a_item[1:] != a_item[:-1])), len(a_item))
    within = len(a) > 0 and a.column("pair_a")[0].as_py() < 0  # a block with itself
    out: dict[str, list] = {c: [] for c in ("item_i", "item_j", "dot", "n2_i", "n2_j", "known")}

    def products(x: int, y: int) -> tuple:
        rows = np.repeat(np.arange(x, y), count[x:y])
        k = np.repeat(begin[x:y] - (at[x:y] - at[x]), count[x:y]) + np.arange(at[y] - at[x])
        p = a_r[rows] * b_r[k]
        return rows, column[k], np.nan_to_num(p), ~np.isnan(p)

    def keep(i: np.ndarray, j: np.ndarray, i_n2: np.ndarray, dot: np.ndarray, known: np.ndarray) -> None:
        if within:
            some = i <= partner[j]
            i, j, i_n2, dot, known = i[some], j[some], i_n2[some], dot[some], known[some]
        first = i <= partner[j]
        for c, v in (("item_i", np.where(first, i, partner[j])), ("item_j", np.where(first, partner[j], i)), ("dot", dot), ("known", known),
                     ("n2_i", np.where(first, i_n2, n2[j])), ("n2_j", np.where(first, n2[j], i_n2))):
            out[c].append(v)

    s = 0
    while s < len(cuts) - 1:
        e = max(s + 1, int(np.searchsorted(at[cuts], at[cuts[s]] + most, side="right")) - 1)
        x, y = cuts[s], cuts[e]
        if at[y] - at[x] > most:  # one item
            dot, known, met = (np.zeros(len(partner)) for _ in range(3))
            while x < y:
                z = min(y, max(x + 1, int(np.searchsorted(at, at[x] + most, side="right")) - 1))
                _, j, p, ok = products(x, z)
                dot += np.bincount(j, weights=p, minlength=len(partner))
                known += np.bincount(j, weights=ok, minlength=len(partner))
                met += np.bincount(j, minlength=len(partner))
                x = z
            j = np.flatnonzero(met)
            keep(np.full(len(j), a_item[cuts[s]]), j, np.full(len(j), a_n2[cuts[s]]), dot[j], known[j] > 0)
        elif at[y] > at[x]:
            rows, j, p, ok = products(x, y)
            own = np.repeat(np.arange(e - s), np.diff(cuts[s:e + 1]))[rows - x]
            key = own * len(partner) + j
            order = np.argsort(key, kind="stable")
            key = key[order]
            new = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            i = cuts[s:e][key[new] // len(partner)]
            keep(a_item[i], key[new] % len(partner), a_n2[i], np.add.reduceat(p[order], new), np.add.reduceat(ok[order].astype(np.int64), new) > 0)
        s = e
    whole = {c: np.concatenate(v) if v else np.empty(0) for c, v in out.items()}
    return pa.table({c: pa.array(whole[c], pa.int64() if c.startswith("item") else pa.float64(), mask=~whole["known"].astype(bool) if c == "dot" else None) for c in ("item_i", "item_j", "dot", "n2_i", "n2_j")})


def _products_by_blocks(util: DataFrame, blocks: int) -> DataFrame:
    """(item_i <= item_j, dot, n2_i, n2_j).  Items are dealt to blocks by hash, and a rating goes once to each pair of blocks
    that its item's block is in.  A pair's products are made and summed where its ratings are, with the norms beside
    them, so what is exchanged is ratings x (blocks + 1), not one row for each product."""
    rated = (util.where("uid is not null").select("uid", "song_id", F.col("rating").cast("double").alias("rating")).join(item_norms(util).withColumn("n2", F.col("n2").cast("double")), "song_id")
             .withColumn("c", F.pmod(F.xxhash64("song_id"), F.lit(blocks)).cast("int")))

    def side(name: str, first: F.Column, last: F.Column, lo: F.Column, hi: F.Column) -> DataFrame:
        # a block with itself has a pair below zero
        pair = F.when(lo == hi, -1 - lo).otherwise(lo * blocks + hi).alias(f"pair_{name}")
        return rated.withColumn("k", F.explode(F.sequence(first, last))).select(pair, F.col("uid").alias(f"{name}_uid"), F.col("song_id").alias(name), F.col("rating").alias(f"r_{name}"), F.col("n2").alias(f"n2_{name}"))

    c, k = F.col("c"), F.col("k")
    parts = blocks * (blocks + 1) // 2
    a = side("a", c, F.lit(blocks - 1), c, k).repartition(parts, "pair_a")
    b = side("b", F.lit(0), c, k, c).repartition(parts, "pair_b")
    most = PAIR_PRODUCTS
    return (a.groupBy("pair_a").cogroup(b.groupBy("pair_b"))
            .applyInArrow(lambda left, right: _sums(left, right, most), "item_i long, item_j long, dot double, n2_i double, n2_j double"))


def item_similarity(util: DataFrame, chunk_items: int = CHUNK_ITEMS, blocks: int = 1) -> DataFrame:
    """Cosine similarity of every co-rated item pair, both orders (self pair = 1).

    ``blocks`` (:func:`similarity_blocks`) above 1 sums the products by pairs of item blocks, for tables whose products don't fit the disk."""
    if blocks > 1:
        gram = _products_by_blocks(util, blocks)
    else:
        norms = item_norms(util)
        ni = norms.select(F.col("song_id").alias("item_i"), F.col("n2").alias("n2_i"))
        nj = norms.select(F.col("song_id").alias("item_j"), F.col("n2").alias("n2_j"))
        gram = cooccurrence(util, chunk_items).join(ni, "item_i").join(nj, "item_j")
    return both_orders(gram)


def both_orders(gram: DataFrame) -> DataFrame:
    """(item_i, item_j, sim) for both orders of the pairs (item_i <= item_j, dot, n2_i, n2_j)."""
    sim = F.col("dot") / F.sqrt(F.col("n2_i") * F.col("n2_j"))
    upper = gram.select("item_i", "item_j", sim.alias("sim"))
    fwd = F.struct(F.col("item_i").alias("a"), F.col("item_j").alias("b"), F.col("sim").alias("s"))
    rev = F.struct(F.col("item_j").alias("a"), F.col("item_i").alias("b"), F.col("sim").alias("s"))
    both = F.when(F.col("item_i") < F.col("item_j"), F.array(fwd, rev)).otherwise(F.array(fwd))
    return (upper.select(F.explode(both).alias("e"))
                 .select(F.col("e.a").alias("item_i"), F.col("e.b").alias("item_j"), F.col("e.s").alias("sim")))


def neighbours(sim: DataFrame, k: int = NEIGHBOURS) -> DataFrame:
    """The k most similar items of each item (itself included); ties to the larger id."""
    w = Window.partitionBy("item_i").orderBy(F.desc("sim"), F.desc("item_j"))
    return (sim.where(F.col("sim") > 0).withColumn("rank", F.row_number().over(w))
               .where(F.col("rank") <= k))


def _blocks(util: DataFrame, block_ratings: int, chunk_items: int) -> tuple[DataFrame, DataFrame]:
    """(items' ratings, users' postings), both keyed by (block, part).

    A block of items meets each of its users' postings once, however many of its items the user rated.  An item that
    alone meets more than ``block_ratings`` ratings is a block of its own, in parts by user.
    """
    rated = util.select("uid", "song_id", F.col("rating").cast("double").alias("rating")).join(item_norms(util).withColumn("n2", F.col("n2").cast("double")), "song_id")
    users = rated.groupBy("uid").agg(F.count(F.lit(1)).alias("n"), F.max(F.col("rating") / F.sqrt("n2")).alias("top"))
    rows = rated.join(users, "uid")
    items = rows.groupBy("song_id").agg(F.sum("n").alias("meets"))
    met = int(items.agg(F.sum("meets")).first()[0] or 0)
    blocks = max(1, -(-met // block_ratings))
    hot = F.col("meets") > block_ratings
    items = items.select("song_id", F.when(hot, -1 - F.col("song_id")).otherwise(F.pmod(F.xxhash64("song_id"), F.lit(blocks))).alias("block"), F.when(hot, F.ceil(F.col("meets") / block_ratings)).otherwise(F.lit(1)).cast("int").alias("parts"))
    probes = rows.join(items, "song_id").withColumn("part", F.pmod(F.xxhash64("uid"), F.col("parts")).cast("int")).select("block", "part", "parts", "uid", "song_id", "rating", "n2", "top")
    postings = (rows.withColumn("chunk", F.pmod(F.xxhash64("song_id"), F.ceil(F.col("n") / chunk_items)))
                .groupBy("uid", "chunk").agg(F.collect_list(F.struct("song_id", "rating", "n2")).alias("posted")))  # chunk_items, about
    postings = postings.select("uid", F.col("posted.song_id").alias("songs"), F.col("posted.rating").alias("ratings"), F.col("posted.n2").alias("n2s"))  # 24 bytes a posting, not 40
    index = probes.select("block", "part", "uid").distinct().join(postings, "uid").select("block", "part", "uid", "songs", "ratings", "n2s")
    index = index.toDF("met_block", "met_part", "rater", "songs", "ratings", "n2s")
    # a block, about, is a partition: the sort before the blocks meet then holds one of them
    return spread(probes, met, "block", "part", each=block_ratings), spread(index, met, "met_block", "met_part", each=block_ratings)


def _accumulate(order: np.ndarray, own: np.ndarray, top: np.ndarray, first: np.ndarray, last: np.ndarray, column: np.ndarray, rating: np.ndarray,
                norm: np.ndarray, own_norm: float, k: int) -> np.ndarray:
    """Inner products of one item with all, as far as they can be among its k best.

    The item's users go by falling bound, rating x the greatest normed rating in the user's postings.  Products so far are
    lower bounds, since ratings are positive.  Once the bounds of the users that are left can't lift an item that hasn't been
    met above the k-th best, their postings only add to items that have been; items that can't reach it any more are dropped.
    """
    dots = np.zeros(len(norm))
    bound = own[order] * top[order] / own_norm
    rest = np.append(np.cumsum(bound[::-1])[::-1], 0.0)  # what the users from here on can add to a similarity
    least, admitted = -1.0, None
    for begin in range(0, len(order), 16):
        step = order[begin:begin + 16]
        at = np.concatenate([np.arange(a, b) for a, b in zip(first[step], last[step])])
        by = np.repeat(own[step], last[step] - first[step])
        if admitted is None and rest[begin] * (1 + 1e-9) < least:
            admitted = dots > 0
        if admitted is not None:
            keep = admitted[column[at]]
            at, by = at[keep], by[keep]
        dots += np.bincount(column[at], weights=by * rating[at], minlength=len(norm))
        if begin + 16 < len(order):
            sims = dots / (norm * own_norm)
            if np.count_nonzero(sims) >= k:
                least = np.partition(sims, len(sims) - k)[len(sims) - k]
            if admitted is not None:
                admitted &= sims + rest[begin + 16] * (1 + 1e-9) >= least
                dots[~admitted] = 0
    return dots


PAIRS = pa.schema([("item_i", pa.int64()), ("item_j", pa.int64()), ("dot", pa.float64()), ("n2_i", pa.float64()), ("n2_j", pa.float64())])


def best_pairs(song: np.ndarray, own: np.ndarray, top: np.ndarray, n2_i: np.ndarray, first: np.ndarray, last: np.ndarray, posted: np.ndarray, rating: np.ndarray,
               n2: np.ndarray, k: int, whole: bool) -> pa.Table:
    """PAIRS of each item of ``song`` (sorted) with its ``k`` best partners, or with all if the item isn't ``whole`` here.  The
    postings of a row's user are ``first`` to ``last`` of ``posted``, ``rating`` and ``n2``."""
    out: dict[str, list] = {c: [] for c in PAIRS.names}
    cuts = np.append(np.flatnonzero(np.append(True, song[1:] != song[:-1])), len(song)) if len(song) else []
    for a, b in zip(cuts, cuts[1:]):
        order = np.argsort(-own[a:b] * top[a:b], kind="stable")
        # only the partners of this item: the arrays of a step are as long as its users' postings, not as the block
        count = last[a:b] - first[a:b]
        ends = np.cumsum(count)
        at = np.repeat(first[a:b] - (ends - count), count) + np.arange(ends[-1])
        partner, at_first, column = np.unique(posted[at], return_index=True, return_inverse=True)
        n2_j = n2[at[at_first]]
        dots = _accumulate(order, own[a:b], top[a:b], ends - count, ends, column, rating[at], np.sqrt(n2_j), float(np.sqrt(n2_i[a])), k if whole else len(partner) + 1)
        j = np.flatnonzero(dots)
        if whole and len(j) > k:
            j = j[np.lexsort((~partner[j], -(dots[j] / np.sqrt(n2_i[a] * n2_j[j]))))[:k]]
        for c, v in zip(PAIRS.names, (np.full(len(j), song[a]), partner[j], dots[j], np.full(len(j), n2_i[a]), n2_j[j])):
            out[c].append(v)
    return pa.table({f.name: pa.array(np.concatenate(out[f.name]) if out[f.name] else [], f.type) for f in PAIRS})


def neighbour_pairs(util: DataFrame, k: int = NEIGHBOURS, block_ratings: int = BLOCK_RATINGS, chunk_items: int = CHUNK_ITEMS) -> DataFrame:
    """(item_i, item_j, dot, n2_i, n2_j): for each item its k best partners and no others; of an item in parts, every partner."""
    probes, index = _blocks(util, block_ratings, chunk_items)

    def best(items: pa.Table, users: pa.Table) -> pa.Table:
        if not items.num_rows:
            return pa.Table.from_batches([], PAIRS)
        users = users.sort_by("rater")
        posted = users.column("songs").combine_chunks()
        lengths = np.append(0, np.cumsum(posted.value_lengths().to_numpy()))
        uid = users.column("rater").to_numpy()
        items = items.sort_by([("song_id", "ascending"), ("uid", "ascending")])
        song, own, top, n2_i = (items.column(c).to_numpy() for c in ("song_id", "rating", "top", "n2"))
        first = lengths[np.searchsorted(uid, items.column("uid").to_numpy(), side="left")]
        last = lengths[np.searchsorted(uid, items.column("uid").to_numpy(), side="right")]
        return best_pairs(song, own, top, n2_i, first, last, posted.flatten().to_numpy(), *(users.column(c).combine_chunks().flatten().to_numpy() for c in ("ratings", "n2s")),
                          k, items.column("parts")[0].as_py() == 1)

    return probes.groupBy("block", "part").cogroup(index.groupBy("met_block", "met_part")).applyInArrow(best, "item_i long, item_j long, dot double, n2_i double, n2_j double")


def top_neighbours(util: DataFrame, k: int = NEIGHBOURS, block_ratings: int = BLOCK_RATINGS, chunk_items: int = CHUNK_ITEMS) -> DataFrame:
    """(item_i, item_j, sim, rank), the k most similar items of each item (itself included), ties to the larger id;
    the same rows as ``neighbours(item_similarity(util), k)``, without the table of all pairs.  Ratings are positive."""
    # only items in parts have more than one row of a pair
    return neighbours(similarity_of_pairs(neighbour_pairs(util, k, block_ratings, chunk_items)), k)


def similarity_of_pairs(pairs: DataFrame) -> DataFrame:
    """(item_i, item_j, sim) of PAIRS, of which some are in parts."""
    dots = pairs.groupBy("item_i", "item_j").agg(F.sum("dot").alias("dot"), F.max("n2_i").alias("n2_i"), F.max("n2_j").alias("n2_j"))
    return dots.select("item_i", "item_j", (F.col("dot") / F.sqrt(F.col("n2_i") * F.col("n2_j"))).alias("sim"))


def prediction_parts(util: DataFrame, k: int = NEIGHBOURS) -> int:
    """Parts for :func:`predict` and :func:`recommend`, by the ratings x neighbours that they sum."""
    return max(1, -(-util.count() * k // TASK_CONTRIBUTIONS))


def _by_user(rated: DataFrame, nb: DataFrame, parts: int) -> DataFrame:
    """(uid, song_id, rating, item_i, sim) as rated x nb on the song, in ``parts`` partitions by uid.  A song's neighbours
    travel as one list (of LIST_ITEMS, about), and the single contributions are only made where they are summed."""
    pieces = nb.groupBy("item_j").agg(F.ceil(F.count(F.lit(1)) / LIST_ITEMS).alias("pieces"))
    lists = (nb.join(pieces, "item_j").groupBy(F.col("item_j"), F.pmod(F.xxhash64("item_i"), F.col("pieces")).alias("piece"))
             .agg(F.collect_list(F.struct("item_i", "sim")).alias("near")).select("item_j", F.col("near.item_i").alias("items"), F.col("near.sim").alias("sims")))
    sent = rated.join(lists, rated.song_id == lists.item_j).select("uid", "song_id", "rating", "items", "sims").repartition(parts, "uid")
    return sent.select("uid", "song_id", "rating", F.inline(F.arrays_zip(F.col("items").alias("item_i"), F.col("sims").alias("sim"))))


def _scored(util: DataFrame, neigh: DataFrame, with_marks: bool = True, users: DataFrame | None = None, parts: int | None = None) -> list[DataFrame]:
    """Per (uid, item): sum(r * sim), sum(sim) over the item's neighbours the user
    rated, and whether the user rated the item itself; in tables of different users.

    The neighbour table (at most items x k rows) gets one marker row (i, i,
    sim 0) per item, so the "already rated" test (J8) falls out of the same
    aggregate instead of an anti join that would reshuffle by (uid, item).
    Contributions are summed in the tasks before the exchange by (uid, item),
    so neither a user nor a song with very many ratings is one task.  With ``parts`` (:func:`prediction_parts`)
    only users of very many ratings go that way: the others' contributions are summed
    in ``parts`` partitions by user, and no contribution is exchanged.
    """
    nb = neigh.select("item_i", "item_j", "sim")
    if with_marks:
        marks = neigh.select("item_i").distinct().select("item_i", F.col("item_i").alias("item_j"), F.lit(0.0).alias("sim"))
        nb = nb.unionByName(marks)
    rated = util.select("uid", "song_id", "rating")
    if users is not None:
        rated = rated.join(users.select("uid").distinct(), "uid", "left_semi")
    plain = lambda some: some.join(nb, some.song_id == nb.item_j)
    met = [plain(rated)]
    if parts is not None and parts > 1:
        heavy = rated.groupBy("uid").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > USER_CONTRIBUTIONS // NEIGHBOURS).select("uid")
        met = [_by_user(rated.join(heavy, "uid", "left_anti"), nb, parts), plain(rated.join(heavy, "uid", "left_semi"))]
    return [m.groupBy("uid", F.col("item_i"))
             .agg(F.sum(F.col("rating") * F.col("sim")).alias("num"), F.sum("sim").alias("den"),
                  F.max((F.col("item_i") == F.col("song_id")).cast("int")).alias("rated")).withColumnRenamed("item_i", "song_id") for m in met]


def _pred(digits: int | None) -> F.Column:
    pred = nan_to_zero(F.try_divide("num", "den"))  # N5: 0/0 -> 0
    return F.round(pred, digits) if digits is not None else pred


def predict(util: DataFrame, neigh: DataFrame, digits: int | None = 6, parts: int | None = None) -> DataFrame:
    """G5/J10/A21 for all users at once: similarity-weighted mean of the user's ratings
    over the neighbours of each item that the user rated; 0/0 -> 0 (X31).

    (user, item) pairs where no neighbour was rated carry no row: their
    prediction is 0 and they are never recommended.
    """
    return reduce(DataFrame.unionByName, [s.where(F.col("den") > 0).select("uid", "song_id", _pred(digits).alias("pred")) for s in _scored(util, neigh, with_marks=False, parts=parts)])


def recommend(util: DataFrame, neigh: DataFrame, names: DataFrame | None = None, n: int = TOP_N,
              digits: int | None = 6, users: DataFrame | None = None, parts: int | None = None) -> DataFrame:
    """The n best unrated songs per user (ties to the larger song id), with a name.

    ``users`` (uid) restricts the work to chosen users (J13); all users if None."""
    w = Window.partitionBy("uid").orderBy(F.desc("pred"), F.desc("song_id"))

    def best(scored: DataFrame) -> DataFrame:
        cand = scored.where((F.col("den") > 0) & (F.col("rated") == 0)).select("uid", "song_id", _pred(digits).alias("pred"))
        return cand.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)

    out = reduce(DataFrame.unionByName, [best(s) for s in _scored(util, neigh, users=users, parts=parts)])
    if names is not None:
        out = out.join(names, "song_id", "left")
    return out


def top_n(pred: DataFrame, util: DataFrame, names: DataFrame | None = None, n: int = TOP_N) -> DataFrame:
    """O4/J8 for any prediction table: anti join with the rated pairs, then top n per user."""
    unrated = pred.join(util.select("uid", "song_id"), ["uid", "song_id"], "left_anti")
    w = Window.partitionBy("uid").orderBy(F.desc("pred"), F.desc("song_id"))
    out = unrated.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
    if names is not None:
        out = out.join(names, "song_id", "left")
    return out
