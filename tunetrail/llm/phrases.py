"""Collocations: phrases of two or three words that hold together, from count transducers.

1. Words are counted for each language, by their text.  Words with more occurrences than a range should hold are hot.
2. Each slice of the corpus (a shard) sorts its n-grams and builds a weighted acyclic automaton: states are shared
   prefixes, arcs carry a word each, weights are counts.  It is cut by prefix ranges: a range is a stretch of the hashes
   of first words; below a hot word it is chosen by two words, below two hot words by three, so that no prefix fills
   a range.  A shard's n-gram is one path, however often it occurs.
3. In each range the shards' automata are united, weights summed, and paths lighter than the least count cut off; what
   is left is the count transducer, stored by range.  Every phrase of that count or more is in it, and so are its parts.
4. Parts of two words are looked up by composing the candidates' parts with the transducer of their range; parts of one
   word by a join with the word table.
5. Scores are exact integers.

Word hashes have 64 bits and include the language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunetrail.llm.common import checkpointed, stored
from tunetrail.llm.tokens import bucket_of, byte_classes, hashes, mixed, packed, slices, tokenize, unpacked

LEAST, TOP, SHARE, SCALE = 10, 2000, 50, 1_000_000
#: Tokens of a prefix range, and bytes of text of a shard, about.
RANGE_TOKENS, SHARD_BYTES = 1_000_000, 6 << 20
NO_LANG = "und"

_CLASSES = byte_classes(b"\x20\x09", b".,;:!?\x0a\x0b\x0c\x0d")


def _by_language(it: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.RecordBatch]]:
    for batch in it:
        langs = batch.column(0).dictionary_encode()
        for k, lang in enumerate(langs.dictionary.to_pylist()):
            for part in slices(batch.filter(pc.equal(langs.indices, k)), 1, SHARD_BYTES):
                yield lang, part


def _source(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit(NO_LANG)).alias("lang"), F.col(f"`{text_col}`").cast("binary").alias("text"))


def _prefix(lang: str) -> bytes:
    return lang.encode() + b"\x00"


def word_counts(src: DataFrame) -> DataFrame:
    """(lang, word binary, key, f): occurrences of each word of each language; ``key`` is its hash."""
    schema = pa.schema([("lang", pa.string()), ("word", pa.binary()), ("key", pa.int64()), ("n", pa.int64())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, part in _by_language(it):
            t = tokenize(part.column(1), _CLASSES)
            keys = hashes(t.words, _prefix(lang)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), t.words.cast(pa.binary()), pa.array(keys), pa.array(np.bincount(t.ids, minlength=len(keys)).astype(np.int64))], schema=schema)

    return src.mapInArrow(run, "lang string, word binary, key long, n long").groupBy("lang", "key").agg(F.min("word").alias("word"), F.sum("n").alias("f"))


# ------------------------------------------------------------------ automata

@dataclass
class Automaton:
    """A weighted acyclic automaton over word hashes, depth by depth.

    At each depth the arcs lie in the order of the states that they leave, and within a state by label; ``fans`` tells how
    many arcs leave each state, which is the arc of the depth before.  Arcs of the last depth share one final state.
    A weight of 0 marks a path that is only a prefix.
    """

    labels: list[np.ndarray]
    fans: list[np.ndarray]
    weights: list[np.ndarray]

    @staticmethod
    def build(paths: np.ndarray, weights: np.ndarray, depths: np.ndarray) -> Automaton:
        """From paths (rows of labels, zeros beyond a path's depth) in rising order, each path once.

        Each path adds the arcs beyond what it shares with the path before it, which is found for all rows together."""
        labels, fans, out = [], [], []
        new = np.zeros(len(paths), dtype=bool)  # a row that leaves the path before it at this depth or above
        new[:1] = True
        above = np.zeros(len(paths), dtype=np.int64)
        states = 1
        for d in range(paths.shape[1]):
            deep = depths > d
            new[1:] |= paths[1:, d] != paths[:-1, d]
            arcs = np.flatnonzero(new & deep)
            at = np.cumsum(new & deep) - 1
            labels.append(paths[arcs, d])
            fans.append(np.bincount(above[arcs], minlength=states))
            w = np.zeros(len(arcs), dtype=np.int64)
            ends = np.flatnonzero(depths == d + 1)
            w[at[ends]] = weights[ends]
            out.append(w)
            above, states = at, len(arcs)
        return Automaton(labels, fans, out)

    def paths(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(paths, weights, depths) of all weighted paths."""
        rows = np.zeros((1, 0), dtype=np.uint64)
        depth = len(self.labels)
        found = []
        for d, (labels, fans, weights) in enumerate(zip(self.labels, self.fans, self.weights)):
            rows = np.concatenate([np.repeat(rows, fans, axis=0), labels[:, None]], axis=1)
            keep = weights > 0
            wide = np.zeros((int(keep.sum()), depth), dtype=np.uint64)
            wide[:, :d + 1] = rows[keep]
            found.append((wide, weights[keep], np.full(len(wide), d + 1)))
        return tuple(np.concatenate(x) for x in zip(*found))

    def compose(self, paths: np.ndarray) -> np.ndarray:
        """Weight of each path (rows of labels), 0 if it isn't there: the paths' acceptor composed with the automaton, depth by depth."""
        state = np.zeros(len(paths), dtype=np.int64)
        there = np.ones(len(paths), dtype=bool)
        for d in range(paths.shape[1]):
            ends = np.cumsum(self.fans[d])
            # arcs are in order of (state, label): a composed key finds the arc
            label, place = np.unique(np.concatenate([self.labels[d], paths[:, d]]), return_inverse=True)
            n = len(self.labels[d])
            owner = np.repeat(np.arange(len(ends)), self.fans[d])
            arcs, asked = owner * len(label) + place[:n], state * len(label) + place[n:]
            i = np.searchsorted(arcs, asked)
            there &= (i < n) & (arcs[np.minimum(i, n - 1)] == asked) if n else False
            state = np.where(there, i, 0)
        return np.where(there, self.weights[paths.shape[1] - 1][state], 0) if len(self.weights[paths.shape[1] - 1]) else np.zeros(len(paths), dtype=np.int64)

    def pruned(self, least: int) -> Automaton:
        paths, weights, depths = self.paths()
        keep = weights >= least
        return ordered(paths[keep], weights[keep], depths[keep])

    def blobs(self) -> dict:
        return {"labels": [x.tobytes() for x in self.labels], "fans": [packed(x) for x in self.fans], "weights": [packed(x) for x in self.weights]}

    @staticmethod
    def read(row: dict) -> Automaton:
        return Automaton([np.frombuffer(x, np.uint64) for x in row["labels"]], [unpacked(x) for x in row["fans"]], [unpacked(x) for x in row["weights"]])


def ordered(paths: np.ndarray, weights: np.ndarray, depths: np.ndarray) -> Automaton:
    """An automaton from paths in any order; weights of equal paths are summed."""
    code = np.zeros(len(paths), dtype=np.int64)
    for d in range(paths.shape[1]):
        _, place = np.unique(paths[:, d], return_inverse=True)
        # equal and ordered as the prefixes of d + 1 labels and their lengths
        code = np.unique(code * (2 * len(paths) + 2) + 2 * place + (depths > d), return_inverse=True)[1].astype(np.int64)
    _, first, inverse = np.unique(code, return_index=True, return_inverse=True)
    return Automaton.build(paths[first], np.bincount(inverse, weights=weights, minlength=len(first)).astype(np.int64), depths[first])


def union(automata: list[Automaton]) -> Automaton:
    """All paths of the automata, with their weights summed."""
    return ordered(*(np.concatenate(x) for x in zip(*(a.paths() for a in automata))))


def range_of(first: np.ndarray, second: np.ndarray, third: np.ndarray | None, hot: np.ndarray, ranges: int) -> np.ndarray:
    """The prefix range of n-grams of two words (third None) or three."""
    is_hot = lambda x: hot[np.minimum(np.searchsorted(hot, x), len(hot) - 1)] == x if len(hot) else np.zeros(len(x), dtype=bool)
    one, two = is_hot(first), is_hot(second)
    pair = mixed(first, second)
    key = np.where(one, pair, first)
    if third is not None:
        key = np.where(one & two, mixed(pair, third), key)
    return bucket_of(key, ranges)


def _sorted_ngrams(t, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs (first, second, times) and triples of a shard, each sorted by the hashes of their words: (paths, times) twice."""
    order = np.argsort(keys)
    rank = np.empty(len(keys), dtype=np.int64)
    rank[order] = np.arange(len(keys))
    w, sorted_keys = rank[t.ids], keys[order]
    near = (t.text[1:] == t.text[:-1]) & (t.piece[1:] == t.piece[:-1])
    i = np.flatnonzero(near)
    pairs, place, times = np.unique(w[i] << 32 | w[i + 1], return_inverse=True, return_counts=True)
    two = np.stack([sorted_keys[pairs >> 32], sorted_keys[pairs & 0xFFFFFFFF]], axis=1) if len(pairs) else np.empty((0, 2), np.uint64)
    where = np.flatnonzero(near[:-1] & near[1:])
    number = np.full(len(near) + 1, -1)
    number[i] = place
    triples, often = np.unique(number[where] << 32 | w[where + 2], return_counts=True)
    three = np.concatenate([two[triples >> 32], sorted_keys[triples & 0xFFFFFFFF][:, None]], axis=1) if len(triples) else np.empty((0, 3), np.uint64)
    return two, times, three, often


_BLOBS = "labels array<binary>, fans array<binary>, weights array<binary>"


def transducers(src: DataFrame, hot: np.ndarray, ranges: int, least: int) -> DataFrame:
    """(range, labels, fans, weights): for each prefix range the united automaton of all shards, without paths lighter than ``least``."""
    blobs = [("labels", pa.list_(pa.binary())), ("fans", pa.list_(pa.binary())), ("weights", pa.list_(pa.binary()))]
    schema = pa.schema([("range", pa.int32()), *blobs])

    def shard(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, part in _by_language(it):
            t = tokenize(part.column(1), _CLASSES)
            two, times, three, often = _sorted_ngrams(t, hashes(t.words, _prefix(lang)))
            at2, at3 = range_of(two[:, 0], two[:, 1], None, hot, ranges), range_of(three[:, 0], three[:, 1], three[:, 2], hot, ranges)
            order2, order3 = np.argsort(at2, kind="stable"), np.argsort(at3, kind="stable")
            cuts2, cuts3 = np.searchsorted(at2[order2], np.arange(ranges + 1)), np.searchsorted(at3[order3], np.arange(ranges + 1))
            for r in range(ranges):
                a, b = order2[cuts2[r]:cuts2[r + 1]], order3[cuts3[r]:cuts3[r + 1]]
                if len(a) or len(b):
                    yield pa.RecordBatch.from_pylist([{"range": r, **_merged(two[a], times[a], three[b], often[b]).blobs()}], schema=schema)

    def unite(rows: pa.Table) -> pa.Table:
        one = union([Automaton.read(r) for r in rows.to_pylist()]).pruned(least)
        return pa.Table.from_pylist([{"range": rows.column("range")[0].as_py(), **one.blobs()}] if len(one.labels[0]) else [], schema=schema)

    return src.mapInArrow(shard, f"range int, {_BLOBS}").groupBy("range").applyInArrow(unite, f"range int, {_BLOBS}")


def _merged(two: np.ndarray, times: np.ndarray, three: np.ndarray, often: np.ndarray) -> Automaton:
    """The automaton of sorted pairs and sorted triples; a pair comes before the triples that it begins."""
    paths = np.concatenate([np.concatenate([two, np.zeros((len(two), 1), np.uint64)], axis=1), three])
    depths = np.repeat([2, 3], [len(two), len(three)])
    order = np.lexsort((depths, paths[:, 1], paths[:, 0]))  # stable: triples of one pair keep their order
    return Automaton.build(paths[order], np.concatenate([times, often])[order], depths[order])


def _phrases(automata: DataFrame) -> DataFrame:
    """(k1, k2, k3, a): the paths of the transducers; k3 is null for two words."""
    schema = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("k3", pa.int64()), ("a", pa.int64())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for row in batch.to_pylist():
                paths, weights, depths = Automaton.read(row).paths()
                k = paths.view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(k[:, 0]), pa.array(k[:, 1]), pa.array(k[:, 2], mask=depths == 2), pa.array(weights)], schema=schema)

    return automata.mapInArrow(run, "k1 long, k2 long, k3 long, a long")


def _part_weights(triples: DataFrame, automata: DataFrame, hot: np.ndarray, ranges: int) -> DataFrame:
    """``triples`` (k1, k2, k3, a) with l2, the weight of the first two words, and r1, that of the last two."""
    schema = pa.schema([("range", pa.int32()), ("k1", pa.int64()), ("k2", pa.int64()), ("k3", pa.int64()), ("part", pa.int32())])

    def ask(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            k = [batch.column(i).to_numpy().view(np.uint64) for i in range(3)]
            for part in (0, 1):
                at = range_of(k[part], k[part + 1], None, hot, ranges)
                yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), *batch.columns[:3], pa.array(np.full(len(at), part, np.int32))], schema=schema)

    def answer(asked: pa.Table, owned: pa.Table) -> pa.Table:
        k = np.stack([asked.column(c).to_numpy().view(np.uint64) for c in ("k1", "k2", "k3")], axis=1) if asked.num_rows else np.empty((0, 3), np.uint64)
        part = asked.column("part").to_numpy() if asked.num_rows else np.empty(0, np.int64)
        pairs = k[np.arange(len(k))[:, None], part[:, None] + np.arange(2)] if len(k) else np.empty((0, 2), np.uint64)
        rows = owned.to_pylist()
        weight = Automaton.read(rows[0]).compose(pairs) if rows else np.zeros(len(k), np.int64)
        return asked.select(["k1", "k2", "k3", "part"]).append_column("weight", pa.array(weight, pa.int64()))

    asks = triples.select("k1", "k2", "k3").mapInArrow(ask, "range int, k1 long, k2 long, k3 long, part int")
    answers = asks.groupBy("range").cogroup(automata.groupBy("range")).applyInArrow(answer, "k1 long, k2 long, k3 long, part int, weight long")
    both = answers.groupBy("k1", "k2", "k3").agg(F.max(F.when(F.col("part") == 0, F.col("weight"))).alias("l2"), F.max(F.when(F.col("part") == 1, F.col("weight"))).alias("r1"))
    return triples.join(both, ["k1", "k2", "k3"])


def _score(a: Column, lower: Column, upper: Column) -> Column:
    """floor(SCALE a a / (l r)) in 38 digits: counts may have 15, and the quotient is SCALE at most."""
    whole = lambda c: c.cast("decimal(15,0)")
    top, bottom = (F.lit(SCALE).cast("decimal(7,0)") * (whole(a) * whole(a))).cast("decimal(38,0)"), (whole(lower) * whole(upper)).cast("decimal(38,0)")
    return F.call_function("div", top, bottom)


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, share: int = SHARE, range_tokens: int = RANGE_TOKENS, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of two or three words.

    Texts are cut into pieces at ``.,;:!?`` and line ends, pieces into words at blanks and tabs, A-Z in lower case.  A
    phrase occurs inside a piece, ``least`` times or more (a).  l and r are the counts of its two parts at the cut with
    the lowest score floor(10^6 a^2 / (l r)), the earliest of equal cuts.  A phrase inside a longer one that occurs
    ``share`` per cent as often or more is left out.  n counts all words of the language; a null language is ``und``.
    Null, empty and blank texts have no words; repeated rows count each time; a null id doesn't matter.  Ties of score and
    count go by the phrase's UTF-8 bytes.  No phrases give no rows.
    """
    src = _source(docs, lang_col, text_col)
    words = stored(word_counts(src))
    total = words.agg(F.sum("f")).first()[0] or 0
    ranges = max(1, -(-total // range_tokens))
    hot = np.sort(np.array([r.key for r in words.where(F.col("f") > range_tokens // 4).select("key").collect()], dtype=np.int64).view(np.uint64))  # 4 a range at most
    automata = stored(transducers(src, hot, ranges, least))
    phrases = checkpointed(_phrases(automata))
    frequent = words.where(F.col("f") >= least).select("key", "lang", "word", "f")
    named = lambda k: frequent.select(F.col("key").alias(f"k{k}"), F.col("word").alias(f"w{k}"), F.col("f").alias(f"f{k}"))

    triples = checkpointed(_part_weights(phrases.where("k3 is not null"), automata, hot, ranges))
    pairs = phrases.where("k3 is null")
    longest = (triples.select("a", F.explode(F.array(F.struct("k1", "k2"), F.struct(F.col("k2").alias("k1"), F.col("k3").alias("k2")))).alias("p"))
               .groupBy("p.k1", "p.k2").agg(F.max("a").alias("longer")))
    pairs = pairs.join(longest, ["k1", "k2"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("a")))
    both = (pairs.select("k1", "k2", F.lit(None).cast("long").alias("k3"), "a", F.lit(None).cast("long").alias("l2"), F.lit(None).cast("long").alias("r1"))
            .unionByName(triples.select("k1", "k2", "k3", "a", "l2", "r1")))
    counted = (both.join(frequent.select(F.col("key").alias("k1"), "lang", F.col("word").alias("w1"), F.col("f").alias("f1")), "k1")
               .join(named(2), "k2").join(named(3), "k3", "left"))
    is_pair = F.col("k3").isNull()
    cut1 = F.struct(_score(F.col("a"), F.col("f1"), F.when(is_pair, F.col("f2")).otherwise(F.col("r1"))).alias("score"), F.lit(1).alias("k"), F.col("f1").alias("l"), F.when(is_pair, F.col("f2")).otherwise(F.col("r1")).alias("r"))
    cut2 = F.when(~is_pair, F.struct(_score(F.col("a"), F.col("l2"), F.col("f3")).alias("score"), F.lit(2).alias("k"), F.col("l2").alias("l"), F.col("f3").alias("r")))
    phrase = F.concat_ws(" ", F.col("w1").cast("string"), F.col("w2").cast("string"), F.col("w3").cast("string"))
    scored = counted.withColumn("cut", F.least(cut1, cut2)).select("lang", phrase.alias("phrase"), "a", "cut.l", "cut.r", "cut.score")
    by = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    best = scored.withColumn("rank", F.row_number().over(by).cast("long")).where(F.col("rank") <= top)
    return best.join(words.groupBy("lang").agg(F.sum("f").alias("n")), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
