import random
from collections import defaultdict

import numpy as np
import pyarrow as pa

from tests.llm.helpers import SCHEMA, edge_docs, edge_rows, empty_docs
from tunetrail.llm import neardup
from tunetrail.llm.components import connected_components


def roots(nodes, links):
    up = {n: n for n in nodes}

    def top(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def shingles(text, n=4):
    w = (text or "").encode().lower().split()
    n = min(n, len(w))
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if w else frozenset()


def brute(rows):
    """(id, n_shingles, component_id, kept) of each row, sorted; rows are told apart by their place."""
    sets = [shingles(t) for _, t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    group = roots(range(len(rows)), links)
    ids = defaultdict(list)
    for k, (doc, _) in enumerate(rows):
        ids[group[k]] += [doc] if doc is not None else []
    out = []
    for k, (doc, _) in enumerate(rows):
        least = (min(ids[group[k]]) if ids[group[k]] else None) if sets[k] else doc
        out.append((str(doc), len(sets[k]), str(least), doc == least))
    return sorted(out)


def found(df):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in df.collect())


def copies():
    """Groups whose members are linked through others only, a large group of edited copies, and texts that share a long passage."""
    r = random.Random(5)
    rows, base = [], [f"w{r.randint(0, 10**6)}" for _ in range(200)]
    for k in range(12):  # a chain: each is like the next, the first isn't like the last
        w = list(base)
        w[:8 * k] = [f"c{i}" for i in range(8 * k)]
        rows.append((100 + k, " ".join(w)))
    other = [f"v{r.randint(0, 10**6)}" for _ in range(150)]
    for k in range(60):
        w = list(other)
        for _ in range(r.randint(0, 8)):
            w[r.randrange(len(w))] = f"e{r.randint(0, 10**6)}"
        rows.append((1000 - k, " ".join(w)))
    passage = [f"p{i}" for i in range(60)]
    for k in range(40):
        rows.append((2000 + k, " ".join([f"u{k}x{i}" for i in range(r.randint(10, 60))] + passage)))
    return rows


def test_equals_brute_force(spark):
    rows = copies() + [(i, t) for i, t, *_ in edge_rows()]
    docs = edge_docs(spark).unionByName(spark.createDataFrame([(i, t, *[None] * 11) for i, t in copies()], SCHEMA))
    assert found(neardup.near_duplicates(docs)) == brute(rows)


def test_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(neardup, "CLASSES", (3, 5, 4, 2))
    monkeypatch.setattr(neardup, "BYTES", (3000, 9000, 2000, 1500))
    docs = spark.createDataFrame([(i, t) for i, t in copies()[:50]], "doc_id long, text string")
    assert found(neardup.near_duplicates(docs)) == brute(copies()[:50])


def test_slot_nought(spark):
    ids = spark.createDataFrame([(194350146,), (194350148,)], "doc long")
    for slots in (1 << 16, 1 << 26):
        bits = np.unpackbits(neardup._filter_bits(ids, slots), bitorder="little")
        want = [r[0] for r in ids.select(neardup._slot(neardup.F.col("doc"), slots)).collect()]
        assert want[0] == 0 and np.flatnonzero(bits).tolist() == sorted(want)
    text = " ".join(f"w{i}" for i in range(100))
    docs = spark.createDataFrame([(194350146, text), (194350160, text + " more")], "doc_id long, text string")
    assert found(neardup.near_duplicates(docs)) == [("194350146", 97, "194350146", True), ("194350160", 98, "194350146", False)]


def test_unlinked_classes_send_no_sets(spark):
    """One list of unlike classes: sketches tell them apart, so no full set is copied; blocks of sets keep to their bytes."""
    r = random.Random(8)
    rows = [(b"m" if k == 0 else b"n%d" % k, np.array(sorted({r.getrandbits(60) for _ in range(2000)}), dtype=np.uint64)) for k in range(120)]
    sets = spark.createDataFrame([(n, s.view(np.int64).tolist(), neardup.sketch(s)) for n, s in rows], "node binary, shingles array<long>, sketch binary").checkpoint()
    lists = sets.select(neardup.F.lit(b"m").alias("major"), "node", neardup.F.col("node").alias("label"))
    assert neardup._with_partners(lists, sets.select("node", "sketch"), neardup.CLOSE).count() == 0
    bounds = (60_000, 200_000, 1000, 50_000)
    blocks = neardup._blocks(lists.join(sets, "node"), 8 * neardup.F.size("shingles"), bounds, ["shingles"])
    size = lambda left, right: pa.table({"l": [8 * 2000 * left.num_rows], "r": [8 * 2000 * right.num_rows]})
    got = blocks.applyInArrow(size, "l long, r long").collect()
    assert max(x.l for x in got) < 4 * bounds[0] and max(x.r for x in got) < 3 * bounds[1] and sum(x.l for x in got) >= 119 * 16_000


def test_row_key(spark):
    docs = spark.createDataFrame([(1, "a b c d e"), (5, "a b c d e"), (5, "f g h i"), (None, "a b c d e"), (7, None)], "doc_id long, text string")
    got = {(r.doc_id, r.row_key): r.kept for r in neardup.near_duplicates(docs, row_key=neardup.F.col("text")).collect()}
    assert got == {(1, "a b c d e"): True, (5, "a b c d e"): False, (5, "f g h i"): True, (None, "a b c d e"): False, (7, None): True}


def test_empty(spark):
    assert neardup.near_duplicates(empty_docs(spark)).collect() == []


def test_components(spark):
    r = random.Random(2)
    links = [(r.randint(0, 150), r.randint(0, 150)) for _ in range(110)] + [(1000 + i, 1001 + i) for i in range(40)] + [(7, 7)]
    rows = connected_components(spark.createDataFrame([*links, (None, 3), (None, None)], "a long, b long")).collect()
    ends = {x for a, b in links if a != b for x in (a, b)}
    want = roots(ends, [(a, b) for a, b in links if a != b])
    assert {r.node: r.root for r in rows} == want and len(rows) == len(want)
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []
