import random
import re
from collections import Counter

import numpy as np

from tests.llm.helpers import SCHEMA, edge_rows, empty_docs
from tunetrail.llm import phrases


def brute(rows, least, top, share):
    f, n = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = lang or "und"
        low = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = [x for x in re.split("[ \t]+", piece) if x]
            n[lang] += len(w)
            for k in (1, 2, 3):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    out = {}
    for (lang, p), a in f.items():
        if len(p) > 1 and a >= least:
            if len(p) == 2 and any(q[0] == lang and len(q[1]) == 3 and p in (q[1][:2], q[1][1:]) and 100 * b >= share * a for q, b in f.items() if b >= least):
                continue
            score, _, lo, hi = min((10**6 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
            out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), lo, hi))
    return sorted((lang, rank, p.decode(), -a, lo, hi, n[lang], -s) for lang, c in out.items() for rank, (s, a, p, lo, hi) in enumerate(sorted(c)[:top], 1))


def run(spark, rows, **parameters):
    return sorted(tuple(r) for r in phrases.collocations(spark.createDataFrame(rows, SCHEMA).repartition(3), **parameters).collect())


def texts(seed, n):
    r = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(25)] + ["Été", "日本"]
    return [(i, "".join(r.choice(vocabulary[:r.randint(2, 27)]) + r.choice([" ", " ", " ", "\t ", ", ", ".", "\n"]) for _ in range(r.randint(0, 60))), r.choice(["en", "de", None]), *[None] * 10) for i in range(n)]


def test_equals_brute_force(spark):
    rows = texts(1, 150)
    assert run(spark, rows, least=4) == brute(rows, 4, 2000, 50)
    # hot words in many small ranges, and a short report
    assert run(spark, rows, least=3, top=15, range_tokens=120) == brute(rows, 3, 15, 50)


def test_odd_rows(spark):
    rows = edge_rows()
    assert run(spark, rows, least=2, top=50) == brute(rows, 2, 50, 50)
    assert phrases.collocations(empty_docs(spark)).collect() == []


def test_exact_beyond_64_bits(spark):
    a, lower, upper = 3 * 10**12 + 1, 4 * 10**12 + 3, 5 * 10**12 + 7
    got = spark.sql(f"select {a}L a, {lower}L l, {upper}L r").select(phrases._score(*(phrases.F.col(c) for c in "alr"))).first()[0]
    assert got == 10**6 * a * a // (lower * upper)


def random_paths(seed, n):
    r = np.random.default_rng(seed)
    depths = r.integers(1, 4, n)
    paths = r.integers(1, 7, (n, 3)).astype(np.uint64) * (np.arange(3) < depths[:, None]).astype(np.uint64)
    return paths, r.integers(1, 9, n), depths


def as_dict(automaton):
    return {tuple(p[:d].tolist()): int(w) for p, w, d in zip(*automaton.paths())}


def test_automata():
    total, parts = Counter(), []
    for seed in range(4):
        paths, weights, depths = random_paths(seed, 80)
        one = Counter()
        for p, w, d in zip(paths, weights, depths):
            one[tuple(p[:d].tolist())] += int(w)
        total += one
        parts.append(phrases.ordered(paths, weights, depths))
        assert as_dict(parts[-1]) == one
        # states are shared prefixes: as many arcs as distinct prefixes of each length
        assert [len(x) for x in parts[-1].labels] == [len({p[:d] for p in one if len(p) >= d}) for d in (1, 2, 3)]
    whole = phrases.union([phrases.Automaton.read(p.blobs()) for p in parts])
    assert as_dict(whole) == total
    assert as_dict(whole.pruned(12)) == {p: w for p, w in total.items() if w >= 12}
    for d in (1, 2, 3):
        asked = random_paths(9, 200)[0][:, :d] + np.uint64(1)
        assert whole.compose(asked).tolist() == [total.get(tuple(p.tolist()), 0) for p in asked]
