import hashlib
import random
import zlib

from tunetrail.llm import prefixtrie

SCHEMA = "conv_id long, turn long, role string, text string, key binary, d int, parent string, words long"


def brute(rows):
    turns = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            turns.setdefault(c, []).append((turn is not None, turn, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest(), (role, text)))
    own = {c: [t[3] for t in sorted(ts, key=lambda t: (t[0], t[1] or 0, t[2]))] for c, ts in turns.items()}
    rebuilt = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = tuple(own.get(c - c % 20, [])[:h] + ts[h:])
    nodes = {}
    for c, ts in rebuilt.items():
        for d in range(len(ts) + 1):
            nodes.setdefault(ts[:d], []).append(c)
    blanks = str.maketrans("\x09\x0a\x0b\x0c\x0d", "     ")
    value = {p: (len(m) - 1) * len([w for w in p[-1][1].translate(blanks).split(" ") if w]) if p else 0 for p, m in nodes.items()}
    kids = {p: sum(1 for q in nodes if len(q) == len(p) + 1 and q[:len(p)] == p) for p in nodes}
    out = []
    for p, members in nodes.items():
        under = [q for q in nodes if q[:len(p)] == p]
        ends = ",".join(map(str, sorted(c for c in members if len(rebuilt[c]) == len(p))))
        out.append((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), kids[p], sum(kids[q] == 0 for q in under), sum(value[q] for q in under), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows):
    full = [(*r, b"k", 1, "p", 7) for r in rows]
    return sorted((tuple(r) for r in prefixtrie.prefix_trie(spark.createDataFrame(full, SCHEMA)).collect()), key=str)


def test_random_conversations(spark):
    r = random.Random(3)
    rows = []
    for c in list(range(0, 90)) + [400, 401, 407, 1000, 1003]:
        for t in range(r.randint(1, 6)):
            rows.append((c, t, r.choice(["user", "assistant"]), r.choice(["a", "a b", "hello\tthere  you", ""])))
    r.shuffle(rows)
    assert run(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rows = [(1, None, "user", "x"), (1, 0, None, None), (1, 0, None, None), (1, 0, "user", "b"), (1, 3, "user", " \x0b y z\r"), (None, 1, "user", "lost"), (20, 1, "a", "bc"), (20, 2, "ab", "c"), (20, 3, "z", "q"),
            (37, 1, "user", "gone"), (57, 1, "user", "gone"), (77, 1, "u", "gone"), (97, 5, "u", "long " * 30_000), (117, 5, "u", "long " * 30_000)]
    assert run(spark, rows) == brute(rows)


def test_long_chains_are_peeled_together(spark, monkeypatch):
    rows = [(c, t, "user", f"{t % 3} {'x' if c < 3 or t < 20 else c}") for c, n in ((0, 60), (1, 60), (2, 3), (3, 33), (4, 2), (40, 41)) for t in range(n)]
    want = brute(rows)
    steps = []
    real = prefixtrie.compact
    monkeypatch.setattr(prefixtrie, "compact", lambda df, n: steps.append(1) or real(df, n))
    assert run(spark, rows) == want
    assert len(steps) < 30  # 61 depths


def test_one_node_for_many_copies(spark, monkeypatch):
    monkeypatch.setattr(prefixtrie, "PIECE_IDS", 7)
    rows = [(c * 20, 0, "user", "same words") for c in range(300)]
    got = run(spark, rows)
    assert got == brute(rows)


def test_no_rows(spark):
    got = prefixtrie.prefix_trie(spark.createDataFrame([], SCHEMA))
    assert got.collect() == [] and got.columns[:3] == ["conv_id", "depth", "parent_conv_id"]
    assert run(spark, [(None, 1, "a", "b")]) == []
