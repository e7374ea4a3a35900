import random

from tunetrail.llm import topk


def brute(rows, k, every):
    vectors = [(i, x) for i, x in rows if i is not None and x is not None and all(c is not None and c == c and abs(c) != float("inf") for c in x)]
    ints = [(i, [int(64 * c // 1) for c in x]) for i, x in vectors]
    out = set()
    for i, x in ints:
        if i % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(x, y)), j) for j, y in ints if j != i)[:k]
            out |= {(i, r + 1, j, -s) for r, (s, j) in enumerate(scores)}
    return out


def found(df, k, every, **sizes):
    v = topk.integers(df)
    rows = topk.top_k(v.where(f"id % {every} = 0"), v, k, **sizes).collect()
    assert len(rows) == len(set(map(tuple, rows)))
    return set(map(tuple, rows))


def vectors():
    r = random.Random(11)
    rows = [(i, [r.gauss(0, 0.3) for _ in range(6)]) for i in range(180)]
    rows += [(300 + i, [0.5, 0.25, 0.0, -0.25, 0.1, 0.0]) for i in range(60)]  # ties
    rows += [(400, None), (401, [0.1, None, 0.2, 0.3, 0.1, 0.1]), (402, [float("nan")] * 6), (405, [float("inf")] * 6), (410, [0.0] * 6), (None, [1.0] * 6), (-5, [-9.0] * 6), (415, [1e4] * 6)]
    return rows


def test_equals_brute_force(spark):
    schema = "vec_id long, embedding array<float>, id string, x string, chunk string, score int, label int"
    rows = [(i, x, "c", "c", "c", 1, 2) for i, x in vectors()]
    df = spark.createDataFrame(rows, schema)
    exact = [(r[0], r[1]) for r in df.select("vec_id", "embedding").collect()]
    want = brute(exact, 4, 5)
    assert found(df, 4, 5) == want
    assert found(df, 4, 5, chunk_rows=50, block_rows=9) == want  # many chunks and blocks
    few = df.where("vec_id < 3")
    assert found(few, 4, 1) == brute([x for x in exact if x[0] is not None and x[0] < 3], 4, 1)
    assert found(df.limit(0), 4, 5) == set()


def test_stops_early():
    import numpy as np

    r = np.random.default_rng(3)
    x = np.round(r.gamma(0.3, 300, size=(5000, 3))).astype(np.int64)  # a few vectors stand out, so the threshold falls fast
    s = x @ np.array([3, 2, 1])
    want = [(0, int(j), int(s[j])) for j in np.lexsort((np.arange(5000), -s))[:5]]
    chunk = topk.Chunk(np.arange(5000), x)
    assert [*chunk.top(np.array([9000]), np.array([[3, 2, 1]]), 5)] == want and chunk.scored < 2500
    bounded = topk.Chunk(np.arange(5000), x)
    assert [*bounded.top(np.array([9000]), np.array([[3, 2, 1]]), 5, np.array([want[-1][2]]))] == want and bounded.scored <= chunk.scored
    hopeless = topk.Chunk(np.arange(5000), x)
    assert [*hopeless.top(np.array([9000]), np.array([[3, 2, 1]]), 5, np.array([10**9]))] in ([], want) and hopeless.scored < 200


def test_own_rows_do_not_stand_for_others():
    import numpy as np

    ids = np.array([7] * 30 + list(range(100, 140)))
    x = np.concatenate([np.arange(1000, 970, -1), np.arange(40)])[:, None]
    got = [*topk.Chunk(ids, x).top(np.array([7]), np.array([[2]]), 20)]
    assert got == [(0, 139 - i, 2 * (39 - i)) for i in range(20)]


def test_every_query_row_has_its_rows(spark):
    rows = [(20, [1.0, 0.0]), (20, [0.0, 1.0]), (40, [1.0, 1.0]), (40, [1.0, 1.0])] + [(i, [i / 8, -i / 16]) for i in range(1, 8)]
    v = topk.integers(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    ints = [(i, [int(64 * c // 1) for c in x]) for i, x in rows]
    want = []
    for i, x in ints:
        if i % 20 == 0:
            scores = sorted((-sum(a * b for a, b in zip(x, y)), j) for j, y in ints if j != i)[:3]
            want += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores)]
    for sizes in ({}, {"chunk_rows": 3, "block_rows": 2}):
        assert sorted(map(tuple, topk.top_k(v.where("id % 20 = 0"), v, 3, **sizes).collect())) == sorted(want)
    same = topk.integers(spark.createDataFrame([(1, [1.0])] * 50 + [(20, [1.0])], "vec_id long, embedding array<double>"))
    assert sorted(map(tuple, topk.top_k(same.where("id = 20"), same, 4).collect())) == [(20, r, 1, 4096) for r in (1, 2, 3, 4)]


def test_wide_values_stay_integers(spark):
    df = spark.createDataFrame([(0, [2**24 + 1.0, 1.0]), (1, [2**24 + 1.0, 0.0]), (2, [2**24 + 1.0, 1.0])], "vec_id long, embedding array<double>")
    a = 64 * (2**24 + 1)
    assert found(df, 2, 20) == {(0, 1, 2, a * a + 64 * 64), (0, 2, 1, a * a)}
