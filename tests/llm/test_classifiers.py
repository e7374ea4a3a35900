import zlib

import numpy as np
from pyspark.sql import functions as F

from tests.llm.helpers import edge_docs, edge_rows, empty_docs
from tunetrail.llm import quality, queries, toxicity

SF = "/root/testdata/sf0.01"


def auc(score, label):
    order = np.argsort(score, kind="stable")
    s, y = np.array(score)[order], np.array(label)[order]
    ranks = np.array([(np.searchsorted(s, x) + np.searchsorted(s, x, side="right") + 1) / 2 for x in s])
    n1 = (y == 1).sum()
    return (ranks[y == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(y) - n1))


def held_out(spark, name, label, mod, rest):
    rows = {r.doc_id: r for r in queries.QUERIES[name](spark, SF).collect()}
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for i, r in rows.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % mod == rest) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    known = [(rows[r.doc_id], r[label]) for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if r.doc_id in rows]
    known = [(r, y) for r, y in known if r.held_out]
    return auc([r.score for r, _ in known], [y for _, y in known]), np.mean([r.predicted == y for r, y in known])


def test_quality_on_held_out_rows(spark):
    area, right = held_out(spark, "op7_quality_classifier", "quality", 3, 1)
    assert area > 0.9 and right > 0.9


def test_toxicity_on_held_out_rows(spark):
    area, right = held_out(spark, "op9_toxicity", "toxic", 5, 0)
    assert area > 0.85 and right > 0.9


def edge_labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 1, 0), (3, 0, 1), (4, None, None), (5, 1, 0), (9, 0, 1), (11, 0, 1), (13, 1, 0), (13, 0, 1), (None, 1, 1), (99, 7, 7), (14, 0, 1), (17, 0, 1)], "doc_id long, quality int, toxic int")


def test_edges(spark):
    labels, none = edge_labels(spark), edge_labels(spark).limit(0)
    n = len(edge_rows())
    for scored in (quality.score_quality(edge_docs(spark), labels), toxicity.score_toxicity(edge_docs(spark), labels)):
        rows = scored.select("row.doc_id", "row.words", "row.label", "score").collect()
        assert len(rows) == n and all(0 <= r.score <= 1 and r.words == 2 and r.label == "l" for r in rows)
    for scored in (quality.score_quality(edge_docs(spark), none), toxicity.score_toxicity(edge_docs(spark), none)):
        assert [r.score for r in scored.collect()] == [0.0] * n
    one = labels.where("toxic = 0")
    assert {r.score for r in quality.score_quality(edge_docs(spark), one).collect()} == {1.0}
    assert {r.score for r in toxicity.score_toxicity(edge_docs(spark), one).collect()} == {0.0}
    assert quality.score_quality(empty_docs(spark), labels).collect() == [] and toxicity.score_toxicity(empty_docs(spark), labels).collect() == []


def test_features():
    lexicon = toxicity.Lexicon(["zork"])
    f = dict(zip(toxicity.FEATURES, toxicity.features("You are an IDIOT! zorkish 1d10t i-d-i-o-t".encode(), lexicon)))
    assert f["lexicon_peak"] == 1 and f["learnt_distinct"] == 1 and f["near_person"] == 1 and f["hidden"] == 2 and f["exclaims"] > 0
    assert toxicity.features(None, lexicon) == [0.0] * len(toxicity.FEATURES) and quality.statistics(b"") == [0.0] * len(quality.STATISTICS)
    assert all(np.isfinite(quality.statistics(t.encode())).all() for _, t, *_ in edge_rows() if t)


def test_samples_are_bounded(spark):
    labels = spark.range(1000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic"))
    n = toxicity.known_labels(labels, "toxic", F.lit(True), 100, "fit").count()
    assert 60 < n < 140 and toxicity.known_labels(labels, "toxic", F.lit(True), 1000, "fit").count() == 1000


def test_isotonic():
    x, y = quality.isotonic([0, 1, 2, 3, 4], [0, 1, 0, 1, 1], [1, 1, 1, 1, 1])
    assert (np.diff(y) >= 0).all() and y[0] < y[-1] and x[0] == 0 and x[-1] == 4


def test_isotonic_equals_plain_pooling():
    """Against the least-squares monotone fit by the min-max formula, drawn towards the mean by one weight."""
    rng = np.random.default_rng(5)
    for n in (1, 2, 9, 60):
        x, y, w = np.arange(n, dtype=float), rng.random(n) + np.arange(n) / n, rng.integers(1, 9, n)
        mean = lambda a, b: (y[a:b] @ w[a:b]) / w[a:b].sum()
        want = np.array([max(min(mean(a, b) for b in range(i + 1, n + 1)) for a in range(i + 1)) for i in range(n)])
        pool = np.array([w[np.isclose(want, v)].sum() for v in want])
        xs, ys = quality.isotonic(x.tolist(), y.tolist(), w.tolist())
        assert np.allclose(np.interp(x, xs, ys), np.maximum.accumulate((want * pool + mean(0, n)) / (pool + 1)))


def stat_rows(spark, n=400):
    rng = np.random.default_rng(3)
    x = rng.random((n, len(quality.STATISTICS)))
    y = (x[:, 0] + x[:, 1] ** 2 > 0.9).astype(float)
    return spark.createDataFrame([(*map(float, a), float(b)) for a, b in zip(x, y)], ", ".join(f"{c} double" for c in quality.STATISTICS) + ", label double")


def test_ridge_equals_numpy(spark):
    """The weights from partition sums against one dense ridge solve on the same features."""
    rows = stat_rows(spark)
    model = quality.Quality.fit(rows)
    table = np.array(rows.where(F.pmod(F.xxhash64(F.lit("calibrate"), *quality.STATISTICS), F.lit(5)) != 0).collect(), dtype=float)
    x, y = table[:, :-1], table[:, -1]
    assert np.allclose(model.mean, x.mean(0)) and np.allclose(model.scale, x.std(0))
    w, b = model.projection()
    z = np.hstack([np.sqrt(2 / quality.FEATURES) * np.cos(np.clip((x - x.mean(0)) / x.std(0), -8, 8) @ w + b), np.ones((len(x), 1))])
    ridge = np.sqrt(np.r_[np.full(quality.FEATURES, quality.PENALTY * len(x)), 0.0] + 1e-9)
    want = np.linalg.lstsq(np.vstack([z, np.diag(ridge)]), np.r_[y, np.zeros(z.shape[1])], rcond=None)[0]
    assert np.allclose(model.raw(x), z @ want, atol=1e-6)


def test_stems_equal_a_plain_count(spark):
    tail = ["common", "ordinary", "thing"]
    texts = [(i, f"{'Grumblers grumbling grumbled' if i % 3 == 0 else 'pleasant'} {tail[i % 3 if i % 2 else 0]} {'GRUMBLY' if i % 6 == 0 else 'day'}", int(i % 3 == 0)) for i in range(90)]
    docs = spark.createDataFrame([t[:2] for t in texts] + [(7000, None), (None, "grumbling")], "doc_id long, text string")
    labels = spark.createDataFrame([(t[0], t[2]) for t in texts], "doc_id long, toxic int")
    seen = [(word, toxic) for _, text, toxic in texts for word in set(text.lower().split())]
    total = [sum(toxic == k for _, toxic in seen) for k in (0, 1)]
    want = set()
    for stem in {word[:k] for word, _ in seen for k in toxicity.STEM_LENGTHS if len(word) >= min(toxicity.STEM_LENGTHS)}:
        of = [(word, toxic) for word, toxic in seen if word.startswith(stem)]
        t, c = sum(toxic for _, toxic in of), sum(not toxic for _, toxic in of)
        if len({word for word, toxic in of if toxic}) >= toxicity.STEM_WORDS and t >= toxicity.STEM_TEXTS and t / total[1] >= toxicity.STEM_LIFT * (c + 1) / total[0]:
            want.add(stem)
    assert want and set(toxicity.learn_stems(docs, labels, "toxic", F.lit(True))) == want


def test_fits_repeat(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    for score in (toxicity.score_toxicity, quality.score_quality):
        first, second = ({r[0]: r[1] for r in score(docs.repartition(n), labels).select("row.doc_id", "score").collect()} for n in (3, 11))
        if score is toxicity.score_toxicity:
            assert first == second
        else:
            assert np.allclose([first[k] for k in first], [second[k] for k in first], atol=1e-6)
