import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import SCHEMA, edge_rows, empty_docs
from tunetrail.llm import lm
from tunetrail.llm.tokens import byte_classes, tokenize


def words(text):
    low = (text or "").encode().translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256)))
    return [*low.split(), b"</s>"]


class Katz:
    """A plain dictionary model."""

    def __init__(self, texts, order):
        self.order, self.counts, self.contexts = order, [Counter() for _ in range(order)], [Counter() for _ in range(order)]
        for text in texts:
            w = ["<s>"] * (order - 1) + words(text)
            for i in range(order - 1, len(w)):
                for n in range(order):
                    self.counts[n][tuple(w[i - n:i + 1])] += 1
                    self.contexts[n][tuple(w[i - n:i])] += 1
        self.d = [lm.discounts([sum(v == r for v in c.values()) for r in range(1, lm.K + 2)]) for c in self.counts]
        self.follow = defaultdict(set)
        for n in range(1, order):
            for g in self.counts[n]:
                self.follow[g[:-1]].add(g[-1])
        self.vocabulary = [g[0] for g in self.counts[0]]

    def kept(self, n, c):
        return self.d[n][c] * c if c <= lm.K else c - lm.TRUSTED

    def p(self, word, context):
        n = len(context)
        c, total = self.counts[n][(*context, word)], self.contexts[n][context]
        if c:
            return self.kept(n, c) / total
        if n == 0:
            return sum(x - self.kept(0, x) for x in self.counts[0].values()) / total if total else 1.0
        low = self.p(word, context[1:])
        return self.weight(context) * low if total else low

    def weight(self, context):
        n, seen = len(context), self.follow[context]
        left = sum(self.counts[n][(*context, w)] - self.kept(n, self.counts[n][(*context, w)]) for w in seen) / self.contexts[n][context]
        return left / (1 - sum(self.p(w, context[1:]) for w in seen))

    def score(self, text):
        w = ["<s>"] * (self.order - 1) + words(text)
        return sum(math.log10(self.p(w[i], tuple(w[i - self.order + 1:i]))) for i in range(self.order - 1, len(w)))


def compare(spark, rows, order, **parameters):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    train = F.col("doc_id").isNull() | (F.col("doc_id") % 3 != 0)
    got = lm.score_texts(docs, train, order=order, **parameters).collect()
    learnt = [r[1] for r in rows if r[0] is None or r[0] % 3 != 0]
    model = Katz(learnt, order)
    n, v = sum(model.counts[0].values()), len(model.counts[0])
    want = sorted((str(i), len(words(t)), sum((w,) in model.counts[0] for w in words(t)), n, sum(math.log10((model.counts[0][(w,)] + 1) / (n + v + 1)) for w in words(t)), model.score(t)) for i, t, *_ in rows)
    got = sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    np.testing.assert_allclose([g[4:] for g in got], [w[4:] for w in want], rtol=1e-9, atol=1e-9)
    return model


def random_rows(n, seed=1):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    return [(i, " ".join(r.choices(vocabulary, weights=[1 / (k + 1) for k in range(60)], k=r.randint(0, 40))), *[None] * 11) for i in range(n)]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_equals_a_dictionary_model(spark, order):
    model = compare(spark, random_rows(120), order, bucket_tokens=500)
    everything = [*model.vocabulary, "never seen"]
    for context in [(), ("<s>",), (b"w0",), (b"w59",), (b"</s>",)] + ([(b"w0", b"w1"), ("<s>", b"w3")] if order > 2 else []):
        if len(context) < order:
            assert math.isclose(sum(model.p(w, context) for w in everything), 1, rel_tol=1e-9)


def test_odd_rows(spark):
    compare(spark, edge_rows(), 2)


def test_no_training_and_no_rows(spark):
    got = lm.score_texts(spark.createDataFrame([(1, "a b", *[None] * 11)], SCHEMA), F.lit(False)).first()
    assert (got.n_tokens, got.n_known, got.train_tokens, got.base_score, got.score) == (3, 0, 0, 0.0, 0.0)
    assert lm.score_texts(empty_docs(spark), F.lit(True)).collect() == []


def test_discounts_follow_good_turing():
    n = [100, 40, 20, 12, 8, 6]
    rest = 6 * n[5] / n[0]
    want = [((r + 1) * n[r] / (r * n[r - 1]) - rest) / (1 - rest) for r in range(1, 6)]
    np.testing.assert_allclose(lm.discounts(n)[1:], want)
    for odd in ([0] * 6, [1, 0, 0, 0, 0, 0], [5, 500, 3, 2, 1, 1], [0, 9, 9, 9, 9, 9]):
        assert (lm.discounts(odd)[1:] < 1).all() and (lm.discounts(odd)[1:] > 0).all()


def test_tokenizer():
    import pyarrow as pa

    t = tokenize(pa.array([b"A b", None, b"", b"b\ta \n", b"\xffx", b"c"]), byte_classes(b"\x20\x09", b"\x0a"))
    assert [t.words.to_pylist()[i] for i in t.ids] == [b"a", b"b", b"b", b"a", b"\xffx", b"c"]
    assert t.text.tolist() == [0, 0, 3, 3, 4, 5] and t.piece.tolist() == [0, 0, 0, 0, 1, 1]
