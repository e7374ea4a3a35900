"""The ReLU network: gradients and steps against numpy, and a problem that a line can't part."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tunetrail.operators import metrics as mt
from tunetrail.operators import relu_net as rn


def table(spark, n=1200):
    """Label 1 outside a ring, in two of three features of unlike sizes."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(n, 3)) * [1.0, 500.0, 0.01] + [0.0, 3000.0, 5.0]
    y = ((x[:, 0] ** 2 + ((x[:, 1] - 3000) / 500) ** 2) > 1.4).astype(int)
    df = spark.createDataFrame([(i, int(b), a.tolist(), "test" if i % 4 == 0 else "train") for i, (a, b) in enumerate(zip(x, y))], "uid long, label int, a array<double>, split string")
    return df.repartition(5).select("uid", "label", array_to_vector("a").alias("features"), "split"), x, y


def test_gradient_equals_numpy(spark):
    _, x, y = table(spark, 60)
    net = rn.ReluNet.drawn(3, 7, 2, x.mean(0), x.std(0))
    rows = spark.createDataFrame([(a.tolist(), float(b)) for a, b in zip(x, y)], "x array<double>, label double").repartition(4)
    total = rn.gradient(rows, net)
    assert total[0] == 60 and np.allclose(total, net.gradient_sum(x, y))
    loss, grads = rn.penalised(net, total, 0.3)

    def objective():
        logit = np.maximum((x - net.mean) / net.scale @ net.w1 + net.b1, 0) @ net.w2 + net.b2[0]
        p = 1 / (1 + np.exp(-logit))
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean() + 0.3 * ((net.w1 ** 2).sum() + (net.w2 ** 2).sum()) / 120

    assert np.isclose(loss, objective())
    for part, grad in zip(net.parts(), grads):  # central differences
        for at in list(np.ndindex(part.shape))[:8]:
            kept, ends = part[at], []
            for step in (1e-6, -1e-6):
                part[at] = kept + step
                ends.append(objective())
            part[at] = kept
            assert np.isclose((ends[0] - ends[1]) / 2e-6, grad[at], atol=1e-6)
    assert rn.gradient(rows.limit(0), net).tolist() == [0.0] * len(total)


def test_first_step_is_the_rate(spark):
    net = rn.ReluNet.drawn(3, 4, 0, np.zeros(3), np.ones(3))
    before = [p.copy() for p in net.parts()]
    grads = [np.where(np.arange(p.size).reshape(p.shape) % 2, 0.5, -2.0) for p in before]
    rn.Adam(net, 0.01).step(net, grads)
    for a, b, g in zip(before, net.parts(), grads):
        assert np.allclose(a - b, 0.01 * np.sign(g), atol=1e-6)


def test_learns_a_ring(spark):
    data, *_ = table(spark)
    net = rn.fit(data.where("split = 'train'"), hidden=30, rate=0.03, epochs=12, batch_rows=300)
    scored = rn.score(net, data)
    assert scored.count() == 1200 and scored.where("p < 0 or p > 1 or p is null").count() == 0
    area = {r.split: r.auc for r in mt.classification_report(scored).select("split", "auc").collect()}
    assert area["test"] > 0.95 and area["train"] > 0.95


def test_odd_rows(spark):
    data, *_ = table(spark, 40)
    odd = data.unionByName(data.limit(1).select(F.lit(None).cast("long").alias("uid"), F.lit(None).cast("int").alias("label"), F.lit(None).cast(data.schema["features"].dataType).alias("features"), F.lit("test").alias("split")))
    net = rn.fit(odd, hidden=3, epochs=1)
    assert [r.p for r in rn.score(net, odd).where("uid is null").collect()] == [None] and rn.score(net, odd).count() == 41
    with pytest.raises(ValueError):
        rn.fit(data.limit(0))


def test_chunks_take_the_same_steps(spark, monkeypatch):
    data, *_ = table(spark, 400)
    taken = []
    inner = rn.chunk_steps
    monkeypatch.setattr(rn, "chunk_steps", lambda rows, net, adam, l2, order: taken.append(order) or inner(rows, net, adam, l2, order))
    nets = []
    for rows in (10_000, 130, 0):  # an epoch in a task; some batches; each batch by the tasks' summed gradients
        monkeypatch.setattr(rn, "CHUNK_ROWS", rows)
        nets.append(rn.fit(data, hidden=5, epochs=2, batch_rows=50))
    assert [len(c) for c in taken[:2]] == [8, 8] and 4 < len(taken) < 18
    for net in nets[1:]:
        for a, b in zip(nets[0].parts(), net.parts()):
            assert np.allclose(a, b, rtol=1e-9, atol=1e-12)


def test_epochs_in_a_task_take_the_same_steps(spark, monkeypatch):
    data, *_ = table(spark, 400)
    jobs, inner = [], rn.epoch_steps
    monkeypatch.setattr(rn, "epoch_steps", lambda *args: jobs.append(len(args[-2])) or inner(*args))
    nets = [rn.fit(data, hidden=5, epochs=5, batch_rows=50), rn.fit(data, hidden=5, batch_rows=50, tolerance=9.0, patience=3)]
    assert jobs == []
    monkeypatch.setattr(rn, "EPOCH_ROWS", 0)
    monkeypatch.setattr(rn, "TASK_EPOCHS", 2)
    monkeypatch.setattr(rn, "KEPT_BYTES", 3000)  # some batches are read again in each epoch
    monkeypatch.setattr(rn, "chunk_steps", None)  # no job for a part of an epoch
    nets += [rn.fit(data, hidden=5, epochs=5, batch_rows=50), rn.fit(data, hidden=5, batch_rows=50, tolerance=9.0, patience=3)]
    assert jobs == [2, 2, 1, 2, 2]  # the second fit ends after its fourth epoch
    for a, b in zip(nets[:2], nets[2:]):
        for x, y in zip(a.parts(), b.parts()):
            assert np.allclose(x, y, rtol=1e-9, atol=1e-12)
