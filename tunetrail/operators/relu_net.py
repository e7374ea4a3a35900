"""M10 as the reference sets it: one hidden ReLU layer, logistic loss, Adam, L2 1e-5.

Rows are laid out once: dealt to mini-batches by a hash of uid and written, a
folder for each batch.  Steps follow each other, so small batches gain nothing from more
tasks: one task takes the batches of CHUNK_ROWS rows in their order and gives back
weights, Adam's two moments (of a fixed size that doesn't depend on rows) and the loss.  On a table of more rows
a task takes whole epochs, reading one batch's files at a time, so that the number of jobs doesn't grow with the rows.  Of a larger
batch tasks sum the gradient of their rows with matrix products, Spark adds the tasks' sums, and the
driver takes the step.  Batches are the same in each epoch, in a new order.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunetrail.session import readable, shared_path
from tunetrail.sources.logs import file_system

# The reference's settings, and those it leaves at their defaults.
HIDDEN, L2, SEED = 100, 1e-5, 1
RATE, BETA1, BETA2, EPSILON = 1e-3, 0.9, 0.999, 1e-8
EPOCHS, TOLERANCE, PATIENCE = 200, 1e-4, 10
#: Rows of a mini-batch, about.  The reference takes 200; on a large table a step should be worth a job.
BATCH_ROWS = 200
#: Tunable: rows whose batches one task takes one after the other, at most.
CHUNK_ROWS = 10_000
#: Tunables: rows from which a task takes whole epochs, epochs of a task, and bytes of batches that it keeps from epoch to epoch.
EPOCH_ROWS, TASK_EPOCHS, KEPT_BYTES = 10_000, 20, 100_000_000


@dataclass
class ReluNet:
    """Weights, and the standardisation of the inputs (zero and one where they are taken as they are)."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    @classmethod
    def drawn(cls, n_features: int, hidden: int, seed: int, mean: np.ndarray, scale: np.ndarray) -> ReluNet:
        """Uniform draws within the square root of 6 over inputs and outputs of the layer."""
        rng = np.random.default_rng(seed)
        a, b = np.sqrt(6 / (n_features + hidden)), np.sqrt(6 / (hidden + 1))
        return cls(rng.uniform(-a, a, (n_features, hidden)), rng.uniform(-a, a, hidden), rng.uniform(-b, b, hidden), rng.uniform(-b, b, 1), mean, scale)

    def parts(self) -> list[np.ndarray]:
        return [self.w1, self.b1, self.w2, self.b2]

    def forward(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Inputs, hidden layer and the logit of each row."""
        z = (x - self.mean) / self.scale
        h = np.maximum(z @ self.w1 + self.b1, 0.0)
        return z, h, h @ self.w2 + self.b2[0]

    def probability(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.forward(x)[2])

    def gradient_sum(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Over rows, without the penalty: the number of rows, the summed loss, and the summed gradient of all parts in one array."""
        z, h, logit = self.forward(x)
        loss = np.logaddexp(0.0, logit) - y * logit
        d = _sigmoid(logit) - y
        back = np.outer(d, self.w2) * (h > 0)
        return np.concatenate([[len(y), loss.sum()], (z.T @ back).ravel(), back.sum(0), h.T @ d, [d.sum()]])

    def unpacked(self, flat: np.ndarray) -> list[np.ndarray]:
        out, at = [], 0
        for part in self.parts():
            out.append(flat[at:at + part.size].reshape(part.shape))
            at += part.size
        return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.exp(-np.logaddexp(0.0, -x))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), dtype=np.float64)


def gradient(rows: DataFrame, net: ReluNet) -> np.ndarray:
    """:meth:`ReluNet.gradient_sum` of all (x, label) rows: summed in the tasks, then by Spark; one row comes back."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in it:
            if batch.num_rows:
                part = net.gradient_sum(_matrix(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["g"])

    parts = rows.select("x", "label").mapInArrow(run, "g array<double>")
    found = parts.groupBy(F.lit("all")).agg(Summarizer.sum(array_to_vector("g")).alias("g")).first()
    return np.zeros(2 + sum(p.size for p in net.parts())) if found is None else found["g"].toArray()


class Adam:
    def __init__(self, net: ReluNet, rate: float) -> None:
        self.rate, self.steps = rate, 0
        self.first, self.second = ([np.zeros_like(p) for p in net.parts()] for _ in range(2))

    def step(self, net: ReluNet, grads: list[np.ndarray]) -> None:
        self.steps += 1
        rate = self.rate * np.sqrt(1 - BETA2 ** self.steps) / (1 - BETA1 ** self.steps)
        for p, g, m, v in zip(net.parts(), grads, self.first, self.second):
            m += (1 - BETA1) * (g - m)
            v += (1 - BETA2) * (g * g - v)
            p -= rate * m / (np.sqrt(v) + EPSILON)


def penalised(net: ReluNet, total: np.ndarray, l2: float) -> tuple[float, list[np.ndarray]]:
    """Mean loss and mean gradient of a batch with the L2 penalty on weights, not on intercepts."""
    n = max(total[0], 1.0)
    grads = [g / n for g in net.unpacked(total[2:])]
    grads[0], grads[2] = grads[0] + l2 * net.w1 / n, grads[2] + l2 * net.w2 / n
    return total[1] / n + l2 * ((net.w1 ** 2).sum() + (net.w2 ** 2).sum()) / (2 * n), grads


def chunk_steps(rows: DataFrame, net: ReluNet, adam: Adam, l2: float, order: list[int]) -> float:
    """The steps of the batches ``order`` of (x, label, batch) rows, in one task; ``net`` and ``adam`` are as after them.  Returns
    the batches' losses, each times its rows, in all."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in it if b.num_rows]
        x = np.concatenate([_matrix(b.column(0)) for b in got])
        y, batch = (np.concatenate([b.column(c).to_numpy(zero_copy_only=False) for b in got]) for c in (1, 2))
        loss = 0.0
        for k in order:
            total = net.gradient_sum(x[batch == k], y[batch == k])
            batch_loss, grads = penalised(net, total, l2)
            loss += batch_loss * total[0]
            adam.step(net, grads)
        state = np.concatenate([[loss], *(p.ravel() for p in [*net.parts(), *adam.first, *adam.second])])
        yield pa.RecordBatch.from_arrays([pa.array([state.tolist()], pa.list_(pa.float64()))], names=["state"])

    state = np.array(rows.select("x", "label", "batch").coalesce(1).mapInArrow(run, "state array<double>").first()["state"])
    at = 1
    for part in [*net.parts(), *adam.first, *adam.second]:
        part[...] = state[at:at + part.size].reshape(part.shape)
        at += part.size
    adam.steps += len(order)
    return float(state[0])


@dataclass
class Progress:
    """How often the loss of an epoch hasn't fallen, since its least."""

    tolerance: float
    patience: int
    best: float = np.inf
    waited: int = 0

    def ended(self, loss: float) -> bool:
        self.waited = 0 if loss < self.best - self.tolerance else self.waited + 1
        self.best = min(self.best, loss)
        return self.waited >= self.patience


def epoch_steps(spark: SparkSession, files: dict[int, list[str]], rows: int, net: ReluNet, adam: Adam, l2: float, orders: list[list[int]], progress: Progress) -> bool:
    """The steps of whole epochs, one after the other, in one task that reads a batch's files when its turn comes; ``net``, ``adam`` and
    ``progress`` are as after them.  Returns whether training has ended."""
    state = [*net.parts(), *adam.first, *adam.second]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, held = {}, 0
        for _ in it:
            pass
        for order in orders:
            loss = 0.0
            for k in order:
                xy = kept.get(k)
                if xy is None:
                    tables = [_stored_batch(f) for f in files[k]]
                    xy = np.concatenate([x for x, _ in tables]), np.concatenate([y for _, y in tables])
                    if held + xy[0].nbytes <= KEPT_BYTES:
                        kept[k], held = xy, held + xy[0].nbytes
                total = net.gradient_sum(*xy)
                batch_loss, grads = penalised(net, total, l2)
                loss += batch_loss * total[0]
                adam.step(net, grads)
            ended = progress.ended(loss / rows)
            if ended:
                break
        flat = np.concatenate([[ended, progress.best, progress.waited, adam.steps], *(p.ravel() for p in state)])
        yield pa.RecordBatch.from_arrays([pa.array([flat.tolist()], pa.list_(pa.float64()))], names=["state"])

    found = np.array(spark.range(0, 1, 1, 1).mapInArrow(run, "state array<double>").first()["state"])
    at = 4
    for part in state:
        part[...] = found[at:at + part.size].reshape(part.shape)
        at += part.size
    progress.best, progress.waited, adam.steps = float(found[1]), int(found[2]), int(found[3])
    return bool(found[0])


def _stored_batch(file: str) -> tuple[np.ndarray, np.ndarray]:
    system, name = file_system(file)
    with system.open_input_file(name) as f:
        t = pq.read_table(f, columns=["x", "label"], use_threads=False)
    return _matrix(t.column("x")), t.column("label").to_numpy()


def chunks(order: Iterable[int], rows: dict[int, int]) -> Iterator[list[int]]:
    """``order`` cut where the rows of the batches would exceed CHUNK_ROWS; a larger batch is alone."""
    chunk, held = [], 0
    for k in order:
        if chunk and held + rows[k] > CHUNK_ROWS:
            yield chunk
            chunk, held = [], 0
        chunk.append(k)
        held += rows[k]
    if chunk:
        yield chunk


def fit(data: DataFrame, hidden: int = HIDDEN, l2: float = L2, rate: float = RATE, epochs: int = EPOCHS, batch_rows: int = BATCH_ROWS,
        tolerance: float = TOLERANCE, patience: int = PATIENCE, seed: int = SEED, standardise: bool = True) -> ReluNet:
    """Trained on (uid, label, features).  Ends when the loss of an epoch hasn't fallen by ``tolerance`` for ``patience`` epochs.

    The reference feeds raw features; ``standardise`` (by the training rows) is what the network needs
    here, where some features are shares and some are sums of seconds.  Rows with a null label or null
    features are left out; without rows an error is raised.
    """
    spark = data.sparkSession
    rows = data.where("label is not null and features is not null").select("uid", F.col("label").cast("double").alias("label"), "features")
    stats = rows.groupBy(F.lit("all")).agg(F.count(F.lit(1)).alias("n"), Summarizer.mean(F.col("features")).alias("mean"), Summarizer.std(F.col("features")).alias("std")).first()
    if stats is None:
        raise ValueError("no rows to train on")
    mean, std = stats["mean"].toArray(), stats["std"].toArray()
    shift, scale = (mean, np.where(std > 0, std, 1.0)) if standardise else (np.zeros_like(mean), np.ones_like(mean))
    batches = -(-stats["n"] // batch_rows)
    path = shared_path(spark, "batches")
    dealt = rows.select(F.pmod(F.xxhash64(F.lit(seed), "uid"), F.lit(batches)).cast("int").alias("batch"), vector_to_array("features").alias("x"), "label")
    dealt.hint("rebalance", "batch").write.partitionBy("batch").parquet(path)
    stored = spark.read.schema("x array<double>, label double, batch int").parquet(path)
    held = {r.batch: r["count"] for r in stored.groupBy("batch").count().collect()}
    used = sorted(held)
    net = ReluNet.drawn(len(mean), hidden, seed, shift, scale)
    adam, order = Adam(net, rate), np.random.default_rng(seed)
    progress = Progress(tolerance, patience)
    if stats["n"] > EPOCH_ROWS and max(held.values()) <= CHUNK_ROWS and readable(spark):
        files: dict[int, list[str]] = {}
        for f in sorted(stored.inputFiles()):
            files.setdefault(int(re.search(r"/batch=(\d+)/[^/]*$", f)[1]), []).append(f)
        for begin in range(0, epochs, TASK_EPOCHS):
            orders = [order.permutation(used).tolist() for _ in range(min(TASK_EPOCHS, epochs - begin))]
            if epoch_steps(spark, files, stats["n"], net, adam, l2, orders, progress):
                break
        return net
    for _ in range(epochs):
        loss = 0.0
        for chunk in chunks(order.permutation(used).tolist(), held):
            rows_of = stored.where(f"batch in ({', '.join(map(str, chunk))})")
            if sum(held[k] for k in chunk) <= CHUNK_ROWS:
                loss += chunk_steps(rows_of, net, adam, l2, chunk) / stats["n"]
                continue
            total = gradient(rows_of, net)
            batch_loss, grads = penalised(net, total, l2)
            loss += batch_loss * total[0] / stats["n"]
            adam.step(net, grads)
        if progress.ended(loss):
            break
    return net


def score(net: ReluNet, data: DataFrame) -> DataFrame:
    """(uid, label, p, split) of every row; a row without features has no p."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            known = [x for x in batch.column(3).to_pylist() if x is not None]
            p = iter(net.probability(np.array(known, dtype=np.float64)).tolist() if known else ())
            scored = [None if x is None else next(p) for x in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(scored, pa.float64())], names=["uid", "label", "split", "p"])

    src = data.select("uid", F.col("label").cast("int").alias("label"), "split", F.when(F.col("features").isNotNull(), vector_to_array("features")).alias("x"))
    uid = src.schema["uid"].dataType.simpleString()
    return src.mapInArrow(run, f"uid {uid}, label int, split string, p double").select("uid", "label", "p", "split")
