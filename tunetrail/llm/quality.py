"""Quality scores: random Fourier features, ridge regression by partition-summed normal equations, isotonic calibration.

Dense statistics of whole texts are standardised and mapped to cosines of
random projections, which approximate a Gaussian kernel.  Each partition of
the labelled rows sums its share of the normal equations; the sums, of fixed
size, are added up and solved for the ridge weights.  Isotonic regression on
labelled rows that weren't fitted turns raw scores into probabilities.
Labels, language, source and id never enter a score.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunetrail.llm.common import checkpointed
from tunetrail.llm.toxicity import known_labels, labelled, text_features

STATISTICS = ("chars", "words", "word_length", "word_length_spread", "distinct_words", "top_word", "top_three_words", "same_next", "lines", "line_length", "repeated_lines",
              "capitals", "digits", "symbols", "commas", "stops", "exclaims", "bars", "marked_words", "capital_words", "blanks", "other_bytes", "compression", "sentence_length", "repeated_fours")
#: Labelled rows to fit and calibrate on at most (a hash sample of them if there are more); one in five of these calibrates.
MAX_FIT_ROWS = 60_000
#: Random features, kernel width in units of the standardised statistics' typical distance, ridge penalty a row, seed.
FEATURES, WIDTH, PENALTY, SEED = 384, 1.0, 1e-4, 29
#: Partitions that sum normal equations, and bins of raw scores for the calibration: what reaches the driver is bounded by these.
PARTS, BINS = 8, 512

_WORD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
_SETS = {name: chars.encode() for name, chars in {"capitals": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digits": "0123456789", "symbols": "#$%&*+/<=>@\\^_`{}~", "commas": ",;:", "stops": ".", "exclaims": "!?", "bars": "|", "blanks": " \t\n\r"}.items()}
_OTHER = bytes(range(128, 256))
_SENTENCE = re.compile(rb"[.!?]+")


def statistics(text: bytes | None) -> list[float]:
    """The STATISTICS of a UTF-8 text; null and empty texts have all zeros."""
    if not text:
        return [0.0] * len(STATISTICS)
    size = len(text)
    share = {name: (size - len(text.translate(None, chars))) / size for name, chars in _SETS.items()}
    raw = text.split()
    w = text.translate(_WORD).split()
    n, m = max(1, len(w)), max(1, len(raw))
    lengths = np.fromiter(map(len, w), dtype=np.float64, count=len(w)) if w else np.zeros(1)
    counts: dict[bytes, int] = {}
    for x in w:
        counts[x] = counts.get(x, 0) + 1
    top = sorted(counts.values(), reverse=True)[:3] or [0]
    lines = [x for x in text.split(b"\n") if x.strip()]
    k = max(1, len(lines))
    same = sum(a == b for a, b in zip(w, w[1:]))
    fours = [*zip(w, w[1:], w[2:], w[3:])]
    marked = sum(not (48 <= x[-1] <= 57 or 65 <= x[-1] <= 90 or 97 <= x[-1] <= 122 or x[-1] >= 128 or x[-1] in b".,;:!?") or x[-2:] in (b"!!", b"??") for x in raw)
    return [np.log1p(size), np.log1p(len(w)), lengths.mean(), lengths.std(), len(counts) / n, top[0] / n, sum(top) / n, same / n, np.log1p(len(lines)), np.log1p(size / k), 1 - len(set(lines)) / k,
            share["capitals"], share["digits"], share["symbols"], share["commas"], share["stops"], share["exclaims"], share["bars"], marked / m, sum(x.isupper() for x in raw) / m, share["blanks"],
            (size - len(text.translate(None, _OTHER))) / size, min(2.0, len(zlib.compress(text, 1)) / size), np.log1p(n / max(1, len(_SENTENCE.findall(text)))), 1 - len(set(fours)) / max(1, len(fours))]


class Quality:
    """A fitted model: standardisation, random projection, ridge weights, calibration; or a constant score."""

    def __init__(self, mean=None, scale=None, weights=None, steps=None, constant: float = 0.0) -> None:
        self.mean, self.scale, self.weights, self.steps, self.constant = mean, scale, weights, steps, constant

    def projection(self) -> tuple[np.ndarray, np.ndarray]:
        rng = np.random.default_rng(SEED)
        width = WIDTH * np.sqrt(len(STATISTICS))
        return rng.standard_normal((len(STATISTICS), FEATURES)) / width, rng.uniform(0, 2 * np.pi, FEATURES)

    def random_features(self, x: np.ndarray) -> np.ndarray:
        """Rows of FEATURES cosines and a one."""
        w, b = self.projection()
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.hstack([np.sqrt(2 / FEATURES) * np.cos(z @ w + b), np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.random_features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), self.constant)
        return np.clip(np.interp(self.raw(x), *self.steps), 0.0, 1.0)

    @classmethod
    def fit(cls, rows: DataFrame) -> Quality:
        """From STATISTICS and ``label``.  Without rows of both labels, the score is the one label there is, or 0."""
        rows = checkpointed(rows.withColumn("held", F.pmod(F.xxhash64(F.lit("calibrate"), *STATISTICS), F.lit(5)) == 0).repartition(PARTS))
        moments = rows.where("not held").agg(*[f(c).alias(f"{name}_{c}") for c in STATISTICS for name, f in (("m", F.avg), ("s", F.stddev_pop))], F.min("label").alias("least"), F.max("label").alias("most")).first()
        if moments["least"] is None or moments["least"] == moments["most"]:
            return cls(constant=moments["most"] if moments["most"] is not None else rows.agg(F.max("label")).first()[0] or 0.0)
        model = cls(np.array([moments[f"m_{c}"] for c in STATISTICS]), np.array([moments[f"s_{c}"] or 1.0 for c in STATISTICS]))
        d = FEATURES + 1

        def normal_equations(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            gram, moment, n = np.zeros((d, d)), np.zeros(d), 0
            for batch in it:
                table = _matrix(batch, (*STATISTICS, "label"))
                z = model.random_features(table[:, :-1])
                gram, moment, n = gram + z.T @ z, moment + z.T @ table[:, -1], n + len(z)
            yield pa.RecordBatch.from_arrays([pa.array([gram.tobytes()], pa.binary()), pa.array([moment.tobytes()], pa.binary()), pa.array([n], pa.int64())], names=["gram", "moment", "n"])

        sums = rows.where("not held").select(*STATISTICS, "label").mapInArrow(normal_equations, "gram binary, moment binary, n long").collect()  # PARTS rows of fixed size
        gram = sum(np.frombuffer(r["gram"]).reshape(d, d) for r in sums)
        moment, n = sum(np.frombuffer(r["moment"]) for r in sums), sum(r["n"] for r in sums)
        model.weights = np.linalg.solve(gram + PENALTY * n * np.diag([1.0] * FEATURES + [0.0]) + 1e-9 * np.eye(d), moment)

        def raw_scores(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in it:
                table = _matrix(batch, (*STATISTICS, "label"))
                yield pa.RecordBatch.from_arrays([pa.array(model.raw(table[:, :-1])), pa.array(table[:, -1])], names=["raw", "label"])

        held = rows.where("held") if not rows.where("held").isEmpty() else rows
        cut = F.floor(F.greatest(F.lit(-0.5), F.least(F.lit(1.5), "raw")) * (BINS // 2)).alias("cut")
        bins = held.select(*STATISTICS, "label").mapInArrow(raw_scores, "raw double, label double").groupBy(cut).agg(F.avg("raw").alias("x"), F.avg("label").alias("y"), F.count(F.lit(1)).alias("n")).orderBy("x").collect()
        model.steps = isotonic([r["x"] for r in bins], [r["y"] for r in bins], [r["n"] for r in bins])
        return model


def isotonic(x: list[float], y: list[float], weight: list[float]) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over points sorted by x: the ends of each pool and its mean.

    Pools of like labels are drawn a little towards each other's mean, so a score is never surer than its pool is large.
    """
    pools: list[list[float]] = []  # sum, weight, first x, last x
    for a, b, w in zip(x, y, weight):
        pools.append([b * w, w, a, a])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            s, w_, _, last = pools.pop()
            pools[-1][0] += s
            pools[-1][1] += w_
            pools[-1][3] = last
    mean = sum(p[0] for p in pools) / sum(p[1] for p in pools)
    xs, ys = [], []
    for s, w, first, last in pools:
        value = (s + mean) / (w + 1)
        xs += [first, last] if last > first else [first]
        ys += [value, value] if last > first else [value]
    return np.array(xs), np.maximum.accumulate(ys)


def _matrix(batch: pa.RecordBatch, names: tuple[str, ...]) -> np.ndarray:
    return np.column_stack([batch.column(batch.schema.get_field_index(n)).to_numpy(zero_copy_only=False) for n in names]) if batch.num_rows else np.empty((0, len(names)))


def score_quality(docs: DataFrame, labels: DataFrame, learn: Column | None = None, max_fit_rows: int = MAX_FIT_ROWS, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """(row, score) per row of ``docs``: row is a struct of all its columns, score is from 0 to 1, higher for label 1.

    ``learn``, a condition on the id, says from which ids' labels may be learnt (all, if None).  Null and empty texts
    have a score too.  Null and repeated ids give a row each.  Without labels of both kinds the score is constant (see
    ``Quality.fit``).  All documents are scored where they are read; only labelled ones, a bounded number, are read
    before, to fit.
    """
    known = known_labels(labels, label_col, F.lit(True) if learn is None else learn, max_fit_rows, "fit", id_col)
    model = Quality.fit(text_features(labelled(docs, known, id_col, text_col), STATISTICS, statistics, "_body", (F.col("label"),)))
    src = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text_col}`").cast("binary").alias("_text"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            x = np.array([statistics(t.as_py()) for t in batch.column(1)], dtype=np.float64).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(x), pa.float64())], names=["row", "score"])

    return src.mapInArrow(run, f"row {src.schema['row'].dataType.simpleString()}, score double")
