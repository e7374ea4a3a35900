"""Toxicity scores: gradient-boosted trees over dense text features, with isotonic calibration.

Features come from whole texts, in one pass: densities of a fixed lexicon and
of one learnt from the labels (overall, at their densest, distinct words), how
near they stand to second-person pronouns, capitals, punctuation, and
obfuscated spellings.  The learnt lexicon has the stems whose words stand
far more often in toxic texts, in whatever language.  It, the trees and the
calibration are fitted on labelled rows, on bounded samples of them
(``LEXICON_ROWS``, ``max_fit_rows``) if there are more.  Labels, language, source and id
never enter a score.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunetrail.llm.common import checkpointed
from tunetrail.llm.lexicon import LEET, SECOND_PERSON, TOXIC_WORDS

FEATURES = ("words", "learnt", "learnt_density", "learnt_peak", "learnt_distinct", "lexicon", "lexicon_density", "lexicon_peak", "lexicon_distinct", "person_density", "near_person", "capitals", "capital_words",
            "exclaims", "questions", "punctuation", "punctuation_runs", "digits", "leet_words", "hidden", "hidden_density", "spaced")
#: Labelled rows that the model is fitted on at most (a hash sample of them if there are more); one in five of these calibrates.
MAX_FIT_ROWS = 60_000
TREES, DEPTH, SEED = 20, 3, 17
#: Labelled rows that the learnt lexicon comes from at most; its stems at most, and their least and greatest length.
LEXICON_ROWS, STEMS, STEM_LENGTHS = 20_000, 96, (4, 5, 6, 7)
#: A stem counts if it is in so many words and texts, and so many times likelier in toxic texts.
STEM_WORDS, STEM_TEXTS, STEM_LIFT = 3, 6, 5.0
#: Words between a lexicon word and a pronoun that count as near; words of the window for the densest stretch.
NEAR, PEAK = 4, 50

_WORD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
_UNLEET = bytes.maketrans("".join(LEET).encode(), "".join(LEET.values()).encode())
_PUNCTUATION = bytes(b for b in range(33, 127) if not chr(b).isalnum())
_UPPER = bytes(range(65, 91))
_LEXICON, _PERSON = frozenset(w.encode() for w in TOXIC_WORDS), frozenset(w.encode() for w in SECOND_PERSON)
_LEETED = re.compile(rb"(?<![a-z0-9@$!|+])(?=[a-z0-9@$!|+]*[a-z])(?=[a-z]*[0-9@$!|+])[a-z0-9@$!|+]{3,24}(?![a-z0-9@$!|+])")
_SPACED = re.compile(rb"(?<![a-z0-9])(?:[a-z][ .*_-]){3,14}[a-z](?![a-z0-9])")
_CAPS = re.compile(rb"\b[A-Z]{3,}\b")
_RUNS = re.compile(rb"[!?*#$%&@]{2,}")


class Lexicon:
    """Finds the words of the fixed lexicon and the words that begin with a learnt stem; one lookup of its first bytes rules out most words."""

    def __init__(self, stems: list[str]) -> None:
        stems = [x.encode() for x in stems]
        self.heads = {x[:4]: () for x in _LEXICON} | {x[:4]: tuple(y for y in stems if y[:4] == x[:4]) for x in stems}

    def find(self, words: list[bytes]) -> tuple[list[int], list[int]]:
        """Places of fixed and of learnt words."""
        heads = self.heads
        some = [i for i, x in enumerate(words) if x[:4] in heads]
        return [i for i in some if words[i] in _LEXICON], [i for i in some if words[i].startswith(heads[words[i][:4]])]


def _peak(at: list[int]) -> float:
    a = np.array(at)
    return float((np.searchsorted(a, a + PEAK) - np.arange(len(a))).max()) if at else 0.0


def features(text: bytes | None, lexicon: Lexicon) -> list[float]:
    """The FEATURES of a UTF-8 text; null and empty texts have all zeros."""
    if not text:
        return [0.0] * len(FEATURES)
    low = text.lower()
    w = low.translate(_WORD).split()
    n, size = max(1, len(w)), len(text)
    at, learnt = lexicon.find(w)
    person = [i for i, x in enumerate(w) if x in _PERSON]
    near = 0
    if at and person:
        a, p = np.array(at), np.array(person)
        k = np.searchsorted(p, a)
        gap = np.minimum(np.abs(a - p[np.clip(k - 1, 0, len(p) - 1)]), np.abs(p[np.clip(k, 0, len(p) - 1)] - a))
        near = int((gap <= NEAR).sum())
    leet = _LEETED.findall(low)
    bare = [(x, x.strip(b"!|+@$")) for x in leet]
    spaced = [re.sub(rb"[^a-z]", b"", x) for x in _SPACED.findall(low)]
    hidden = sum(x.translate(_UNLEET) in _LEXICON or y not in _LEXICON and y.translate(_UNLEET) in _LEXICON for x, y in bare) + sum(x in _LEXICON for x in spaced)
    punctuation = size - len(text.translate(None, _PUNCTUATION))
    return [np.log1p(len(w)), np.log1p(len(learnt)), len(learnt) / n, _peak(learnt), float(len({w[i] for i in learnt})),
            np.log1p(len(at)), len(at) / n, _peak(at), float(len({w[i] for i in at})), len(person) / n, float(near),
            (size - len(text.translate(None, _UPPER))) / size, len(_CAPS.findall(text)) / n, text.count(b"!") / size, text.count(b"?") / size, punctuation / size,
            len(_RUNS.findall(text)) / n, (size - len(text.translate(None, b"0123456789"))) / size, len(leet) / n, float(hidden), hidden / n, len(spaced) / n]


def learn_stems(docs: DataFrame, labels: DataFrame, label_col: str, learn: Column, id_col: str = "doc_id", text_col: str = "text", max_rows: int = LEXICON_ROWS) -> list[str]:
    """The stems that mark toxic texts, from at most about ``max_rows`` labelled rows; STEMS of them at most."""
    upper, lower = ("".join(map(chr, range(a, a + 26))) for a in (65, 97))
    words = F.array_distinct(F.split(F.translate("_body", upper, lower), "[\\x00-\\x60\\x7B-\\x7F]+"))
    each = labelled(docs, known_labels(labels, label_col, learn, max_rows, "lexicon", id_col), id_col, text_col).select("label", F.explode(words).alias("word"))
    counts = checkpointed(each.groupBy("word").agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean")))
    total = counts.agg(F.sum("toxic"), F.sum("clean")).first()
    if not total[0] or not total[1]:
        return []
    stems = (counts.where(F.length("word") >= min(STEM_LENGTHS)).select(F.explode(F.array_distinct(F.transform(F.array(*map(F.lit, STEM_LENGTHS)), lambda k: F.substring("word", F.lit(1), k)))).alias("stem"), "toxic", "clean")
             .groupBy("stem").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c"), F.sum((F.col("toxic") > 0).cast("int")).alias("w")))
    share = F.lit(total[0] / (total[0] + total[1]))
    lift = (F.col("t") / total[0]) / ((F.col("c") + 1) / total[1])
    gain = F.col("t") * F.log(F.col("t") / ((F.col("t") + F.col("c")) * share))
    best = stems.where((F.col("w") >= STEM_WORDS) & (F.col("t") >= STEM_TEXTS) & (lift >= STEM_LIFT)).orderBy(gain.desc(), "stem").limit(STEMS)
    return [r["stem"] for r in best.collect()]


def text_features(docs: DataFrame, names: tuple[str, ...], of, text_col: str = "text", carry: tuple[Column, ...] = ()) -> DataFrame:
    """The columns in ``carry`` and one double for each name, from ``of(bytes | None)``; one row for each row of ``docs``."""
    src = docs.select(F.col(f"`{text_col}`").cast("binary").alias("_text"), *carry)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            x = np.array([of(t.as_py()) for t in batch.column(0)], dtype=np.float64).reshape(-1, len(names))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *(pa.array(x[:, k]) for k in range(len(names)))], names=[*batch.schema.names[1:], *names])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[1:]]
    return src.mapInArrow(run, ", ".join([*fields, *(f"{n} double" for n in names)]))


def known_labels(labels: DataFrame, label_col: str, learn: Column, max_rows: int, salt: str, id_col: str = "doc_id") -> DataFrame:
    """(_id, label 0.0 or 1.0) of the labels that may be learnt from, about ``max_rows`` at most, chosen by hash of the id.

    Null labels and labels but 0 and 1 count for nothing; a repeated id counts as often as it is labelled."""
    known = labels.select(F.col(f"`{id_col}`"), F.col(f"`{label_col}`").cast("double").alias("label")).where(learn & F.col("label").isin(0.0, 1.0)).withColumnRenamed(id_col, "_id")
    n = known.count()
    return known if n <= max_rows else known.where(F.pmod(F.xxhash64(F.lit(salt), "_id"), F.lit(n)) < max_rows)


def labelled(docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_body, label) of the documents that have a label; ``known`` has a bounded number of rows and is broadcast, so texts aren't shuffled."""
    texts = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_body"))
    return texts.join(F.broadcast(known), "_id").select("_body", "label")


class Toxicity:
    """A fitted model; ``score`` adds a score from 0 to 1 to a table of FEATURES."""

    def __init__(self, trees, calibration, constant: float) -> None:
        self.trees, self.calibration, self.constant = trees, calibration, constant

    @classmethod
    def fit(cls, rows: DataFrame) -> Toxicity:
        """From FEATURES and ``label``.  Without rows of both labels, the score is the one label there is, or 0."""
        vector = VectorAssembler(inputCols=list(FEATURES), outputCol="_x")
        held = (F.pmod(F.xxhash64(F.lit("calibrate"), *FEATURES), F.lit(5)) == 0).alias("held")
        # A bounded number of short rows, in one part and in order: sums then have one order, so the same rows give the same trees.
        rows = checkpointed(vector.transform(rows.select(*FEATURES, "label", held).repartition(1).sortWithinPartitions(*FEATURES, "label")).select("_x", "label", "held"))
        seen = {(r["held"], r["label"]) for r in rows.groupBy("held", "label").count().collect()}
        if not {(False, 0.0), (False, 1.0)} <= seen:
            return cls(None, None, max((label for _, label in seen), default=0.0))
        trees = GBTClassifier(featuresCol="_x", labelCol="label", maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, maxBins=32, seed=SEED).fit(rows.where("not held"))
        held = rows.where("held") if any(h for h, _ in seen) else rows
        margin = trees.transform(held).select(vector_to_array("rawPrediction")[1].alias("_margin"), "label")
        return cls(trees, IsotonicRegression(featuresCol="_margin", labelCol="label", predictionCol="score").fit(margin), 0.0)

    def score(self, rows: DataFrame) -> DataFrame:
        if self.trees is None:
            return rows.withColumn("score", F.lit(float(self.constant)))
        out = self.trees.transform(VectorAssembler(inputCols=list(FEATURES), outputCol="_x").transform(rows))
        out = self.calibration.transform(out.withColumn("_margin", vector_to_array("rawPrediction")[1]))
        return out.withColumn("score", F.greatest(F.lit(0.0), F.least(F.lit(1.0), "score"))).drop("_x", "rawPrediction", "probability", "prediction", "_margin")


def score_toxicity(docs: DataFrame, labels: DataFrame, learn: Column | None = None, max_fit_rows: int = MAX_FIT_ROWS, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """(row, FEATURES, score) per row of ``docs``: row is a struct of all its columns, score is from 0 to 1.

    ``learn``, a condition on the id, says from which ids' labels may be learnt (all, if None).  Null and empty texts
    have a score too.  Null and repeated ids give a row each.  Without labels of both kinds the score is constant (see
    ``Toxicity.fit``).  All documents are scored where they are read; only labelled ones, a bounded number, are read
    before, to fit.
    """
    learn = F.lit(True) if learn is None else learn
    lexicon = Lexicon(learn_stems(docs, labels, label_col, learn, id_col, text_col))
    known = known_labels(labels, label_col, learn, max_fit_rows, "fit", id_col)
    model = Toxicity.fit(text_features(labelled(docs, known, id_col, text_col), FEATURES, lambda text: features(text, lexicon), "_body", (F.col("label"),)))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return model.score(text_features(docs, FEATURES, lambda text: features(text, lexicon), text_col, (row,)))
