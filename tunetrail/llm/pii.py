"""Personal data in texts by weak supervision.

Regular expressions propose spans.  Labelers (strict patterns, gazetteers and
the words around a span) vote on each: personal, not personal, or nothing.
Expectation-maximisation over the counts of vote patterns, of which there is a
bounded number, estimates how reliable each labeler is for each kind of span
and how likely each pattern is personal.  A logistic regression over votes and
shape, fitted to these probabilities, is the final classifier.  Spans of the
base kinds are always reported; those of the other kinds where the classifier
says personal.

Built-in DataFrame functions only; the driver computes on pattern counts.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunetrail.llm.common import checkpointed
from tunetrail.llm.spans import digest, with_matches

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "tel", "ssn", "iban", "name")

# Patterns.  Lookbehinds and possessive parts only spare work on long runs: a match begins where a run begins or the last match ended.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+"
#: After separators that aren't between two digits are crossed out, a card is a run of digits and separators.
CARD = r"[0-9][0-9\x20-]+"
LOOSE = r"(?<![0-9])[\x20-]|[\x20-](?![0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
TEL = r"(?<![0-9+])(?:\([0-9]{3}\)[\x20]?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
NAME = r"\b(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Señora?|Sra?|Mme|Monsieur|Madame)\.?\x20[A-Z][\p{L}'-]{1,30}(?:\x20[A-Z][\p{L}'-]{1,30})?"

# Words near a span that speak for personal data, by kind, and against it.
FOR = {
    "email": r"(?i)e-?mail|contact|kontakt|correo|courriel|write|reach|cc:|from:|to:", "ip": r"(?i)\bip\b|addr|host|login|client|visitor|user", "card": r"(?i)card|visa|master|credit|karte|tarjeta|carte|payment|cvv",
    "phone": r"(?i)phone|tel|call|mobile|fax|whatsapp|handy|móvil", "tel": r"(?i)phone|tel|call|mobile|fax|whatsapp|handy|móvil", "ssn": r"(?i)ssn|social|security|tax", "iban": r"(?i)iban|account|konto|cuenta|compte|bank|transfer",
    "name": r"(?i)dear|signed|regards|sincerely|patient|born|lives|met|wrote|said",
}
AGAINST = r"(?i)version|release|section|chapter|figure|page|isbn|issn|doi|article|example|sample|dummy|placeholder|test"
# Gazetteers.  Spans that match the first are taken for personal, those that match the second aren't.
GAZETTEER = {
    "email": (r"(?i)\.(?:com|org|net|edu|gov|io|de|fr|es|uk|eu|info|us|ca|ch|at|it|nl)$", r"(?i)^(?:no-?reply|info|admin|support|webmaster|postmaster|abuse|sales|hello)@|@(?:localhost|test|invalid)"),
    "ip": (r"^(?:[1-9]|[1-9][0-9]|1[0-9][0-9]|2[01][0-9]|22[0-3])\.", r"^(?:0|10|127|169\.254|192\.168|172\.(?:1[6-9]|2[0-9]|3[01])|22[4-9]|23[0-9]|24[0-9]|25[0-5])\."),
    "card": (r"^(?:4|5[1-5]|2[2-7]|3[47]|6(?:011|5))", r"^(?:0|1|9)"),
    "phone": (r"^\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[2-9][0-9]{2})", r"^\+0"),
    "tel": (r"^\(?[2-9]", r"^\(?[01]"), "ssn": (r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)", r"^(?:000|666|9)|-00-|-0000$"),
    "iban": (r"^(?:AT|BE|CH|DE|DK|ES|FI|FR|GB|IE|IT|LU|NL|NO|PL|PT|SE)", r"^(?:XX|ZZ)"),
    "name": (r"(?i)\x20(?:john|mary|james|anna|peter|paul|maria|josé|carlos|hans|klaus|marie|pierre|jean|luis|david|michael|thomas|sarah|laura|smith|müller|garcía|dupont|brown|miller)\b", r"(?i)\x20(?:president|minister|king|queen|doctor|god)\b"),
}
LABELERS = ("strict", "gazetteer", "context", "against", "borders")
STRICT = {"email": r"^[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.)++[A-Za-z]{2,24}$", "ip": r"^(?:(?:0|[1-9][0-9]{0,2})(?:\.|$)){4}$", "card": r"^[0-9]{4}(?:[ -]?[0-9]{4}){2}[ -]?[0-9]{3,4}$|^[0-9]{4}[ -]?[0-9]{6}[ -]?[0-9]{5}$",
          "phone": r"^\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){1,4}$", "tel": r"^\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}$|^([0-9]{3})([ .-])[0-9]{3}\2[0-9]{4}$", "ssn": r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$",
          "iban": r"^[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{4}){3,7}[A-Z0-9]{0,3}$|^[A-Z]{2}[0-9]{2}(?: [A-Z0-9]{4}){3,7}(?: [A-Z0-9]{1,3})?$", "name": r"^\p{Lu}[\p{L}]*\.? \p{Lu}\p{Ll}+(?: \p{Lu}\p{Ll}+)?$"}
#: Rounds of expectation-maximisation, and of the classifier's Newton steps.
ROUNDS, NEWTON = 60, 25
#: Spans of the other kinds are reported from this probability on.
LEAST_PROBABILITY = 0.5


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _luhn(x: Column) -> Column:
    """Whether the digits of ``x`` pass Luhn's check."""
    digits = F.transform(F.split(F.reverse(_digits(x)), ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(F.when(c.cast("int") > 4, 2 * c.cast("int") - 9).otherwise(2 * c.cast("int"))))
    return F.aggregate(digits, F.lit(0), lambda s, d: s + F.coalesce(d, F.lit(0))) % 10 == 0


def _valid(kind: str, x: Column) -> Column:
    if kind == "ip":
        return x.rlike(r"^(?:0*+(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9]|)(?:\.|$)){4}$")
    if kind == "card":
        return F.length(_digits(x)).between(12, 19) & _luhn(x)
    if kind == "phone":
        return F.length(_digits(x)).between(9, 15)
    return F.lit(True)


def candidates(docs: DataFrame, carry: list[str], text_col: str = "_text") -> DataFrame:
    """``carry`` and ``spans``: array of (start, end, kind, match, before, after); the base kinds' failing matches are dropped."""
    t = F.col(text_col)
    plain = {"email": (EMAIL, t.contains("@"), 0), "ip": (IP, t.rlike(r"[0-9]\.[0-9]++\.[0-9]"), 0), "phone": (PHONE, t.contains("+"), 0), "tel": (TEL, t.rlike(r"[0-9]{3}[\x20.-][0-9]{4}"), 0),
             "ssn": (SSN, t.rlike(r"[0-9]-[0-9]{2}-[0-9]"), 0), "iban": (IBAN, t.rlike(r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]{4}"), 0), "name": (NAME, t.rlike(NAME), 0)}
    first = with_matches(docs, text_col, plain, [*carry, text_col])
    digits = first.withColumn("_crossed", F.when(t.rlike(r"(?:[0-9][\x20-]?){12}"), F.regexp_replace(t, LOOSE, "x"))).drop(text_col)
    found = with_matches(digits, "_crossed", {"card": (CARD, F.col("_crossed").isNotNull(), 0)}, [*carry, *plain])

    def of(kind: str) -> Column:
        rows = F.filter(F.col(kind), lambda x: _valid(kind, x["match"])) if kind in BASE else F.col(kind)
        return F.transform(rows, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), F.lit(kind).alias("kind"), x["match"].alias("match"), x["before"].alias("before"), x["after"].alias("after")))

    return found.select(*carry, F.concat(*[of(k) for k in KINDS]).alias("spans"))


def _by_kind(of: dict[str, Column], kind: Column) -> Column:
    out = F.lit(None).cast("int")
    for k, v in of.items():
        out = F.when(kind == k, v).otherwise(out)
    return out


def votes(x: Column) -> list[Column]:
    """The LABELERS' votes on a span: 1 personal, 0 not, -1 none."""
    kind, match = x["kind"], x["match"]
    near = F.concat_ws(" ", x["before"], x["after"])
    yes, no, none = F.lit(1), F.lit(0), F.lit(-1)
    strict = _by_kind({k: F.when(match.rlike(p), yes).otherwise(no) for k, p in STRICT.items()}, kind)
    gazetteer = _by_kind({k: F.when(match.rlike(b), no).when(match.rlike(a), yes).otherwise(none) for k, (a, b) in GAZETTEER.items()}, kind)
    context = _by_kind({k: F.when(near.rlike(p), yes).otherwise(none) for k, p in FOR.items()}, kind)
    against = F.when(near.rlike(AGAINST), no).otherwise(none)
    borders = F.when(x["before"].rlike(r"[\p{L}\p{N}]$") | x["after"].rlike(r"^[\p{L}\p{N}]"), no).otherwise(yes)
    return [strict, gazetteer, context, against, borders]


def estimate(counts: dict[tuple, float]) -> dict[tuple, float]:
    """Probability that a span is personal, for each pattern (kind, vote of each labeler), by expectation-maximisation.

    Given the class, labelers vote independently, each with its own chances of 1, 0 and -1 for each kind.  Chances
    are smoothed towards labelers that are right more often than wrong, which settles which class is which.
    """
    out: dict[tuple, float] = {}
    for kind in sorted({p[0] for p in counts}):
        rows = sorted(p for p in counts if p[0] == kind)
        n = np.array([counts[p] for p in rows], dtype=float)
        v = np.array([p[1:] for p in rows], dtype=int)
        share = np.array([0.5 + 0.4 * np.tanh((r == 1).sum() - (r == 0).sum()) for r in v])
        for _ in range(ROUNDS):
            prior = np.clip((n * share).sum() / n.sum(), 0.02, 0.98)
            logit = np.full(len(rows), math.log(prior / (1 - prior)))
            for j in range(v.shape[1]):
                for value, good, bad in ((1, 3.0, 1.0), (0, 1.0, 3.0), (-1, 2.0, 2.0)):
                    at = v[:, j] == value
                    yes = ((n * share)[at].sum() + good) / ((n * share).sum() + 6)
                    no = ((n * (1 - share))[at].sum() + bad) / ((n * (1 - share)).sum() + 6)
                    logit[at] += math.log(yes / no)
            share = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        out |= dict(zip(rows, share.tolist()))
    return out


def _features(kind: str, vote: tuple[int, ...]) -> list[float]:
    return [1.0, *(float(kind == k) for k in KINDS[1:]), *(float(x == value) for x in vote for value in (1, 0))]


def train(counts: dict[tuple, float], soft: dict[tuple, float], ridge: float = 1.0) -> list[float]:
    """Weights of the final classifier: logistic regression on kind and votes, fitted to soft labels by Newton's method."""
    rows = sorted(counts)
    if not rows:
        return [0.0] * len(_features(KINDS[0], (-1,) * len(LABELERS)))
    x = np.array([_features(p[0], p[1:]) for p in rows])
    n, y = np.array([counts[p] for p in rows], dtype=float), np.array([soft[p] for p in rows])
    w = np.zeros(x.shape[1])
    for _ in range(NEWTON):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w += np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (n * (y - p)) - ridge * w)
    return w.tolist()


def probability(weights: list[float], kind: Column, vote: list[Column]) -> Column:
    """The final classifier as an expression."""
    terms = [F.lit(weights[0])] + [F.when(kind == k, F.lit(w)).otherwise(0.0) for k, w in zip(KINDS[1:], weights[1:])]
    rest = weights[len(KINDS):]
    for j, x in enumerate(vote):
        terms.append(F.when(x == 1, F.lit(rest[2 * j])).when(x == 0, F.lit(rest[2 * j + 1])).otherwise(0.0))
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return 1 / (1 + F.exp(-total))


def scan_pii(docs: DataFrame, least: float = LEAST_PROBABILITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, n_email, n_ip, n_card, n_phone, n_other (long), base and spans (arrays of start, end, kind, probability).

    ``base`` has all spans of the base kinds; ``spans`` has also the others' spans whose probability is ``least`` or
    more.  Null and empty texts have none.  Null and repeated ids give a row each.  Texts aren't shuffled: the spans
    found are stored, their vote patterns counted, and the classifier is applied to the stored spans.
    """
    src = docs.select(F.col(f"`{id_col}`").alias("_doc"), F.col(f"`{text_col}`").alias("_text"))
    voted = F.transform("spans", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"), F.array(*votes(x)).alias("votes")))
    rows = checkpointed(candidates(src, ["_doc"]).select("_doc", voted.alias("spans")))
    patterns = rows.select(F.explode("spans").alias("x")).groupBy("x.kind", "x.votes").count().collect()  # kinds x 3 ** labelers at most
    counts = {(r["kind"], *r["votes"]): float(r["count"]) for r in patterns}
    weights = train(counts, estimate(counts))
    scored = F.transform("spans", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"), probability(weights, x["kind"], [x["votes"][j] for j in range(len(LABELERS))]).alias("probability")))
    out = rows.select("_doc", F.filter(scored, lambda x: x["kind"].isin(*BASE) | (x["probability"] >= least)).alias("spans"))
    count = lambda *kinds: F.size(F.filter("spans", lambda x: x["kind"].isin(*kinds))).cast("long")
    return out.select(F.col("_doc").alias(id_col), *[count(k).alias(f"n_{k}") for k in BASE], count(*KINDS[len(BASE):]).alias("n_other"), F.filter("spans", lambda x: x["kind"].isin(*BASE)).alias("base"), "spans")


def span_digest(spans: Column) -> Column:
    return digest(spans, KINDS)
