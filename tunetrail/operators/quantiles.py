"""Exact quantiles of columns with any number of distinct values (A3, A4).

``percentile`` keeps a map of all distinct values, which for a continuous
column is the column.  Here a KLL sketch proposes two values around each wanted
place, one pass counts what lies below and at them -- so the bracket holds
the place for certain, whatever the sketch's error -- and so on inside the bracket
until it holds at most ``LIMIT`` values, which are then sorted.  A pass
is one aggregate for all columns and places; the driver gets a few numbers of each.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LIMIT = 10_000   # values of a bracket that are sorted in one array
SKETCH_K = 4000  # a sketch has some tens of kB
MARGIN = 0.002   # half width of a bracket as a share of its values; a place outside costs a round, not the result


@dataclass
class _Place:
    """The ``index``-th value (from 0) of a column lies strictly between ``low`` and ``high`` (None: open end)."""
    col: str
    index: int
    below: int                 # values up to ``low``
    inside: int                # values strictly between
    low: float | None = None
    high: float | None = None
    value: float | None = None

    def bracket(self):
        return self.col, self.low, self.high

    def settle(self, a: float, b: float, under_a: int, to_a: int, under_b: int, to_b: int) -> None:
        """Narrow by the counts of values < a, <= a, < b, <= b (a <= b)."""
        end = self.below + self.inside
        if under_a <= self.index < to_a:
            self.value = a
        elif under_b <= self.index < to_b:
            self.value = b
        elif self.index < under_a:
            self.high, self.inside = a, under_a - self.below
        elif self.index < under_b:
            self.low, self.high, self.below, self.inside = a, b, to_a, under_b - to_a
        else:
            self.low, self.below, self.inside = b, to_b, end - to_b


def _number(col: str) -> Column:
    x = F.col(col).cast("double")
    return F.when(~F.isnan(x), x)


def _within(bracket) -> Column:
    col, low, high = bracket
    x = _number(col)
    ok = F.lit(True)
    if low is not None:
        ok = ok & (x > F.lit(low))
    if high is not None:
        ok = ok & (x < F.lit(high))
    return F.when(ok, x)


def exact_quantiles(df: DataFrame, cols: Sequence[str], probabilities: Sequence[float], limit: int = LIMIT, margin: float = MARGIN,
                    rounds: list | None = None) -> dict[tuple[str, float], float | None]:
    """{(column, p): quantile}, linear between neighbours as numpy's; None for a column without values.

    Nulls and NaN take no part; values are compared as doubles.  ``rounds``, if given, receives for each narrowing round the
    largest number of values left in a bracket.
    """
    cols = list(dict.fromkeys(cols))
    if not cols:
        return {}
    ns = df.agg(*[F.count(_number(c)).alias(f"n{i}") for i, c in enumerate(cols)]).first()
    n = {c: ns[i] for i, c in enumerate(cols)}
    places = {}
    for c in cols:
        for p in probabilities:
            if n[c]:
                for k in {math.floor(p * (n[c] - 1)), math.ceil(p * (n[c] - 1))}:
                    places[c, k] = _Place(c, k, 0, n[c])
    while True:
        wide = [t for t in places.values() if t.value is None and t.inside > limit]
        if not wide:
            break
        if rounds is not None:
            rounds.append(max(t.inside for t in wide))
        _narrow(df, wide, margin)
    _sort_brackets(df, [t for t in places.values() if t.value is None])
    out = {}
    for c in cols:
        for p in probabilities:
            out[c, p] = None
            if n[c]:
                at = p * (n[c] - 1)
                low, high = places[c, math.floor(at)].value, places[c, math.ceil(at)].value
                out[c, p] = low if low == high else low + (at - math.floor(at)) * (high - low)
    return out


def _narrow(df: DataFrame, places: list[_Place], margin: float) -> None:
    """One round: a sketch of each bracket, then exact counts around the values that it proposes."""
    brackets = list(dict.fromkeys(t.bracket() for t in places))
    sketches = df.agg(*[F.kll_sketch_agg_double(_within(b), F.lit(SKETCH_K)).alias(f"s{i}") for i, b in enumerate(brackets)])
    ask = []
    for j, t in enumerate(places):
        s, rank = F.col(f"s{brackets.index(t.bracket())}"), (t.index - t.below + 0.5) / t.inside
        ask += [F.kll_sketch_get_quantile_double(s, F.lit(max(0.0, rank - margin))).alias(f"a{j}"), F.kll_sketch_get_quantile_double(s, F.lit(min(1.0, rank + margin))).alias(f"b{j}")]
    near = sketches.select(*ask).first()
    counts = []
    for j, t in enumerate(places):
        x = _number(t.col)
        for v in (near[f"a{j}"], near[f"b{j}"]):
            counts += [F.count_if(x < F.lit(v)), F.count_if(x <= F.lit(v))]
    got = df.agg(*[c.alias(f"c{i}") for i, c in enumerate(counts)]).first()
    for j, t in enumerate(places):
        t.settle(near[f"a{j}"], near[f"b{j}"], *got[4 * j:4 * j + 4])


def _sort_brackets(df: DataFrame, places: list[_Place]) -> None:
    if not places:
        return
    brackets = list(dict.fromkeys(t.bracket() for t in places))
    held = df.agg(*[F.sort_array(F.collect_list(_within(b))).alias(f"v{i}") for i, b in enumerate(brackets)])
    got = held.select(*[F.get(f"v{brackets.index(t.bracket())}", F.lit(t.index - t.below)).alias(f"r{j}") for j, t in enumerate(places)]).first()
    for j, t in enumerate(places):
        t.value = got[j]
