"""Spans of regular expressions in whole texts, with built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters of context on each side of a match.
CONTEXT = 40


def with_matches(df: DataFrame, text_col: str, patterns: dict[str, tuple[str, Column, int]], carry: list[str]) -> DataFrame:
    """``df``'s ``carry`` columns and an array for each kind: structs (start, end, match, group, before, after).

    ``patterns``: kind -> (Java pattern, condition that a text with a match meets, group).  The leftmost
    non-overlapping matches are what splits the text, so the lengths of the pieces and of the matches give the
    places, in code points.  ``before`` and ``after`` are the text around, as far as the matches next to it and
    CONTEXT characters.  A null text has no matches.
    """
    text = F.col(text_col)
    parts = []
    for kind, (pattern, some, group) in patterns.items():
        parts += [F.when(some, F.split(text, pattern, -1)).alias(f"{kind}_s"), F.when(some, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).alias(f"{kind}_m")]
        if group:
            parts.append(F.when(some, F.regexp_extract_all(text, F.lit(pattern), F.lit(group))).alias(f"{kind}_g"))
    cut = df.select(*carry, *parts)
    return cut.select(*carry, *[_places(kind, bool(group)).alias(kind) for kind, (_, _, group) in patterns.items()])


def _places(kind: str, group: bool) -> Column:
    s, m = F.col(f"{kind}_s"), F.col(f"{kind}_m")
    g, t = F.col(f"{kind}_g") if group else m, F.slice(s, F.lit(2), F.size(s))
    before = F.zip_with(s, m, lambda a, b: F.struct(a.alias("s"), b.alias("m")))
    after = F.zip_with(g, t, lambda a, b: F.struct(a.alias("g"), b.alias("t")))
    found = F.zip_with(before, after, lambda a, b: F.struct(a["s"].alias("s"), a["m"].alias("m"), b["g"].alias("g"), b["t"].alias("t")))
    none = F.array().cast("array<struct<start:bigint,end:bigint,match:string,group:string,before:string,after:string>>")

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["s"])
        end = start + F.length(x["m"])
        row = F.struct(start.alias("start"), end.alias("end"), x["m"].alias("match"), x["g"].alias("group"), F.right(x["s"], F.lit(CONTEXT)).alias("before"), F.left(x["t"], F.lit(CONTEXT)).alias("after"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(row)).alias("out"))

    # the last piece has no match after it
    walked = F.aggregate(F.slice(found, F.lit(1), F.greatest(F.lit(0), F.size(m))), F.struct(F.lit(0).cast("long").alias("at"), none.alias("out")), add)
    return F.when(F.coalesce(F.size(m), F.lit(0)) > 0, walked["out"]).otherwise(none)


def digest(spans: Column, order: tuple[str, ...]) -> Column:
    """'kind:start:end' of structs (kind, start, end), by start, then by kind's place in ``order``; comma-joined."""
    place = F.array(*[F.lit(k) for k in order])
    rows = F.array_sort(F.transform(spans, lambda x: F.struct(x["start"].alias("start"), F.array_position(place, x["kind"]).alias("k"), x["end"].alias("end"), x["kind"].alias("kind"))))
    return F.array_join(F.transform(rows, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
