"""Licence scans by canonical digest lookup.

A text is made canonical (case, punctuation, copyright lines, equivalent
spellings), and its digest is joined with the digests of known licence texts.
Whole documents are looked up, and so are all lines and paragraphs of them, as
licences often stand inside other texts.  Of the common licences' whole texts
(files in ``license_texts``) each paragraph is known; a text holds such a licence
if it holds all of its paragraphs.

Built-in DataFrame functions only.
"""

from __future__ import annotations

from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values: (licence, form, text) of short licence texts and notices.
KNOWN = (
    ("MIT", "notice", "Released under the MIT License."),
    ("MIT", "notice", "Licensed under the MIT License."),
    ("MIT", "notice", "This project is licensed under the MIT License."),
    ("MIT", "text", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("Apache-2.0", "notice", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "notice", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License."""),
    ("GPL-3.0", "notice", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "notice", "Licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "notice", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "notice", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "notice", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "notice", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "notice", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "notice", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "notice", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "notice", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "notice", "Licensed under CC BY-NC-SA 4.0."),
    ("CC0-1.0", "notice", "Released under CC0 1.0."),
    ("ISC", "text", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("Unlicense", "text", "This is free and unencumbered software released into the public domain."),
    ("BSD", "notice", "All rights reserved. Use of this source code is governed by a BSD-style license."),
)

# Spellings that mean the same, after case and punctuation are gone; longer ones first.
SPELLINGS = (
    ("creative commons attribution", "cc by"), ("non commercial", "nc"), ("noncommercial", "nc"), ("share alike", "sa"), ("sharealike", "sa"), ("no derivatives", "nd"), ("noderivatives", "nd"),
    ("and or", "or"), ("non infringement", "noninfringement"), ("sub license", "sublicense"), ("per cent", "percent"), ("copyright owner", "copyright holder"),
    ("version", "v"), ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("sublicence", "sublicense"), ("favour", "favor"), ("organisation", "organization"), ("whilst", "while"),
    ("acknowledgement", "acknowledgment"), ("https", "http"),
)

#: A line that says only who has the copyright.
COPYRIGHT = r"^[\p{P}\x20\t]*(?:copyright[\x20\t]*)?(?:\(c\)|©)?[\x20\t]*(?:\(c\)|©)?[\x20\t]*(?:19|20)[0-9][0-9][^\n]*"

#: The same, or a line that begins with the word or sign, year or not; lookups are tried without these lines, too.
ANY_COPYRIGHT = rf"(?:{COPYRIGHT}|^[\p{{P}}\x20\t]*(?:copyright\b|\(c\)|©)[^\n]*)"

#: (licence, contained): the paragraphs of the second are among those of the first, so of both only the first is told.
CONTAINED = (("BSD-3-Clause", "BSD-2-Clause"),)


def _worded(text: Column, without: str = COPYRIGHT) -> Column:
    """Lines of words, in lower case, with two blanks between words and one around a line; copyright lines are empty."""
    plain = F.regexp_replace(F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), f"(?dim){without}", "")), r"[^\p{L}\p{N}\n]+", "  ")
    return F.concat(F.lit(" "), F.replace(plain, F.lit("\n"), F.lit(" \n ")), F.lit(" "))


def _finished(worded: Column) -> Column:
    """One line with one blank between words, and equivalent spellings made one.  Each word has blanks of its own till
    then, so spellings match whole words only."""
    out = F.concat(F.lit(" "), F.trim(F.regexp_replace(F.replace(worded, F.lit("\n"), F.lit("")), " {3,}", "  ")), F.lit(" "))
    for said, meant in SPELLINGS:
        out = F.replace(out, F.lit(f" {said.replace(' ', '  ')} "), F.lit(f" {meant.replace(' ', '  ')} "))
    return F.replace(F.trim(out), F.lit("  "), F.lit(" "))


def canonical(text: Column) -> Column:
    """The canonical form of a text; null is like empty."""
    return _finished(_worded(text))


def _digest(canon: Column) -> Column:
    return F.sha2(canon.cast("binary"), 256)


def known_digests(spark: SparkSession, known: tuple[tuple[str, str, str], ...] = KNOWN) -> DataFrame:
    """(digest, license_id): one row for each digest; of texts that are canonically equal, the least licence."""
    rows = spark.createDataFrame([*known], "license_id string, form string, text string")
    return rows.select(_digest(canonical(F.col("text"))).alias("digest"), "license_id").groupBy("digest").agg(F.min("license_id").alias("license_id"))


def whole_texts() -> list[tuple[str, str, bool, str]]:
    """(name, license_id, is body, text) of the files ``license_id[.variant].txt``.  A variant is another wording or the
    notice for source files; ``frame`` has what may stand around a licence (titles, appendices) and is never required."""
    files = sorted((f.name.removesuffix(".txt"), f) for f in resources.files("tunetrail.llm").joinpath("license_texts").iterdir() if f.name.endswith(".txt"))
    variant = lambda name: name.rpartition(".")[2]
    return [(name, name.removesuffix(f".{variant(name)}") if variant(name).isalpha() or "-flat" in variant(name) else name, variant(name) != "frame", f.read_text(encoding="utf-8")) for name, f in files]


def known_parts(spark: SparkSession) -> DataFrame:
    """(digest, parts): the paragraphs of the whole texts; parts has (name, id, n, body, part) for each text with that
    paragraph, n being how many different ones its body has."""
    texts = spark.createDataFrame(whole_texts(), "name string, id string, body boolean, text string")
    split = texts.select("name", "id", "body", F.explode(F.split(_worded(F.col("text")), "\n[ ]*\n")).alias("w")).select("name", "id", "body", _finished(F.col("w")).alias("canon"))
    parts = split.where("canon != ''").select("name", "id", "body", _digest(F.col("canon")).alias("digest")).distinct()
    sizes = parts.groupBy("name").agg(F.count(F.lit(1)).cast("int").alias("n"))
    return parts.join(sizes, "name").groupBy("digest").agg(F.collect_list(F.struct("name", "id", "n", "body", F.col("digest").alias("part"))).alias("parts"))


def scan_licenses(docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text", parts: DataFrame | None = None) -> DataFrame:
    """Per row of ``docs``: id, canon_sha256, license_id (of the whole text, or null), n_lines and n_paragraphs (long; of
    the text, that are known), licenses (the ids of all these, sorted, comma-joined).

    ``known`` has (digest, license_id), ``parts`` has (digest, parts) as ``known_parts`` gives it, which is the default.
    A licence of ``parts`` is told, and its paragraphs count as known, if all of them are in the text, in any order; it is
    that of the whole text if nothing else stands there but copyright lines and the licence's frame.  A null text is like
    an empty one; texts, lines and paragraphs without words are never looked up.  Null and repeated ids give a row each.
    Only digests are shuffled, and a text's are summed up where it is read.
    """
    text = F.col(f"`{text_col}`")
    loose = F.when(text.rlike(r"(?dim)^[\p{P}\x20\t]*(?:copyright\b|\(c\)|©)"), _worded(text, ANY_COPYRIGHT))
    worded = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(f"`{id_col}`").alias("_doc"), _worded(text).alias("_w"), loose.alias("_v"))
    unit = lambda kind, text: F.struct(F.lit(kind).alias("unit"), _finished(text).alias("canon"))
    paragraphs = lambda kind, w: F.transform(F.split(w, "\n[ ]*\n"), lambda x: unit(kind, x))
    units = F.concat(F.array(unit("text", F.col("_w"))), paragraphs("paragraph", "_w"), F.transform(F.split("_w", "\n"), lambda x: unit("line", x)))
    more = F.when(F.col("_v").isNotNull(), F.concat(F.array(unit("loose text", F.col("_v"))), paragraphs("loose paragraph", "_v")))
    each = (worded.select("_row", "_doc", F.explode(F.when(F.col("_v").isNull(), units).otherwise(F.concat(units, more))).alias("x")).where("x.unit = 'text' or x.canon != ''")
            .select("_row", "_doc", "x.unit", _digest(F.col("x.canon")).alias("digest"), (F.col("x.canon") != "").alias("some")))
    parts = known_parts(docs.sparkSession) if parts is None else parts
    lookup = (known.select("digest", F.col("license_id").alias("_license")).unionByName(parts.select("digest", F.explode("parts").alias("_part")), allowMissingColumns=True)
              .groupBy("digest").agg(F.min("_license").alias("_license"), F.collect_list("_part").alias("_parts")))
    found = each.join(lookup, "digest", "left").withColumn("_license", F.when(F.col("some"), F.col("_license")))
    of = lambda kind: F.col("unit") == kind
    count = lambda kind: F.count(F.when(of(kind), F.col("_license")))
    held = lambda kind: F.collect_list(F.when(of(kind) & (F.size("_parts") > 0), F.struct(F.col("_license").isNotNull().alias("counted"), F.col("_parts").alias("parts"))))
    out = found.groupBy("_row", "_doc").agg(
        F.max(F.when(of("text"), F.col("digest"))).alias("canon_sha256"), F.max(F.when(of("text"), F.col("_license"))).alias("_text"), F.max(F.when(of("loose text"), F.col("_license"))).alias("_loose_text"),
        count("line").alias("n_lines"), F.collect_set("_license").alias("_all"),
        *[x for k, kind in enumerate(("paragraph", "loose paragraph")) for x in (count(kind).alias(f"_known{k}"), F.count(F.when(of(kind), 1)).alias(f"_n{k}"), held(kind).alias(f"_held{k}"))])

    bodies = F.array_distinct(F.filter(F.flatten(F.transform(F.concat("_held0", "_held1"), lambda x: x["parts"])), lambda p: p["body"]))
    out = out.withColumn("_b", bodies)
    out = out.withColumn("_full", F.array_distinct(F.transform(F.filter("_b", lambda p: F.size(F.filter("_b", lambda q: q["name"] == p["name"])) == p["n"]), lambda p: F.struct(p["name"].alias("name"), p["id"].alias("id")))))
    out = out.withColumn("_names", F.transform("_full", lambda f: f["name"])).withColumn("_ids", F.array_distinct(F.transform("_full", lambda f: f["id"])))

    def n_known(k: int) -> Column:
        return F.col(f"_known{k}") + F.size(F.filter(f"_held{k}", lambda x: ~x["counted"] & F.exists(x["parts"], lambda p: F.array_contains(F.col("_names"), p["name"]))))

    def covers(k: int, i: Column) -> Column:
        return F.size(F.filter(f"_held{k}", lambda x: F.exists(x["parts"], lambda p: p["id"] == i))) == F.col(f"_n{k}")

    whole = F.array_min(F.filter("_ids", lambda i: covers(0, i) | ((F.col("_n1") > 0) & covers(1, i))))
    told = F.col("_ids")
    for licence, contained in CONTAINED:
        told = F.when(F.array_contains(told, licence), F.array_remove(told, contained)).otherwise(told)
    return out.select(F.col("_doc").alias(id_col), "canon_sha256", F.coalesce("_text", "_loose_text", whole).alias("license_id"), "n_lines", F.greatest(n_known(0), n_known(1)).cast("long").alias("n_paragraphs"),
                      F.array_join(F.array_sort(F.array_union("_all", told)), ",").alias("licenses"))
