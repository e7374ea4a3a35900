"""Removal of lines that stand on many sites, by distinct-site spread.

Every line's hash carries a HyperLogLog sketch of the sites it stands on; the
sketches are built in the map tasks and merged by aggregation, so a line that
fills a third of the corpus is one small sketch per task.  Where a sketch's
estimate is near the threshold, within its error, the line's distinct sites
are counted exactly.  Lines that reach the threshold are boilerplate: they are
removed everywhere but at their first place, so nothing is lost to the corpus.

Built-in DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunetrail.llm.common import checkpointed

MIN_SITES = 5
#: Sketches have 2**LG_K registers: a relative standard error of about 1.04 / 2**(LG_K / 2), 1.6 % for 12.
LG_K = 12
#: Estimates within this share of the threshold are counted exactly: over six standard errors.
BAND = 0.1
#: Parts that the places of a line on one site are dealt into.
SALT = 32


def _key(line: Column) -> Column:
    """96 bits of hash, so that lines of a very large corpus don't meet by chance."""
    return F.struct(F.xxhash64(line).alias("x"), F.hash(line).alias("y"))


def document_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source") -> DataFrame:
    """(doc, body, site, pos, line): one row per line that isn't blank, compared without blanks around it.

    ``body`` is the hash of the text; a document is a row's id and text."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    lines = docs.select(F.col(f"`{id_col}`").alias("doc"), F.xxhash64(text).alias("body"), F.col(f"`{site_col}`").cast("string").alias("site"), F.posexplode(F.split(text, "\n", -1)).alias("pos", "raw"))
    return lines.select("doc", "body", "site", "pos", F.trim(F.regexp_replace("raw", "[\t\r]+", " ")).alias("line")).where("line != ''")


def line_spread(lines: DataFrame, min_sites: int = MIN_SITES, lg_k: int = LG_K, band: float = BAND) -> DataFrame:
    """(key, sites, exact, first) of the lines on ``min_sites`` sites or more, from (doc, body, site, pos, line).

    ``sites`` is the sketch's estimate, or the exact count where that was near the threshold; ``first`` is the line's
    least (doc, body, pos).  A null site is one site of its own.
    """
    keyed = lines.select(_key(F.col("line")).alias("key"), F.coalesce(F.concat(F.lit("="), "site"), F.lit("-")).alias("site"), F.struct("doc", "body", "pos").alias("at"))
    spread = keyed.groupBy("key").agg(F.hll_sketch_agg("site", F.lit(lg_k)).alias("sketch"), F.min("at").alias("first"))
    low, high = min_sites * (1 - band), min_sites * (1 + band)
    wide = checkpointed(spread.select("key", F.hll_sketch_estimate("sketch").alias("sites"), "first").where(F.col("sites") >= low))
    near = wide.where(F.col("sites") <= high)
    salt = F.pmod(F.hash("at"), F.lit(SALT)).alias("salt")  # a line's many places are dealt over several tasks
    dealt = keyed.join(near.select("key"), "key", "left_semi").select("key", "site", salt).repartition("key", "site", "salt").distinct()
    counted = dealt.select("key", "site").distinct().groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    return (wide.join(counted, "key", "left").withColumn("exact", F.col("n").isNotNull())
            .select("key", F.coalesce("n", "sites").alias("sites"), "exact", "first").where(F.col("sites") >= min_sites))


def remove_boilerplate(docs: DataFrame, min_sites: int = MIN_SITES, lg_k: int = LG_K, band: float = BAND,
                       id_col: str = "doc_id", text_col: str = "text", site_col: str = "source") -> DataFrame:
    """``docs`` with the boilerplate lines taken out of ``text`` and the columns n_lines and n_removed (long).

    Every row stays, and every column; a null text stays null and a text without boilerplate is unchanged to the byte.
    Blank lines aren't boilerplate.  Rows with the same id and text are one document; a repeated id with another text
    is another document.  A null id is an id.  No rows give no rows.
    """
    lines = document_lines(docs, id_col, text_col, site_col)
    wide = checkpointed(line_spread(lines, min_sites, lg_k, band))
    places = lines.select("doc", "body", "pos", _key(F.col("line")).alias("key")).join(wide.select("key", "first"), "key")
    drop = (places.where(~F.struct("doc", "body", "pos").eqNullSafe(F.col("first"))).groupBy("doc", "body")
            .agg(F.collect_set("pos").alias("_drop")))  # a document's own lines
    names = docs.columns
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), F.col(f"`{id_col}`").alias("_doc"), F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("_body"))
    both = held.join(drop.toDF("_d", "_b", "_drop"), F.col("_doc").eqNullSafe(F.col("_d")) & (F.col("_body") == F.col("_b")), "left")
    text = F.col("_row")[text_col]
    kept = F.array_join(F.filter(F.split(text, "\n", -1), lambda x, i: ~F.array_contains("_drop", i)), "\n")
    body = F.when(F.col("_drop").isNull() | text.isNull(), text).otherwise(kept)
    return both.select(*[body.alias(c) if c == text_col else F.col("_row")[c].alias(c) for c in names],
                       F.when(text.isNull(), 0).otherwise(F.size(F.split(text, "\n", -1))).cast("long").alias("n_lines"),
                       F.when(F.col("_drop").isNull(), 0).otherwise(F.size("_drop")).cast("long").alias("n_removed"))
