"""Corpus pipeline: documents through the training-data operators, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns that they got.  Rows with null or empty texts pass the
filters; rows that repeat an id and text are one document and stay or go
together; other columns of ``docs`` are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunetrail.llm import decontaminate, linededup, neardup, packing, queries, toxicity
from tunetrail.llm.common import checkpointed, delete_stored, stored, table
from tunetrail.session import shared_path

#: Documents with this toxicity score or more are rejected.
TOXIC = 0.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the toxicity model rejects.  It learns from the labels that its query learns from."""
    scored = toxicity.score_toxicity(docs, table(spark, sf_dir, "labels"), ~queries.toxicity_held_out())
    return scored.where(F.col("score") < TOXIC).select(*[F.col("row")[c].alias(c) for c in docs.columns])


def drop_boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines of many sites, each but at its first place; every document stays, n_chars follows its text."""
    clean = linededup.remove_boilerplate(docs)
    return clean.select(*[F.length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one of the least id.  A row goes by its id and text; a row without
    an id goes if a document with one is like it."""
    key = F.sha2(F.col("text").cast("binary"), 256)
    found = neardup.near_duplicates(docs, row_key=key)
    gone = checkpointed(found.where("not kept and row_key is not null").select(F.col("doc_id").alias("_gone_id"), F.col("row_key").alias("_gone_key")).distinct())
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    same = F.col("_row")["doc_id"].eqNullSafe(F.col("_gone_id")) & (F.sha2(F.col("_row")["text"].cast("binary"), 256) == F.col("_gone_key"))
    return row.join(gone, same, "left_anti").select(*[F.col("_row")[c].alias(c) for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold too much of the benchmark."""
    row = docs.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    found = decontaminate.find_contamination(row, table(spark, sf_dir, "benchmark"), id_col="_id", text_col="_text", keep=("_row",))
    return found.where("not contaminated").select(*[F.col("_row")[c].alias(c) for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents, packed into sequences."""
    return packing.pack_documents(docs, packing.vocabulary(queries.tokenizer_path()))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate_lines),
    ("minhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("best_fit_packing", pack),
]

#: SQL expresses neither the trained stage nor the packing; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, one after the other; what each keeps is written once, and deleted when the next
    stage's rows are written.  The last one, which the result reads, stays in the checkpoint folder."""
    docs, before = table(spark, sf_dir, "documents"), None
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = shared_path(spark, f"pipeline-{name}")
            docs = stored(docs, path)
            if before:
                delete_stored(spark, before)
            before = path
    return docs
