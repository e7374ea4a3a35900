"""The registered queries of this subpackage: thin calls of the operators with production parameters on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tunetrail.llm import decontaminate, licenses, linededup, lm, neardup, packing, phrases, pii, prefixtrie, quality, secrets, topk, toxicity
from tunetrail.llm.common import crc_bucket, table


def tokenizer_path() -> str:
    """The public byte-level BPE vocabulary of 50,257 ids."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source stands for an owner, its documents of one language for a repository."""
    found = secrets.scan_secrets(table(spark, sf_dir, "documents"), F.col("source"), F.concat_ws("/", "source", "lang"))
    base = secrets.span_digest(F.col("base"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(base.cast("binary"), 256).alias("base_sha256"), secrets.span_digest(F.col("spans")).alias("spans"), "n_token", "n_live", "n_example", "most_owners", "most_repos", "most_docs")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), packing.vocabulary(tokenizer_path()))


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.integers(table(spark, sf_dir, "embeddings"))
    found = topk.top_k(vectors.where(F.col("id") % topk.QUERY_EVERY == 0), vectors)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op5_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"), licenses.known_digests(spark))


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(crc_bucket(F.col("doc_id"), 3) == 1, F.lit(False))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score_quality(docs, table(spark, sf_dir, "labels"), ~held_out)
    return scored.select("row.doc_id", "score").select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.scan_pii(table(spark, sf_dir, "documents"))
    base = pii.span_digest(F.col("base"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2(base.cast("binary"), 256).alias("base_sha256"), pii.span_digest(F.col("spans")).alias("spans"), "n_other")


def toxicity_held_out() -> Column:
    return F.coalesce(crc_bucket(F.col("doc_id"), 5) == 0, F.lit(False))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = toxicity_held_out()
    scored = toxicity.score_toxicity(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"), ~held_out)
    return scored.select("row.doc_id", "score").select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = linededup.remove_boilerplate(table(spark, sf_dir, "documents"))
    return clean.select("doc_id", "n_lines", "n_removed", F.length("text").cast("long").alias("n_chars_clean"), F.sha2(F.col("text").cast("binary"), 256).alias("clean_sha256"))


def op11_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixtrie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(crc_bucket(F.col("doc_id"), 7) == 2, F.lit(False))
    scored = lm.score_texts(table(spark, sf_dir, "documents"), ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op13_phrase_collocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scans": op1_secret_scans,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_benchmark_decontamination": op3_benchmark_decontamination,
    "op4_exact_top_k": op4_exact_top_k,
    "op5_license_scans": op5_license_scans,
    "op6_minhash_near_dedup": op6_minhash_near_dedup,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_pii": op8_pii,
    "op9_toxicity": op9_toxicity,
    "op10_line_dedup": op10_line_dedup,
    "op11_conversation_prefix_trie": op11_conversation_prefix_trie,
    "op12_lm_scoring": op12_lm_scoring,
    "op13_phrase_collocation": op13_phrase_collocation,
}
