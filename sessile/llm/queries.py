"""One query for each operator: ``(spark, sf_dir) -> DataFrame`` over a whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessile.llm import hard_negatives, oracles, pii, quality_classifier, toxicity
from sessile.llm.host_rules import quality_rules
from sessile.llm.html_text import extract_text
from sessile.llm.line_dedup import dedup_lines
from sessile.llm.lm_scoring import Backoff, score_documents
from sessile.llm.mixing import mixed_report
from sessile.llm.near_dedup import near_duplicates
from sessile.llm.packing import Packing, pack_documents
from sessile.llm.phrases import collocations
from sessile.llm.storage import materialize
from sessile.llm.topk_search import scaled, top_k


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def packing_params() -> Packing:
    """The installed byte-level vocabulary, sequences of 1024."""
    return Packing(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: lines, dropped lines and their numbers, length and hash of the text that stays."""
    docs = _table(spark, sf_dir, "documents")
    n_lines = F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(0)).cast("long")
    out = dedup_lines(docs.select("doc_id", "text", n_lines.alias("n_lines")))
    numbers = F.array_join(F.sort_array("dropped_lines"), ",")
    return out.select("doc_id", "n_lines", F.size("dropped_lines").cast("long").alias("n_dropped"), numbers.alias("dropped"), F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("kept_chars"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    stats = materialize(docs.select("doc_id", quality_classifier.statistics(F.col("text")).alias("stats")), "stats")
    model = quality_classifier.fit_on_labels(stats, _table(spark, sf_dir, "labels"))
    held_out = quality_classifier.fold(F.col("doc_id")) == 0
    scored = stats.select("doc_id", held_out.alias("held_out"), quality_classifier.scored(F.col("stats"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(_table(spark, sf_dir, "documents"), Backoff(order=3))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find_pii(_table(spark, sf_dir, "documents")))


def op5_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", scaled(F.col("embedding")).alias("vector"))
    return top_k(vectors, F.col("vec_id") % 20 == 0)


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"), packing_params())


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed_report(_table(spark, sf_dir, "documents"))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = extract_text(_table(spark, sf_dir, "pages"))
    n_lines = F.when(F.col("text") == "", 0).otherwise(F.size(F.split("text", "\n", -1)))
    return text.select("page_id", F.length("text").cast("long").alias("n_chars"), n_lines.cast("long").alias("n_lines"), "text")


def op9_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(_table(spark, sf_dir, "documents")).drop("host").withColumn("host_rate", F.round("host_rate", 6))


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = _table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    found = toxicity.classify(_table(spark, sf_dir, "documents"), labels)
    held_out = quality_classifier.fold(F.col("doc_id")) == 0
    # Neighbours as id:label:cosine, nearest first.
    shown = F.array_join(F.transform("evidence", lambda x: F.concat_ws(":", x["doc_id"], x["label"], F.format_number(x["cosine"], 6))), ",")
    return found.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), shown.alias("evidence"))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(_table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = rows.select("vec_id", label.alias("label"), hard_negatives.scaled(F.col("embedding")).alias("vector"))
    return hard_negatives.hard_negatives(vectors, F.col("vec_id") % 100 == 0)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        op1_line_dedup,
        op2_quality_classifier,
        op3_lm_scoring,
        op4_pii,
        op5_topk_search,
        op6_best_fit_packing,
        op7_source_mixing,
        op8_html_text,
        op9_host_rules,
        op10_minhash_near_dedup,
        op11_toxicity,
        op12_phrases,
        op13_hard_negatives,
    ]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    """Tokenizers, trained models, rendering and orders by xxHash64 are left to the tests' plain versions."""
    return {
        "op1_line_dedup": oracles.LINE_DEDUP,
        "op5_topk_search": oracles.TOP_K,
        "op9_host_rules": oracles.HOST_RULES,
        "op10_minhash_near_dedup": oracles.NEAR_DEDUP,
        "op12_phrases": oracles.COLLOCATIONS,
        "op13_hard_negatives": oracles.HARD_NEGATIVES,
    }
