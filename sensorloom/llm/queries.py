"""The registered queries of the text operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from sensorloom.llm import decontam, divergence, linedup, mixing, neardup, negatives, pages, privacy, quality, secrets, tokens, topk, toxicity
from sensorloom.llm.common import table


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.find_secrets(table(spark, sf_dir, "documents")))


def op2_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "similarity", "start", "distance")


def op3_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes, _ = neardup.near_duplicates(table(spark, sf_dir, "documents"))
    return classes.select("doc_id", "class_id", "kept")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op5_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.main_text(table(spark, sf_dir, "pages"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents")).drop("failed_lines")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    predicted = (F.col("score") >= toxicity.DECISION).cast("int")
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", predicted.alias("predicted"))


def op8_privacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return privacy.digest(privacy.personal_spans(table(spark, sf_dir, "documents")))


def op9_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"), tokens.vocabulary())


def op10_linedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, _ = linedup.near_duplicate_lines(table(spark, sf_dir, "documents"))
    return lines.select("doc_id", "line_no", "first_doc", "first_line", "n_links", "kept")


def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


def op12_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_top_k(table(spark, sf_dir, "embeddings"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secrets": op1_secrets,
    "op2_decontam": op2_decontam,
    "op3_neardup": op3_neardup,
    "op4_mixing": op4_mixing,
    "op5_pages": op5_pages,
    "op6_quality": op6_quality,
    "op7_toxicity": op7_toxicity,
    "op8_privacy": op8_privacy,
    "op9_tokens": op9_tokens,
    "op10_linedup": op10_linedup,
    "op11_negatives": op11_negatives,
    "op12_topk": op12_topk,
    "op13_divergence": op13_divergence,
}
