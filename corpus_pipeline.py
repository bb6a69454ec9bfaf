"""A corpus from raw documents to a training mix, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sensorloom.llm import decontam, linedup, mixing, neardup, quality
from sensorloom.llm.common import table
from sensorloom.session import scratch, scratch_scope


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality rules keep, without their lines that failed."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without lines near an earlier line, and without those of which too little is left."""
    return linedup.drop_repeated_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return neardup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no item of the benchmark."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How much the mix takes of each document that it takes; ``taken`` counts repeats."""
    return mixing.mix_sources(docs).filter("taken > 0")


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixed_sources),
]
#: Near-duplicate sampling and the fingerprints' hashes are not SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over ``documents``; each stage's result is written and read again.

    What a stage has written for itself goes as soon as its result is stored. Nulls, empty and very long texts, repeated
    rows and empty tables are what each stage's operator says of them.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch(spark, name.replace(" ", "-"))
        with scratch_scope(spark):
            kept = stage(spark, docs, sf_dir)
            kept.write.parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
