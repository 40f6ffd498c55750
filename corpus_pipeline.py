"""Corpus pipeline: five stages, each written as Parquet and read again as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessile.llm import quality_classifier
from sessile.llm.line_dedup import drop_lines
from sessile.llm.mixing import Mix, mix_documents
from sessile.llm.near_dedup import drop_near_duplicates
from sessile.llm.packing import pack_documents
from sessile.llm.queries import packing_params
from sessile.llm.storage import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go.  It learns from the labelled documents of this stage's input."""
    stats = materialize(docs.select("doc_id", quality_classifier.statistics(F.col("text")).alias("stats")), "stats")
    model = quality_classifier.fit_on_labels(stats, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_classifier.classify(docs, model).filter("quality_kept").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Recurring lines go; so does a document of which no word is left, if each of its lines stays elsewhere word for word."""
    return drop_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return drop_near_duplicates(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks for, in training order; none is cut."""
    return mix_documents(docs, Mix(whole=True))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of a document, with its place in a sequence."""
    return pack_documents(docs, packing_params())


STAGES = [
    ("quality_classifier", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

#: The classifier and the tokenizer can't be written in SQL; tests/llm holds the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"stage-{name}")
    return docs
