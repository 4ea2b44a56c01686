"""The corpus pipeline: documents through five operators, each stage written and read again.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of ``documents``. ``run`` writes every stage as Parquet in the folder that
``spark.checkpoint.dir`` names, so a lost executor repeats at most its own tasks of one stage.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from venuelens.llm import packing, quality_lm, repetition, simhash, suffix_dedup
from venuelens.llm.common import documents
from venuelens.session import scratch_path


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is within their language's quantile."""
    return quality_lm.keep(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the repetition rules."""
    return repetition.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest doc_id) of each group of linked fingerprints."""
    return simhash.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the 100-byte strings that start earlier elsewhere."""
    return suffix_dedup.strip(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed training sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("packing", pack_sequences),
]

#: Language-model scores, hashes and token ids are out of SQL's reach; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents`` of ``sf_dir``."""
    docs = documents(spark, sf_dir)
    base = scratch_path(spark, f"pipeline-{uuid4().hex}")
    for number, (_, stage) in enumerate(STAGES):
        written = f"{base}/{number}"
        stage(spark, docs, sf_dir).write.parquet(written)
        docs = spark.read.parquet(written)
    return docs
