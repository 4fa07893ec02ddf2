"""The corpus pipeline: quality rules, line dedup, n-gram Jaccard join, benchmark decontamination,
best-fit packing.

Each stage takes all that its predecessor kept and decides on that input alone.  Stages are
written as Parquet below the session's checkpoint folder and read again, so a lost executor
costs at most the running stage.  All stages but the last return the columns of documents; the
last returns one row per packed piece.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tastebud.llm import decontaminate, line_dedup, near_dup, packing, quality
from tastebud.llm.queries import tokenizer_path
from tastebud.session import ensure_checkpoint_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.quality_stage(docs)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup_stage(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicate_stage(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontamination_stage(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_deduplication),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: the language model and the tokenizer have no SQL form; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline/{uuid.uuid4().hex}"
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
