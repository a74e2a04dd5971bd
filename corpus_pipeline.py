"""A training corpus from raw documents, in five stages.

Each stage works on all that the stage before it kept. Its result is written as Parquet and read again as the next
stage's documents. Files go to a new folder under the cluster's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from windrose.llm import decontaminate, minhash, packing, quality, suffix_dedup
from windrose.llm.common import prepare


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from labels in its training folds."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, alike from 0.8 on, the document with the smallest id stays."""
    return minhash.keep_first(docs, percent=80)


def repeated_text_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 100 bytes that start earlier go from the texts."""
    return suffix_dedup.without_repeats(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten words in a row of a benchmark item go."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are cut into pieces of at most 1024 tokens, and pieces are packed into sequences."""
    return packing.pack(docs, str(public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [
    ("quality classifier", quality_stage),
    ("near-duplicate removal", near_duplicate_stage),
    ("repeated-text removal", repeated_text_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: A trained classifier and a tokenizer have no SQL; tests/llm checks each stage's columns, counts and odd tables, and its operator against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents that the stages keep, with their places in sequences."""
    prepare(spark)
    folder = f"{spark.conf.get('spark.checkpoint.dir', None) or spark.sparkContext._jsc.sc().getCheckpointDir().get()}/corpus-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
    return docs
