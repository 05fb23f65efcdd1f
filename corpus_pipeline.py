"""A corpus cleaned and packed for training: five stages over ``documents``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next one's docs. All but the last return the
columns they were given.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from marketlens.llm import decontamination, language, packing, simhash, substrings
from marketlens.llm.common import run_folder, table

#: SQL cannot express near copies by hash, templates or packing; tests hold the
#: stages against brute force.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is not recognised go."""
    return language.keep_identified(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one of the smallest id."""
    return simhash.drop_near_duplicates(docs, shingle=3, radius=2)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 35 words or more that repeat are cut out of all their places;
    documents that lose every word go."""
    return substrings.drop_repeats(docs, length=35)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark go."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of all documents, each with its sequence and offset."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.packed_sequences(docs, tokenizer=path, capacity=4096)


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", simhash_near_dedup),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after another, over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        folder = f"{run_folder(spark)}/pipeline-{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
