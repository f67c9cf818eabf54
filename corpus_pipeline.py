"""Corpus pipeline: good documents of a known language, one of each near-duplicate group, clean of benchmarks, as token ids
and the text they decode to.

Each stage takes ``(spark, docs, sf_dir)`` and returns a table that is written as Parquet and read again as the next
one's ``docs``. All stages but the last return rows of ``documents`` with all their columns.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from txguard import workspace
from txguard.llm import bpe, decontaminate, jaccard_forest, language, quality


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised with some certainty."""
    return language.keep_known(docs)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id."""
    return jaccard_forest.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without too many words of benchmark items."""
    return decontaminate.remove_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode_and_decode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``lang``, ``source``, the token ``ids`` of each whole text, with their number, and the text they decode to."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.encode(docs, path, ["doc_id", "lang", "source"])


STAGES = [
    ("quality classifier", keep_good),
    ("language ID", keep_known_language),
    ("n-gram Jaccard join", keep_one_of_each_group),
    ("benchmark decontamination", drop_contaminated),
    ("BPE encoding and decoding", encode_and_decode),
]

#: The learnt stages have no equal in SQL; the tests check every stage against its rule.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = workspace.write_table(stage(spark, docs, sf_dir), workspace.new_path(spark, "stage-" + name.replace(" ", "-")))
    return docs
