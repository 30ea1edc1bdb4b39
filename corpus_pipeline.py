"""A training corpus from the documents table.

Language ID drops documents without a language; exact dedup keeps one of equal texts;
the n-gram join keeps one of each group of near duplicates; mixing keeps documents by
their rates; the last stage encodes them. Each stage takes (spark, docs, sf_dir), works
on all that the one before kept, and returns the columns of documents, but for the last.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sparkloom.llm import bpe_codec, exact_dedup, language_id, mixing, ngram_join
from sparkloom.llm.common import staged, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.identified(docs, language_id.fit(docs))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.kept_documents(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs, table(spark, sf_dir, "labels"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe_codec.token_ids(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("ngram_join", drop_near_copies),
    ("mixing", mix),
    ("bpe_codec", encode),
]

#: Language ID, the chosen paths and the encoding are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}", compression="snappy")
    return STAGES[-1][1](spark, docs, sf_dir)
