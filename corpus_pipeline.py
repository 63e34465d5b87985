"""A corpus from raw documents to token ids: each stage works on what the one before kept.

All but the last return the columns of the documents, of whatever names. An empty table gives an
empty one at every stage, and texts of any length are taken whole. Documents with a null or
empty text fail the quality rules. Rows that repeat an id, or have none, are rows of their own but
for near-duplicates, of which the row with the least id stays, or one of those that share it. Documents
that tie in the mix are taken in the order of a hash of their id, then of their position.
"""

from __future__ import annotations

import public_tokenizers
from barstats.llm import decontamination, mixing, quality, queries, simhash, token_store
from barstats.sources.scratch import new_folder
from pyspark.sql import DataFrame, SparkSession


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighed rules reject go."""
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak an item of the benchmark go."""
    return decontamination.decontaminate(docs, queries.table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.mix(docs).select(*docs.columns)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every document, written to a store and read back by key."""
    store = token_store.write_store(
        docs, new_folder(spark, "token-store"), public_tokenizers.path(queries.BYTE_TOKENIZER)
    )
    read = store.read(store.directory.select("doc_id", "copy"), "ids_crc32 long", token_store.crc32_of)
    return read.select("doc_id", "copy", "start", "n_tokens", "ids_crc32")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
    ("token_output", token_output),
]

#: No SQL expresses the fingerprints and the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir)
    folder = new_folder(spark, "pipeline")
    for i, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}-{name}")
        docs = spark.read.parquet(f"{folder}/{i}-{name}")
    return docs
