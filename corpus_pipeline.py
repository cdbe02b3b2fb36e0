"""A training corpus from ``documents``: language ID, near-dedup, benchmark
decontamination, mixing to target weights, token-ID output.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
it as Parquet to the shared checkpoint folder and reads it back as the next
stage's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from riskforge.llm import decontaminate, langid, mixing, probminhash, tokens
from riskforge.llm.common import load, materialize
from riskforge.llm.queries import TOKENIZER_DIR
from riskforge.session import checkpoint_root


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is in a learned language stay; ``und`` and doubtful ones go."""
    return langid.accept(docs, langid.train(docs.filter(~langid.held_out())))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return probminhash.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap a benchmark item go."""
    return decontaminate.clean(docs, load(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.take(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 as read back from the token files."""
    path = f"{checkpoint_root(spark).rstrip('/')}/tables/corpus-tokens-{uuid.uuid4().hex[:12]}"
    tokens.write_tokens(docs, path, f"{TOKENIZER_DIR}/byte_bpe_50k.json")
    return tokens.checksums(spark, path).withColumnRenamed("id", "doc_id")


STAGES = [("language_id", known_language), ("near_dedup", one_of_each_group), ("decontamination", without_benchmark),
          ("mixing", mixed), ("token_files", token_files)]

#: A learned model, hashed registers and a tokenizer are not SQL; tests/llm/test_pipeline.py
#: holds the result against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
