"""The queries of this package, one per operator, over their whole tables."""

from __future__ import annotations

import os
import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskforge.llm import (collocations, decontaminate, embeddings, html, langid, mixing, pii, probminhash, suffix,
                           tokencount, tokens, walsh, warc)
from riskforge.llm.common import load, materialize
from riskforge.session import checkpoint_root

#: Where the public vocabulary files lie; a parameter, read on the executors.
TOKENIZER_DIR = os.path.dirname(public_tokenizers.path("byte_bpe_50k.json"))

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op10_probminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, class_id (smallest doc_id of the near-duplicate class), kept."""
    return probminhash.near_duplicates(load(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "class_id", "kept")


@query
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32, from the written files."""
    path = f"{checkpoint_root(spark).rstrip('/')}/tables/token-ids-{uuid.uuid4().hex[:12]}"
    tokens.write_tokens(load(spark, sf_dir, "documents"), path, f"{TOKENIZER_DIR}/byte_bpe_50k.json")
    return tokens.checksums(spark, path).withColumnRenamed("id", "doc_id")


@query
def op4_water_filling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target, taken."""
    names = {c: c for c in ("size", "source_size", "target", "taken")}
    return mixing.mix(load(spark, sf_dir, "documents").select("doc_id", "text", "source"), names=names).drop("text", "source")


ORACLE["op4_water_filling"] = mixing.ORACLE


@query
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score; trained on the documents that are not held out."""
    docs = load(spark, sf_dir, "documents").withColumn("held_out", langid.held_out())
    model = langid.train(docs.filter(~F.col("held_out")))
    return langid.identify(docs.select("doc_id", "held_out", "text"), model).drop("text")


@query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, item_id, n_equal, n_window of every document that overlaps a benchmark item."""
    found = decontaminate.overlaps(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "item_id", "n_equal", "n_window").distinct()


ORACLE["op5_decontamination"] = decontaminate.ORACLE


@query
def op1_int8_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, n_links, component_id, kept."""
    return embeddings.near_duplicates(load(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


@query
def op8_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    return suffix.remove_repeats(load(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query
def op2_bootstrapped_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, n_added, base_sha256, spans."""
    return pii.find(load(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query
def op7_min_cut_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, url, text, n_chars of the main text of every page."""
    return html.extract(load(spark, sf_dir, "pages"))


@query
def op6_merkle_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record with its status, page archive against a written copy that was damaged
    by a fixed rule: page_id, url, segment, offset, length, sha256, status."""
    pages = load(spark, sf_dir, "pages")
    copy = materialize(warc.replica(warc.damaged(pages)), "warc-replica")
    return warc.audit(warc.replica(pages), copy)


ORACLE["op6_merkle_audit"] = warc.ORACLE


@query
def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit. The query's cache is a folder of its own, empty at first, so
    every distinct text is encoded; a caller's cache lives on between runs."""
    cache = f"{checkpoint_root(spark).rstrip('/')}/tables/token-counts-{uuid.uuid4().hex[:12]}"
    counts, _ = tokencount.count_tokens(load(spark, sf_dir, "documents"), f"{TOKENIZER_DIR}/byte_bpe_50k.json", cache)
    return counts.withColumnRenamed("id", "doc_id")


@query
def op12_walsh_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    return walsh.cluster(load(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


ORACLE["op12_walsh_clusters"] = walsh.oracle()


@query
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score."""
    return collocations.collocations(load(spark, sf_dir, "documents"))


ORACLE["op13_collocations"] = collocations.oracle()
