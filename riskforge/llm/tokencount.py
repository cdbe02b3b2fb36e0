"""Token counts with a digest cache.

A text's content digest (SHA-256 of its normalised bytes) and the tokenizer's
digest (SHA-256 of the library's name and version and of the vocabulary file)
are the key of a stored count. A run joins its digests to the stored counts,
encodes each missing content once, appends the new counts, and reads every
document's count from the cache. Another version of the vocabulary or of the
library has another digest and never meets old counts.

The texts stay where they are: digests (32 bytes a document) are what is
aggregated and joined. Of each missing digest one row is chosen; the rows to
encode are found by a broadcast of (digest, row tag) where that list is
counted small, by a join otherwise. The tag keeps a group of copies, however
large, apart in that join. The cache is Parquet under a folder named by the
tokenizer's digest; an append that dies leaves no rows, one that runs twice
leaves equal rows, which reading folds.

Defined results: null reads as empty and has 0 tokens; equal texts have equal
counts; repeated rows are returned each; rows without an id count like any
other; an empty table returns no rows and appends nothing.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable
from importlib.metadata import version

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskforge.llm.common import materialize, string_buffers, text_or_empty

SLICE_BYTES = 1 << 20        # texts encoded in one call of the library
BROADCAST_MISSES = 20_000    # 40 bytes each
STORED = "digest binary, n_tokens long"


def tokenizer_digest(path: str) -> str:
    """Identifies a tokenizer: library, its version and the vocabulary file's content."""
    library = "sentencepiece" if path.endswith(".model") else "tokenizers"
    with open(path, "rb") as f:
        content = hashlib.sha256(f.read()).hexdigest()
    return hashlib.sha256(f"{library} {version(library)} {content}".encode()).hexdigest()


class _Counter:
    """Token counts of texts by the library itself, opened once a worker."""

    _open: dict = {}

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if path.endswith(".model"):
            import sentencepiece

            self.piece = sentencepiece.SentencePieceProcessor(model_file=path)
        else:
            from tokenizers import Tokenizer

            self.piece, self.tok = None, Tokenizer.from_file(path)
            self.tok.no_truncation()
            self.tok.no_padding()

    @classmethod
    def of(cls, path: str) -> "_Counter":
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def count(self, texts: list[str]) -> list[int]:
        if self.piece is not None:
            return [len(ids) for ids in self.piece.encode(texts, num_threads=1)]
        return [len(e) for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]


def _encode(path: str):
    def run(batches):
        counter = _Counter.of(path)
        for whole in batches:
            # rows with equal id and text share a tag: such repeats are encoded once a batch
            codes = whole.column("digest").dictionary_encode().indices.to_numpy()
            whole = whole.take(pa.array(np.unique(codes, return_index=True)[1]))
            sizes = np.diff(string_buffers(whole.column("text"))[1])
            cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // SLICE_BYTES)) + 1
            for a, z in zip([0, *cuts.tolist()], [*cuts.tolist(), len(sizes)]):
                part = whole.slice(a, z - a)
                yield pa.RecordBatch.from_arrays(
                    [part.column("digest"), pa.array(counter.count(part.column("text").to_pylist()), pa.int64())], ["digest", "n_tokens"])
    return run


def stored(cache: str, spark, tokenizer: str) -> DataFrame:
    """digest, n_tokens of one tokenizer digest; empty where nothing is stored."""
    folder = f"{cache.rstrip('/')}/tokenizer={tokenizer}"
    spark.createDataFrame([], STORED).write.mode("append").parquet(folder)      # makes the folder
    return spark.read.schema(STORED).parquet(folder).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(docs: DataFrame, tokenizer: str, cache: str, *, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 512, normalise: Callable[[Column], Column] | None = None) -> tuple[DataFrame, int]:
    """(id, n_bytes, n_tokens, over_limit) per row, and how many contents had to be encoded.

    ``cache`` is a folder on shared storage, kept between runs. ``normalise``
    maps the text column to the content that is digested and encoded (default:
    the text itself); n_bytes is the text's own length.
    """
    spark = docs.sparkSession
    text = text_or_empty(text_col)
    content = normalise(text) if normalise else text
    rows = docs.select(F.col(id_col).alias("id"), F.octet_length(text).cast("long").alias("n_bytes"), content.alias("text"))
    rows = rows.withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256))).withColumn("tag", F.xxhash64("id", "n_bytes"))
    keys = materialize(rows.drop("text"), "content-digests")
    version_digest = tokenizer_digest(tokenizer)
    distinct = materialize(keys.groupBy("digest").agg(F.min("tag").alias("tag")), "token-contents")
    misses = materialize(distinct.join(stored(cache, spark, version_digest), "digest", "left_anti"), "token-misses")
    n_misses = misses.count()
    if n_misses:
        wanted = F.broadcast(misses) if n_misses <= BROADCAST_MISSES else misses
        encoded = (rows.select("digest", "tag", "text").join(wanted, ["digest", "tag"], "left_semi").select("digest", "text")
                   .mapInArrow(_encode(tokenizer), STORED))
        encoded.write.mode("append").parquet(f"{cache.rstrip('/')}/tokenizer={version_digest}")
    # written, so that the join reads two plain tables and a digest that many rows share is split
    counts = materialize(stored(cache, spark, version_digest).join(distinct, "digest", "left_semi"), "token-counts")
    out = keys.join(counts, "digest").select("id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
    return out, n_misses
