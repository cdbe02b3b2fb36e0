"""Shared pieces of the training-data operators.

Words are the runs of characters other than ASCII white space
(``[^\\x20\\x09-\\x0D]+``) throughout this package.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskforge.session import materialize

__all__ = ["connected_components", "fold", "fresh", "load", "materialize", "mix64", "shingle_counts", "string_buffers",
           "text_or_empty", "word_hashes"]

CHUNK = 1 << 22          # bytes hashed at once (bounds the scratch arrays of a task)
SHINGLE_BITS = 44        # a shingle's hash; the upper 20 bits of a sort key hold its document


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_or_empty(col: str = "text"):
    """The whole text; null reads as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not use."""
    used = {c.lower() for c in df.columns}
    while (name := f"{name}_").lower() in used:
        pass
    return name


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of the public splitmix64 generator: 64-bit avalanche."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _byte_table() -> np.ndarray:
    return mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


_BYTE = _byte_table()
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)[:n]


def string_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all values together and the value boundaries (n + 1); nulls are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_string()).fill_null("")
    _, offs, data = col.buffers()
    offs = np.frombuffer(offs, dtype=np.int64)[col.offset:col.offset + len(col) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


def word_hashes(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(value index, 64-bit hash) of every word, in order.

    A polynomial hash from prefix sums, made independent of position by the
    inverse power; computed in chunks that end between words.
    """
    n = len(raw)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    word = ~_SPACE[raw]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offs[offs < n]] = True
    edge[n] = True
    first = word.copy()
    first[1:] &= ~word[:-1] | edge[1:n]
    last = word.copy()
    last[:-1] &= ~word[1:] | edge[1:n]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    out = np.empty(len(start), dtype=np.uint64)
    i, size = 0, 0
    up = down = None
    while i < len(start):
        j = max(int(np.searchsorted(end, start[i] + CHUNK, side="right")), i + 1)
        lo, hi = int(start[i]), int(end[j - 1])
        if hi - lo > size:
            size = max(hi - lo, min(CHUNK, n))
            up, down = powers(_BASE, size), powers(_BASE_INV, size)
        total = np.zeros(hi - lo + 1, dtype=np.uint64)
        np.cumsum(_BYTE[raw[lo:hi]] * up[:hi - lo], out=total[1:])
        out[i:j] = (total[end[i:j] - lo] - total[start[i:j] - lo]) * down[start[i:j] - lo]
        i = j
    return np.searchsorted(offs, start, side="right") - 1, mix64(out)


def fold(parts: list[np.ndarray], seed: int = 0) -> np.ndarray:
    """One 64-bit hash of several aligned 64-bit columns."""
    acc = np.full(len(parts[0]), seed + 1, dtype=np.uint64)
    for p in parts:
        acc = mix64(acc * np.uint64(0xD1342543DE82EF95) + p)
    return acc


def shingle_counts(col: pa.Array, width: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct word shingles per value: (value index, 44-bit hash, count), sorted.

    A value with fewer than ``width`` words has one shingle, all its words;
    one without words has none. At most 2**20 values a call.
    """
    raw, offs = string_buffers(col)
    doc, words = word_hashes(raw, offs)
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    n = len(words) - width + 1
    keys = []
    mask = np.uint64((1 << SHINGLE_BITS) - 1)
    if n > 0:
        ok = np.flatnonzero(doc[:n] == doc[width - 1:])
        coef = powers(0xD6E8FEB86659FD93, width + 1)[1:]
        h = np.zeros(len(ok), dtype=np.uint64)
        for i in range(width):
            h += words[ok + i] * coef[i]
        keys.append((doc[ok].astype(np.uint64) << np.uint64(SHINGLE_BITS)) | (mix64(h) & mask))
    sizes = np.bincount(doc, minlength=len(offs) - 1)
    at = np.concatenate([[0], np.cumsum(sizes)])
    for d in np.flatnonzero((sizes > 0) & (sizes < width)):
        own = fold([words[at[d] + i:at[d] + i + 1] for i in range(sizes[d])], seed=int(sizes[d]))
        keys.append((np.uint64(d) << np.uint64(SHINGLE_BITS)) | (own & mask))
    key = np.sort(np.concatenate(keys))
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    count = np.diff(np.concatenate([new, [len(key)]]))
    key = key[new]
    return (key >> np.uint64(SHINGLE_BITS)).astype(np.int64), key & mask, count


def connected_components(edges: DataFrame, name: str) -> DataFrame:
    """(node, component): smallest node reachable, for the nodes of ``edges`` (a, b long).

    Alternating large-star and small-star steps (Kiveris et al., "Connected
    components in MapReduce and beyond"): neighbour minima are ordinary partial
    aggregates, so a hub with very many links is never gathered in one task.
    Each round is written to the shared checkpoint folder.
    """
    e = materialize(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct(),
        f"{name}-edges")
    before = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u != v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select("u", "v", "m")
        e = materialize(
            small.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v"))).filter("u != v").distinct(), f"{name}-edges")
        now = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if now == before or not now["n"]:
            break
        before = now
    roots = e.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
