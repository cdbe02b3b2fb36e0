"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are folded to lower case; runs of other characters than letters are
boundaries. Every 1-, 2- and 3-gram that holds a letter is hashed into one of
``BUCKETS`` features. Training counts features per language over all labelled
rows, summed inside the tasks and then by (language, feature); one task a
language turns its sums into a row of log-probabilities. The matrix is broadcast
in blocks of at most MAX_LANGS languages (64 MB). Scoring adds the rows of the
matrix for the features of a batch, in numpy, without a shuffle, one pass a
block; further blocks go on from the best language and the total so far, written
between them.

Defined results: a null text or one without letters is ``und`` with score 0;
rows with a null label or without letters do not train; with no training rows
everything is ``und``; repeated rows are scored alike; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskforge.llm.common import fresh, materialize, string_buffers

BUCKETS = 1 << 16
MAX_LANGS = 256      # languages of one broadcast block; more make further blocks
SMOOTHING = 0.5
CHARS = 1 << 19      # characters hashed at once
UNKNOWN = "und"
_MULT = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], dtype=np.uint32)
_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _letters[0]


def features(texts: list[str | None]):
    """Chunks of (text index, feature) of the n-grams of ``texts``."""
    parts = "".join("\0\0" + (t.lower().replace("\0", " ") if t else "") for t in texts) + "\0\0"
    flat = np.frombuffer(parts.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    end = flat == 0                                 # two separators stand before every text and behind the last
    doc = (np.cumsum(end) - end) // 2 - 1           # those behind a text belong to it
    letter = _is_letter()[flat]
    code = np.where(letter, flat, np.uint32(0x20)).astype(np.uint32)
    for a in range(0, len(code), CHARS):
        lo = max(a - 2, 0)
        c, w, d = code[lo:a + CHARS], letter[lo:a + CHARS], doc[lo:a + CHARS]
        skip = a - lo
        h = c * _MULT[0]
        out_d, out_f = [], []
        for n in range(3):
            if n:
                h = (h[:-1] ^ (h[:-1] >> np.uint32(15))) * _MULT[n] + c[n:] * _MULT[0]
                has = has[:-1] | w[n:]
            else:
                has = w
            at = np.flatnonzero(has[max(skip - n, 0):]) + max(skip - n, 0)
            x = h[at] * np.uint32(0x2545F491)
            x ^= x >> np.uint32(15)
            out_f.append(((x * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.int64))
            out_d.append(d[at + n])
        yield np.concatenate(out_d), np.concatenate(out_f)


def _parts(batch: pa.RecordBatch, col: str):
    sizes = np.diff(string_buffers(batch.column(col))[1])
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // (4 * CHARS))) + 1
    for a, z in zip([0, *cuts.tolist()], [*cuts.tolist(), len(sizes)]):
        if z > a:
            yield batch.slice(a, z - a)


def _count(batches):
    seen: dict[str, np.ndarray] = {}
    rows: dict[str, int] = {}

    def out():
        for lang, c in seen.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * (len(at) + 1), pa.string()), pa.array(np.append(at, -1).astype(np.int32)),
                 pa.array(np.append(c[at], rows[lang]))], ["lang", "feature", "n"])

    for whole in batches:
        for b in _parts(whole, "text"):
            lang = b.column("lang").to_pylist()
            names = sorted(set(lang))
            own = np.array([names.index(x) for x in lang])
            some = np.zeros(len(lang), bool)
            acc = np.zeros(len(names) * BUCKETS, np.int64)
            for d, f in features(b.column("text").to_pylist()):
                acc += np.bincount(own[d] * BUCKETS + f, minlength=len(acc))
                some[d] = True
            for i, x in enumerate(names):
                if some[own == i].any():
                    seen[x] = seen.get(x, 0) + acc[i * BUCKETS:(i + 1) * BUCKETS]
                    rows[x] = rows.get(x, 0) + int(some[own == i].sum())
            if len(seen) > MAX_LANGS:               # many labels: sums so far go out
                yield from out()
                seen, rows = {}, {}
    yield from out()


def _weights(key, tab):
    """The sums of one language (at most BUCKETS + 1 rows) as one row: documents, log-probabilities."""
    feature, n = tab.column("feature").to_numpy(), tab.column("n").to_numpy()
    counts, real = np.zeros(BUCKETS), feature >= 0
    counts[feature[real]] = n[real]
    weight = np.log((counts + SMOOTHING) / (counts.sum() + SMOOTHING * BUCKETS)).astype(np.float32)
    return pa.table({"lang": [key[0].as_py()], "n_docs": [int(n[~real].sum())], "weight": [weight.tobytes()]})


class Block:
    """At most MAX_LANGS languages: names, log-probabilities (BUCKETS, languages) and log-priors."""

    def __init__(self, rows: list, n_docs: int):
        self.langs = [r["lang"] for r in rows]
        self.weight = np.stack([np.frombuffer(r["weight"], np.float32) for r in rows], axis=1)
        self.prior = np.log(np.array([r["n_docs"] for r in rows]) / n_docs)

    def best(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text: place of the best language (first of equals), its log-score, log of the sum of all; -1 without letters."""
        n, m = len(texts), len(self.langs)
        score, some = np.zeros((n, m)), np.zeros(n, bool)
        for d, f in features(texts):
            for j in range(m):
                score[:, j] += np.bincount(d, weights=self.weight[f, j], minlength=n)
            some[d] = True
        score += self.prior
        at = score.argmax(axis=1)
        top = score[np.arange(n), at]
        return np.where(some, at, -1), top, top + np.log(np.exp(score - top[:, None]).sum(axis=1))


class Model:
    """The learned languages in code point order, in blocks of at most MAX_LANGS."""

    def __init__(self, blocks: list[Block]):
        self.blocks = blocks

    @property
    def langs(self) -> list[str]:
        return [x for b in self.blocks for x in b.langs]


def train(rows: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Fit on every row with a label."""
    counted = (rows.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
               .filter("lang is not null and text is not null").mapInArrow(_count, "lang string, feature int, n long")
               .groupBy("lang", "feature").agg(F.sum("n").alias("n")))
    table = materialize(counted.groupBy("lang").applyInArrow(_weights, "lang string, n_docs long, weight binary"), "langid-model")
    n_docs = table.agg(F.sum("n_docs")).first()[0]
    blocks, rest = [], table
    while len(part := rest.orderBy("lang").limit(MAX_LANGS).collect()):
        blocks.append(Block(part, n_docs))
        rest = table.filter(F.col("lang") > part[-1]["lang"])
    return Model(blocks)


def _score(shared, first: bool, last: bool, text_col: str, names: list[str], kept: int):
    """Scores one block of languages and keeps the better of it and of the blocks before."""
    def run(batches):
        for whole in batches:
            for b in _parts(whole, text_col):
                n = b.num_rows
                lang = np.full(n, None, dtype=object)
                top, total = np.full(n, -np.inf), np.full(n, -np.inf)
                if not first:
                    lang = np.array(b.column(kept).to_pylist(), dtype=object)
                    top, total = (b.column(kept + i).to_numpy() for i in (1, 2))
                if shared is not None:
                    at, own, own_total = shared.value.best(b.column(text_col).to_pylist())
                    better = (at >= 0) & (own > top)
                    lang = np.where(better, np.array(shared.value.langs, dtype=object)[at], lang)
                    top, total = np.where(better, own, top), np.where(at >= 0, np.logaddexp(total, own_total), total)
                out = [pa.array(lang, pa.string()), pa.array(top), pa.array(total)]
                if last:
                    known = np.not_equal(lang, None)
                    gap = np.subtract(top, total, out=np.full(n, -np.inf), where=known)
                    out = [pa.array(np.where(known, lang, UNKNOWN), pa.string()), pa.array(np.exp(np.minimum(gap, 0)))]
                yield pa.RecordBatch.from_arrays([*b.columns[:kept], *out], [*b.schema.names[:kept], *names[:len(out)]])
    return run


def identify(docs: DataFrame, model: Model, text_col: str = "text", names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with the predicted language and its posterior probability; one pass a block of languages."""
    if clash := set(names) & set(docs.columns):
        raise ValueError(f"columns exist already: {sorted(clash)}")
    spark, kept = docs.sparkSession, docs.schema.fields
    done = T.StructType([*kept, T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())])
    blocks, out = model.blocks or [None], docs
    own = [fresh(docs, "best_lang"), fresh(docs, "best_score"), fresh(docs, "log_total")]
    between = T.StructType([*kept, T.StructField(own[0], T.StringType()), *(T.StructField(c, T.DoubleType()) for c in own[1:])])
    for i, block in enumerate(blocks):
        last = i == len(blocks) - 1
        shared = spark.sparkContext.broadcast(block) if block else None
        out = out.mapInArrow(_score(shared, not i, last, text_col, list(names) if last else own, len(kept)), done if last else between)
        if not last:
            out = materialize(out, "langid-block")
    return out


def held_out(id_col: str = "doc_id") -> Column:
    """A quarter of the rows, by the id's CRC-32, that never train."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def accept(docs: DataFrame, model: Model, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows with a known language at ``least`` posterior probability."""
    names = (fresh(docs, "lang_pred"), fresh(docs, "lang_score"))
    found = identify(docs, model, text_col, names)
    return found.filter((F.col(names[0]) != UNKNOWN) & (F.col(names[1]) >= least)).select(*docs.columns)
