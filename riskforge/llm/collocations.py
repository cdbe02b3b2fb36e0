"""Phrase collocations by top-order marginalisation.

Only the longest windows are counted: every word with the two that follow it
in its piece, padded at the piece's end. Counts of shorter phrases are sums
over windows with the same first words, so one Spark ROLLUP over (lang, w1,
w2, w3) gives words, pairs, triples and the language's total at once; no
n-gram table of another order is ever exploded.

Windows are counted inside the tasks (a slice of texts at a time) and leave
them as one row per first pair with its followers, dealt by that pair. The
task that gets a pair knows all its windows: it pads the ones that stay below
``min_count`` (nothing longer of them can be reported, their prefixes keep the
count) and hands the rest to the ROLLUP. A pair with more followers in a slice
than an average task takes is hot: its windows are dealt by all three words, a
mark goes to the pair's own task, and none of its windows is padded, so a pair
or word that holds a third of the text is spread over all tasks. Tasks grow in
number with the text (``TASK_BYTES`` each), not in size.

Scores are decimals of 38 digits (exact up to counts of 10^15). The parts of a
phrase are at least as frequent as the phrase, so all counts a score needs are
among those of ``min_count`` and more.

Defined results: null text is empty, null lang is ``und`` (together with rows
labelled so); equal rows count each; a phrase's score ties go to the shorter
first part; an empty table returns no rows. Languages with fewer candidates
than ``top`` return what they have.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskforge.llm.common import materialize, string_buffers, text_or_empty, word_hashes

SLICE_BYTES = 5 << 20        # text counted at once
TASK_BYTES = 8 << 20         # text whose windows one task of the second step takes
SALTS = 1 << 20
ENDS = b".,;:!?\n\x0b\x0c\r"  # fixed: where a text is cut into pieces

_MAP = np.arange(256, dtype=np.uint8)
_MAP[ord("A"):ord("Z") + 1] += 32
_MAP[list(ENDS)] = ord(".")
_MAP[ord("\t")] = ord(" ")


def _words(col: pa.Array) -> tuple[np.ndarray, pa.DictionaryArray, np.ndarray]:
    """Value index, word and piece number (rising over all values) of every word."""
    raw, offs = string_buffers(col)
    raw = _MAP[raw]
    n = len(raw)
    dot = raw == ord(".")
    inside = ~(dot | (raw == ord(" ")))
    edge = np.zeros(n + 1, dtype=bool)
    edge[offs] = True
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:n]
    end[:-1] &= ~inside[1:] | edge[1:n]
    start, end = np.flatnonzero(start), np.flatnonzero(end) + 1
    ends = np.zeros(len(start) + 1, dtype=np.int64)
    np.cumsum(end - start, out=ends[1:])
    words = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(ends), pa.py_buffer(raw[inside]))
    doc = np.searchsorted(offs, start, side="right") - 1
    return doc, words.dictionary_encode(), np.cumsum(dot)[start] + doc


def _count(cols: list[np.ndarray], sizes: list[int]) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct tuples of the aligned code columns, sorted, and how often each occurs."""
    if math.prod(sizes) < 1 << 62:
        key = np.zeros(len(cols[0]), dtype=np.int64)
        for c, s in zip(cols, sizes):
            key = key * s + c
        key.sort()
        new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        n, key, out = np.diff(np.append(new, len(key))), key[new], []
        for s in reversed(sizes):
            key, c = np.divmod(key, s)
            out.append(c)
        return out[::-1], n
    order = np.lexsort(cols[::-1])
    cols = [c[order] for c in cols]
    new = np.flatnonzero(np.concatenate([[True], np.any([c[1:] != c[:-1] for c in cols], axis=0)]))
    return [c[new] for c in cols], np.diff(np.append(new, len(order)))


def _salt(words: pa.Array) -> np.ndarray:
    """1 to SALTS by content, the same in every task."""
    raw, offs = string_buffers(words)
    value, h = word_hashes(raw, offs)
    out = np.ones(len(words), dtype=np.int32)
    # a word may hold a character that counts as white space elsewhere: all its parts go in
    np.add.at(out, value, (h % np.uint64(SALTS)).astype(np.int32))
    return (out - 1) % SALTS + 1


def _windows(tasks: int):
    def count(lang: pa.Array, text: pa.Array):
        doc, words, piece = _words(text)
        if not len(doc):
            return
        label = lang.dictionary_encode()
        code = words.indices.to_numpy().astype(np.int64)
        vocab = words.dictionary.cast(pa.string())
        d = len(vocab)
        second, third = np.zeros((2, len(code)), dtype=np.int64)
        second[:-1] = np.where(piece[1:] == piece[:-1], code[1:] + 1, 0)      # 0 pads
        third[:-1] = np.where(second[:-1] > 0, second[1:], 0)
        (la, a, b, c), n = _count([label.indices.to_numpy()[doc].astype(np.int64), code, second, third],
                                  [len(label.dictionary), d, d + 1, d + 1])
        new = np.flatnonzero(np.concatenate([[True], (la[1:] != la[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
        size = np.diff(np.append(new, len(n)))
        padded = pa.concat_arrays([pa.array([""]), vocab])
        key = pc.binary_join_element_wise(label.dictionary.take(pa.array(la[new])), vocab.take(pa.array(a[new])), "\t")
        pair = pc.binary_join_element_wise(key, padded.take(pa.array(b[new])), " ")
        key = pc.if_else(pa.array(b[new] > 0), pair, key)
        tail = pc.binary_join_element_wise(padded.take(pa.array(c)), pa.array(n).cast(pa.string()), " ")
        hot = (size > max(4, len(n) // tasks)) & (b[new] > 0)
        far = np.repeat(hot, size)
        near = np.flatnonzero(~hot)
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size[near])]).astype(np.int32)), tail.filter(pa.array(~far)))
        yield key.take(pa.array(near)), np.zeros(len(near), np.int32), pc.binary_join(lists, " ")
        if hot.any():
            marked = key.take(pa.array(np.flatnonzero(hot)))
            yield marked, np.zeros(len(marked), np.int32), pa.nulls(len(marked), pa.string())
            owner = np.repeat(np.arange(len(new)), size)[far]
            yield key.take(pa.array(owner)), _salt(padded)[c[far]], tail.filter(pa.array(far))

    def run(batches):
        for batch in batches:
            sizes = np.diff(string_buffers(batch.column("text"))[1])
            cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // SLICE_BYTES)) + 1
            for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), len(sizes)]):
                part = batch.slice(i, j - i)
                for key, salt, tails in count(part.column("lang"), part.column("text")):
                    for x in range(0, len(key), 1 << 17):
                        yield pa.RecordBatch.from_arrays([key.slice(x, 1 << 17), pa.array(salt[x:x + (1 << 17)]), tails.slice(x, 1 << 17)],
                                                         ["pair", "salt", "tails"])
    return run


def _pad(min_count: int):
    """All windows of the pairs of one task: those too rare for any phrase are padded."""
    def run(batches):
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        rows = pa.Table.from_batches(got).combine_chunks()
        pair = rows.column("pair").combine_chunks().dictionary_encode()
        code = pair.indices.to_numpy().astype(np.int64)
        mark = rows.column("tails").is_null().to_numpy() | (rows.column("salt").to_numpy() > 0)
        hot = np.zeros(len(pair.dictionary), dtype=bool)
        hot[code[mark]] = True
        some = rows.column("tails").is_valid().to_numpy()
        lists = pc.split_pattern(rows.column("tails").combine_chunks().drop_null(), " ")
        code = np.repeat(code[some], np.diff(lists.offsets.to_numpy()) // 2)
        flat = lists.values
        third = flat.take(pa.array(np.arange(0, len(flat), 2))).dictionary_encode()
        n = flat.take(pa.array(np.arange(1, len(flat), 2))).cast(pa.int64()).to_numpy()
        names = third.dictionary
        del rows, lists, flat
        if not len(code):
            return
        key = code * len(names) + third.indices.to_numpy()
        order = np.argsort(key, kind="stable")
        key = key[order]
        new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        n = np.add.reduceat(n[order], new)
        code, tail = np.divmod(key[new], len(names))
        total = np.zeros(len(hot), dtype=np.int64)
        np.add.at(total, code, n)
        kept_pair = hot | (total >= min_count)
        kept_tail = hot[code] | (n >= min_count)
        # parts of the pairs: language, first word, second word or none
        cut = pc.split_pattern(pair.dictionary, "\t", max_splits=1, reverse=True)
        lang, words = pc.list_element(cut, 0), pc.list_element(cut, 1)
        gap = pc.find_substring(words, " ").to_numpy()
        both = pa.array(gap >= 0)
        halves = pc.split_pattern(pc.if_else(both, words, pc.binary_join_element_wise(words, "", " ")), " ")
        first, second = pc.list_element(halves, 0), pc.list_element(halves, 1)
        # 1 full windows, 2 pairs that are kept without their rare third words, 3 first words of the rest
        full = np.flatnonzero(kept_pair[code] & kept_tail)
        rest = np.flatnonzero(kept_pair[code] & ~kept_tail)
        rare = np.zeros(len(hot), dtype=np.int64)
        np.add.at(rare, code[rest], n[rest])
        mid = np.flatnonzero(rare)
        alone = np.flatnonzero(~kept_pair)
        head = pc.binary_join_element_wise(lang.take(pa.array(alone)), first.take(pa.array(alone)), "\t").dictionary_encode()
        count = np.zeros(len(head.dictionary), dtype=np.int64)
        at = head.indices.to_numpy()
        np.add.at(count, at, total[alone])
        one = np.zeros(len(count), dtype=np.int64)
        one[at] = alone
        parts = [(code[full], pa.array(tail[full]), n[full], True), (mid, None, rare[mid], True), (one, None, count, False)]
        for of, tails, sums, with_second in parts:
            blank = pa.array(np.full(len(of), "", dtype=object), pa.string())
            cols = [lang.take(pa.array(of)), first.take(pa.array(of)), second.take(pa.array(of)) if with_second else blank,
                    names.take(tails) if tails is not None else blank, pa.array(sums)]
            yield pa.RecordBatch.from_arrays(cols, ["lang", "w1", "w2", "w3", "n"])
    return run


def phrase_counts(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", min_count: int = 10) -> DataFrame:
    """lang, w1, w2, w3, order, f: phrases of 1 to 3 words (``order``) that occur ``min_count`` times, and
    the language's words in all (order 0)."""
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), text_or_empty(text_col).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    tasks = max(1, -(-size // TASK_BYTES))
    windows = (rows.mapInArrow(_windows(tasks), "pair string, salt int, tails string").repartition(tasks, "pair", "salt")
               .mapInArrow(_pad(min_count), "lang string, w1 string, w2 string, w3 string, n long"))
    sums = windows.rollup("lang", "w1", "w2", "w3").agg(F.sum("n").alias("f"), F.grouping_id().alias("level"))
    order = F.when(F.col("level") == 7, 0).when(F.col("level") == 3, 1).when(F.col("level") == 1, 2).when(F.col("level") == 0, 3)
    whole = ((F.col("level") == 7) | (F.col("f") >= min_count)) & (F.coalesce("w2", F.lit("-")) != "") & (F.coalesce("w3", F.lit("-")) != "")
    return sums.withColumn("order", order).filter(F.col("order").isNotNull() & whole).drop("level")


def collocations(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", min_count: int = 10, top: int = 2000,
                 inside_percent: int = 50, scale: int = 1_000_000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the best phrases of every language."""
    found = materialize(phrase_counts(docs, text_col=text_col, lang_col=lang_col, min_count=min_count), "phrase-counts")
    word = found.filter("order = 1").select("lang", "w1", "f")
    pair = found.filter("order = 2").select("lang", "w1", "w2", "f")
    triple = found.filter("order = 3").select("lang", "w1", "w2", "w3", F.col("f").alias("a"))
    total = found.filter("order = 0").select("lang", F.col("f").alias("n"))

    def count(rows: DataFrame, of: DataFrame, name: str, *words: str) -> DataFrame:
        keys = ["lang", *(f"w{i + 1}" for i in range(len(words)))]
        of = of.select(*(F.col(k).alias(f"__{k}") for k in keys), F.col("f").alias(name))
        on = [F.col(a) == F.col(f"__{b}") for a, b in zip(["lang", *words], keys)]
        return rows.join(of, on).drop(*(f"__{k}" for k in keys))

    big = lambda c: F.col(c).cast("decimal(20,0)")

    def cut(left: str, right: str, k: int):
        up = (big("a") * big("a")).cast("decimal(38,0)") * F.lit(scale).cast("decimal(9,0)")
        return F.struct(F.call_function("div", up, big(left) * big(right)).cast("long").alias("score"), F.lit(k).alias("k"),
                        F.col(left).alias("l"), F.col(right).alias("r"))

    # a pair inside a triple that holds most of its occurrences says nothing of its own
    longest = (triple.select("lang", F.explode(F.array(F.struct("w1", "w2"), F.struct(F.col("w2").alias("w1"), F.col("w3").alias("w2")))).alias("p"), "a")
               .groupBy("lang", F.col("p.w1").alias("w1"), F.col("p.w2").alias("w2")).agg(F.max("a").alias("longer")))
    pairs = pair.withColumnRenamed("f", "a").join(longest, ["lang", "w1", "w2"], "left")
    inside = F.coalesce(F.lit(100).cast("decimal(9,0)") * big("longer") >= F.lit(inside_percent).cast("decimal(9,0)") * big("a"), F.lit(False))
    pairs = count(count(pairs.filter(~inside), word, "f1", "w1"), word, "f2", "w2")
    pairs = pairs.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", cut("f1", "f2", 1).alias("best"))
    triples = count(count(count(count(triple, pair, "f12", "w1", "w2"), pair, "f23", "w2", "w3"), word, "f1", "w1"), word, "f3", "w3")
    triples = triples.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a",
                             F.least(cut("f1", "f23", 1), cut("f12", "f3", 2)).alias("best"))
    rows = pairs.unionByName(triples).select("lang", "phrase", "a", "best.l", "best.r", "best.score")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase"))
    best = rows.withColumn("rank", rank.cast("long")).filter(F.col("rank") <= top)
    return best.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def oracle(table: str = "documents", min_count: int = 10, top: int = 2000, inside_percent: int = 50, scale: int = 1_000_000) -> str:
    """DuckDB SQL of ``collocations`` with one n-gram table per order."""
    ends = "chr(10) || chr(11) || chr(12) || chr(13)"
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""WITH pieces AS (
      SELECT coalesce(lang, 'und') AS lang, unnest(string_split(
        translate(coalesce(text, ''), '{upper},;:!?' || {ends}, '{upper.lower()}.........'), '.')) AS piece FROM {table}),
    listed AS (SELECT lang, regexp_extract_all(piece, '[^ \\t]+') AS w FROM pieces),
    g1 AS (SELECT lang, w1, count(*) AS f FROM (SELECT lang, unnest(w) AS w1 FROM listed) GROUP BY ALL),
    g2 AS (SELECT lang, w1, w2, count(*) AS f FROM (SELECT lang, unnest(w) AS w1, unnest(w[2:]) AS w2 FROM listed)
      WHERE w2 IS NOT NULL GROUP BY ALL),
    g3 AS (SELECT lang, w1, w2, w3, count(*) AS f FROM (SELECT lang, unnest(w) AS w1, unnest(w[2:]) AS w2, unnest(w[3:]) AS w3 FROM listed)
      WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= {min_count}),
    total AS (SELECT lang, sum(f)::BIGINT AS n FROM g1 GROUP BY lang),
    longer AS (SELECT lang, w1, w2, max(f) AS f FROM (
        SELECT lang, w1, w2, f FROM g3 UNION ALL SELECT lang, w2, w3, f FROM g3) GROUP BY ALL),
    cuts AS (
      SELECT p.lang, p.w1 || ' ' || p.w2 AS phrase, p.f AS a, 1 AS k, x.f AS l, y.f AS r
      FROM g2 p JOIN g1 x ON x.lang = p.lang AND x.w1 = p.w1 JOIN g1 y ON y.lang = p.lang AND y.w1 = p.w2
      LEFT JOIN longer o ON o.lang = p.lang AND o.w1 = p.w1 AND o.w2 = p.w2
      WHERE p.f >= {min_count} AND (o.f IS NULL OR 100 * o.f < {inside_percent} * p.f)
      UNION ALL
      SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.f, 1, x.f, y.f
      FROM g3 t JOIN g1 x ON x.lang = t.lang AND x.w1 = t.w1 JOIN g2 y ON y.lang = t.lang AND y.w1 = t.w2 AND y.w2 = t.w3
      UNION ALL
      SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.f, 2, x.f, y.f
      FROM g3 t JOIN g2 x ON x.lang = t.lang AND x.w1 = t.w1 AND x.w2 = t.w2 JOIN g1 y ON y.lang = t.lang AND y.w1 = t.w3),
    scored AS (SELECT *, ({scale}::HUGEINT * a::HUGEINT * a::HUGEINT) // (l::HUGEINT * r::HUGEINT) AS score FROM cuts),
    best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
    SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN total USING (lang) WHERE rank <= {top}"""
