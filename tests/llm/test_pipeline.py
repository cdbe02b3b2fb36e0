"""The pipeline against a plain single-process version of its stages."""

import collections
import random
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from tokenizers import Tokenizer

import corpus_pipeline
from riskforge.llm import mixing, probminhash
from riskforge.llm.common import shingle_counts
from riskforge.llm.queries import TOKENIZER_DIR
from . import plain_bayes

STOCK = {"en": "the and with that this from have which over under".split(), "de": "und der die nicht über für schön ich wenn dann".split()}


def corpus():
    rng = random.Random(11)
    item = " ".join(f"secret{i}" for i in range(24))
    texts, langs = [], []
    for i in range(120):
        lang = rng.choice(["en", "en", "de"])
        words = [rng.choice(STOCK[lang]) + rng.choice("abcdefgh") for _ in range(rng.randint(5, 90))]
        if i % 17 == 0:
            words[2:2] = item.split()
        texts.append(" ".join(words))
        langs.append(lang)
    for i in (3, 10, 11, 40):                       # exact and near copies
        texts += [texts[i]] * 2 + [texts[i] + " extra"]
        langs += [langs[i]] * 3
    texts += ["123 456", "", None, "!!", "the one"]
    langs += ["en", None, "de", "en", "en"]
    sources = [rng.choice(["s0", "s0", "s0", "s1", "s2", None]) for _ in texts]
    return [(i, t, x, s, len(t or "")) for i, (t, x, s) in enumerate(zip(texts, langs, sources))], [(1, item), (2, "short item text of benchmark kind")]


def plain(docs, bench):
    """doc ids with repetitions after each of the first four stages."""
    training = [d for d in docs if d[1] is not None and d[2] is not None and zlib.crc32(str(d[0]).encode()) % 4 != 2]
    model = plain_bayes.train((d[1], d[2]) for d in training)
    lang, p = zip(*(plain_bayes.predict(model, d[1]) for d in docs))
    one = [d for d, x, s in zip(docs, lang, p) if x != "und" and s >= 0.5]

    doc, item, count = shingle_counts(pa.array([d[1] for d in one]))
    at = np.searchsorted(doc, np.arange(len(one) + 1))
    low = list(range(len(one)))
    for i in range(len(one)):
        for j in range(i):
            a, b = slice(at[i], at[i + 1]), slice(at[j], at[j + 1])
            if one[i][1] == one[j][1] or probminhash.probability_jaccard(item[a], count[a], item[b], count[b]) >= 0.8:
                x, y = low[i], low[j]
                low = [min(x, y) if v in (x, y) else v for v in low]
    two = [d for i, d in enumerate(one) if low[i] == i]

    bad = {d[0] for d in two for _, t in bench if t in d[1]}
    three = [d for d in two if d[0] not in bad]

    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": [d[0] for d in three], "text": [d[1] for d in three], "source": pa.array([d[3] for d in three], pa.string())}))
    taken = {i: t // s for i, s, t in con.sql(f"select doc_id, size, taken from ({mixing.ORACLE})").fetchall()}
    return [one, two, three, [d for d in three for _ in range(taken[d[0]])]]


def test_pipeline_equals_plain_version(spark, tmp_path):
    docs, bench = corpus()
    pq.write_table(pa.table({n: pa.array([d[i] for d in docs], t) for i, (n, t) in enumerate(
        [("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64())])}),
        tmp_path / "documents.parquet")
    pq.write_table(pa.table({"item_id": [b[0] for b in bench], "text": [b[1] for b in bench]}), tmp_path / "benchmark.parquet")
    want = plain(docs, bench)
    assert [len(w) for w in want] == sorted([len(w) for w in want[:3]], reverse=True) + [len(want[3])] and len(want[2]) < len(want[1]) < len(want[0]) < len(docs)
    frame = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for (name, stage), rows in zip(corpus_pipeline.STAGES[:4], want):
        out = stage(spark, frame, str(tmp_path))
        assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        out.write.parquet(str(tmp_path / name))
        frame = spark.read.parquet(str(tmp_path / name))
        assert sorted(map(tuple, frame.collect()), key=str) == sorted(rows, key=str), name
    tok = Tokenizer.from_file(f"{TOKENIZER_DIR}/byte_bpe_50k.json")
    got = corpus_pipeline.STAGES[4][1](spark, frame, str(tmp_path)).collect()
    ids = {d[0]: [*tok.encode(d[1], add_special_tokens=False).ids, 0] for d in want[3]}
    assert collections.Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == collections.Counter(
        (d[0], len(ids[d[0]]), zlib.crc32(np.array(ids[d[0]], "<u4").tobytes())) for d in want[3])
    start = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == start
        start += r["n_tokens"]
    assert [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])] == sorted(r["doc_id"] for r in got)


def test_pipeline_of_an_empty_table(spark, tmp_path):
    pq.write_table(pa.table({"doc_id": pa.array([], pa.int64()), "text": pa.array([], pa.string()), "lang": pa.array([], pa.string()),
                             "source": pa.array([], pa.string()), "n_chars": pa.array([], pa.int64())}), tmp_path / "documents.parquet")
    pq.write_table(pa.table({"item_id": pa.array([], pa.int64()), "text": pa.array([], pa.string())}), tmp_path / "benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
