"""Token counts with a cache, Walsh-Hadamard clustering, collocations."""

import collections
import hashlib
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from riskforge.llm import collocations, tokencount, tokens, walsh
from riskforge.llm.queries import TOKENIZER_DIR
from tests.llm.test_text_ops import duck, same_rows


# ------------------------------------------------------------------ token counts

ODD = [None, "", " ", "a  b", "x <|endoftext|> y", "Grüße 你好　!", "word " * 60_000, "same", "same", "tab\tnew\n line"]


def library_counts(name, texts):
    path = f"{TOKENIZER_DIR}/{name}"
    if name.endswith(".model"):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        return [len(sp.encode(t or "")) for t in texts]
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)
    return [len(tok.encode(t or "", add_special_tokens=False).ids) for t in texts]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_token_counts(spark, make_docs, clash, tmp_path, name):
    docs = clash(make_docs(ODD)).withColumn("digest", F.lit(1)).withColumn("tag", F.lit(1))
    path, cache = f"{TOKENIZER_DIR}/{name}", str(tmp_path / "cache")
    got, missed = tokencount.count_tokens(docs, path, cache)
    want = [(i, len((t or "").encode()), n, n > 512) for i, (t, n) in enumerate(zip(ODD, library_counts(name, ODD)))]
    assert sorted(map(tuple, got.collect())) == want
    assert missed == len({t or "" for t in ODD})


def test_token_cache_is_kept(spark, make_docs, tmp_path, monkeypatch):
    path, cache = f"{TOKENIZER_DIR}/byte_bpe_50k.json", str(tmp_path / "cache")
    first, missed = tokencount.count_tokens(make_docs(["one two", "three", "three"]), path, cache)
    assert (first.count(), missed) == (3, 2)
    again, missed = tokencount.count_tokens(make_docs(["three", "one two"]), path, cache)
    assert (again.count(), missed) == (2, 0)
    monkeypatch.setattr(tokencount, "BROADCAST_MISSES", 0)       # rows found by a join
    more, missed = tokencount.count_tokens(make_docs(["three", "four five", "four five"], ids=[7, 7, 7]), path, cache)
    assert missed == 1 and sorted(r["n_tokens"] for r in more.collect()) == sorted(library_counts("byte_bpe_50k.json", ["three", "four five", "four five"]))
    # an append that ran twice, another tokenizer and nulls
    spark.read.parquet(f"{cache}/tokenizer={tokencount.tokenizer_digest(path)}").coalesce(1).write.mode("append").parquet(
        f"{cache}/tokenizer={tokencount.tokenizer_digest(path)}")
    assert tokencount.count_tokens(make_docs(["three", None], ids=[None, None]), path, cache)[0].count() == 2
    assert tokencount.count_tokens(make_docs(["three"]), f"{TOKENIZER_DIR}/word_bpe_49k.json", cache)[1] == 1
    # content that is normalised first shares a count; the length stays the text's own
    got, missed = tokencount.count_tokens(make_docs([" three", "three  "]), path, cache, normalise=F.trim)
    assert missed == 0 and sorted(r["n_bytes"] for r in got.collect()) == [6, 7]
    empty, missed = tokencount.count_tokens(make_docs(["x"]).limit(0), path, cache)
    assert (empty.count(), missed) == (0, 0)


def test_word_memory_forgets_and_agrees(monkeypatch):
    from tokenizers import Tokenizer
    monkeypatch.setattr(tokens, "WORDS_KEPT", 40)
    path = f"{TOKENIZER_DIR}/byte_bpe_50k.json"
    enc, tok, rnd = tokens.WordEncoder(path), Tokenizer.from_file(path), random.Random(3)
    for _ in range(12):
        texts = [" ".join(rnd.choice("abcdéf\n") * rnd.randint(0, 9) + str(rnd.randint(0, 50)) for _ in range(30)) for _ in range(5)]
        ids, per = enc.encode(pa.array(texts))
        assert [p.tolist() for p in np.split(ids, np.cumsum(per)[:-1])] == [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]
    assert len(enc.further.words) < 400       # 145 new words a call, half forgotten


# ------------------------------------------------------------------ clustering

def plain_nearest(vectors, cents):
    out = []
    for v in vectors:
        d = [sum((int(a) - int(b)) ** 2 for a, b in zip(v, c)) for c in cents]
        out.append((d.index(min(d)), min(d)))
    return out


@pytest.mark.parametrize("top", [3, 200, 1 << 18, 1 << 24, 1 << 40, (1 << 62) - 1])
def test_progressive_search_is_exact(top):
    rnd = np.random.default_rng(top % 1000)
    vectors = rnd.integers(-top, top + 1, (60, 64))
    cents = np.concatenate([rnd.integers(-top, top + 1, (9, 64)), vectors[:3], vectors[:3]])     # ties: equal centroids
    own, far = walsh.nearest(vectors, cents)
    assert list(zip(own.tolist(), far)) == plain_nearest(vectors, cents)


def test_walsh_matrix():
    m = walsh.walsh(64)
    assert np.array_equal(m @ m.T, 64 * np.eye(64, dtype=np.int64))
    assert (np.diff(m, axis=1) != 0).sum(axis=1).tolist() == list(range(64))
    with pytest.raises(ValueError):
        walsh.walsh(48)


def plain_cluster(rows, k, rounds):
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in e]) for i, e in rows
            if e is not None and len(e) == 64 and all(x is not None and math.isfinite(x) for x in e)]
    start = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))[:k]
    cents = [v for _, v in start]
    for _ in range(rounds):
        own = plain_nearest([v for _, v in kept], cents)
        for c in range(len(cents)):
            mine = [v for (_, v), (o, _) in zip(kept, own) if o == c]
            if mine:
                cents[c] = [sum(col) // len(mine) for col in zip(*mine)]
    own = plain_nearest([v for _, v in kept], cents)
    whole = sum(d for _, d in own)
    return sorted(((-1 if i is None else i), c, d, sum(x for o, x in own if o == c), whole,
                   hashlib.sha256(",".join(map(str, cents[c])).encode()).hexdigest()) for (i, _), (c, d) in zip(kept, own))


def vectors_table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def test_cluster_equals_plain_version(spark, clash):
    rnd = random.Random(5)
    rows = [(i, [rnd.gauss(i % 5, 1) for _ in range(64)]) for i in range(80)]
    rows += [(200, None), (201, [1.0] * 63), (202, [None] + [1.0] * 63), (203, [float("nan")] * 64), (204, [float("inf")] * 64)]
    rows += [(7, rows[7][1]), (7, rows[8][1]), (None, rows[3][1])]
    got = walsh.cluster(clash(vectors_table(spark, rows)).withColumn("v", F.lit(1)), k=6, rounds=3)
    assert sorted(((-1 if r[0] is None else r[0]), *r[1:]) for r in got.collect()) == plain_cluster(rows, 6, 3)
    same_rows(walsh.cluster(vectors_table(spark, rows[:80]), k=6, rounds=3).withColumnRenamed("id", "vec_id"),
              duck(walsh.oracle(k=6, rounds=3), embeddings=vectors_table(spark, rows[:80])))


def test_cluster_edges(spark):
    assert walsh.cluster(vectors_table(spark, [(1, [0.0] * 64)]).limit(0)).count() == 0
    few = walsh.cluster(vectors_table(spark, [(1, [0.5] * 64), (2, [-0.5] * 64)])).collect()
    assert sorted((r["id"], r["distance"], r["inertia"]) for r in few) == [(1, 0, 0), (2, 0, 0)] and len({r["cluster"] for r in few}) == 2
    # beyond 64 bits: null figures, same clusters; beyond +-2**62: left out
    huge = walsh.cluster(vectors_table(spark, [(1, [1e15] * 64), (2, [-1e15] * 64), (3, [1e30] * 64)]), k=1, rounds=1).collect()
    assert sorted((r["id"], r["cluster"], r["distance"], r["inertia"]) for r in huge) == [(1, 0, None, None), (2, 0, None, None)]


# ------------------------------------------------------------------ collocations

def prose(n, seed):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(12)] + ["É", "Zeit", "a.b", "x y", "New York", " "]
    return [" ".join(rnd.choice(vocab) + rnd.choice(["", "", "", ",", ".", "\t", "\n", "!"]) for _ in range(rnd.randint(0, 60))) for _ in range(n)]


def phrases_equal_sql(spark, docs, **args):
    same_rows(collocations.collocations(docs, **args), duck(collocations.oracle(**args), documents=docs))


def test_collocations_equal_sql(spark, make_docs, clash):
    texts = prose(150, 1) + [None, "", "...", "one", "New York " * 3000] + ["the same old line, again"] * 30
    langs = [[None, "und", "de", "en"][i % 4] for i in range(len(texts))]
    docs = clash(make_docs(texts, langs=langs))
    phrases_equal_sql(spark, docs.select("doc_id", "text", "lang"))
    phrases_equal_sql(spark, docs.select("doc_id", "text", "lang"), top=7, min_count=3, inside_percent=90)
    assert collocations.collocations(docs).count() == collocations.collocations(docs.select("text", "lang")).count() > 0
    assert collocations.collocations(docs.limit(0)).count() == 0


def test_collocations_with_hot_pairs_over_many_tasks(spark, make_docs, monkeypatch):
    monkeypatch.setattr(collocations, "SLICE_BYTES", 300)
    monkeypatch.setattr(collocations, "TASK_BYTES", 200)
    rnd = random.Random(2)
    texts = [" ".join(f"hot pair v{rnd.randint(0, 40)}" for _ in range(25)) for _ in range(60)] + prose(60, 4)
    phrases_equal_sql(spark, make_docs(texts, langs=["en"] * 60 + ["de"] * 60))


def test_window_counts_without_packed_keys():
    rnd = np.random.default_rng(0)
    cols = [rnd.integers(0, 3, 500) for _ in range(4)]
    packed = collocations._count([c.copy() for c in cols], [3, 3, 3, 3])
    plain = collocations._count(cols, [1 << 20] * 4)
    want = collections.Counter(zip(*map(list, cols)))
    for got, n in (packed, plain):
        assert dict(zip(zip(*(g.tolist() for g in got)), n.tolist())) == want
