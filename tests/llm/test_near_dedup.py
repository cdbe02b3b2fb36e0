"""ProbMinHash near-dedup and int8 embedding near-dedup against brute force."""

import collections

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import types as T

from riskforge.llm import embeddings, probminhash
from riskforge.llm.common import connected_components, shingle_counts, word_hashes, string_buffers


def words(rng, n, vocab=4000):
    return [f"w{i}" for i in rng.integers(0, vocab, n)]


def corpus(seed=5):
    """Clean texts, a group of near copies that are not all alike, exact copies, edge cases."""
    rng = np.random.default_rng(seed)
    texts = [" ".join(words(rng, 120)) for _ in range(25)]
    base = words(rng, 150)
    for _ in range(60):                                  # 4 substitutions each: alike to the base, less to one another
        w = list(base)
        for i in rng.choice(len(w), 4, replace=False):
            w[i] = f"x{rng.integers(1e9)}"
        texts.append(" ".join(w))
    texts += [" ".join(base)] + [texts[0]] * 5 + ["same short"] * 2 + ["", None, "   ", "one", "one two three four five", "repeat it " * 400]
    return texts


def classes(texts, threshold=0.8):
    t = [x or "" for x in texts]
    doc, item, count = shingle_counts(pa.array(t))
    at = np.searchsorted(doc, np.arange(len(t) + 1))
    up = list(range(len(t)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for i in range(len(t)):
        for j in range(i):
            a, b = slice(at[i], at[i + 1]), slice(at[j], at[j + 1])
            if t[i] == t[j] or probminhash.probability_jaccard(item[a], count[a], item[b], count[b]) >= threshold:
                x, y = root(i), root(j)
                up[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(t))]


def test_classes_equal_brute_force(make_docs, clash):
    texts = corpus()
    got = {r["id"]: r for r in probminhash.near_duplicates(clash(make_docs(texts))).collect()}
    want = classes(texts)
    assert [got[i]["class_id"] for i in range(len(texts))] == want
    assert {i for i, r in got.items() if r["kept"]} == set(want)


def test_keep_one_keeps_columns_and_one_row_each(make_docs, clash):
    texts = ["a b c d e f g"] * 3 + ["other text of six words here", None, ""]
    ids = [7, 7, 3, 4, None, 5]
    docs = clash(make_docs(texts, ids))
    kept = probminhash.keep_one(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert sorted((r["doc_id"] for r in rows), key=str) == [3, 4, 5]


def test_repeated_row_stays_once(make_docs):
    assert probminhash.keep_one(make_docs(["a b c d e f"] * 4, [1, 1, 1, 2])).count() == 1


def test_empty_table(make_docs):
    assert probminhash.near_duplicates(make_docs([])).count() == 0
    assert probminhash.keep_one(make_docs([])).count() == 0


def test_probability_jaccard_and_its_estimate():
    rng = np.random.default_rng(0)

    def plain(x, y):
        return sum(1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in {*x, *y}) for i in x if i in y)
    for _ in range(30):
        x = {int(i): int(c) for i, c in zip(rng.choice(60, 40, replace=False), rng.integers(1, 5, 40))}
        y = {int(i): int(c) for i, c in zip(rng.choice(60, 40, replace=False), rng.integers(1, 5, 40))}
        arrays = [np.array(sorted(d)) for d in (x, y)], [np.array([d[k] for k in sorted(d)]) for d in (x, y)]
        j = probminhash.probability_jaccard(arrays[0][0], arrays[1][0], arrays[0][1], arrays[1][1])
        assert j == pytest.approx(plain(x, y))
        doc = np.repeat([0, 1], 40)
        sig = probminhash.signatures(doc, np.concatenate(arrays[0]).astype(np.uint64), np.concatenate(arrays[1]), 2, 4096)
        assert (sig[0] == sig[1]).mean() == pytest.approx(j, abs=0.04)


def test_words_split_anywhere_alike(monkeypatch):
    from riskforge.llm import common
    text = pa.array(["a bb  ccc\n\tdd " * 50, "", None, "é漢 x", "long" * 200])
    whole = word_hashes(*string_buffers(text))
    monkeypatch.setattr(common, "CHUNK", 16)
    cut = common.word_hashes(*string_buffers(text))
    assert (whole[0] == cut[0]).all() and (whole[1] == cut[1]).all()
    assert collections.Counter(whole[0].tolist()) == {0: 200, 3: 2, 4: 1}


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(5, 5), (200, 201), (201, 200)]
    got = dict(connected_components(spark.createDataFrame(edges, "a long, b long"), "t").collect())
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 200: 200, 201: 200}
    assert connected_components(spark.createDataFrame([], "a long, b long"), "t").count() == 0


def vectors(spark, rows):
    return spark.createDataFrame(rows, T.StructType([T.StructField("vec_id", T.LongType()),
                                                     T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType())]))


@pytest.mark.parametrize("block", [8192, 40])
def test_embeddings_equal_brute_force(spark, clash, block):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(120, 16))
    x[30:90] = x[0] + rng.normal(size=(60, 16)) * rng.uniform(0.05, 0.4, (60, 1))   # on both sides of the threshold
    x[100:110] = x[99]
    x = x.astype(np.float32).astype(float)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    link = u @ u.T >= 0.95
    np.fill_diagonal(link, False)
    low = np.arange(len(x))
    for _ in range(len(x)):
        low = np.array([min([low[i], *low[link[i]]]) for i in range(len(x))])
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    odd = [(500, None, 0), (501, [0.0] * 16, 0), (502, [1.0, None] * 8, 0), (503, [float("nan")] * 16, 0), (504, [float("inf")] * 16, 0),
           (505, [], 0), (506, [1.0, 2.0], 0), (507, [2.0, 4.0], 0)]
    got = {r["id"]: r for r in embeddings.near_duplicates(clash(vectors(spark, rows + odd)), block=block).collect()}
    assert [got[i]["n_links"] for i in range(len(x))] == link.sum(axis=1).tolist()
    assert [got[i]["component_id"] for i in range(len(x))] == low.tolist()
    assert all(got[i]["n_links"] == 0 and got[i]["component_id"] == i and got[i]["kept"] for i in range(500, 506))
    assert got[507]["component_id"] == 506 and got[507]["n_links"] == 1
    assert embeddings.near_duplicates(vectors(spark, [])).count() == 0


def test_quantisation_bound_holds():
    rng = np.random.default_rng(3)
    a, b = (embeddings.unit(rng.normal(size=(200, 24))) for _ in range(2))
    (qa, sa, ea), (qb, sb, eb) = embeddings.quantise(a), embeddings.quantise(b)
    gap = np.abs(a @ b.T - sa * sb * embeddings._product(qa, qb))
    assert (gap <= ea[:, None] + eb[None, :] + ea[:, None] * eb[None, :]).all()
