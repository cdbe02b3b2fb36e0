"""Personal data, language ID, mixing, decontamination, suffix arrays, token files, pages, audit."""

import collections
import hashlib
import itertools
import os
import random
import re
import tracemalloc
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from riskforge.llm import decontaminate, html, langid, mixing, pii, suffix, tokens, warc
from riskforge.llm.queries import TOKENIZER_DIR
from . import plain_bayes

BPE = f"{TOKENIZER_DIR}/byte_bpe_50k.json"


def duck(sql, **tables):
    con = duckdb.connect()
    for name, df in tables.items():
        con.register(name, df.toArrow())
    return con.sql(sql).df()


def same_rows(spark_df, frame):
    got = collections.Counter(tuple(r[c] for c in sorted(spark_df.columns)) for r in spark_df.collect())
    clean = frame.astype(object).where(frame.notna(), None)
    want = collections.Counter(tuple(r) for r in clean[sorted(frame.columns)].itertuples(index=False))
    assert got == want


# ------------------------------------------------------------------ personal data

def naive_spans(t):
    out = [(0, m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(1, m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
            if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        if 16 <= len(d) <= 19 and sum(sum(map(int, str(int(c) * (1 + i % 2)))) for i, c in enumerate(d[::-1])) % 10 == 0:
            out.append((2, m.start(), m.end()))
    return out + [(3, m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t)
                  if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]


def test_base_spans_equal_plain_patterns():
    rng, letters = random.Random(1), "ab0123456789....@@--+ ()_é"
    for _ in range(20000):
        t = "".join(rng.choice(letters) for _ in range(rng.randint(0, 60)))
        assert pii.base_spans(t) == naive_spans(t)
    for t in ("4111 1111-1111 1111", "x 001.2.3.255 256.1.1.1", "@a.b", "a@b@c.de", "0" * 20000 + "a@b.c" + "a" * 20000):
        assert pii.base_spans(t) == naive_spans(t)


def test_contexts_find_unseen_identifiers(make_docs, clash):
    seen = [f"hello there dial my number +1 (415) 555-{1000 + i} please now" for i in range(6)]
    texts = seen + ["well then dial my number 415-555-7777 please now", "count of pages 415-555-8888 was odd", None, "", "plain words only",
                    "tel +1 (415) 555-1234 4111111111111111 glued"]
    rows = {r["id"]: r for r in pii.find(clash(make_docs(texts))).collect()}
    assert [rows[i]["n_phone"] for i in range(6)] == [1] * 6
    at = texts[6].index("415")
    assert rows[6]["n_added"] == 1 and rows[6]["spans"] == f"phone:{at}:{at + 12}"
    assert rows[6]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert all(rows[i]["n_added"] == 0 and rows[i]["spans"] == "" for i in range(7, 11))
    assert rows[11]["n_phone"] == 0 and rows[11]["spans"] == "phone:4:21"      # its shape is that of trusted numbers
    assert pii.find(make_docs([])).count() == 0


def test_trusted_contexts_find_other_forms(make_docs):
    phones = ["4155557777", "030 1234567", "06 12 34 56 78", "020 7946 0958", "415/555-7777"]
    cards = ["378282246310005", "4111/1111/1111/1111"]
    texts = [f"hello there dial my number +1 (415) 555-{1000 + i} please now" for i in range(12)]
    texts += [f"then the server at address 10.0.0.{i} went down" for i in range(6)]
    texts += [f"she paid with her card {c} for it" for c in ("4111111111111111", "5500005555555559", "4012888888881881", "6011111111111117")]
    texts += [f"please write to our mailbox x{i}@mail.example.com soon enough" for i in range(4)]
    first = len(texts)
    forms = [("dial my number", p, 3) for p in phones] + [("server at address", "2001:db8::1", 1), ("server at address", "10[.]1[.]2[.]3", 1)]
    forms += [("with her card", c, 2) for c in cards] + [("to our mailbox", "jörg@müller.de", 0)]
    texts += [f"well {c} {v} and so on" for c, v, _ in forms]
    texts += [f"the pages counted {v} in all" for _, v, _ in forms[:3]] + ["order 20240115 7 9 of my list", "dial my number 030 7654321 12 then"]
    rows = {r["id"]: r for r in pii.find(make_docs(texts)).collect()}
    for i, (c, v, kind) in enumerate(forms, first):
        assert rows[i]["spans"] == f"{pii.KINDS[kind]}:{len(c) + 6}:{len(c) + 6 + len(v)}" and rows[i]["n_added"] == 1, (v, rows[i])
    assert rows[first + len(forms) + 3]["spans"] == ""                       # neither its context nor its shape is trusted
    assert rows[first + len(forms) + 4]["spans"].startswith("phone:15:")
    for i, (_, v, kind) in enumerate(forms[:3], first + len(forms)):         # a trusted value is found in any context
        assert rows[i]["spans"] == f"phone:18:{18 + len(v)}"


def test_chain_of_contexts_is_followed_to_its_end(make_docs):
    rng, contexts = random.Random(3), ["ax bx", "cx dx", "ex fx", "gx hx", "ix jx"]
    word = lambda: "".join(rng.choice("klmnopqrstuv") for _ in range(9))
    groups, texts, n = [[f"+1 (415) 555-{1000 + i}" for i in range(48)]], [], 0
    for size in (30, 18, 11, 6, 3):
        groups.append([f"415-{555 + len(groups)}-{2000 + i}" for i in range(size)])
    for i, c in enumerate(contexts):       # each context: values of the group before it, then those of its own
        texts += [f"{word()} {c} {v} {word()} {word()}" for v in groups[i] + groups[i + 1]]
    last = len(texts) - 1
    texts += [f"{word()} {word()} {word()} 212-333-{1000 + i} {word()} {word()}" for i in range(150)]
    rows = {r["id"]: r["n_added"] for r in pii.find(make_docs(texts)).collect()}
    assert all(rows[i] == 1 for i in range(last - 2, last + 1)) and not any(rows[i] for i in range(last + 1, len(texts)))


def test_generic_candidates():
    def found(t):
        base = pii.base_spans(t)
        return {(pii.KINDS[k], t[a:z]) for k, a, z, _, _ in pii.generic(t, base + pii.candidates(t, base))}
    assert found("call 030 1234567 2 x") == {("phone", "030 1234567 2"), ("phone", "030 1234567"), ("phone", "1234567 2")}
    assert found("x123456 123456x 1234567_ 12 34") == set() and found("line:2001:db8::1, at 12:30:45") == {("ip", "2001:db8::1")}
    assert found("mailto:ü@é.de") == {("email", "ü@é.de")} and found("@you a@ 1.2.3.4") == set()
    for t in ("1 " * 40000 + "x", "1" * 90000 + "x", "1-" * 40000, "a:" * 40000, "@" * 40000, "(" * 40000, "1.1." * 20000):
        assert len(pii.generic(t, [])) < 100


# ------------------------------------------------------------------ language

def test_language_of_held_out_rows(make_docs, clash):
    rng = random.Random(4)
    stock = {"en": "the and with that this from have which".split(), "de": "und der die nicht über für schön ich".split(),
             "fr": "les des être où garçon pour dans même".split()}
    langs = [rng.choice([*stock]) for _ in range(90)]
    texts = [" ".join(rng.choice(stock[x]) for _ in range(30)) for x in langs]
    docs = make_docs(texts + [None, "12 34 !!", "the with that"], langs=langs + ["en", "fr", None]).withColumn("held_out", langid.held_out())
    model = langid.train(docs.filter("not held_out"))
    assert model.langs == ["de", "en", "fr"]
    rows = {r["doc_id"]: r for r in langid.identify(clash(docs.drop("source")), model, names=("lang_pred", "p")).collect()}
    assert all(rows[i]["lang_pred"] == langs[i] and 0.5 < rows[i]["p"] <= 1 for i in range(90))
    assert rows[90]["lang_pred"] == rows[91]["lang_pred"] == "und" and rows[90]["p"] == 0 and rows[92]["lang_pred"] == "en"
    kept = langid.accept(clash(docs), model)
    assert kept.columns == clash(docs).columns and {r["doc_id"] for r in kept.collect()} == set(range(93)) - {90, 91}
    assert sum(r["held_out"] for r in rows.values()) == sum(zlib.crc32(str(i).encode()) % 4 == 2 for i in range(93))
    empty = langid.train(make_docs([]))
    assert langid.identify(make_docs(["abc"]).drop("lang"), empty).first()["lang_pred"] == "und"


@pytest.mark.parametrize("block", [256, 2])
def test_languages_equal_plain_naive_bayes(make_docs, monkeypatch, block):
    monkeypatch.setattr(langid, "MAX_LANGS", block)
    monkeypatch.setattr(langid, "CHARS", 1 << 10)        # texts beyond one chunk
    rng = random.Random(9)
    stock = {x: ["".join(rng.choice("abcdefghijklmnoß é") for _ in range(rng.randint(1, 7))) for _ in range(12)] for x in ("a", "b", "c", "d", "e")}
    langs = [rng.choice([*stock]) for _ in range(60)]
    texts = [" ".join(rng.choice(stock[x] + stock["a"]) for _ in range(rng.randint(1, 25))) for x in langs]
    texts += ["", None, "1 2", "Ab İ c", texts[0], texts[0], " ".join(rng.choice(stock["c"]) for _ in range(3000)), "zz"]
    langs += ["a", "b", "c", None, "a", "a", "b", "e"]
    docs = make_docs(texts, langs=langs)
    model = langid.train(docs)
    assert model.langs == [*"abcde"] and len(model.blocks) == -(-5 // block)
    plain = plain_bayes.train(zip(texts, langs))
    for r in langid.identify(docs, model).collect():
        lang, p = plain_bayes.predict(plain, r["text"])
        assert r["lang_pred"] == lang and abs(r["score"] - p) < 1e-3 and r["score"] <= 1


def test_ngrams_do_not_depend_on_neighbours():
    texts = ["Über den", None, "x", "", "ab c\0d" * 50]
    together = collections.Counter((int(d), int(f)) for ds, fs in langid.features(texts) for d, f in zip(ds, fs))
    alone = collections.Counter((i, int(f)) for i, t in enumerate(texts) for _, fs in langid.features([t]) for f in fs)
    assert together == alone


# ------------------------------------------------------------------ mixing

def test_mix_equals_sql(make_docs, clash):
    rng = random.Random(9)
    texts = [None if rng.random() < .05 else "w " * rng.randint(0, 60) for _ in range(400)]
    sources = [rng.choice(["a", "a", "a", "a", "a", "b", "c", "ä", None]) for _ in range(400)]
    docs = make_docs(texts + ["x y"] * 3, [*range(400), 1000, 1000, None], sources=sources + ["z", "z", "z"])
    names = {c: c for c in ("size", "source_size", "target", "taken")}
    got = mixing.mix(docs.select("doc_id", "text", "source"), names=names).drop("text", "source")
    same_rows(got, duck(mixing.ORACLE, documents=docs))
    rows = mixing.mix(clash(docs).drop("size", "times"), names={"source_size": "source_size", "target": "target", "taken": "taken"}).collect()
    per = collections.defaultdict(int)
    for r in rows:
        per[r["source"]] += r["taken"]
        assert r["taken"] <= 3 * len((r["text"] or "").split())
    for r in rows:
        assert abs(per[r["source"]] - r["target"]) <= 60 and r["target"] <= 3 * r["source_size"]
    taken = collections.Counter(r["doc_id"] for r in mixing.take(clash(docs)).collect())
    assert mixing.take(clash(docs)).columns == clash(docs).columns
    want = {r["doc_id"]: r["taken"] // r["size"] for r in got.collect() if r["size"] and r["doc_id"] is not None and r["doc_id"] < 400}
    assert all(taken[i] == n for i, n in want.items())


def test_mix_passes_over_very_long_documents(make_docs):
    """Few documents a source, some very long: what a source lacks is less than any document it could still take."""
    rng = random.Random(3)
    sizes = [rng.choice([1, 2, 3, 5, 9, 20, 300, 4000, 60_000 if i % 97 == 0 else 40]) for i in range(600)]
    docs = make_docs(["w " * n for n in sizes], sources=[f"s{i % 20}" for i in range(600)])
    got = mixing.mix(docs.select("doc_id", "text", "source"), names={c: c for c in ("size", "source_size", "target", "taken")})
    same_rows(got.drop("text", "source"), duck(mixing.ORACLE, documents=docs))
    per = collections.defaultdict(list)
    for r in got.collect():
        per[r["source"]].append(r)
    for rows in per.values():
        lack = rows[0]["target"] - sum(r["taken"] for r in rows)
        times = min(r["taken"] // r["size"] for r in rows)
        assert 0 <= lack < min(r["size"] for r in rows if r["taken"] == times * r["size"])
        assert all(r["taken"] in (times * r["size"], (times + 1) * r["size"]) and r["taken"] <= 3 * r["size"] for r in rows)


def test_mix_of_nothing(make_docs):
    assert mixing.mix(make_docs([])).count() == 0
    r = mixing.mix(make_docs([None, ""])).collect()
    assert [(x["size"], x["target"], x["taken"]) for x in r] == [(0, 0.0, 0)] * 2


# ------------------------------------------------------------------ decontamination

def test_overlaps_equal_sql_and_survive_substitutions(spark, make_docs, clash):
    rng = random.Random(6)
    item = [f"t{i}" for i in range(30)]
    sub = list(item)
    for i in (5, 14, 23):
        sub[i] = "zz"
    far = [w if i % 3 else "qq" for i, w in enumerate(item)]
    noise = lambda n: [f"n{rng.randrange(9999)}" for _ in range(n)]
    texts = [" ".join(noise(40) + item + noise(10)), " ".join(noise(20) + sub), " ".join(far), " ".join(noise(80)), None, "",
             " ".join(item[:20]), "Five SHORT words, here: now!", " ".join(item).upper() + "."]
    bench = spark.createDataFrame([(1, " ".join(item)), (2, "five short words here now"), (3, "t1 t2"), (4, None), (5, " ".join(item))],
                                  "item_id long, text string")
    found = decontaminate.overlaps(clash(make_docs(texts)), bench)
    pairs = {(r["id"], r["item_id"]): (r["n_equal"], r["n_window"]) for r in found.collect()}
    assert {d for d, _ in pairs} == {0, 1, 6, 7, 8} and (7, 2) in pairs and (0, 5) in pairs and pairs[0, 1] == (16, 16)
    same_rows(found.select(F.col("id").alias("doc_id"), "item_id", "n_equal", "n_window"),
              duck(decontaminate.ORACLE, documents=make_docs(texts), benchmark=bench))
    left = decontaminate.clean(clash(make_docs(texts)), bench)
    assert {r["doc_id"] for r in left.collect()} == {2, 3, 4, 5} and left.columns == clash(make_docs(texts)).columns
    assert decontaminate.overlaps(make_docs([]), bench).count() == 0
    assert decontaminate.clean(make_docs(texts), bench.limit(0)).count() == len(texts)


def test_large_benchmark_joins_by_shuffle(spark, make_docs, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_SEEDS", 0)
    text = " ".join(f"t{i}" for i in range(20))
    bench = spark.createDataFrame([(1, text)], "item_id long, text string")
    assert [r["id"] for r in decontaminate.overlaps(make_docs(["x " + text, "y"]), bench).collect()] == [0]


def test_masks_hit_every_accepted_substitution():
    for n, masks in decontaminate.MASKS.items():
        wrong = max(k for k in range(n) if n - k >= n * decontaminate.AGREE)
        placed = [{p + i for i, c in enumerate(m) if c == "1"} for m in masks for p in range(n - len(m) + 1)]
        assert all(m[0] == m[-1] == "1" for m in masks)
        assert all(any(at.isdisjoint(gone) for at in placed) for gone in itertools.combinations(range(n), wrong))
    assert list(decontaminate.MASKS) == list(range(decontaminate.SHORTEST, decontaminate.WINDOW + 1))


def plain_overlaps(texts, items):
    found = {}
    for (d, t), (i, item) in itertools.product(enumerate(texts), items.items()):
        ids, n = t.split(), min(16, len(item))
        for diag in range(1 - len(item), len(ids)):
            same = [0 <= diag + j < len(ids) and ids[diag + j] == w for j, w in enumerate(item)]
            best = max(sum(same[s:s + n]) for s in range(len(item) - n + 1))
            if best >= n * 0.8:
                found[d, i] = max(found.get((d, i), (0, n)), (best, n))
    return found


def test_overlaps_equal_brute_force(spark, make_docs):
    rng = random.Random(12)
    items = {n: [f"i{n}x{j}" for j in range(n)] for n in range(5, 22)}
    texts = []
    for n, item in items.items():
        for _ in range(25):
            wrong = rng.randint(0, 4 if n > 12 else 3 if n > 9 else 2)
            text = list(item)
            for j in rng.sample(range(n), wrong):
                text[j] = "zz"
            cut = rng.choice([0, 0, 1, 2])                # the item may begin before the document
            texts.append(" ".join([] if cut else [f"n{rng.randrange(99)}" for _ in range(rng.randint(0, 3))]) + " " + " ".join(text[cut:n - rng.choice([0, 0, 1])]))
    texts += [" ".join(["zz", *items[11][1:]]), " ".join(items[20][2:18])]
    bench = spark.createDataFrame([(n, " ".join(item)) for n, item in items.items()], "item_id long, text string")
    got = {(r["id"], r["item_id"]): (r["n_equal"], r["n_window"]) for r in decontaminate.overlaps(make_docs(texts), bench).collect()}
    want = plain_overlaps(texts, items)
    assert got == want and (len(texts) - 2, 11) in got
    sql = duck(decontaminate.ORACLE, documents=make_docs(texts), benchmark=bench)
    same_rows(spark.createDataFrame([(d, i, *v) for (d, i), v in want.items()], "doc_id long, item_id long, n_equal int, n_window int"), sql)


def test_short_items_and_scripts_without_spaces(spark, make_docs):
    """Items of 1 to 4 tokens by whole texts, unspaced scripts by character, a very long text; SQL has no masks."""
    han = "天地玄黄宇宙洪荒日月盈昃辰宿列张寒来暑往秋收冬藏"
    changed = han[:6] + "某" + han[7:]
    texts = ["One two, THREE four!", "one two three four five", "solo", "solo solo", han, "前" + changed + "后文", han[::-1], "จาก",
             "x " * 60_000 + "a b c d e f" + " y" * 60_000, "...", None, "one two three four"]
    items = ["one two three four", "solo", han, "จาก", "a b c d e f", "!?", None, "", "solo"]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = decontaminate.overlaps(make_docs(texts), bench)
    assert {(r["id"], r["item_id"]) for r in found.collect()} == {(0, 0), (11, 0), (2, 1), (2, 8), (4, 2), (5, 2), (7, 3), (8, 4)}
    same_rows(found.select(F.col("id").alias("doc_id"), "item_id", "n_equal", "n_window"),
              duck(decontaminate.ORACLE, documents=make_docs(texts), benchmark=bench))
    only_short = decontaminate.overlaps(make_docs(texts), bench.where("item_id < 2"))
    assert {(r["id"], r["item_id"]) for r in only_short.collect()} == {(0, 0), (11, 0), (2, 1)}


# ------------------------------------------------------------------ suffix arrays

def plain_removal(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = collections.Counter(b[i:i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = True
        edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int), [0]])) == 1)
        out.append((len(b), int(gone.sum()), len(edge), hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~gone])).hexdigest()))
    return out


@pytest.mark.parametrize("shard_bytes", [1 << 20, 900])
def test_removal_equals_brute_force(make_docs, clash, shard_bytes):
    rng = random.Random(8)
    piece = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    shared = [piece(n) for n in (60, 90, 200)]
    texts = [piece(rng.randint(0, 150)) + rng.choice(shared)[rng.randint(0, 20):] + piece(rng.randint(0, 90)) for _ in range(60)]
    texts += [texts[0]] * 3 + [None, "", "a" * 300, "a" * 120, "ab" * 100, piece(39), piece(41), "x" * 40, "x" * 40]
    got = {r["id"]: tuple(r)[1:] for r in suffix.remove_repeats(clash(make_docs(texts)), length=40, anchor=12, shard_bytes=shard_bytes, split_bytes=shard_bytes).collect()}
    assert [got[i] for i in range(len(texts))] == plain_removal(texts, 40)
    assert suffix.remove_repeats(make_docs([])).count() == 0


def test_hot_anchors_and_windows_stay_where_they_lie(make_docs, monkeypatch):
    monkeypatch.setattr(suffix, "HOT_ROWS", 1)
    rng = random.Random(3)
    piece = lambda n: "".join(rng.choice("abcd ") for _ in range(n))
    passage = piece(70)
    texts = [piece(rng.randint(0, 50)) + passage + piece(rng.randint(0, 50)) for _ in range(80)] + [piece(130)] * 30 + ["a" * 90] * 3 + [None, ""]
    got = {r["id"]: tuple(r)[1:] for r in suffix.remove_repeats(make_docs(texts), length=40, anchor=12).collect()}
    assert [got[i] for i in range(len(texts))] == plain_removal(texts, 40)


@pytest.mark.parametrize("split", [0, 1])
def test_memory_of_a_shard(split):
    rng = np.random.default_rng(1)
    for copies in (False, True):
        rows = rng.integers(97, 123, size=(1000, 600), dtype=np.uint8)
        if copies:
            rows[:] = rows[0]
            rows[np.arange(1000), rng.integers(0, 600, 1000)] = 65
        tab = pa.table({"fp": np.zeros(1000, np.int64), "w": np.arange(1000), "n": np.full(1000, 201), "cnt": np.ones(1000, np.int64),
                        "bytes": pa.array([r.tobytes() for r in rows], pa.binary())})
        tracemalloc.start()
        suffix._shard(400)((None, None, pa.scalar(split)), tab)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak <= suffix.SORT_COST * rows.size


def test_windows_of_a_long_text_in_chunks(monkeypatch):
    monkeypatch.setattr(suffix, "CHUNK", 100)
    raw = np.frombuffer(random.Random(1).randbytes(1000), np.uint8)
    _, s, n = suffix.windows(raw, 40, 12)
    assert s.tolist() == (np.cumsum(n) - n).tolist() and n.sum() == 961


def test_suffix_array_and_common_prefixes():
    rng = np.random.default_rng(1)
    for _ in range(150):
        parts = [bytes(rng.integers(97, 99, rng.integers(1, 40)).astype(np.uint8)) for _ in range(rng.integers(1, 6))]
        offs = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        d, end = b"".join(parts), np.repeat(offs[1:], np.diff(offs))
        raw = np.frombuffer(d, np.uint8)
        sa, rank = suffix.suffix_array(raw, end)
        assert sa.tolist() == sorted(range(len(d)), key=lambda i: (d[i:end[i]], i)) and (rank[sa] == np.arange(len(d))).all()
        shared = suffix.common_prefixes(raw, end, sa, rank, offs[:-1], np.diff(offs))
        for r in range(1, len(d)):
            assert shared[sa[r]] == len(os.path.commonprefix([d[sa[r - 1]:end[sa[r - 1]]], d[sa[r]:end[sa[r]]]]))


# ------------------------------------------------------------------ token files

@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_token_files_round_trip(spark, make_docs, clash, tmp_path, encoding):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(BPE)
    texts = ["Hello  world\n\n x", None, "", "a<|endoftext|>b", "été 漢字 it's 'll", "word " * 3000, " lead", "tail ", "Hello  world\n\n x"]
    ids = [5, 3, None, 8, 1, 2, 7, 6, 5]
    path = str(tmp_path / "t")
    tokens.write_tokens(clash(make_docs(texts, ids)).drop("id", "tokens", "start", "n_tokens"), path, BPE, meta=("lang",), encoding=encoding, page_bytes=4096)
    want, start = [], 0
    for i, t in sorted(zip(ids, texts), key=lambda x: (x[0] is not None, x[0] or 0)):
        out = [*tok.encode(t or "", add_special_tokens=False).ids, 0]
        want.append((i, start, len(out), zlib.crc32(np.array(out, "<u4").tobytes())))
        start += len(out)
    assert sorted(map(tuple, tokens.checksums(spark, path).collect()), key=lambda r: r[1]) == want
    assert set(tokens.read_tokens(spark, path, "id", "lang").columns) == {"id", "lang", "start"}
    import glob

    import pyarrow.parquet as pq
    meta = [pq.ParquetFile(f).metadata.row_group(0) for f in glob.glob(f"{path}/*.parquet") if pq.ParquetFile(f).metadata.num_row_groups]
    cols = [g.column(c) for g in meta for c in range(g.num_columns) if "tokens" in g.column(c).path_in_schema]
    used = {e for c in cols for e in c.encodings}        # a chunk of few ids may do without its dictionary
    assert any("DICT" in e for e in used) if encoding == "dictionary" else "DELTA_BINARY_PACKED" in used and not any("DICT" in e for e in used)
    assert all(c.has_offset_index for c in cols)
    with pytest.raises(ValueError):
        tokens.write_tokens(make_docs(["a"]), path, BPE, meta=("id",))


def test_word_encoder_equals_library(monkeypatch):
    monkeypatch.setattr(tokens, "WORDS_KEPT", 500)
    enc, rng = tokens.WordEncoder(BPE), random.Random(2)
    letters = [*"aB1 '\n\t .é漢\x1c\r- "] + ["'s", "<|endoftext|>", "  ", "ab ", " a", " \n"]
    for _ in range(5):
        texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
        ids, per = enc.encode(pa.array(texts))
        at = np.concatenate([[0], np.cumsum(per)])
        assert all(enc.tok.encode(t, add_special_tokens=False).ids == ids[a:b].tolist() for t, a, b in zip(texts, at[:-1], at[1:]))


@pytest.mark.parametrize("share", [1, 64, 1 << 64])
def test_words_with_equal_keys_are_told_apart(monkeypatch, share):
    """Remembered words were all hashed again for every slice of texts; their keys are kept now, and may be shared."""
    whole = tokens._keys
    monkeypatch.setattr(tokens, "_keys", lambda words: whole(words) % np.uint64(share) if share < 1 << 64 else whole(words))
    monkeypatch.setattr(tokens, "WORDS_KEPT", 300)
    enc, rng = tokens.WordEncoder(BPE), random.Random(4)
    words = ["", "a" * 40 + "b" * 33, "a" * 40 + "c" + "b" * 32, *("".join(rng.choices("abcdé", k=rng.randint(1, 70))) for _ in range(500))]
    for _ in range(4):
        texts = [" ".join(rng.choices(words, k=60)) for _ in range(10)]
        ids, per = enc.encode(pa.array(texts))
        want = [e.ids for e in enc.tok.encode_batch(texts, add_special_tokens=False)]
        assert np.split(ids, np.cumsum(per)[:-1])[0].tolist() == want[0] and per.tolist() == list(map(len, want))
        assert ids.tolist() == [i for w in want for i in w]


def test_freed_word_columns_are_given_back(monkeypatch):
    """Arrow kept what the word columns of earlier slices had taken: up to 3,024 MB in an executor of 3,000."""
    pool, given = pa.default_memory_pool(), []

    class Pool:
        def release_unused(self):
            given.append(1)
            pool.release_unused()

    class Task:
        def partitionId(self):  # noqa: N802
            return 0

    monkeypatch.setattr("pyspark.TaskContext.get", lambda: Task())
    monkeypatch.setattr(tokens, "SLICE_BYTES", 20)
    monkeypatch.setattr(pa, "default_memory_pool", Pool)
    rows = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(["some words of a text"] * 6)], ["id", "text"])
    out = list(tokens._tokenise(f"{TOKENIZER_DIR}/byte_bpe_50k.json", 0, [])(iter([rows])))
    assert sum(b.num_rows for b in out) == 6 and len(given) == len(out) > 1


def test_empty_token_file(spark, make_docs, tmp_path):
    tokens.write_tokens(make_docs([]), str(tmp_path / "e"), BPE)
    assert tokens.checksums(spark, str(tmp_path / "e")).count() == 0


# ------------------------------------------------------------------ pages

PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style></head><body class="has-sidebar"><header class="site-header">
<a href="/">Logo</a> My Site</header><div id="cookie-banner"><p>We use cookies to improve. Accept all, it is a long notice that goes on.</p></div>
<script>var t = "</p><p>no";</script><form><main><div class="post-content"><h1>Title &amp; more</h1><p>By A. Writer<p>First <em>para</em>graph, with&nbsp;
some   text.<div class="advertisement"><p>Buy now! Great deals on everything you want to buy.</p></div><p>Short.</p><ul><li>one<li>two</ul>
<div class="share-buttons"><a href=#>Tweet</a></div><p>Last &#8212; 1 <3.<br>End.</p></div></main></form><aside><p>Some other article's teaser, which is long.</p></aside>
<section id="comments"><article class="comment"><p>I think this is a great article, thank you so much for it.</p></article></section>
<footer><p>© 2020 Us. All rights reserved.</p></footer></body></html>"""


def test_main_text(spark, clash):
    want = "Title & more By A. Writer First paragraph, with some text. Short. one two Last — 1 <3. End."
    rows = [(1, "u", PAGE), (2, None, None), (None, "v", ""), (4, "w", "<p>cut off <b at"), (1, "u", PAGE),
            (5, "x", "<nav><a href=/>a</a></nav>"), (6, "y", "<article>" + "<p>some text.<div class=ad>buy</div>" * 3000)]
    got = html.extract(clash(spark.createDataFrame(rows, "page_id long, url string, html string"))).collect()
    assert [(r["page_id"], r["url"]) for r in got] == [r[:2] for r in rows]
    assert [r["text"] for r in got] == [want, "", "", "cut off", want, "", " ".join(["some text."] * 3000)]
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert html.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_cut_is_minimal():
    rng = random.Random(3)
    for _ in range(200):
        n = rng.randint(1, 9)
        s = [rng.uniform(-2, 2) for _ in range(n)]
        e = [(i, j, rng.uniform(0, 2)) for i in range(n) for j in range(i) if rng.random() < .5]

        def cost(x):
            return sum(max(v, 0) if not k else max(-v, 0) for v, k in zip(s, x)) + sum(w for i, j, w in e if x[i] != x[j])
        best = min(cost([m >> i & 1 for i in range(n)]) for m in range(1 << n))
        assert cost(html.min_cut(s, e)) == pytest.approx(best)


# ------------------------------------------------------------------ audit

def test_audit_equals_sql(spark):
    rows = [(i, f"http://h/{i}", f"<p>{i}</p>" * (i % 7)) for i in range(1500)] + [(3, "http://h/3", "other"), (3, "http://h/3", "other"),
                                                                                  (None, None, None), (2000, "é", "ü")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = warc.audit(warc.replica(pages), warc.replica(warc.damaged(pages)))
    plain = spark.createDataFrame([r for r in rows if r[0] != 3], pages.schema)
    status = {r["page_id"]: r["status"] for r in warc.audit(warc.replica(plain), warc.replica(warc.damaged(plain))).collect()}
    want = duck(f"select coalesce(page_id, -1) page_id, status from ({warc.ORACLE})", pages=plain)
    assert {-1 if p is None else p: x for p, x in status.items()} == dict(zip(want["page_id"], want["status"]))
    assert {"changed", "missing", "moved", "ok"} == set(status.values())
    assert got.count() == len({r for r in rows})


def test_audit_of_equal_and_of_empty_replicas(spark):
    pages = spark.createDataFrame([(i, f"u{i}", "x") for i in range(40)], "page_id long, url string, html string")
    assert {r["status"] for r in warc.audit(warc.replica(pages), warc.replica(pages)).collect()} == {"ok"}
    none = pages.limit(0)
    assert {r["status"] for r in warc.audit(warc.replica(pages), warc.replica(none)).collect()} == {"missing"}
    assert {r["status"] for r in warc.audit(warc.replica(none), warc.replica(pages)).collect()} == {"extra"}
    assert warc.audit(warc.replica(none), warc.replica(none)).count() == 0


STORY = "<p>" + "This is a long sentence of the story that goes on and on, with words. " * 4 + "</p>"


@pytest.mark.parametrize("page, title", [
    ("<body class='single comments-open'><article>%s</article></body>", ""),
    ("<body><div class='post has-comments'>%s</div></body>", ""),
    ("<body><svg><article>%s</article></body>", ""),
    ("<body><p>Lead.</p><svg><article>%s</article><svg>x</svg></body>", "Lead. "),
    ("<body><article><video>%s</article></body>", ""),
    ("<body><article><header class='entry-header'><h1>The title of it</h1></header>%s</article></body>", "The title of it "),
    ("<body><header><p>Site header.</p></header><article>%s</article><div class='comments-area'><p>I like this story a lot.</p></div></body>", ""),
])
def test_pages_whose_classes_or_tags_mislead(page, title):
    story = " ".join(STORY[3:-4].split())
    assert html.main_text(page % STORY) in (title + story, story if title == "Lead. " else title + story)
