"""Suffix-array deduplication: bytes inside a string of ``length`` bytes that also starts elsewhere.

Finding what can repeat. Every run of ``length`` bytes has one canonical
anchor, its ``ANCHOR``-byte piece of smallest hash (winnowing, Schleimer et
al.), so equal runs have equal anchors at equal places. A text is cut into
windows, each the consecutive starts that have the same anchor, with the bytes
they cover; every start is in exactly one window. Only windows whose anchor
occurs twice can hold a repeat, and equal windows are kept once with a count.

Suffix arrays. Windows are dealt to shards by anchor. A shard's suffix array is
built in numpy by Larsson-Sadakane refinement (groups of suffixes that tie on h
symbols are split by the rank of the suffix h further on, h doubling, settled
groups left alone); Kasai's algorithm, run over all windows of the shard in
step, gives the common prefix of every suffix with the one before it. A start
repeats if that prefix, or its successor's, has ``length`` bytes, or if its
window occurs more than once.

Cross-shard merging. An anchor with more bytes than one task should sort is dealt to
several shards; each of them then gives one digest for every distinct run, and the
runs that stand alone in their shard are found in the sorted digests of the
others by binary search, again in pieces dealt by digest.

Texts are told apart by 60 bits of SHA-256 and their length; identical texts
take part once. Strings are judged on the input, overlaps count, matches never
cross documents. An anchor or window with more rows than an even share of a
shuffle partition (so at most as many as partitions) stays where its rows lie:
only the keys are broadcast.

Defined results: a null text is empty; texts shorter than ``length`` keep all
bytes; rows with equal texts of at least ``length`` bytes lose all; an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskforge.llm.common import _BASE, _BASE_INV, _BYTE, materialize, mix64, powers, string_buffers, text_or_empty

LENGTH = 400
ANCHOR = 96
SHARD_BYTES = 1 << 20
SORT_MEMORY = 512 << 20  # what the arrays of one shard may take in a task
SORT_COST = 128          # bytes of arrays for a byte of windows, rounded up (measured in the tests)
SPLIT_BYTES = SORT_MEMORY // SORT_COST   # an anchor with more goes to several shards
HOT_ROWS = 1024          # a join key with fewer rows is never hot
FEW = 1 << 20            # rows of (anchor, shards) that may be broadcast
BATCH_BYTES = 4 << 20
HEAD = 5                 # symbols compared by the first sort
CHUNK = 1 << 22          # starts anchored at once in a long text


# ---------------------------------------------------------------- windows

_held: list[np.ndarray] = []


def _powers(n: int) -> list[np.ndarray]:
    """The first powers of the hash's base and of its inverse, kept for the next text."""
    if not _held or len(_held[0]) < n:
        _held[:] = [powers(_BASE, max(n, 1 << 16)), powers(_BASE_INV, max(n, 1 << 16))]
    return [p[:n] for p in _held]


def windows(raw: np.ndarray, length: int, anchor: int):
    """(anchor hash, first start, number of starts) of the windows of a text."""
    out = []
    for lo in range(0, len(raw) - length + 1, CHUNK):
        part = raw[lo:lo + CHUNK + length - 1]
        n = len(part) - length + 1
        up, down = _powers(len(part))
        total = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(_BYTE[part] * up, out=total[1:])
        g = mix64((total[anchor:] - total[:-anchor]) * down[:len(part) - anchor + 1])
        span = length - anchor + 1
        low = np.uint64((1 << 23) - 1)
        key = (g & ~low) | np.arange(len(g), dtype=np.uint64)
        rows = np.concatenate([key, np.full(-len(key) % span, ~np.uint64(0))]).reshape(-1, span)
        ahead = np.minimum.accumulate(rows, axis=1).ravel()
        back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        at = (np.minimum(back[:n], ahead[span - 1:span - 1 + n]) & low).astype(np.int64)
        cut = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        out.append((g[at[cut]].view(np.int64), cut + lo, np.diff(np.concatenate([cut, [n]]))))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else None


def _anchor(length: int, anchor: int):
    def run(batches):
        for b in batches:
            raw, offs = string_buffers(b.column("text"))
            k = b.column("k").to_numpy()
            parts = []
            for i in np.flatnonzero(np.diff(offs) >= length):
                own = raw[offs[i]:offs[i + 1]]
                fp, s, n = windows(own, length, anchor)
                data = own.tobytes()
                w = np.array([int.from_bytes(hashlib.blake2b(data[a:a + m + length - 1], digest_size=8).digest(), "little", signed=True)
                              for a, m in zip(s.tolist(), n.tolist())], dtype=np.int64)
                parts.append((np.full(len(s), k[i]), np.full(len(s), len(own)), fp, w, s, n))
            if parts:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x).astype(np.int64)) for x in zip(*parts)], ["k", "len", "fp", "w", "s", "n"])
    return run


def _cut(length: int):
    """(text, list of windows) -> one row a window with its bytes, in batches of about BATCH_BYTES."""
    names = ["shard", "sub", "split", "fp", "w", "n", "cnt"]

    def run(batches):
        held, size = [], 0
        for b in batches:
            raw, offs = string_buffers(b.column("text"))
            lists = b.column("wins")
            at = lists.offsets.to_numpy()
            flat = lists.values.slice(int(at[0]), int(at[-1] - at[0])) if len(at) else lists.values
            cols = {f.name: c.to_numpy() for f, c in zip(flat.type, flat.flatten())}
            at = at - at[0]
            for i in range(b.num_rows):
                data = raw[offs[i]:offs[i + 1]].tobytes()
                r = slice(int(at[i]), int(at[i + 1]))
                pieces = [data[a:a + m + length - 1] for a, m in zip(cols["s"][r].tolist(), cols["n"][r].tolist())]
                held.append(([cols[c][r] for c in names], pieces))
                size += sum(map(len, pieces))
                if size >= BATCH_BYTES:
                    yield emit(held)
                    held, size = [], 0
        if held:
            yield emit(held)

    def emit(held):
        return pa.RecordBatch.from_arrays(
            [*(pa.array(np.concatenate(c)) for c in zip(*(h[0] for h in held))),
             pa.array([p for h in held for p in h[1]], pa.binary())], [*names, "bytes"])
    return run


# ---------------------------------------------------------------- suffix arrays

def suffix_array(text: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order and rank of all suffixes of several strings; ``end[i]`` is where the string of position i ends.

    Equal suffixes stay in text order.
    """
    n = len(text)
    pos = np.arange(n, dtype=np.int32)
    end = end.astype(np.int32)
    left = end - pos
    longest = int(left.max())
    symbol = np.concatenate([text, np.zeros(HEAD, np.uint8)]).astype(np.uint64) + np.uint64(1)
    code = np.zeros(n, dtype=np.uint64)
    for i in range(HEAD):
        code = code * np.uint64(257) + symbol[i:n + i] * (left > i)
    sa, key = _by(code, pos, n)
    first = np.concatenate([[True], key[1:] != key[:-1]])
    rank = np.empty(n, dtype=np.int32)
    rank[sa] = np.maximum.accumulate(np.where(first, pos, np.int32(0)))
    place, who, h = pos, sa, HEAD
    while h < longest:
        # only members of groups that still tie stay, in their places of the order
        tied = ~(first & np.concatenate([first[1:], [True]]))
        place, who, first = place[tied], who[tied], first[tied]
        if not len(place):
            break
        further = np.where(left[who] > h, rank[np.minimum(who + h, n - 1)] + 1, 0).astype(np.uint64)
        group = (np.cumsum(first) - 1).astype(np.uint64)
        who, key = _by(group * np.uint64(n + 1) + further, who, n)
        first = np.concatenate([[True], key[1:] != key[:-1]])
        sa[place] = who
        rank[who] = np.maximum.accumulate(np.where(first, place, np.int32(0)))
        h *= 2
    rank[sa] = pos
    return sa.astype(np.int64), rank.astype(np.int64)


def _by(key: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Values and keys sorted by (key, value); one packed sort where 64 bits hold both."""
    bits = max(int(n - 1).bit_length(), 1)
    if int(key.max()).bit_length() + bits <= 64:
        both = key << np.uint64(bits)
        both |= value.astype(np.uint64)
        both.sort()
        return (both & np.uint64((1 << bits) - 1)).astype(np.int32), both >> np.uint64(bits)
    order = np.lexsort((value, key))
    return value[order], key[order]


def common_prefixes(text: np.ndarray, end: np.ndarray, sa: np.ndarray, rank: np.ndarray,
                    begin: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Kasai: length shared by the suffix at begin + t, t < starts, and the one before it in the order.

    One string's loop carries its length to the next start less one; all
    strings take their t-th step together. 0 for the first suffix and beyond ``starts``.
    """
    n = len(text)
    word = np.zeros(n + 8, dtype=np.uint64)
    pad = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    for i in range(8):                                   # the first byte in the lowest bits
        word[:n] |= pad[i:n + i] << np.uint64(8 * i)
    shared = np.zeros(n, dtype=np.int64)
    h = np.zeros(len(begin), dtype=np.int64)
    for t in range(int(starts.max())):
        live = np.flatnonzero(starts > t)
        s = begin[live] + t
        r = rank[s]
        p = sa[np.maximum(r - 1, 0)]
        most = np.where(r > 0, np.minimum(end[s] - s, end[p] - p), 0)
        now = np.minimum(np.maximum(h[live] - 1, 0), most)
        go = np.flatnonzero(now < most)
        while len(go):
            x = word[s[go] + now[go]] ^ word[p[go] + now[go]]
            low = x & (~x + np.uint64(1))                # lowest differing bit
            same = np.where(x == 0, 8, np.log2(np.maximum(low, np.uint64(1)).astype(np.float64)).astype(np.int64) // 8)
            now[go] = np.minimum(now[go] + same, most[go])
            go = go[(same == 8) & (now[go] < most[go])]
        h[live] = now
        shared[s] = now
    return shared


def _shard(length: int):
    """One shard: flagged runs of starts (kind 0), and for split anchors a digest of every distinct run (kind 1)."""
    names = ["kind", "fp", "w", "n", "a", "b", "d1", "d2"]

    def run(key, tab):
        col = {c: tab.column(c).to_numpy() for c in ("fp", "w", "n", "cnt")}
        raw, offs = string_buffers_binary(tab.column("bytes"))
        begin, size = offs[:-1], np.diff(offs)
        end = np.repeat(offs[1:], size)
        sa, rank = suffix_array(raw, end)
        starts = col["n"]
        shared = common_prefixes(raw, end, sa, rank, begin, starts)
        flag = shared >= length
        before = sa[np.maximum(rank - 1, 0)]
        flag[before[np.flatnonzero(flag)]] = True
        many = np.flatnonzero(col["cnt"] > 1)
        inside = np.zeros(len(raw) + 1, dtype=np.int64)
        np.add.at(inside, begin, 1)
        np.add.at(inside, begin + starts, -1)
        inside = np.cumsum(inside)[:-1] > 0              # starts, not the bytes behind them
        often = np.zeros(len(raw) + 1, dtype=np.int64)
        np.add.at(often, begin[many], 1)
        np.add.at(often, (begin + starts)[many], -1)
        flag = (flag | (np.cumsum(often)[:-1] > 0)) & inside
        owner = np.repeat(np.arange(len(begin)), size)
        up = np.flatnonzero(flag & ~np.concatenate([[False], flag[:-1] & (owner[1:] == owner[:-1])]))
        down = np.flatnonzero(flag & ~np.concatenate([flag[1:] & (owner[1:] == owner[:-1]), [False]])) + 1
        i = owner[up]
        zero = np.zeros(len(up), np.int64)
        out = [[zero, col["fp"][i], col["w"][i], col["n"][i], up - begin[i], down - begin[i], zero, zero]]
        if key[2].as_py():
            # first of each class of equal runs, in the order of the suffix array
            heads = np.flatnonzero(inside & ~(shared >= length))
            data = raw.tobytes()
            d = np.frombuffer(b"".join(hashlib.blake2b(data[p:p + length], digest_size=16).digest() for p in heads.tolist()),
                              dtype=np.int64).reshape(-1, 2)
            i = owner[heads]
            one = np.ones(len(heads), np.int64)
            # b tells whether the run is settled already
            out.append([one, col["fp"][i], col["w"][i], col["n"][i], heads - begin[i], flag[heads].astype(np.int64), d[:, 0], d[:, 1]])
        return pa.table({c: pa.array(np.concatenate(x).astype(np.int64)) for c, x in zip(names, zip(*out))})
    return run


def string_buffers_binary(col) -> tuple[np.ndarray, np.ndarray]:
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    col = col.cast(pa.large_binary())
    _, offs, data = col.buffers()
    offs = np.frombuffer(offs, dtype=np.int64)[col.offset:col.offset + len(col) + 1]
    raw = np.frombuffer(data, dtype=np.uint8)[offs[0]:offs[-1]]
    return raw, offs - offs[0]


def _merge(key, tab):
    """Digests of several shards: single runs that another shard has too, by binary search."""
    c = {x: tab.column(x).to_numpy() for x in ("fp", "w", "n", "a", "b", "d1", "d2")}
    hit = np.zeros(len(c["a"]), dtype=bool)
    order = np.lexsort((c["d2"], c["d1"]))
    d1 = c["d1"][order]
    lo, hi = np.searchsorted(d1, c["d1"], "left"), np.searchsorted(d1, c["d1"], "right")
    for i in np.flatnonzero((c["b"] == 0) & (hi - lo > 1)):
        near = order[lo[i]:hi[i]]
        hit[i] = ((c["d2"][near] == c["d2"][i]) & (near != i)).any()
    return pa.table({x: pa.array(c[x][hit]) for x in ("fp", "w", "n", "a")} | {"b": pa.array(c["a"][hit] + 1)})


# ---------------------------------------------------------------- the operator

def _hot(counts: DataFrame, keys: list[str], total: int) -> DataFrame:
    """The keys with more of the ``total`` rows (column c) than an even share of a shuffle partition.

    They are at most as many as the partitions, which bounds what is broadcast.
    """
    parts = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return F.broadcast(counts.filter(F.col("c") > max(HOT_ROWS, -(-total // parts))).select(*keys))


def _remove(length: int):
    def run(batches):
        for b in batches:
            raw, offs = string_buffers(b.column("text"))
            lo, hi = b.column("lo"), b.column("hi")
            removed, spans, digest = [], [], []
            for i in range(b.num_rows):
                own = raw[offs[i]:offs[i + 1]]
                if not lo[i].is_valid or not len(own):
                    removed.append(0), spans.append(0), digest.append(hashlib.sha256(own.tobytes()).hexdigest())
                    continue
                depth = np.zeros(len(own) + 1, dtype=np.int64)
                np.add.at(depth, lo[i].values.to_numpy(), 1)
                np.add.at(depth, hi[i].values.to_numpy() + length - 1, -1)
                gone = np.cumsum(depth)[:-1] > 0
                removed.append(int(gone.sum()))
                spans.append(int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()))
                digest.append(hashlib.sha256(own[~gone].tobytes()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(np.diff(offs)), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
                 pa.array(digest, pa.string())], ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
    return run


def repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, length: int = LENGTH,
             anchor: int = ANCHOR, shard_bytes: int = SHARD_BYTES, split_bytes: int = SPLIT_BYTES) -> tuple[DataFrame, DataFrame]:
    """(k, len, id, text) of every row, and (k, len, lo, hi): the runs of repeated starts of each text."""
    base = docs.select(F.conv(F.substring(F.sha2(text_or_empty(text_col), 256), 1, 15), 16, 10).cast("long").alias("k"),
                       F.octet_length(text_or_empty(text_col)).cast("long").alias("len"),
                       F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    # equal texts give equal rows, dropped in the tasks first
    anchors = materialize(base.filter(F.col("len") >= length).select("k", "text").mapInArrow(
        _anchor(length, anchor), "k long, len long, fp long, w long, s long, n long").distinct(), "sfx-anchors")
    twice = materialize(anchors.groupBy("fp").agg(F.count("*").alias("c")).filter("c > 1"), "sfx-twice")
    hot = _hot(twice, ["fp"], anchors.count())
    shared = materialize(anchors.join(hot, "fp", "left_anti").join(twice.select("fp"), "fp").unionByName(
        anchors.join(hot, "fp", "left_semi")), "sfx-shared")
    wins = shared.groupBy("fp", "w", "n").agg(F.count("*").alias("cnt"), F.min(F.struct("k", "len", "s")).alias("r"))
    wins = materialize(wins.select("fp", "w", "n", "cnt", "r.k", "r.len", "r.s"), "sfx-windows")
    size = F.sum(F.col("n") + length - 1)
    whole = wins.agg(size.alias("b"), F.sum("cnt").alias("c")).first()
    total = whole["b"] or 0
    shards = max(1, -(-total // shard_bytes))
    large = wins.groupBy("fp").agg(size.alias("b")).filter(F.col("b") > split_bytes).select(
        "fp", F.ceil(F.col("b") / shard_bytes).alias("subs"))
    if total // split_bytes <= FEW:                      # no more anchors than that can be large
        large = F.broadcast(large)
    dealt = wins.join(large, "fp", "left").select(
        F.when(F.col("subs").isNull(), F.pmod(F.xxhash64("fp"), F.lit(shards))).otherwise(F.col("fp")).alias("shard"),
        F.coalesce(F.pmod(F.xxhash64("w", "n"), F.col("subs")), F.lit(0)).cast("long").alias("sub"),
        F.col("subs").isNotNull().cast("long").alias("split"), "fp", "w", "n", "cnt", "s", "k", "len")
    lists = dealt.groupBy("k", "len").agg(F.collect_list(F.struct("shard", "sub", "split", "fp", "w", "n", "cnt", "s")).alias("wins"))
    # one row of each text: the join leaves equal keys side by side, so this is no further shuffle
    cut = (base.select("k", "len", "text").join(lists, ["k", "len"]).dropDuplicates(["k", "len"]).select("text", "wins")
           .mapInArrow(_cut(length), "shard long, sub long, split long, fp long, w long, n long, cnt long, bytes binary"))
    found = materialize(cut.groupBy("shard", "sub", "split").applyInArrow(
        _shard(length), "kind long, fp long, w long, n long, a long, b long, d1 long, d2 long"), "sfx-found")
    flags = found.filter("kind = 0").select("fp", "w", "n", "a", "b")
    runs = found.filter("kind = 1").withColumn("piece", F.pmod(F.xxhash64("d1"), F.lit(shards)))
    flags = flags.unionByName(runs.groupBy("piece").applyInArrow(_merge, "fp long, w long, n long, a long, b long"))
    window = ["fp", "w", "n"]
    hot = _hot(wins.select(*window, F.col("cnt").alias("c")), window, whole["c"] or 0)
    spans = shared.join(hot, window, "left_anti").join(flags, window).select(
        "k", "len", (F.col("s") + F.col("a")).alias("lo"), (F.col("s") + F.col("b")).alias("hi"))
    # a hot window occurs more than once, so all its starts repeat
    spans = spans.unionByName(shared.join(hot, window, "left_semi").select("k", "len", F.col("s").alias("lo"), (F.col("s") + F.col("n")).alias("hi")))
    copies = (base.filter(F.col("len") >= length).groupBy("k", "len").agg(F.count("*").alias("c")).filter("c > 1")
              .select("k", "len", F.lit(0).cast("long").alias("lo"), (F.col("len") - (length - 1)).alias("hi")))
    return base, spans.unionByName(copies)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, length: int = LENGTH, **kw) -> DataFrame:
    """One row per row: id, n_bytes, n_removed, n_spans, kept_sha256."""
    base, spans = repeated(docs, id_col, text_col, length=length, **kw)
    per_text = spans.groupBy("k", "len").agg(F.collect_list(F.struct("lo", "hi")).alias("r"))
    per_text = per_text.select("k", "len", F.col("r.lo").alias("lo"), F.col("r.hi").alias("hi"))
    kind = base.schema["id"].dataType.simpleString()
    return base.join(per_text, ["k", "len"], "left").select("id", "text", "lo", "hi").mapInArrow(
        _remove(length), f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
