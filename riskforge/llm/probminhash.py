"""Near-duplicate documents by ProbMinHash (Ertl, "ProbMinHash", 2020).

Shingles are five words; a shingle's weight is how often the document repeats
it, and the similarity is the probability Jaccard

    J_P(x, y) = sum_i 1 / sum_j max(x_j / x_i, y_j / y_i)

which for equal repeat counts is the plain Jaccard similarity. Each shingle is
a Poisson process with its weight as rate; its arrivals fall on random
registers, a register keeps the shingle that arrives first, and generation
stops at the time at which all registers are filled (early termination). Two
documents agree in a register with probability J_P. Registers are grouped in
bands; documents that agree in a whole band meet in a bucket, and every link is
confirmed on the whole texts.

Identical texts are one class from the start (by SHA-256) and are represented
once afterwards. Inside a bucket, members are first confirmed against one
representative; only buckets whose members are then still in different
components are compared member by member, in blocks, by their registers, so a
bucket with a third of all rows costs one comparison a row.

Defined results: null texts read as empty; texts without words have no
shingles, so they group with identical texts only; a text of one to four words
is one shingle; repeated rows get the same class; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskforge.llm.common import connected_components, fold, fresh, materialize, mix64, shingle_counts, text_or_empty

WIDTH = 5            # words in a shingle
THRESHOLD = 0.8      # probability Jaccard of a link
BANDS, ROWS = 25, 5  # a pair at 0.8 shares a band with probability 1 - (1 - 0.8**5)**25 = 0.99995
MARGIN = 0.25        # register agreement below THRESHOLD - MARGIN (7 standard errors) rules a pair out
STAR_ROUNDS = 2
BLOCK = 512          # bucket members compared at once
SLICE_BYTES = 4 << 20


def signatures(doc: np.ndarray, item: np.ndarray, count: np.ndarray, n: int, k: int) -> np.ndarray:
    """ProbMinHash registers (n, k) of the weighted items of n documents; 0 rows where a document has none."""
    sig = np.zeros((n, k), dtype=np.uint64)
    if not len(doc):
        return sig
    total = np.bincount(doc, weights=count, minlength=n)
    seed = mix64(item + np.uint64(0x632BE59BD9B4E019))
    limit = np.zeros(n)
    np.divide(k * (np.log(k) + 2.0), total, out=limit, where=total > 0)
    todo = total > 0
    while todo.any():
        alive = np.flatnonzero(todo[doc])
        first = np.full(n * k, np.inf)
        who = np.zeros(n * k, dtype=np.uint64)
        time, step = np.zeros(len(alive)), 0
        while len(alive):
            step += 1
            r = mix64(seed[alive] + np.uint64(step * 0x9E3779B97F4A7C15 % (1 << 64)))
            time = time - np.log(((r >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / count[alive]
            keep = time <= limit[doc[alive]]
            alive, time, r = alive[keep], time[keep], r[keep]
            slot = doc[alive] * k + (mix64(r) % np.uint64(k)).astype(np.int64)
            np.minimum.at(first, slot, time)
            won = first[slot] == time
            who[slot[won]] = seed[alive[won]]
        filled = np.isfinite(first).reshape(n, k).all(axis=1)
        done = todo & filled
        sig[done] = who.reshape(n, k)[done]
        todo &= ~filled
        limit[todo] *= 2.0
    return sig


def probability_jaccard(xi: np.ndarray, xc: np.ndarray, yi: np.ndarray, yc: np.ndarray) -> float:
    """J_P of two weighted sets given by sorted items and counts."""
    both, ax, ay = np.intersect1d(xi, yi, assume_unique=True, return_indices=True)
    if not len(both):
        return 0.0
    x, y = xc[ax].astype(float), yc[ay].astype(float)
    only_x, only_y = float(xc.sum()) - x.sum(), float(yc.sum()) - y.sum()
    order = np.argsort(x / y, kind="stable")
    x, y, ratio = x[order], y[order], (x / y)[order]
    left = np.searchsorted(ratio, ratio, side="left")          # items of smaller ratio: y decides
    ys = np.concatenate([[0.0], np.cumsum(y)])[left]
    xs = x.sum() - np.concatenate([[0.0], np.cumsum(x)])[left]
    return float((1.0 / ((xs + only_x) / x + (ys + only_y) / y)).sum())


def _slices(batch: pa.RecordBatch, col: str):
    """Row ranges of about SLICE_BYTES of text."""
    sizes = pc.fill_null(pc.binary_length(batch.column(col)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes.astype(np.int64)) // SLICE_BYTES
    cuts = np.flatnonzero(np.diff(part)) + 1
    at = [0, *cuts.tolist(), len(sizes)]
    for a, b in zip(at[:-1], at[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def _sketch(bands: int, rows: int, width: int):
    def run(batches):
        for whole in batches:
            for b in _slices(whole, "text"):
                n = b.num_rows
                sig = signatures(*shingle_counts(b.column("text"), width), n, bands * rows)
                has = sig.any(axis=1)
                band = np.stack([fold([sig[:, i * rows + j] for j in range(rows)], seed=i) for i in range(bands)], axis=1)
                flat = pa.array(band[has].astype(np.uint64).view(np.int64).ravel())
                offs = np.concatenate([[0], np.cumsum(np.where(has, bands, 0))]).astype(np.int32)
                small = (sig & np.uint64(0xFFFFFFFF)).astype("<u4")
                yield pa.RecordBatch.from_arrays([
                    b.column("key"), b.column("id"), pa.ListArray.from_arrays(pa.array(offs), flat),
                    pa.array([small[i].tobytes() for i in range(n)], pa.binary())], ["key", "id", "bands", "sig"])
    return run


def _verify(threshold: float, width: int):
    """(a, b, ta, tb) -> (a, b) of the pairs at or above the threshold."""
    def run(batches):
        last_a, last = None, None
        for whole in batches:
            for b in _slices(whole, "tb"):
                a, c = b.column("a").to_pylist(), b.column("b").to_pylist()
                doc, item, count = shingle_counts(b.column("tb"), width)
                at = np.searchsorted(doc, np.arange(b.num_rows + 1))
                ta, keep = b.column("ta"), []
                for i in range(b.num_rows):
                    if a[i] != last_a:
                        last_a, last = a[i], shingle_counts(ta.slice(i, 1), width)[1:]
                    s = slice(at[i], at[i + 1])
                    if probability_jaccard(*last, item[s], count[s]) >= threshold:
                        keep.append(i)
                if keep:
                    yield pa.RecordBatch.from_arrays([pa.array([a[i] for i in keep], pa.int64()),
                                                      pa.array([c[i] for i in keep], pa.int64())], ["a", "b"])
    return run


def _confirm(pairs: DataFrame, texts: DataFrame, threshold: float, width: int) -> DataFrame:
    """Pairs (a, b) whose whole texts reach the threshold."""
    both = (pairs.join(texts.select(F.col("tid").alias("b"), F.col("text").alias("tb")), "b")
            .join(texts.select(F.col("tid").alias("a"), F.col("text").alias("ta")), "a")
            .select("a", "b", "ta", "tb").sortWithinPartitions("a"))
    return both.mapInArrow(_verify(threshold, width), "a long, b long")


class _Block:
    """Members of one bucket, or of two blocks of a large one (side 1 against side 2)."""

    def __init__(self, tab: pa.Table, k: int, bands: int, least: float):
        self.tid, comp, self.side, self.band = (tab.column(c).to_numpy() for c in ("tid", "comp", "side", "band"))
        self.label = np.unique(comp, return_inverse=True)[1]
        self.sig = np.frombuffer(b"".join(tab.column("sig").to_pylist()), dtype="<u4").reshape(-1, k)
        self.bands, self.least = bands, least

    def candidates(self):
        """(member, others) in different components whose registers agree often enough; a pair
        that shares several bands is met in the first of them only."""
        left, right = np.flatnonzero(self.side <= 1), np.flatnonzero(self.side != 1)
        for i in left:
            other = right[((self.tid[right] > self.tid[i]) | (self.side[right] == 2)) & (self.label[right] != self.label[i])]
            if len(other):
                same = self.sig[other] == self.sig[i]
                first = same.reshape(len(other), self.bands, -1).all(axis=2).argmax(axis=1)
                other = other[(same.mean(axis=1) >= self.least) & (first == self.band[i])]
                if len(other):
                    yield i, other

    def join(self, i: int, j: int) -> None:
        self.label[self.label == self.label[j]] = self.label[i]


def _blocks(key: list[str], work):
    """Run ``work`` on each group of rows with equal ``key`` columns, as they come sorted."""
    def cuts(tab):
        return np.flatnonzero(np.logical_or.reduce([np.diff(tab.column(c).to_numpy()) != 0 for c in key])) + 1

    def run(batches):
        held = None
        for b in batches:
            tab = pa.Table.from_batches([b])
            tab = pa.concat_tables([held, tab]).combine_chunks() if held is not None else tab
            at = [0, *cuts(tab).tolist()]
            for a, z in zip(at[:-1], at[1:]):
                yield from work(tab.slice(a, z - a))
            held = tab.slice(at[-1])
        if held is not None and held.num_rows:
            yield from work(held)
    return run


def _promising(k: int, bands: int, least: float):
    """The members that have a candidate in their block."""
    def work(tab):
        block = _Block(tab, k, bands, least)
        hit = np.zeros(tab.num_rows, dtype=bool)
        for i, other in block.candidates():
            hit[i] = hit[other] = True
        if hit.any():
            yield from tab.filter(pa.array(hit)).select(["h", "bi", "bj", "band", "side", "tid", "comp", "sig"]).to_batches()
    return _blocks(["h", "bi", "bj"], work)


def _decide(k: int, bands: int, least: float, threshold: float, width: int):
    """Links between components inside a block, on the whole texts. Links that
    would join what is joined already are not looked for: only classes are asked for."""
    def work(tab):
        block = _Block(tab, k, bands, least)
        n, links = tab.num_rows, []
        doc, item, count = shingle_counts(tab.column("text").combine_chunks(), width)
        at = np.searchsorted(doc, np.arange(n + 1))
        total = np.bincount(doc, weights=count, minlength=n)
        code = np.unique(item, return_inverse=True)[1]
        order = np.argsort(code, kind="stable")
        edge = np.searchsorted(code[order], np.arange(code.max() + 2 if len(code) else 1))
        owner, weight = doc[order], count[order]
        for i, other in block.candidates():
            own = slice(at[i], at[i + 1])
            lo, size = edge[code[own]], np.diff(edge)[code[own]]
            end = np.cumsum(size)
            pos = np.arange(end[-1]) + np.repeat(lo - (end - size), size)
            o, y, x = owner[pos], weight[pos].astype(float), np.repeat(count[own], size).astype(float)
            # J_P <= (weight of items repeated equally) / (sum of maxima) + shares of the rest
            least_of = np.bincount(o, weights=np.minimum(x, y), minlength=n)
            even = x == y
            most = (np.bincount(o[even], weights=x[even], minlength=n) / (total[i] + total - least_of)
                    + np.bincount(o[~even], weights=np.minimum(x / total[i], y / total[o])[~even], minlength=n))
            for j in other[most[other] >= threshold - 1e-9]:
                s = slice(at[j], at[j + 1])
                if block.label[i] != block.label[j] and probability_jaccard(
                        item[own], count[own], item[s], count[s]) >= threshold:
                    block.join(i, j)
                    links.append((block.tid[i], block.tid[j]))
        if links:
            x = np.array(links, dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(x[:, 0]), pa.array(x[:, 1])], ["a", "b"])
    return _blocks(["h", "bi", "bj"], work)


def _label(members: DataFrame, comps: DataFrame | None) -> DataFrame:
    if comps is None:
        return members.withColumn("comp", F.col("tid"))
    return (members.join(comps.withColumnRenamed("node", "tid"), "tid", "left")
            .select("h", "band", "tid", F.coalesce("component", "tid").alias("comp")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, threshold: float = THRESHOLD,
                    width: int = WIDTH, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per row of ``docs``: key (SHA-256 of the text), id, class_id (smallest id of
    the class, null if all are null), kept (the row, or repeated row, that stands for it)."""
    k = bands * rows
    work = docs.select(F.sha2(text_or_empty(text_col), 256).alias("key"), F.col(id_col).alias("id"),
                       text_or_empty(text_col).alias("text"))
    id_type = work.schema["id"].dataType.simpleString()
    sketch = materialize(work.mapInArrow(_sketch(bands, rows, width),
                                         f"key string, id {id_type}, bands array<long>, sig binary"), "pmh-sketch")
    texts = materialize(
        sketch.groupBy("key").agg(F.min("id").alias("rep"), F.first("bands").alias("bands"), F.first("sig").alias("sig"))
        .withColumn("tid", F.monotonically_increasing_id()), "pmh-texts")
    slots = texts.select(F.posexplode("bands").alias("band", "h"), "tid")
    shared = slots.groupBy("h").agg(F.min("tid").alias("x"), F.max("tid").alias("y")).filter("x != y").select("h")
    members = materialize(slots.join(shared, "h"), "pmh-members")
    if members.isEmpty():
        comps = None
    else:
        comps = _link(work, texts, members, threshold, width, bands, rows)
    named = texts.select("key", "rep", "tid")
    if comps is None:
        classes = named.select("key", F.col("rep").alias("class_id"), F.col("key").alias("keep_key"))
    else:
        named = named.join(comps.withColumnRenamed("node", "tid"), "tid", "left").select(
            "key", "rep", F.coalesce("component", "tid").alias("component"))
        first = named.groupBy("component").agg(F.min(F.struct(F.col("rep").isNull().alias("none"), "rep", "key")).alias("f"))
        classes = named.join(first, "component").select(
            "key", F.col("f.rep").alias("class_id"), F.col("f.key").alias("keep_key"))
    return sketch.select("key", "id").join(classes, "key").select(
        "key", "id", "class_id",
        ((F.col("key") == F.col("keep_key")) & F.col("id").eqNullSafe(F.col("class_id"))).alias("kept"))


def _link(work: DataFrame, texts: DataFrame, members: DataFrame, threshold: float, width: int, bands: int, rows: int) -> DataFrame:
    needed = texts.join(members.select("tid").distinct(), "tid").select("tid", "key")
    whole = materialize(work.join(needed, "key").dropDuplicates(["tid"]).select("tid", "text"), "pmh-whole")
    comps, links, tested = None, None, None
    for r in range(STAR_ROUNDS):
        now = _label(members, comps)
        pick = (F.min("tid") if r == 0 else F.max("tid")).alias("rep")
        mixed = now.groupBy("h").agg(F.min("comp").alias("c1"), F.max("comp").alias("c2"), pick).filter("c1 != c2")
        reps = mixed.select("h", "rep")
        pairs = (now.join(reps, "h").filter("tid != rep").select(
            F.least("tid", "rep").alias("x"), F.greatest("tid", "rep").alias("y"), (F.col("rep") < F.col("tid")).alias("low"))
            .distinct())
        # the representative, shared by many pairs, is the sorted side
        pairs = pairs.select(F.when(F.col("low"), F.col("x")).otherwise(F.col("y")).alias("a"),
                             F.when(F.col("low"), F.col("y")).otherwise(F.col("x")).alias("b"))
        if tested is not None:
            seen = tested.select(F.least("a", "b").alias("p"), F.greatest("a", "b").alias("q"))
            pairs = pairs.join(seen, (F.least("a", "b") == F.col("p")) & (F.greatest("a", "b") == F.col("q")), "left_anti")
        pairs = materialize(pairs, "pmh-pairs")
        good = materialize(_confirm(pairs, whole, threshold, width), "pmh-links")
        tested = pairs if tested is None else tested.unionByName(pairs)
        links = good if links is None else links.unionByName(good)
        comps = connected_components(links, "pmh")
    now = _label(members, comps)
    mixed = now.groupBy("h").agg(F.min("comp").alias("c1"), F.max("comp").alias("c2"),
                                 F.count("*").alias("n")).filter("c1 != c2")
    rest = now.join(mixed.select("h", F.ceil(F.col("n") / BLOCK).cast("int").alias("nb")), "h")
    rest = rest.join(texts.select("tid", "sig"), "tid").withColumn("blk", F.pmod(F.xxhash64("tid"), F.col("nb")).cast("int"))
    grid = (rest.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
            .select("h", F.least("blk", "o").alias("bi"), F.greatest("blk", "o").alias("bj"), "band",
                    F.when(F.col("blk") == F.col("o"), 0).when(F.col("blk") < F.col("o"), 1).otherwise(2).alias("side"),
                    "tid", "comp", "sig"))
    key, k, least = ["h", "bi", "bj"], bands * rows, threshold - MARGIN
    some = materialize(grid.repartition(*key).sortWithinPartitions(*key).mapInArrow(_promising(k, bands, least), grid.schema),
                       "pmh-promising")
    if some.isEmpty():
        return comps
    more = materialize(some.join(whole, "tid").repartition(*key).sortWithinPartitions(*key).mapInArrow(
        _decide(k, bands, least, threshold, width), "a long, b long"), "pmh-links")
    return connected_components(links.unionByName(more), "pmh")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """The rows of ``docs`` without near duplicates: one row of each class stays
    (of rows with the same id and text, one)."""
    kept = materialize(near_duplicates(docs, id_col, text_col, **kw).filter("kept").groupBy(
        F.col("key").alias(k := fresh(docs, "key")), F.col("id").alias(i := fresh(docs, "id")))
        .agg(F.count("*").alias(n := fresh(docs, "n"))), "pmh-kept")
    rows = docs.join(kept, (F.sha2(text_or_empty(text_col), 256) == F.col(k)) & docs[id_col].eqNullSafe(F.col(i)))
    if kept.filter(F.col(n) > 1).isEmpty():
        return rows.select(*docs.columns)
    return (rows.filter(F.col(n) == 1).unionByName(rows.filter(F.col(n) > 1).dropDuplicates([k, i]))
            .select(*docs.columns))
