"""Leaf-wise gradient boosting of a binary label on Spark.

Features are cut once into at most ``max_bins`` ranges (approximate quantiles
of the training rows, one aggregate) and packed, with label and weight, into
blocks of bytes that stay cached on the executors. A tree grows best-first:
the leaf with the largest gain is split until there are ``leaves`` of them. A
pass over the blocks adds up gradient, hessian and row count per (leaf,
feature, bin) inside the tasks and merges them at the driver, or in a tree of
partial sums where there are many or large ones, so that the driver gets a few
tables whose size depends on leaves, features and bins only. One pass serves
all leaves that may still be split: of every pair of children only the smaller
one is counted, the other is its parent less it.

Rows keep their score in the block; a new tree's values are added when the
next round reads it. Every ``CUT_ROUNDS`` rounds the blocks are written to the
shared checkpoint folder, so a lost executor repeats at most those. Gradients
are multiples of 2^-20: their sums are exact in doubles, whatever the order.

Rows that fit one partition (``LOCAL_ROWS``) need no passes: its task makes
``CUT_ROUNDS`` rounds by the same steps before the driver sees their trees. More
rows are spread over tasks. Where all of these run at once (a barrier stage) and
the checkpoint folder is a mounted one, they make ``GANG_ROUNDS`` rounds in a job:
each adds up its own rows, hands the table to the others as a file and grows the
same tree from the sum. Otherwise, or when such a job fails, a job is a pass as
above. The trees are the same either way.

The validation rows' AUC (scores in 2^14 equal ranges, ties half) is taken
after every round; training ends when ``patience`` rounds bring no better one,
and the trees up to the best round are kept. Without validation rows all
rounds are kept.

This is the one place of the library that uses an RDD: thousands of short
passes over per-partition state, where planning a DataFrame job each time
takes longer than the pass (measured at sf0.1: 0.38 s against 0.07 s).
"""

from __future__ import annotations

import logging
import math
import os
import re
import shutil
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from py4j.protocol import Py4JError, Py4JJavaError
from pyspark import BarrierTaskContext, StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskforge.session import checkpoint_root

GRAIN = float(1 << 20)
AUC_RANGES = 1 << 14
CUT_ROUNDS = 20
BLOCK_ROWS = 1 << 18
LOCAL_ROWS = 1 << 20                # a leaf of so many rows is grown to its end by one task (8 bytes and one a feature each);
                                    # so many rows at all are one partition, which needs no passes (34 bytes and one a feature each)
GANG_ROWS = 1 << 20                 # more rows than these are learnt from by tasks that run at once, where they can
GANG_TASKS = 64                     # so many at most: each reads a table of every other
GANG_ROUNDS = 250                   # rounds of one job of such tasks; it begins by adding the trees before to the scores
SLICE_ROWS = 1 << 15                # rows of one step whose arrays stay in a core's cache
MAIL_SECONDS = 900.0                # a table that another task has not sent by then will not come
DRIVER_BYTES = 1 << 25              # tables of a pass that the driver adds up itself; more go through a tree of partial sums
TASK_ROWS = (1 << 15, 1 << 22)      # rows a task has at least where there are enough, and at most
TREE_SCHEMA = "tree int, node int, feature string, threshold double, left int, right int, value double, gain double, n long"


@dataclass
class Tree:
    """Nodes by number, 0 the root; ``left`` is -1 at a leaf. Rows with value <= threshold go left."""

    feature: list = field(default_factory=list)
    cut: list = field(default_factory=list)          # last bin of the left side
    left: list = field(default_factory=list)
    right: list = field(default_factory=list)
    value: list = field(default_factory=list)
    gain: list = field(default_factory=list)
    n: list = field(default_factory=list)

    def add(self, value: float, n: int) -> int:
        for col, v in zip((self.feature, self.cut, self.left, self.right, self.value, self.gain, self.n),
                          (-1, 0, -1, -1, value, 0.0, n)):
            col.append(v)
        return len(self.n) - 1

    def leaf_of(self, x: np.ndarray, cut=None) -> np.ndarray:
        """Leaf number of every row of ``x`` (bins, or values if ``cut`` holds thresholds); fastest where a column lies in one piece."""
        if cut is None and x.dtype == np.uint8 and len(self.n) < 2 * 64:
            return self._leaf_of_bins(x)
        cut = self.cut if cut is None else cut
        at = np.zeros(len(x), dtype=np.int64)
        todo = [(0, np.arange(len(x)))]
        while todo:
            v, rows = todo.pop()
            if self.left[v] < 0:
                at[rows] = v
                continue
            low = x[:, self.feature[v]][rows] <= cut[v]
            todo += [(self.left[v], rows[low]), (self.right[v], rows[~low])]
        return at

    def _leaf_of_bins(self, x: np.ndarray) -> np.ndarray:
        return self.look_ups()(x)

    def look_ups(self):
        """The same for at most 64 leaves, one bit each: a look-up a feature gives the leaves that a row's bin leaves open,
        and one is left after all features. Made once for many batches of rows."""
        kind = np.uint32 if len(self.n) < 2 * 32 else np.uint64
        leaves, masks = [], {}

        def below(v: int) -> int:
            if self.left[v] < 0:
                leaves.append(v)
                return 1 << (len(leaves) - 1)
            low, high = below(self.left[v]), below(self.right[v])
            mask = masks.setdefault(self.feature[v], np.full(256, np.iinfo(kind).max, kind))
            mask[:self.cut[v] + 1] &= ~kind(high)
            mask[self.cut[v] + 1:] &= ~kind(low)
            return low | high

        below(0)
        every, nodes = kind((1 << len(leaves)) - 1), np.array(leaves)

        def run(x: np.ndarray) -> np.ndarray:
            open_ = None
            for f, mask in masks.items():
                part = mask.take(np.ascontiguousarray(x[:, f]), mode="clip")
                open_ = part if open_ is None else np.bitwise_and(open_, part, out=open_)
            if open_ is None:
                return np.zeros(len(x), dtype=np.int64)
            bit = (open_ & every).astype(np.float64).view(np.int64) >> 52       # a power of two: its exponent
            return nodes.take(bit - 1023)
        return run


def _hash(key: np.ndarray, seed: int) -> np.ndarray:
    """Uniform 64-bit values of the row keys for one seed (splitmix64 finaliser)."""
    x = key.view(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _edges(train: DataFrame, features: list[str], max_bins: int) -> list[np.ndarray]:
    """Upper bounds of all bins but the last, per feature."""
    shares = [i / max_bins for i in range(1, max_bins)]
    row = train.agg(*(F.percentile_approx(F.when(~F.isnan(f), F.col(f)), F.array(*map(F.lit, shares)), 10_000).alias(f"q{i}")
                      for i, f in enumerate(features))).first()
    return [np.unique(np.array(q or [], dtype=np.float64)) for q in row]


def _blocks(data: DataFrame, features: list[str], edges: list[np.ndarray], weight: str):
    """RDD of dicts of arrays, cached: bins, label, weight, validation flag, row key, score."""
    rows = data.select(*(F.col(f).alias(f"f{i}") for i, f in enumerate(features)), F.col("y").cast("double").alias("y"),
                       F.col(weight).cast("double").alias("w"), (F.col("split") == "val").alias("val"),
                       F.xxhash64("y", "split", *features).alias("key"))

    def pack(batches):
        def block(parts):
            t = pa.Table.from_batches(parts)
            x = np.empty((len(edges), t.num_rows), dtype=np.uint8)
            for i, e in enumerate(edges):
                x[i] = np.searchsorted(e, t.column(f"f{i}").to_numpy())
            cols = [x, t.column("y").to_numpy(), t.column("w").to_numpy(), t.column("val").to_numpy().astype(np.uint8), t.column("key").to_numpy()]
            return pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(c).tobytes()], pa.binary()) for c in cols], ["x", "y", "w", "val", "key"])

        parts, n = [], 0
        for b in batches:
            parts.append(b)
            n += b.num_rows
            if n >= BLOCK_ROWS:
                yield block(parts)
                parts, n = [], 0
        if n:
            yield block(parts)

    def unpack(r):
        y = np.frombuffer(r["y"])
        return {"x": np.frombuffer(r["x"], np.uint8).reshape(-1, len(y)).T, "y": y, "w": np.frombuffer(r["w"]),
                "val": np.frombuffer(r["val"], np.uint8) > 0, "key": np.frombuffer(r["key"], np.int64)}

    n = rows.count()
    spark = data.sparkSession
    alone = 0 < n <= LOCAL_ROWS
    tasks = 1 if alone else max(min(spark.sparkContext.defaultParallelism, -(-n // TASK_ROWS[0])), -(-n // TASK_ROWS[1]), 1)
    gang = n > GANG_ROWS and 1 < tasks <= min(_slots(spark), GANG_TASKS)
    return rows.repartition(tasks, "key").mapInArrow(pack, "x binary, y binary, w binary, val binary, key binary").rdd.map(unpack), tasks, alone, gang


def _advance(tree: Tree | None, start: float):
    """Adds a tree's values to the scores, the one part of a block that changes."""
    def run(block):
        return block | {"raw": block["raw"] + np.array(tree.value)[tree.leaf_of(block["x"])] if tree else np.full(len(block["y"]), start)}
    return run


def _taken(key: np.ndarray, val: np.ndarray, bag_seed: int | None, share: float) -> np.ndarray:
    """Which rows a round learns from."""
    return ~val & (_hash(key, bag_seed) < np.uint64(int(share * 2.0 ** 64))) if share < 1.0 else ~val


def _probability(raw: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-raw))


def _slopes(p: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients and hessians."""
    return np.rint((p - y) * w * GRAIN) / GRAIN, np.rint(np.maximum(p * (1.0 - p), 1e-9) * w * GRAIN) / GRAIN


def _gradients(bag_seed: int | None, share: float):
    """Probabilities, gradients and hessians from the scores, and which rows the round takes; made anew in
    every pass, which costs less than keeping them in the blocks."""
    def run(block):
        p = _probability(block["raw"])
        g, h = _slopes(p, block["y"], block["w"])
        return block | {"p": p, "g": g, "h": h, "use": _taken(block["key"], block["val"], bag_seed, share)}
    return run


def _score_counts(block) -> np.ndarray:
    """Positive and negative validation rows per range of the score."""
    return _range_counts(block["p"][block["val"]], block["y"][block["val"]] > 0)


def _range_counts(p: np.ndarray, y: np.ndarray) -> np.ndarray:
    at = np.minimum((p * AUC_RANGES).astype(np.int64), AUC_RANGES - 1)
    both = np.bincount(2 * at + y, minlength=2 * AUC_RANGES)
    return np.array([both[1::2], both[::2]])


def _tables(tree: Tree, nodes: list[int], features: list[int], bins: int, curve: bool):
    """Task sums: an array (node, feature, bin, [g, h, n]) and the validation scores' counts."""
    def run(blocks):
        place = np.full(len(tree.n), -1)
        place[nodes] = np.arange(len(nodes))
        out = np.zeros((len(features), 3, len(nodes) * bins))
        scores = np.zeros((2, AUC_RANGES)) if curve else None
        for b in blocks:
            leaf = place[tree.leaf_of(b["x"])]
            rows = np.flatnonzero((leaf >= 0) & b["use"])
            base, g, h = leaf[rows] * bins, b["g"][rows], b["h"][rows]
            for i, f in enumerate(features):
                k = base + b["x"][:, f][rows]
                for j, v in enumerate((g, h, None)):
                    out[i, j] += np.bincount(k, v, len(nodes) * bins)
            if curve:
                scores += _score_counts(b)
        yield out.reshape(len(features), 3, len(nodes), bins).transpose(2, 0, 3, 1), scores
    return run


def _merge(a, b):
    return a[0] + b[0], None if a[1] is None else a[1] + b[1]


def _auc(scores: np.ndarray) -> float:
    pos, neg = scores
    if not pos.sum() or not neg.sum():
        return 0.0
    return float((pos * (np.cumsum(neg) - neg / 2)).sum() / (pos.sum() * neg.sum()))


@dataclass
class Penalty:
    """What a leaf costs: L1, L2, least rows and least hessian."""

    l1: float
    l2: float
    rows: int
    hessian: float = 1e-3

    def score(self, g, h):
        g = np.maximum(np.abs(g) - self.l1, 0.0)
        return g * g / (h + self.l2)

    def value(self, g: float, h: float) -> float:
        return -math.copysign(max(abs(g) - self.l1, 0.0), g) / (h + self.l2)

    def best(self, table: np.ndarray, features: list[int]):
        """(gain, feature, cut, left sums, right sums) of a leaf's table (feature, bin, [g, h, n]), or None.

        Of equal gains the first feature and bin count."""
        left = np.cumsum(table.transpose(2, 0, 1), axis=2)[..., :-1]
        whole = table[0].sum(axis=0)
        right = whole[:, None, None] - left
        ok = (left[2] >= self.rows) & (right[2] >= self.rows) & (left[1] >= self.hessian) & (right[1] >= self.hessian)
        gain = np.where(ok, self.score(left[0], left[1]) + self.score(right[0], right[1]), 0.0)
        gain = np.where(ok, gain - self.score(whole[0], whole[1]), -1.0)
        if not gain.size or gain.max() <= 0.0:
            return None
        i, c = np.unravel_index(np.argmax(gain), gain.shape)
        return float(gain[i, c]), features[i], int(c), left[:, i, c], right[:, i, c]


def grow(tables, features: list[int], penalty: Penalty, leaves: int, rate: float, curve: bool = False, local=None, n_rows: int = 0,
         ahead: bool = True):
    """One tree, best-first. ``tables(tree, nodes, curve)`` gives the merged sums of those leaves;
    ``local(tree, nodes, splits, curve)`` the trees below leaves of at most ``LOCAL_ROWS`` rows.

    Gains of a pass are those of all children that could become leaves; the next split is the
    largest known one, and a new pass starts when a chosen leaf's children are not known yet.
    Without ``ahead`` only that leaf's children are counted: for tables that cost by their rows, not by the pass.
    """
    tree = Tree()
    tree.add(0.0, n_rows)
    known, best, kids = {}, {}, {}       # sums and best split of a node; children of the nodes whose children are known
    scores = None

    def graft(at: int, part: Tree, v: int = 0) -> None:
        tree.value[at], tree.n[at] = part.value[v], part.n[v]
        best[at] = None
        if part.left[v] >= 0:
            pair = tree.add(0.0, 0), tree.add(0.0, 0)
            tree.feature[at], tree.cut[at], tree.left[at], tree.right[at], tree.gain[at] = part.feature[v], part.cut[v], *pair, part.gain[v]
            kids[at], best[at] = pair, (part.gain[v],)
            graft(pair[0], part, part.left[v])
            graft(pair[1], part, part.right[v])

    def take() -> tuple[list[int], list[int]]:
        """The best-first tree over what is known: the nodes it splits, and those whose children are needed."""
        open_, used = [0], []
        while len(open_) < leaves:
            can = [v for v in open_ if best[v]]
            if not can:
                break
            v = max(can, key=lambda u: (best[u][0], -u))
            if v not in kids:
                # every leaf that may still be taken is split in the same pass
                room = leaves - len(open_) if ahead else 1
                return used, sorted((u for u in can if u not in kids), key=lambda u: -best[u][0])[:room]
            used.append(v)
            open_.remove(v)
            open_.extend(kids[v])
        return used, []

    if local and n_rows <= LOCAL_ROWS:
        found, scores = local(tree, [0], leaves - 1, curve)
        graft(0, found[0])
    else:
        found, scores = tables(tree, [0], curve)
        known[0], best[0] = found[0], penalty.best(found[0], features)
        g, h, n = found[0][0].sum(axis=0)
        tree.value[0], tree.n[0] = rate * penalty.value(g, h), int(n)
    used, need = take()
    while need:
        count, small = [], []
        more = len(used) < leaves - 2           # the children of the last split are leaves
        for v in need:
            gain, f, c, a, b = best[v]
            pair = [tree.add(rate * penalty.value(s[0], s[1]), int(s[2])) for s in (a, b)]
            kids[v] = tuple(pair)
            tree.feature[v], tree.cut[v], tree.left[v], tree.right[v], tree.gain[v] = f, c, *pair, gain
            low, high = pair if a[2] <= b[2] else pair[::-1]
            if more and (not local or tree.n[high] > LOCAL_ROWS):
                count.append((v, low, high))
            small += [u for u in pair if more and local and tree.n[u] <= LOCAL_ROWS]
        if count:
            for (v, low, high), t in zip(count, tables(tree, [low for _, low, _ in count], False)[0]):
                for u, sums in ((low, t), (high, known[v] - t)):
                    known[u], best[u] = sums, penalty.best(sums, features)
        if small:
            for u, part in local(tree, small, leaves - 1 - len(used), False)[0].items():
                graft(u, part)
        used, need = take()
    return _prune(tree, set(used)), scores


def _grains(v: np.ndarray) -> np.ndarray:
    """Multiples of 1 / GRAIN as whole numbers, of four bytes where they fit: what is dealt to other tasks."""
    v = v * GRAIN
    return v.astype(np.int32) if not len(v) or np.abs(v).max() < 1 << 31 else v


def _rows_of(tree: Tree, nodes: list[int], features: list[int], curve: bool):
    """(node, rows) of the given leaves, and (-1, the validation scores' counts)."""
    def run(blocks):
        for b in blocks:
            leaf = np.where(b["use"], tree.leaf_of(b["x"]), -1)
            for v in nodes:
                rows = np.flatnonzero(leaf == v)
                if len(rows):
                    yield v, (np.array([b["x"][:, f][rows] for f in features]), _grains(b["g"][rows]), _grains(b["h"][rows]))
            if curve:
                yield -1, _score_counts(b)
    return run


def _below(features: list[int], penalty: Penalty, splits: int, rate: float, bins: int):
    """The best-first tree of one small leaf from all its rows."""
    def run(pair):
        node, parts = pair
        parts = list(parts)
        if node < 0:
            return node, sum(parts)
        x, g, h = (np.concatenate(c, axis=-1) for c in zip(*parts))
        return node, _grow_rows(x, g / GRAIN, h / GRAIN, features, penalty, splits + 1, rate, bins)
    return run


def _grow_rows(x, g: np.ndarray, h: np.ndarray, features: list[int], penalty: Penalty, leaves: int, rate: float, bins: int,
               merge=None) -> Tree:
    """The best-first tree of rows that lie in one task; ``x`` has the bins of each of ``features``. With ``merge``, which adds
    the tables of the other tasks, that of all tasks' rows."""
    place = {f: i for i, f in enumerate(features)}
    where = {0: None}                    # rows of an open node; None: all

    def tables(tree, nodes, _):
        out = np.zeros((len(nodes), len(features), 3, bins))
        for v, sums in zip(nodes, out):
            if v:
                # of every split one child is asked for: its parent's rows are dealt to both
                up = tree.left.index(v) if v in tree.left else tree.right.index(v)
                r, bin_ = where.pop(up), x[place[tree.feature[up]]]
                low = (bin_ if r is None else bin_.take(r)) <= tree.cut[up]
                for child, side in ((tree.left[up], low), (tree.right[up], ~low)):
                    at = np.flatnonzero(side)
                    where[child] = at if r is None else r.take(at)
            r = where[v]
            for at in range(0, len(g) if r is None else len(r), SLICE_ROWS):
                part = slice(at, at + SLICE_ROWS)
                weights = (g[part], h[part], None) if r is None else (g.take(r[part]), h.take(r[part]), None)
                for i in range(len(features)):
                    k = (x[i][part] if r is None else x[i].take(r[part])).astype(np.intp)        # once, not in every count
                    for j, w in enumerate(weights):
                        sums[i, j] += np.bincount(k, w, bins)
        return (merge(out) if merge else out).transpose(0, 1, 3, 2), None

    return grow(tables, features, penalty, leaves, rate, ahead=merge is not None)[0]


class _Mail:
    """Arrays of doubles that tasks running at once hand to each other, as files of a folder all of them see."""

    def __init__(self, folder: str, me: int, tasks: int):
        self.folder, self.me, self.tasks, self.turn, self.sent = folder, me, tasks, 0, []
        self.last = False               # set by a task that wants to end; after a sum, whether any does
        os.makedirs(folder, exist_ok=True)

    def _send(self, a: np.ndarray) -> None:
        path = f"{self.folder}/{self.turn}-{self.me}"
        a.tofile(f"{path}.part")
        os.replace(f"{path}.part", path)        # seen as a whole or not at all
        self.sent.append(path)

    def _add(self, total: np.ndarray) -> np.ndarray:
        for task in range(self.tasks):
            if task != self.me:
                path, until = f"{self.folder}/{self.turn}-{task}", time.monotonic() + MAIL_SECONDS
                while not os.path.exists(path):
                    if time.monotonic() > until:
                        raise TimeoutError(f"no table of task {task} at {path}")
                    time.sleep(0.0005)
                total = total + np.fromfile(path).reshape(total.shape)
        return total

    def sum(self, a: np.ndarray) -> np.ndarray:
        """The sum over all tasks. All of them have read what was sent before: it is deleted."""
        old, self.sent = self.sent, []
        mine = np.append(a.ravel(), float(self.last))
        self._send(mine)
        total = self._add(mine)
        for path in old:
            os.remove(path)
        self.turn += 1
        self.last = bool(total[-1] > 0)
        return total[:-1].reshape(a.shape)

    def sum_at_first(self, a: np.ndarray) -> np.ndarray | None:
        """The same for task 0 only; the others go on."""
        if self.me:
            self._send(a)
        total = None if self.me else self._add(a)
        self.turn += 1
        return total


def _add_values(raw: np.ndarray, tree: Tree, x: np.ndarray) -> None:
    """Adds a tree's values to the scores, in place; ``x`` has a row for every feature."""
    value, leaf_of = np.array(tree.value), tree.look_ups() if len(tree.n) < 2 * 64 else tree.leaf_of
    for i in range(0, len(raw), SLICE_ROWS):
        raw[i:i + SLICE_ROWS] += value.take(leaf_of(x[:, i:i + SLICE_ROWS].T))


def _slopes_of(raw: np.ndarray, rows: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients and hessians of the given rows; ``y`` and ``w`` are theirs."""
    g, h = np.empty(len(rows)), np.empty(len(rows))
    for i in range(0, len(rows), SLICE_ROWS):
        s = slice(i, i + SLICE_ROWS)
        g[s], h[s] = _slopes(_probability(raw.take(rows[s])), y[s], w[s])
    return g, h


def _kept(curve: list[float]) -> int:
    """How many rounds are kept: those up to the first best AUC."""
    return int(np.argmax(curve)) + 1


def _together(plan: list, first: int, last: int, before: list, start: float, penalty: Penalty, leaves: int, rate: float,
              bins: int, row_share: float, has_val: bool, patience: int, every: bool, folder: str, tasks: int):
    """Rounds ``first`` to ``last - 1``, or to the one that ends training, in ``tasks`` tasks that run at once; task 0 gives
    (tree, AUC of the trees before) of each. ``before`` has those of the rounds before: a task that is run again needs
    nothing that another one kept. ``every``: all rows and features are taken."""
    def run(blocks):
        ctx = BarrierTaskContext.get()
        box = ctx.allGather(uuid.uuid4().hex[:12])[0]          # a second try finds no tables of the first
        mail = _Mail(f"{folder}/{first}-{box}", ctx.partitionId(), tasks)
        blocks = list(blocks)
        width = max((b["x"].shape[1] for b in blocks), default=1 + max(max(chosen) for chosen, _ in plan))
        x = np.concatenate([np.empty((width, 0), np.uint8), *(b["x"].T for b in blocks)], axis=1)
        y, w, val, key = (np.concatenate([np.empty(0, kind), *(b[c] for b in blocks)])
                          for c, kind in (("y", float), ("w", float), ("val", bool), ("key", np.int64)))
        del blocks
        raw, bag, curve = np.full(len(y), start), None, [auc for _, auc in before[1:]]
        judged, bad = np.flatnonzero(val), y[val] > 0
        for tree, _ in before:
            _add_values(raw, tree, x)
        for t in range(first, last):
            chosen, seed = plan[t]
            scores = mail.sum_at_first(_range_counts(_probability(raw.take(judged)), bad).astype(float)) if has_val else None
            auc = None if scores is None else _auc(scores)
            if t and auc is not None:
                curve.append(auc)
                mail.last = t - _kept(curve) >= patience
            grown = None
            if t < len(plan) - 1:
                if seed != bag:
                    bag, rows = seed, np.flatnonzero(_taken(key, val, seed, row_share))
                    taken = x.take(rows, axis=1), y.take(rows), w.take(rows)
                g, h = _slopes_of(raw, rows, *taken[1:])
                grown = _grow_rows([taken[0][f] for f in chosen], g, h, chosen, penalty, leaves, rate, bins, mail.sum)
                _add_values(raw, grown, x)
            if not mail.me:
                yield grown, auc
            if mail.last or grown and grown.left[0] < 0 and every:
                break
    return run


def _mounted(path: str) -> str | None:
    """The folder of a checkpoint path that Python opens as well."""
    found = re.fullmatch("(?:file:(?://)?)?(/.*)", path)
    return found[1] if found else None


def _slots(spark: SparkSession) -> int:
    """How many tasks run at once; 0 if that changes or is not known."""
    sc = spark.sparkContext
    if sc.getConf().get("spark.dynamicAllocation.enabled", "false").lower() == "true":
        return 0
    try:
        own = sc._jsc.sc()
        return own.maxNumConcurrentTasks(own.resourceProfileManager().defaultResourceProfile())
    except (Py4JError, AttributeError):
        return 0


def _rounds(plan: list, first: int, last: int, tree: Tree | None, start: float, penalty: Penalty, leaves: int, rate: float,
            bins: int, row_share: float, has_val: bool):
    """Rounds ``first`` to ``last - 1`` in the one partition there is: its blocks with their new scores, and a list with
    (tree, AUC of the trees before) of every round. ``plan`` has each round's features and seed; round len(plan) - 1 only scores."""
    def run(blocks):
        blocks, out, grown, bag = list(blocks), [], tree, None
        x = np.concatenate([b["x"].T for b in blocks], axis=1)
        y, w, val, key = (np.concatenate([b[c] for b in blocks]) for c in ("y", "w", "val", "key"))
        raw = np.concatenate([b["raw"] for b in blocks]) if tree else np.full(len(y), start)
        judged, bad = np.flatnonzero(val), y[val] > 0
        for t in range(first, last):
            chosen, seed = plan[t]
            if grown:
                raw += np.array(grown.value).take(grown.leaf_of(x.T))
            auc = _auc(_range_counts(_probability(raw.take(judged)), bad)) if has_val else None
            grown = None
            if t < len(plan) - 1:
                if seed != bag:              # the rows are the same for some rounds
                    bag, rows = seed, np.flatnonzero(_taken(key, val, seed, row_share))
                    taken = x.take(rows, axis=1), y.take(rows), w.take(rows)
                g, h = _slopes(_probability(raw.take(rows)), *taken[1:])
                grown = _grow_rows([taken[0][f] for f in chosen], g, h, chosen, penalty, leaves, rate, bins)
            out.append((grown, auc))
        ends = np.cumsum([len(b["y"]) for b in blocks])
        for b, part in zip(blocks, np.split(raw, ends[:-1])):
            yield b | {"raw": part}
        yield out
    return run


def _prune(tree: Tree, used: set[int]) -> Tree:
    """The part of a tree that splits the ``used`` nodes only, numbered anew in depth-first order."""
    out = Tree()

    def copy(v: int) -> int:
        u = out.add(tree.value[v], tree.n[v])
        if v in used:
            out.feature[u], out.cut[u], out.gain[u] = tree.feature[v], tree.cut[v], tree.gain[v]
            out.left[u] = copy(tree.left[v])
            out.right[u] = copy(tree.right[v])
        return u

    copy(0)
    return out


class BoostedModel:
    """Trees with real thresholds. ``transform`` adds ``score`` = P(y = 1)."""

    def __init__(self, features: list[str], start: float, trees: list[dict], curve: list[float] | None = None):
        self.features, self.start, self.trees, self.curve = features, start, trees, curve or []

    @property
    def rounds(self) -> int:
        return len(self.trees)

    def binned(self) -> tuple[list[np.ndarray], list[Tree]]:
        """The thresholds of every feature, ascending, and the trees with positions among them for thresholds: a value
        is at most a threshold where no more thresholds lie below it than below that one. A missing value is above all."""
        cuts = [np.unique([c for t in self.trees for g, c in zip(t["feature"], t["threshold"]) if g == f]) for f in self.features]
        place = {f: i for i, f in enumerate(self.features)}
        return cuts, [Tree([place.get(f, -1) for f in t["feature"]],
                           [int(np.searchsorted(cuts[place[f]], c)) if f in place else 0 for f, c in zip(t["feature"], t["threshold"])],
                           t["left"], t["right"], t["value"], t["gain"], t["n"]) for t in self.trees]

    def transform(self, df: DataFrame) -> DataFrame:
        start, (cuts, trees) = self.start, self.binned()

        @F.pandas_udf("double")
        def p(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            fits = all(len(c) < 256 for c in cuts)
            steps = [(np.array(t.value), t.look_ups() if fits and len(t.n) < 2 * 64 else t.leaf_of) for t in trees]
            for cols in batches:
                cols = (cols,) if isinstance(cols, pd.Series) else cols          # one feature comes alone
                x = np.empty((len(cols), len(cols[0])), dtype=np.uint8 if fits else np.int64)
                for i, (c, cut) in enumerate(zip(cols, cuts)):
                    x[i] = np.searchsorted(cut, c.to_numpy(dtype=np.float64, na_value=np.nan))
                raw = np.full(x.shape[1], start)
                for value, leaf_of in steps:
                    raw += value.take(leaf_of(x.T))
                yield pd.Series(1.0 / (1.0 + np.exp(-raw)))
        # as if not deterministic: a filter on the score would be made below it, by scoring all rows once more
        return df.withColumn("score", p.asNondeterministic()(*(F.col(f).cast("double") for f in self.features)))

    def table(self, spark: SparkSession) -> DataFrame:
        """One row per node; leaves have left = -1. Node -1 of tree -1 holds the starting score."""
        rows = [(-1, -1, None, None, -1, -1, self.start, None, None)]
        for i, t in enumerate(self.trees):
            rows += [(i, j, *r) for j, r in enumerate(zip(t["feature"], t["threshold"], t["left"], t["right"], t["value"], t["gain"], t["n"]))]
        return spark.createDataFrame(rows, TREE_SCHEMA)

    def split_counts(self) -> dict[str, int]:
        """How often each feature is split."""
        out = dict.fromkeys(self.features, 0)
        for t in self.trees:
            for f in t["feature"]:
                if f is not None:
                    out[f] += 1
        return out

    def save(self, spark: SparkSession, path: str) -> None:
        self.table(spark).write.mode("overwrite").parquet(f"{path}/trees")
        spark.createDataFrame([(i, f) for i, f in enumerate(self.features)], "position int, feature string").write.mode("overwrite").parquet(f"{path}/features")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "BoostedModel":
        features = [r["feature"] for r in spark.read.parquet(f"{path}/features").orderBy("position").collect()]
        trees, start = [], 0.0
        for r in spark.read.parquet(f"{path}/trees").orderBy("tree", "node").collect():      # rounds x leaves rows
            if r["tree"] < 0:
                start = r["value"]
                continue
            if r["node"] == 0:
                trees.append({k: [] for k in ("feature", "threshold", "left", "right", "value", "gain", "n")})
            for k, v in trees[-1].items():
                v.append(r[k])
        return cls(features, start, trees)


def fit(data: DataFrame, features: list[str], *, weight: str = "w_pos", rounds: int = 500, leaves: int = 31, rate: float = 0.05,
        min_rows: int = 50, l1: float = 0.1, l2: float = 0.1, feature_share: float = 0.8, row_share: float = 0.8,
        row_every: int = 5, patience: int = 50, max_bins: int = 255, seed: int = 42) -> BoostedModel:
    """Train on the rows with split = train, stop by those with split = val."""
    root = _mounted(checkpoint_root(data.sparkSession))
    data = data.where(F.col("split").isin("train", "val"))
    train = data.where(F.col("split") == "train")
    row = train.agg(F.sum(F.col(weight) * F.col("y")).alias("p"), F.sum(weight).alias("n"),
                    F.count(F.lit(1)).alias("rows")).first()
    n_train = row["rows"]
    share = min(max((row["p"] or 0.0) / (row["n"] or 1.0), 1e-12), 1 - 1e-12)
    start = math.log(share / (1.0 - share))
    edges = _edges(train, features, max_bins)
    bins = max((len(e) for e in edges), default=0) + 1
    penalty = Penalty(l1, l2, min_rows)
    blocks, tasks, one, gang = _blocks(data, features, edges, weight)
    depth = max(2, math.ceil(math.log(max(tasks, 2), 8)))       # about eight tables meet at the driver
    has_val = data.where(F.col("split") == "val").limit(1).count() > 0
    rnd = np.random.default_rng(seed)
    plan = [(sorted(rnd.choice(len(features), max(1, round(feature_share * len(features))), replace=False).tolist()), seed + t // row_every + 1)
            for t in range(rounds + 1)]
    every = row_share >= 1.0 and feature_share >= 1.0

    def alone():
        """(tree, AUC of the trees before) of each round, where there is one partition."""
        state, tree = blocks.persist(StorageLevel.MEMORY_AND_DISK), None
        try:
            for t in range(0, rounds + 1, CUT_ROUNDS):
                old, made = state, state.mapPartitions(_rounds(plan, t, min(t + CUT_ROUNDS, rounds + 1), tree, start, penalty, leaves, rate,
                                                               bins, row_share, has_val)).persist(StorageLevel.MEMORY_AND_DISK)
                made.checkpoint()
                out = made.filter(lambda r: isinstance(r, list)).collect()[0]
                old.unpersist()
                state, tree = made.filter(lambda r: not isinstance(r, list)).persist(StorageLevel.MEMORY_AND_DISK), out[-1][0]
                state.count()
                made.unpersist()
                yield from out
        finally:
            state.unpersist()

    def together():
        """The same by tasks that run at once, each with a part of the rows."""
        folder = f"{root}/boosting-{uuid.uuid4().hex[:12]}"
        state, done = blocks.persist(StorageLevel.MEMORY_AND_DISK), []
        try:
            state.count()
            while len(done) <= rounds:
                t = len(done)
                out = state.barrier().mapPartitions(_together(plan, t, min(t + GANG_ROUNDS, rounds + 1), list(done), start, penalty, leaves, rate, bins,
                                                              row_share, has_val, patience, every, folder, tasks)).collect()
                done += out
                yield from out
        except Py4JJavaError:
            logging.getLogger(__name__).warning("boosting goes on by passes after round %d", len(done), exc_info=True)
            for t, step in enumerate(spread()):
                if t >= len(done):
                    yield step
        finally:
            state.unpersist()
            shutil.rmtree(folder, ignore_errors=True)

    def spread():
        """The same by passes over many partitions."""
        state, old, tree = blocks.persist(StorageLevel.MEMORY_AND_DISK), None, None
        try:
            for t, (chosen, bag) in enumerate(plan):
                old, state = state, state.map(_advance(tree, start)).persist(StorageLevel.MEMORY_AND_DISK)
                if t and t % CUT_ROUNDS == 0:
                    state.checkpoint()
                now = state.map(_gradients(bag, row_share))

                def tables(part, nodes, with_curve):
                    size = 8 * (3 * len(nodes) * len(chosen) * bins + 2 * AUC_RANGES * with_curve)
                    return now.mapPartitions(_tables(part, nodes, chosen, bins, with_curve)).treeReduce(_merge, 1 if tasks * size <= DRIVER_BYTES else depth)

                def local(part, nodes, splits, with_curve):
                    found = dict(now.mapPartitions(_rows_of(part, nodes, chosen, with_curve)).groupByKey(min(tasks, len(nodes) + with_curve))
                                 .map(_below(chosen, penalty, splits, rate, bins)).collect())
                    scores = found.pop(-1, None)
                    return {v: found.get(v) or Tree([-1], [0], [-1], [-1], [0.0], [0.0], [0]) for v in nodes}, scores

                if t < rounds:
                    tree, scores = grow(tables, chosen, penalty, leaves, rate, has_val, local, n_train)
                else:
                    tree, scores = None, tables(Tree([-1], [0], [-1], [-1], [0.0], [0.0], [0]), [0], True)[1] if has_val else None
                old.unpersist()
                yield tree, _auc(scores) if has_val else None
        finally:
            state.unpersist()

    trees, curve, kept = [], [], 0
    steps = alone() if one else together() if gang and root else spread()
    for t, (grown, auc) in enumerate(steps):
        if t and has_val:
            curve.append(auc)
            kept = _kept(curve)
            if t - kept >= patience:
                break
        # a root without a split only shifts all scores: nothing further to learn from these rows
        if grown is None or (grown.left[0] < 0 and every):
            break
        trees.append(grown)
    steps.close()
    trees = trees[:kept] if has_val else trees
    real = [{"feature": [features[f] if f >= 0 else None for f in t.feature],
             "threshold": [float(edges[f][c]) if f >= 0 else None for f, c in zip(t.feature, t.cut)],
             "left": t.left, "right": t.right, "value": [float(v) for v in t.value], "gain": t.gain, "n": t.n} for t in trees]
    return BoostedModel(features, start, real, curve)
