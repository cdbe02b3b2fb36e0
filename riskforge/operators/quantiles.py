"""Exact order statistics and quantiles, computed without a global sort.

Why not ``percentile``: Spark's exact ``percentile`` keeps a value -> count map
of a whole group in one aggregation buffer, so a high-cardinality feature at
scale ends in one task. Why not only ``percentile_approx``: its results are data
values, not the interpolated quantiles used for bin edges.

Method, for all targets of all groups together, in two scans of most tables:

1. Mergeable quantile summaries (``percentile_approx``: partial summaries in
   the tasks, merged by Spark) of all groups in one aggregate. Two of its values
   around a wanted rank, twice the summary's rank error apart from it, bracket it.
2. The rows are counted between and at those values (binary search of a whole
   Arrow batch at once, one batch's counts a group, added up by Spark). Where a bracket
   holds few rows its values are counted one by one in the same scan, which settles its ranks.

What is still open (brackets of very large tables, or a rank beside its bracket)
goes on in rounds over the rows inside its interval only; each has two scans:

1. A random sample of the values inside the intervals, about ``SPLITTERS`` a
   group, is brought to the driver. An interval with few rows is "sampled" with
   probability 1: its histogram is complete and settles its ranks.
2. The rows of the other intervals are counted between and at the sampled
   values. A rank on a sampled value is settled, any other goes on in the interval
   between its two neighbours.

A round divides the rows of an interval by about ``SPLITTERS`` over the number
of intervals of its group, so the number of rounds is about
log(rows / SUMMARY) / log(SPLITTERS / targets): it depends neither on the number of
groups nor on the values. The result is exact whatever summary and sample say. What
reaches the driver is at most about ``SPLITTERS + KEEP`` x targets values a group. A
value that holds a large share of the rows is a bound or in the sample and settled by
its own count.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPLITTERS = 4096    # sampled values of a group in a round
KEEP = 512          # rows of an interval that are taken as they are
SUMMARY = 10_000    # the summaries' ranks are within rows / SUMMARY


@dataclass
class _Interval:
    lo: Any                      # closed bounds
    hi: Any
    below: int                   # values < lo
    size: int                    # values inside
    ranks: list[int] = field(default_factory=list)


def group_counts(df: DataFrame, groups: dict[str, Column]) -> dict[str, int]:
    """Non-null count of every group expression, in one aggregate."""
    if not groups:
        return {}
    row = df.agg(*[F.count(c).alias(f"n{i}") for i, c in enumerate(groups.values())]).first()
    return {k: int(row[f"n{i}"]) for i, k in enumerate(groups)}


def _family(dtype: T.DataType) -> str:
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "long"
    if isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType)):
        return "double"
    raise TypeError(f"order statistics need a numeric key, got {dtype.simpleString()}")


def _ends(family: str) -> tuple[Any, Any]:
    return (-(1 << 63), (1 << 63) - 1) if family == "long" else (-math.inf, math.inf)


def _after(v: Any, family: str) -> Any:
    return int(v) + 1 if family == "long" else float(np.nextafter(v, math.inf))


def _before(v: Any, family: str) -> Any:
    return int(v) - 1 if family == "long" else float(np.nextafter(v, -math.inf))


def order_stats(df: DataFrame, groups: dict[str, Column], ranks: dict[str, list[int]],
                counts: dict[str, int] | None = None) -> dict[tuple[str, int], tuple[Any, int]]:
    """Value at each 0-based rank of each group (ascending, nulls ignored).

    ``groups`` maps a name to a numeric column expression (null = not in the
    group). Returns ``{(group, rank): (value, number of values below it)}``.
    """
    counts = counts if counts is not None else group_counts(df, groups)
    names = {g: f"g{i}" for i, g in enumerate(groups)}
    proj = df.select(*[c.alias(names[g]) for g, c in groups.items()])
    fam = {g: _family(proj.schema[names[g]].dataType) for g in groups}
    open_: dict[str, list[_Interval]] = {}
    for g, rs in ranks.items():
        rs = sorted(set(int(x) for x in rs))
        if rs and not 0 <= rs[0] <= rs[-1] < counts[g]:
            raise ValueError(f"ranks {rs[0]}..{rs[-1]} outside 0..{counts[g] - 1} for {g}")
        if rs:
            open_[g] = [_Interval(*_ends(fam[g]), 0, counts[g], rs)]
    found: dict[tuple[str, int], tuple[Any, int]] = {}
    for family in ("long", "double"):
        mine = {g: iv[0] for g, iv in open_.items() if fam[g] == family}
        if mine:
            open_ = {g: iv for g, iv in open_.items() if g not in mine} | _bracket(proj, names, family, mine, found)
    seed = 0
    while open_:
        seed += 1
        for family in ("long", "double"):
            mine = {g: open_.pop(g) for g in list(open_) if fam[g] == family}
            if mine:
                open_ |= _round(proj, names, family, mine, found, seed)
    return found


def _bracket(proj: DataFrame, names: dict[str, str], family: str, whole: dict[str, _Interval],
             found: dict) -> dict[str, list[_Interval]]:
    """What is open after the summaries and one counting scan; settled ranks go to ``found``."""
    kind = {"long": "bigint", "double": "double"}[family]
    aggs, around = [], {}
    for g, i in whole.items():
        slack = 2 * i.size // SUMMARY + 1
        around[g] = [(max(r - slack, 0) / i.size, min(r + slack, i.size) / i.size) for r in i.ranks]
        shares = sorted({p for pair in around[g] for p in pair})
        aggs.append(F.map_from_arrays(F.array(*map(F.lit, shares)), F.percentile_approx(
            F.col(names[g]).cast(kind), F.array(*map(F.lit, shares)), SUMMARY)).alias(names[g]))
    row = proj.agg(*aggs).first()
    points, inner = {}, {}
    for g, i in whole.items():
        values = row[names[g]]
        points[g] = np.unique(np.array(list(values.values()), dtype=np.int64 if family == "long" else np.float64))
        inner[g] = np.zeros(len(points[g]) + 1, dtype=bool)
        for lo, hi in around[g]:
            a, b = np.searchsorted(points[g], [values[lo], values[hi]])
            inner[g][a + 1:b + 1] = True
        # values are taken one by one where all brackets together hold few rows
        inner[g] &= (4 * i.size // SUMMARY + 2) * len(i.ranks) <= SPLITTERS
    counted = _counted(proj, names, family, list(whole), "cell", _at_points(points, inner))
    parts = dict(list(counted.groupby("grp")))
    left = {}
    for g, i in whole.items():
        part = parts[names[g]]
        cells = part.groupby("cell", as_index=False)["n"].sum()
        n = np.zeros(2 * len(points[g]) + 1, dtype=np.int64)
        n[cells["cell"].to_numpy()] = cells["n"].to_numpy()
        edge = np.concatenate([[0], np.cumsum(n)])
        rest = []
        for r in i.ranks:
            at = int(np.searchsorted(edge, r, side="right")) - 1
            if at % 2 or not inner[g][at // 2]:
                rest.append(r)
                continue
            own = part[part["cell"] == at].sort_values("v")
            upto = edge[at] + np.concatenate([[0], np.cumsum(own["n"].to_numpy())])
            j = int(np.searchsorted(upto, r, side="right")) - 1
            v = own["v"].to_numpy()[j]
            found[g, r] = (int(v) if family == "long" else float(v)), int(upto[j])
        left[g] = _narrow(g, family, [_Interval(i.lo, i.hi, 0, i.size, rest)], [points[g]], [cells], found)
    return {g: iv for g, iv in left.items() if iv}


def _round(proj: DataFrame, names: dict[str, str], family: str, open_: dict[str, list[_Interval]],
           found: dict, seed: int) -> dict[str, list[_Interval]]:
    """One round: what is still open afterwards; settled ranks go to ``found``."""
    quota = {g: max(32, SPLITTERS // len(iv)) for g, iv in open_.items()}
    share = {g: [1.0 if i.size <= max(KEEP, quota[g]) else quota[g] / i.size for i in iv] for g, iv in open_.items()}
    sample = _counted(proj, names, family, list(open_), "k", _drawn(family, open_, share, seed))
    drawn = {key: part.sort_values("v") for key, part in sample.groupby(["grp", "k"])}
    rest: dict[str, list[_Interval]] = {}
    points: dict[str, list[np.ndarray]] = {}
    for g, iv in open_.items():
        for j, i in enumerate(iv):
            part = drawn.get((names[g], j + 1))
            values = part["v"].to_numpy() if part is not None else np.zeros(0, np.int64 if family == "long" else np.float64)
            if share[g][j] == 1.0:
                edge = i.below + np.concatenate([[0], np.cumsum(part["n"].to_numpy())])
                for r in i.ranks:
                    at = int(np.searchsorted(edge, r, side="right")) - 1
                    found[g, r] = values[at].item(), int(edge[at])
            else:
                rest.setdefault(g, []).append(i)
                points.setdefault(g, []).append(values)
    if not rest:
        return {}
    every = {g: np.concatenate(p) for g, p in points.items()}
    counted = _counted(proj, names, family, list(rest), "kc", _in_intervals(family, rest, every))
    width = counted["grp"].map({names[g]: 2 * len(p) + 1 for g, p in every.items()})
    counted["k"], counted["cell"] = counted["kc"] // width, counted["kc"] % width
    cells = {key: part for key, part in counted.groupby(["grp", "k"])}
    left = {g: _narrow(g, family, iv, points[g], [cells[names[g], j + 1] for j in range(len(iv))], found)
            for g, iv in rest.items()}
    return {g: iv for g, iv in left.items() if iv}


def _narrow(g: str, family: str, intervals: list[_Interval], points: list[np.ndarray], cells: list[pd.DataFrame],
            found: dict) -> list[_Interval]:
    out: list[_Interval] = []
    first = 0                                # splitters of the intervals before
    for i, s, c in zip(intervals, points, cells):
        n = np.zeros(2 * len(s) + 1, dtype=np.int64)
        n[c["cell"].to_numpy() - 2 * first] = c["n"].to_numpy()
        edge = i.below + np.concatenate([[0], np.cumsum(n)])
        first += len(s)
        for r in i.ranks:
            at = int(np.searchsorted(edge, r, side="right")) - 1
            k, on = divmod(at, 2)            # cell 2k lies below splitter k, cell 2k + 1 is splitter k
            if on:
                found[g, r] = s[k].item(), int(edge[at])
                continue
            lo = _after(s[k - 1], family) if k else i.lo
            hi = _before(s[k], family) if k < len(s) else i.hi
            if out and out[-1].lo == lo and out[-1].below == edge[at]:
                out[-1].ranks.append(r)
            else:
                out.append(_Interval(lo, hi, int(edge[at]), int(n[at]), [r]))
    return out


def _counted(proj: DataFrame, names: dict[str, str], family: str, groups: list[str], place: str, count) -> pd.DataFrame:
    """(grp, place, v, n): what ``count`` finds in one scan, added up by Spark; at most a few thousand rows a group.

    ``count(group)`` gives a function of a batch's values (those of the group that are not null) and its
    number, which yields (places, values, rows); a row that is only counted has value 0.
    """
    kind, arrow = {"long": ("bigint", pa.int64()), "double": ("double", pa.float64())}[family]
    steps = [(names[g], count(g)) for g in groups]

    def scan(batches):
        for at, b in enumerate(batches):
            parts = []
            for i, (name, step) in enumerate(steps):
                v = b.column(i).drop_null().to_numpy(zero_copy_only=False)
                for where, value, n in step(v[~np.isnan(v)] if family == "double" else v, at):
                    parts.append(pa.RecordBatch.from_arrays([pa.array([name] * len(where), pa.string()), pa.array(where, pa.int64()),
                                                             pa.array(value, arrow), pa.array(n, pa.int64())], names=["grp", place, "v", "n"]))
            if parts:
                yield from pa.Table.from_batches(parts).combine_chunks().to_batches()

    found = proj.select(*[F.col(names[g]).cast(kind).alias(names[g]) for g in groups]).mapInArrow(scan, f"grp string, {place} long, v {kind}, n long")
    return found.groupBy("grp", place, "v").agg(F.sum("n").alias("n")).toPandas()


def _cells(points: np.ndarray, v: np.ndarray) -> np.ndarray:
    """2k for a value below point k and above the one before, 2k + 1 for the point itself."""
    lt = np.searchsorted(points, v)
    return 2 * lt + (np.append(points, points[-1:])[lt] == v) * (lt < len(points)) if len(points) else 2 * lt


def _at_points(points: dict[str, np.ndarray], inner: dict[str, np.ndarray]):
    """Rows per cell; the values themselves in the cells marked ``inner``."""
    def of(g):
        p, w = points[g], inner[g]

        def step(v, at):
            cell = _cells(p, v)
            single = (cell % 2 == 0) & w[cell // 2]
            n = np.bincount(cell[~single], minlength=2 * len(p) + 1)
            where = np.flatnonzero(n)
            yield where, np.zeros(len(where), p.dtype), n[where]
            value, n = np.unique(v[single], return_counts=True)
            yield _cells(p, value), value, n
        return step
    return of


def _place(lo: np.ndarray, hi: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """1-based interval and value of the values that lie in one."""
    k = np.searchsorted(lo, v, side="right")
    ok = (k > 0) & (v <= hi[k - 1])
    return k[ok], v[ok]


def _bounds(family: str, iv: list[_Interval]) -> list[np.ndarray]:
    return [np.array(c, np.int64 if family == "long" else np.float64) for c in ([i.lo for i in iv], [i.hi for i in iv])]


def _drawn(family: str, open_: dict[str, list[_Interval]], share: dict[str, list[float]], seed: int):
    """Values inside the intervals, each row with its interval's probability."""
    def of(g):
        lo, hi = _bounds(family, open_[g])
        p = np.array(share[g])

        def step(v, at):
            k, v = _place(lo, hi, v)
            take = np.random.default_rng([seed, TaskContext.get().partitionId(), at]).random(len(v)) < p[k - 1]
            k, v = k[take], v[take]
            for j in np.unique(k):
                value, n = np.unique(v[k == j], return_counts=True)
                yield np.full(len(value), j), value, n
        return step
    return of


def _in_intervals(family: str, open_: dict[str, list[_Interval]], points: dict[str, np.ndarray]):
    """Rows per (interval, cell), as interval x cells + cell."""
    def of(g):
        lo, hi = _bounds(family, open_[g])
        p = points[g]

        def step(v, at):
            k, v = _place(lo, hi, v)
            where, n = np.unique(k * (2 * len(p) + 1) + _cells(p, v), return_counts=True)
            yield where, np.zeros(len(where), p.dtype), n
        return step
    return of


def interpolated_quantiles(df: DataFrame, groups: dict[str, Column], probs: list[float],
                           counts: dict[str, int] | None = None) -> dict[str, list[float]]:
    """Linear-interpolation quantiles (position (n-1)*p) of every group.

    Same definition as ``quantile_cont`` in SQL engines and numpy's default.
    Groups without values get an empty list.
    """
    counts = counts if counts is not None else group_counts(df, groups)
    ranks: dict[str, list[int]] = {}
    for g, n in counts.items():
        if n > 0:
            rs = []
            for p in probs:
                pos = (n - 1) * p
                rs += [math.floor(pos), math.ceil(pos)]
            ranks[g] = rs
    stats = order_stats(df, {g: groups[g] for g in ranks}, ranks, counts) if ranks else {}
    out: dict[str, list[float]] = {}
    for g, n in counts.items():
        if n == 0:
            out[g] = []
            continue
        qs = []
        for p in probs:
            pos = (n - 1) * p
            lo, hi = math.floor(pos), math.ceil(pos)
            a = float(stats[(g, lo)][0])
            if lo == hi:
                qs.append(a)
            else:
                b = float(stats[(g, hi)][0])
                qs.append(a + (b - a) * (pos - lo))
        out[g] = qs
    return out
