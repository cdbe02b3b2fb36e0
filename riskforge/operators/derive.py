"""Derived-table construction from a feature spec (SQL expressions).

One projection builds every feature; the spec's formula is always what runs.
``AGG(x) OVER (PARTITION BY a, f(b))`` and ``AGG(x) OVER ()`` inside a formula are
not run as windows, which would put all rows of a value (or all rows) in one
task: the aggregate is computed by a grouped aggregation (partial sums before
the shuffle) and joined back on its keys. Where they stand in a formula is read
off the tree that Spark's parser makes of it, so any nesting, FILTER, DISTINCT
and text literal is fine. The table of statistics has one row per distinct key
and is counted first: a small one is broadcast; of a larger one only the keys
with more than ``HOT_ROWS`` rows are broadcast, and all other rows join by key.
Windows with an ORDER BY or a frame are refused.

Rows whose target is null are dropped first, as in the reference CTAS
(aggregates therefore cover labelled rows only).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskforge.functions.templates import clean_names
from riskforge.session import materialize

BROADCAST_KEYS = 50_000     # rows of a statistics table that is broadcast
HOT_ROWS = 1 << 20          # a key with more rows than this is kept out of the shuffle


def split_windows(formula: str) -> tuple[str, list[tuple[str, tuple[str, ...]]]]:
    """The formula with every whole-partition aggregate replaced by ``{i}``-th
    placeholder ``__w<i>``, and the aggregates as (expression, partition keys)."""
    tree = SparkSession.active()._jsparkSession.sessionState().sqlParser().parseExpression(formula)
    found: list[tuple[int, int, str, tuple[str, ...]]] = []

    def text(node) -> tuple[int, int]:
        origin = node.origin()
        return origin.startIndex().get(), origin.stopIndex().get() + 1

    def each(seq):
        it = seq.iterator()
        while it.hasNext():
            yield it.next()

    def walk(node) -> None:
        kind = node.getClass().getSimpleName()
        if "WindowExpression" not in kind:
            for child in each(node.children()):
                walk(child)
            return
        start, end = text(node)
        spec = None if kind.startswith("Unresolved") else node.windowSpec()
        if spec is None or spec.orderSpec().nonEmpty() or spec.frameSpecification().getClass().getSimpleName() != "UnspecifiedFrame$":
            raise ValueError(f"only AGG(x) OVER (PARTITION BY ...) without order or frame can be run: {formula}")
        call = re.sub(r"\s+OVER\s*$", "", formula[start:text(spec)[0]], flags=re.I)
        keys = tuple(formula[slice(*text(k))] for k in each(spec.partitionSpec()))
        found.append((start, end, call, keys))

    walk(tree)
    found.sort()
    parts, at = [], 0
    for i, (start, end, _, _) in enumerate(found):
        parts += [formula[at:start], f"__w{i}"]
        at = end
    return "".join([*parts, formula[at:]]), [(call, keys) for _, _, call, keys in found]


def _join_statistics(df: DataFrame, keys: tuple[str, ...], aggs: dict[str, str], tag: str) -> DataFrame:
    """``df`` with the aggregates (name -> expression) of its rows' key groups."""
    exprs = [F.expr(e).alias(n) for n, e in aggs.items()]
    if not keys:
        row = df.agg(*exprs)
        one = row.first()
        return df.withColumns({n: F.lit(one[n]).cast(row.schema[n].dataType) for n in aggs})
    names, rows = [f"{tag}k{i}" for i in range(len(keys))], f"{tag}rows"
    stats = materialize(df.groupBy(*[F.expr(k).alias(n) for k, n in zip(keys, names)]).agg(*exprs, F.count(F.lit(1)).alias(rows)), "key-statistics")
    on = None
    for k, n in zip(keys, names):
        hit = F.expr(k).eqNullSafe(F.col(n))
        on = hit if on is None else on & hit
    if stats.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS:
        return df.join(F.broadcast(stats), on, "left").drop(*names, rows)
    hot = stats.where(F.col(rows) > HOT_ROWS).orderBy(F.col(rows).desc()).limit(BROADCAST_KEYS)
    if hot.isEmpty():
        return df.join(stats, on, "left").drop(*names, rows)
    hot = materialize(hot, "hot-keys")
    return (df.join(F.broadcast(hot), on).unionByName(df.join(F.broadcast(hot.select(*names)), on, "left_anti").join(stats, on, "left"))
            .drop(*names, rows))


def derive_table(df: DataFrame, features: list[dict], target_col: str, id_col: str = "pid",
                 time_col: str | None = "lend_tm", include_sources: bool = True,
                 keep: list[str] | None = None) -> DataFrame:
    """pid, time, target, the de-duplicated source columns, then every feature.

    Only rows with a non-null target are kept. Names are cleaned first.
    ``keep`` lists further columns of ``df`` to carry along (after the sources).
    """
    feats = clean_names(features)
    fixed = [c for c in [id_col, time_col, target_col] if c]
    sources: list[str] = []
    if include_sources:
        for f in feats:
            for s in f.get("sources", []):
                if s not in df.columns:
                    raise ValueError(f"source {s!r} of {f['name']} is not in the table")
                if s not in fixed and s not in sources:
                    sources.append(s)
    for s in keep or []:
        if s not in fixed and s not in sources:
            sources.append(s)
    data = df.where(F.col(target_col).isNotNull())
    groups: dict[tuple[str, ...], dict[str, str]] = {}
    formulas = []
    for i, f in enumerate(feats):
        text, windows = split_windows(f["formula"])
        for n, (agg, keys) in enumerate(windows):
            text = text.replace(f"__w{n}", f"`__stat{i}_{n}`")
            groups.setdefault(keys, {})[f"__stat{i}_{n}"] = agg
        formulas.append(text)
    for g, (keys, aggs) in enumerate(groups.items()):
        data = _join_statistics(data, keys, aggs, f"__stat_g{g}")
    return data.select(*[F.col(c) for c in fixed + sources],
                       *[F.expr(t).alias(f["name"]) for t, f in zip(formulas, feats)])
