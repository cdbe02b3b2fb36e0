"""Binning: equal-frequency (deciles), equal-width and single-bin.

Edges are small (at most ``n_bins + 1`` numbers per feature); ``evaluate`` joins
them as one broadcast row a feature, ``bin_of`` is the same rule as an expression
for one feature. Right-closed bins, lowest edge included; values outside
the edges get no bin (NULL).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskforge.operators.quantiles import group_counts, interpolated_quantiles


def decile_probs(n_bins: int = 10) -> list[float]:
    """The quantile levels of an ``n_bins`` equal-frequency split (0 .. 1)."""
    return np.linspace(0, 1, n_bins + 1).tolist()


def unique_edges(qs: list[float]) -> list[float]:
    """Drop duplicate edges, keep the order (edges are non-decreasing)."""
    out: list[float] = []
    for q in qs:
        if not out or q != out[-1]:
            out.append(q)
    return out


def equal_freq_edges(df: DataFrame, values: dict[str, Column], n_bins: int = 10,
                     counts: dict[str, int] | None = None) -> dict[str, list[float]]:
    """Equal-frequency edges for many features at once (exact, interpolated)."""
    counts = counts if counts is not None else group_counts(df, values)
    qs = interpolated_quantiles(df, values, decile_probs(n_bins), counts)
    return {k: unique_edges(v) for k, v in qs.items()}


def equal_width_edges(df: DataFrame, values: dict[str, Column], n_bins: int = 10) -> dict[str, list[float]]:
    """Equal-width edges from min / max (one aggregate for all features).

    Same construction as pandas ``cut(x, bins=n)``: n + 1 evenly spaced edges,
    widened by 0.1 % when min == max. The lowest edge is pulled down by 0.1 % of
    the range, which only matters for the minimum (included either way).
    """
    aggs = []
    for i, c in enumerate(values.values()):
        aggs += [F.min(c).alias(f"mn{i}"), F.max(c).alias(f"mx{i}")]
    row = df.agg(*aggs).first()
    out = {}
    for i, k in enumerate(values):
        mn, mx = row[f"mn{i}"], row[f"mx{i}"]
        if mn is None:
            out[k] = []
            continue
        mn, mx = float(mn), float(mx)
        if mn == mx:
            adj = 0.001 * abs(mn) if mn != 0 else 0.001
            mn, mx = mn - adj, mx + adj
            out[k] = np.linspace(mn, mx, n_bins + 1).tolist()
        else:
            edges = np.linspace(mn, mx, n_bins + 1)
            edges[0] -= (mx - mn) * 0.001
            out[k] = edges.tolist()
    return out


def bin_of(value: Column, edges: list[float]) -> Column:
    """Bin index for right-closed bins over ``edges``; NULL when out of range.

    With fewer than two edges no bin exists (a constant column), so every row
    gets NULL.
    """
    if len(edges) < 2:
        return F.lit(None).cast("int")
    expr = F.when(value.isNull() | (value < F.lit(float(edges[0]))), F.lit(None).cast("int"))
    for i, e in enumerate(edges[1:]):
        expr = expr.when(value <= F.lit(float(e)), F.lit(i))
    return expr.otherwise(F.lit(None).cast("int"))


def single_bin(value: Column) -> Column:
    """The fallback for non-numeric features: bin 0 for every non-null value."""
    return F.when(value.isNotNull(), F.lit(0)).otherwise(F.lit(None).cast("int"))


def bin_from_count(value: Column, edges_col: str, count_col: str) -> Column:
    """Bin index from the number of edges below the value (see
    ``functions.arrays.with_count_below``), for an edges array column.
    Same rule as :func:`bin_of`."""
    e = F.col(edges_col)
    n = F.size(e)
    out = ((n < 2) | value.isNull() | (value < F.try_element_at(e, F.lit(1)))
           | (value > F.try_element_at(e, n)))
    return F.when(out, F.lit(None).cast("int")).otherwise(
        F.greatest(F.col(count_col) - F.lit(1), F.lit(0)).cast("int"))
