"""Time-ordered splits (base / recent, train / val / test) without a global sort.

The first ``int(n * ratio)`` rows in (time, id) order form the first part. A
window ``row_number()`` over the whole table would move every row into one
task; instead the key of the last row of each part is found with exact order
statistics (a few aggregate passes), and membership is a plain comparison with
that key (a narrow projection, no shuffle of rows). Nulls sort last, ties in
time are broken by the id column.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskforge.functions.columns import TEXT_TYPES, order_numbers
from riskforge.operators.quantiles import group_counts, order_stats


def _order_columns(df: DataFrame, order_by: list[str]) -> list[Column]:
    """Numeric key columns; a text column gives one per six bytes of its longest value."""
    text = [c for c in order_by if isinstance(df.schema[c].dataType, TEXT_TYPES)]
    longest = df.agg(*[F.max(F.octet_length(c)).alias(f"m{i}") for i, c in enumerate(text)]).first() if text else []
    size = {c: n or 0 for c, n in zip(text, longest)}
    return [k for c in order_by for k in order_numbers(F.col(c), df.schema[c].dataType, size.get(c, 0))]


def cut_keys(df: DataFrame, nums: list[Column], ks: list[int]) -> list[list[Any] | None]:
    """Keys of the rows at 1-based positions ``ks`` of the (nulls-last) order.

    All positions are resolved together, one key column at a time: exact
    order statistics on the first column, then on the next column among the
    rows tied on the first, and so on. ``None`` stands for position 0; inside a
    key, None stands for a null value. Values are the numeric order keys of
    :func:`riskforge.functions.columns.order_numbers`.
    """
    # state per cut: remaining 0-based rank, condition selecting its tied rows, key so far
    state = [{"r": k - 1, "cond": None, "key": []} for k in ks]
    for num in nums:
        live = [st for st in state if st["r"] >= 0]
        if not live:
            break
        # cuts that share the same tied rows share one group
        groups, owner = {}, []
        for st in live:
            sub = num if st["cond"] is None else F.when(st["cond"], num)
            text = str(sub._jc.toString())
            if text not in groups:
                groups[text] = (f"c{len(groups)}", sub)
            owner.append(groups[text][0])
        exprs = {name: sub for name, sub in groups.values()}
        nn = group_counts(df, exprs)
        ranks: dict[str, list[int]] = {}
        for g, st in zip(owner, live):
            if st["r"] < nn[g]:
                ranks.setdefault(g, []).append(st["r"])
        stats = order_stats(df, {g: exprs[g] for g in ranks}, ranks, nn) if ranks else {}
        for g, st in zip(owner, live):
            if st["r"] < nn[g]:
                value, n_lt = stats[(g, st["r"])]
                st["r"] -= n_lt
                st["key"].append(value)
                eq = num == F.lit(value)
            else:
                st["r"] -= nn[g]
                st["key"].append(None)
                eq = num.isNull()
            st["cond"] = eq if st["cond"] is None else (st["cond"] & eq)
    return [st["key"] if k > 0 else None for st, k in zip(state, ks)]


def at_or_before(nums: list[Column], key: list[Any] | None) -> Column:
    """True for rows ordered at or before ``key`` (nulls last)."""
    if key is None:
        return F.lit(False)
    pred: Column = F.lit(True)   # rows equal on every key column are "at" the key
    for num, v in reversed(list(zip(nums, key))):
        if v is None:
            le = num.isNotNull() | (num.isNull() & pred)
        else:
            le = (num < F.lit(v)) | ((num == F.lit(v)) & pred)
        pred = F.coalesce(le, F.lit(False))
    return pred


def split_by_order(df: DataFrame, order_by: list[str], ratios: list[float], labels: list[str],
                   col_name: str = "split") -> DataFrame:
    """Add ``col_name`` with ``labels[i]`` for consecutive parts of the order.

    ``ratios`` are the cumulative cut points' parts, e.g. ``[0.6]`` (base /
    recent) or ``[0.6, 0.2]`` (train / val / test). Cuts are ``int(n * sum)``
    with the same float arithmetic as the reference.
    """
    if len(labels) != len(ratios) + 1:
        raise ValueError("need one label more than cut ratios")
    n = df.count()
    cum, ks = 0.0, []
    for i, ratio in enumerate(ratios):
        cum = cum + ratio if i else ratio
        ks.append(int(n * cum))
    nums = _order_columns(df, order_by)
    preds = [at_or_before(nums, key) for key in cut_keys(df, nums, ks)]
    expr = None
    for pred, label in zip(preds, labels):
        expr = F.when(pred, F.lit(label)) if expr is None else expr.when(pred, F.lit(label))
    return df.withColumn(col_name, expr.otherwise(F.lit(labels[-1])))


def split_psi(df: DataFrame, time_col: str | None, id_col: str, base_ratio: float = 0.6) -> DataFrame:
    """base / recent split used by PSI (60 / 40 by default)."""
    order = [time_col, id_col] if time_col else [id_col]
    return split_by_order(df, order, [base_ratio], ["base", "recent"])


def split_model(df: DataFrame, time_col: str | None, id_col: str, train_ratio: float = 0.6,
                val_ratio: float = 0.2) -> DataFrame:
    """train / val / test split by time (positional by id without a time column)."""
    order = [time_col, id_col] if time_col else [id_col]
    return split_by_order(df, order, [train_ratio, val_ratio], ["train", "val", "test"])


def split_summary(df: DataFrame, label_col: str = "y", split_col: str = "split") -> DataFrame:
    """Rows and positive rate per split."""
    return (df.groupBy(split_col)
            .agg(F.count(F.lit(1)).alias("n_rows"),
                 F.avg(F.col(label_col).cast("double")).alias("positive_rate")))
