"""SQL text (DuckDB dialect) that recomputes each registered query from the raw
tables. Used as the independent oracle in the correctness check and in tests.
"""

from __future__ import annotations

WIDE_ORDERS_CTE = """
li AS (SELECT l_orderkey, count(*) AS n_items, sum(l_quantity) AS sum_qty,
   round(sum(l_extendedprice), 2) AS sum_price,
   round(sum(nullif(l_discount, 0) * l_extendedprice), 4) AS sum_disc, max(l_tax) AS max_tax,
   round(sum(CASE WHEN l_returnflag = 'R' THEN l_extendedprice END), 2) AS returned_amt,
   CAST(sum(CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' AND l_quantity > 45 THEN 1 END) AS BIGINT) AS rare_cnt
 FROM lineitem GROUP BY l_orderkey),
hist AS (SELECT o_orderkey,
   count(*) OVER (PARTITION BY o_custkey ORDER BY d RANGE BETWEEN 90 PRECEDING AND 1 PRECEDING) AS ord_cnt_90d,
   count(*) OVER (PARTITION BY o_custkey ORDER BY d RANGE BETWEEN 360 PRECEDING AND 1 PRECEDING) AS ord_cnt_360d,
   round(sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY d RANGE BETWEEN 90 PRECEDING AND 1 PRECEDING), 2) AS amt_90d,
   round(sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY d RANGE BETWEEN 360 PRECEDING AND 1 PRECEDING), 2) AS amt_360d
 FROM (SELECT o_orderkey, o_custkey, o_totalprice,
         date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS d FROM orders) x),
wide_orders AS (SELECT o.o_orderkey AS pid, o.o_orderdate AS lend_tm, o.o_totalprice AS totalprice,
   c.c_acctbal AS acctbal, c.c_mktsegment AS mktsegment, o.o_orderpriority AS orderpriority,
   li.n_items, li.sum_qty, li.sum_price, li.sum_disc, li.max_tax, li.returned_amt, li.rare_cnt,
   CAST(h.ord_cnt_90d AS BIGINT) AS ord_cnt_90d, CAST(h.ord_cnt_360d AS BIGINT) AS ord_cnt_360d,
   h.amt_90d, h.amt_360d,
   CAST(CASE WHEN o.o_orderkey % 97 = 0 THEN NULL
     WHEN coalesce(li.sum_qty, 0) * 0.5::DOUBLE + coalesce(li.returned_amt, 0) / 4000.0::DOUBLE
          + o.o_totalprice / 50000.0::DOUBLE - c.c_acctbal / 2000.0::DOUBLE
          + CAST((o.o_orderkey * 7919) % 1000 AS DOUBLE) / 25.0::DOUBLE > 80 THEN 1 ELSE 0 END AS INTEGER) AS is_bad
 FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
 LEFT JOIN li ON li.l_orderkey = o.o_orderkey
 JOIN hist h ON h.o_orderkey = o.o_orderkey)
"""


def with_wide(body: str, *ctes: str) -> str:
    """``WITH <wide_orders>, <ctes> <body>``."""
    extra = "".join(f",\n{c}" for c in ctes)
    return f"WITH {WIDE_ORDERS_CTE.strip()}{extra}\n{body}"


# ---------------------------------------------------------------- helpers
def num(x: float) -> str:
    """A DOUBLE literal with the exact value of the Python float."""
    return f"CAST({x!r} AS DOUBLE)"


def deciles() -> str:
    import numpy as np
    return "[" + ", ".join(num(p) for p in np.linspace(0, 1, 11).tolist()) + "]"


def r(expr: str, digits: int) -> str:
    """round, with -0.0 turned into 0.0."""
    return f"(round({expr}, {digits}) + 0.0)"


LABELLED = "SELECT * FROM wide_orders WHERE is_bad IS NOT NULL"

DERIVED_COLUMNS = [
    ("feat_price_per_qty", "sum_price / NULLIF(sum_qty, 0)"),
    ("feat_net_price", "sum_price - sum_disc"),
    ("feat_return_share", "returned_amt / NULLIF(sum_price, 0)"),
    ("feat_log_totalprice", "CASE WHEN totalprice + 1 > 0 THEN ln(totalprice + 1) END"),
    ("feat_bal_to_price", "acctbal / NULLIF(totalprice, 0)"),
]

DERIVED_CTE = ("d AS (SELECT pid, lend_tm, is_bad, CASE WHEN is_bad = 1 THEN 1 ELSE 0 END AS y, "
               "sum_price, sum_qty, sum_disc, returned_amt, totalprice, acctbal, n_items, rare_cnt, "
               + ", ".join(f"{e} AS {n}" for n, e in DERIVED_COLUMNS)
               + " FROM wide_orders WHERE is_bad IS NOT NULL)")

SPLIT_CTE = ("sp AS (SELECT *, row_number() OVER (ORDER BY lend_tm, pid) AS rn, count(*) OVER () AS n_all FROM d)")


def cut(ratio_expr: str) -> str:
    return f"CAST(floor(n_all * ({ratio_expr})) AS BIGINT)"


BASE_CUT = cut(num(0.6))
TRAIN_CUT, VAL_CUT = cut(num(0.6)), cut(f"{num(0.6)} + {num(0.2)}")


def bin_sql(v: str, e: str) -> str:
    return (f"CASE WHEN {e} IS NULL OR len({e}) < 2 OR {v} IS NULL OR {v} < {e}[1] OR {v} > {e}[len({e})] "
            f"THEN NULL ELSE greatest(len(list_filter({e}, lambda x: x < {v})) - 1, 0) END")


def eval_ctes(features: list[str], p: str = "", align: str = "bin") -> list[str]:
    """CTE chain evaluating ``features`` of ``sp`` (needs ``d`` and ``sp``).
    Ends in ``{p}fg(feature, position, iv, psi, missing_rate, n_bins, grade)``,
    ``{p}woe2`` (bins) and ``{p}lg`` (long values)."""
    lg = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, {i} AS position, CAST({f} AS DOUBLE) AS v, y, "
        f"rn <= {BASE_CUT} AS is_base, lend_tm FROM sp" for i, f in enumerate(features))
    ctes = [
        f"{p}lg AS ({lg})",
        f"{p}ed AS (SELECT feature, list_sort(list_distinct(quantile_cont(v, {deciles()}))) AS e "
        f"FROM {p}lg WHERE v IS NOT NULL GROUP BY feature)",
        f"{p}eb AS (SELECT feature, list_sort(list_distinct(quantile_cont(v, {deciles()}))) AS e "
        f"FROM {p}lg WHERE v IS NOT NULL AND is_base GROUP BY feature)",
        f"{p}bn AS (SELECT l.feature, l.position, l.v, l.y, l.is_base, {bin_sql('l.v', 'a.e')} AS bin, "
        f"{bin_sql('l.v', 'b.e')} AS pbin FROM {p}lg l LEFT JOIN {p}ed a ON a.feature = l.feature "
        f"LEFT JOIN {p}eb b ON b.feature = l.feature)",
        f"{p}tot AS (SELECT feature, count(*) AS n, sum(y) AS te, "
        f"sum(CASE WHEN v IS NULL THEN 1 ELSE 0 END) AS nnull FROM {p}bn GROUP BY feature)",
        f"{p}wb AS (SELECT feature, bin, count(*) AS cnt, sum(y) AS ev FROM {p}bn GROUP BY feature, bin)",
        f"{p}woe AS (SELECT w.feature, w.bin, w.cnt, w.ev, "
        f"greatest(w.ev, 1e-9) / greatest(t.te, 1e-9) AS p_ev, "
        f"greatest(w.cnt - w.ev, 1e-9) / greatest(t.n - t.te, 1e-9) AS p_non "
        f"FROM {p}wb w JOIN {p}tot t ON t.feature = w.feature)",
        f"{p}woe2 AS (SELECT *, CASE WHEN bin IS NOT NULL THEN ln(p_ev / p_non) END AS woe_raw, "
        f"CASE WHEN bin IS NOT NULL THEN (p_ev - p_non) * ln(p_ev / p_non) END AS iv_raw FROM {p}woe)",
        f"{p}ivf AS (SELECT feature, sum(iv_raw) AS iv_raw, count(*) AS n_bins FROM {p}woe2 "
        f"WHERE bin IS NOT NULL GROUP BY feature)",
        f"{p}pc AS (SELECT feature, pbin AS bin, sum(CASE WHEN is_base THEN 1 ELSE 0 END) AS expected, "
        f"sum(CASE WHEN NOT is_base THEN 1 ELSE 0 END) AS actual FROM {p}bn WHERE pbin IS NOT NULL "
        f"GROUP BY feature, pbin)",
        f"{p}pt AS (SELECT feature, sum(expected) AS se, sum(actual) AS sa FROM {p}pc GROUP BY feature)",
    ]
    if align == "bin":
        ctes.append(f"{p}pa AS (SELECT feature, bin, expected, actual FROM {p}pc)")
    else:
        ctes.append(
            f"{p}pa AS (SELECT e.feature, e.bin, e.expected, a.actual FROM "
            f"(SELECT feature, bin, expected, row_number() OVER (PARTITION BY feature ORDER BY bin) AS k "
            f"FROM {p}pc WHERE expected > 0) e JOIN "
            f"(SELECT feature, actual, row_number() OVER (PARTITION BY feature ORDER BY bin) AS k "
            f"FROM {p}pc WHERE actual > 0) a ON a.feature = e.feature AND a.k = e.k)")
    ctes += [
        f"{p}ps AS (SELECT x.feature, x.bin, "
        f"CASE WHEN x.expected / greatest(t.se, 1) = 0 THEN 1e-9 ELSE x.expected / greatest(t.se, 1) END AS e, "
        f"CASE WHEN x.actual / greatest(t.sa, 1) = 0 THEN 1e-9 ELSE x.actual / greatest(t.sa, 1) END AS a "
        f"FROM {p}pa x JOIN {p}pt t ON t.feature = x.feature WHERE t.se > 0 AND t.sa > 0)",
        f"{p}psf AS (SELECT feature, sum((a - e) * ln(a / e)) AS psi_raw FROM {p}ps GROUP BY feature)",
        f"{p}fe AS (SELECT f.feature, f.position, {r('coalesce(i.iv_raw, 0.0)', 4)} AS iv, "
        f"{r('coalesce(s.psi_raw, 0.0)', 4)} AS psi, {r('t.nnull / t.n', 4)} AS missing_rate, "
        f"CAST(coalesce(i.n_bins, 0) AS BIGINT) AS n_bins "
        f"FROM (SELECT DISTINCT feature, position FROM {p}lg) f JOIN {p}tot t ON t.feature = f.feature "
        f"LEFT JOIN {p}ivf i ON i.feature = f.feature LEFT JOIN {p}psf s ON s.feature = f.feature)",
        f"{p}fg AS (SELECT *, CASE WHEN iv >= 0.1 AND missing_rate <= 0.2 AND psi <= 0.1 THEN 'excellent' "
        f"WHEN iv >= 0.02 AND missing_rate <= 0.9 AND psi <= 0.25 THEN 'usable' ELSE 'discard' END AS grade "
        f"FROM {p}fe)",
    ]
    return ctes
