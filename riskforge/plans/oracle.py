"""Oracle SQL (DuckDB) per registered query key. Keys without an entry are
checked on rows only (model training, sampling, sinks)."""

from __future__ import annotations

from riskforge.plans import catalog as C
from riskforge.plans.duck_sql import (BASE_CUT, DERIVED_CTE, SPLIT_CTE, TRAIN_CUT, VAL_CUT, bin_sql, deciles,
                                      eval_ctes, num, r, with_wide)

# wide_orders columns as Spark sees them: (name, data type, class)
WIDE_COLUMNS = [
    ("pid", "bigint", "numeric"), ("lend_tm", "timestamp_ntz", "time"), ("totalprice", "double", "numeric"),
    ("acctbal", "double", "numeric"), ("mktsegment", "string", "categorical"),
    ("orderpriority", "string", "categorical"), ("n_items", "bigint", "numeric"),
    ("sum_qty", "double", "numeric"), ("sum_price", "double", "numeric"), ("sum_disc", "double", "numeric"),
    ("max_tax", "double", "numeric"), ("returned_amt", "double", "numeric"), ("rare_cnt", "bigint", "numeric"),
    ("ord_cnt_90d", "bigint", "numeric"), ("ord_cnt_360d", "bigint", "numeric"), ("amt_90d", "double", "numeric"),
    ("amt_360d", "double", "numeric"), ("is_bad", "int", "numeric"),
]
CANDIDATE = ("mob3_flag", "int", "numeric")      # the further label column of the profiled table
PROFILE_TABLE = ("wp AS (SELECT *, CASE WHEN amt_90d IS NOT NULL THEN CASE WHEN pid % 3 = 0 THEN 1 ELSE 0 END END AS mob3_flag "
                 "FROM wide_orders)")
SYSTEM = {"pid", "lend_tm"}
PROFILED = [(i, n, t, k) for i, (n, t, k) in enumerate(WIDE_COLUMNS) if n not in SYSTEM]

TEMPLATE_SQL = {
    "tpl_ratio": ("feat_price_per_qty", "sum_price / NULLIF(sum_qty, 0)"),
    "tpl_diff": ("feat_net_price", "sum_price - sum_disc"),
    "tpl_log": ("feat_log_totalprice", r("CASE WHEN totalprice + 1 > 0 THEN ln(totalprice + 1) END", 10)),
    "tpl_window_diff": ("feat_cnt_90d_minus_360d", "ord_cnt_90d - ord_cnt_360d"),
    "tpl_window_compare": ("feat_amt_rate_90_vs_360", "(amt_90d / 90.0) / NULLIF(amt_360d / 360.0, 0)"),
    "tpl_normalized": ("feat_totalprice_z", r(
        "(totalprice - avg(totalprice) OVER (PARTITION BY mktsegment)) / "
        "NULLIF(stddev_samp(totalprice) OVER (PARTITION BY mktsegment), 0)", 6)),
    "tpl_flag": ("feat_is_urgent",
                 "CASE WHEN orderpriority IS NULL THEN NULL WHEN orderpriority = '1-URGENT' THEN 1 ELSE 0 END"),
    "tpl_ordinal": ("feat_priority_rank", "CASE " + " ".join(
        f"WHEN orderpriority = '{v}' THEN {i}" for i, v in enumerate(C.PRIORITIES, 1)) + " END"),
    "tpl_frequency": ("feat_segment_freq",
                      "CASE WHEN mktsegment IS NULL THEN NULL ELSE count(*) OVER (PARTITION BY mktsegment) END"),
    "fn_sqrt": ("feat_sqrt_acctbal", "CASE WHEN acctbal >= 0 THEN sqrt(acctbal) END"),
    "formula_expr": ("feat_price_per_item", "CASE WHEN n_items > 3 THEN sum_price / n_items ELSE NULL END"),
}


def exact_mean(v: str) -> str:
    """Sums of whole parts and of the rests in units of 2^-52 and 2^-104, divided once."""
    top = f"(({v} - trunc({v})) * 4503599627370496::DOUBLE)"
    whole, rest, last = f"sum(trunc({v})::HUGEINT)", f"sum(trunc({top})::HUGEINT)", f"sum((({top} - trunc({top})) * 4503599627370496::DOUBLE)::HUGEINT)"
    n = f"count({v})::HUGEINT"
    return (f"(({whole} // {n})::DOUBLE + (({whole} - ({whole} // {n}) * {n})::DOUBLE + ({rest}::DOUBLE + {last}::DOUBLE / 4503599627370496::DOUBLE)"
            f" / 4503599627370496::DOUBLE) / {n}::DOUBLE)")


def _labelled(select: str) -> str:
    return with_wide(f"SELECT {select} FROM wide_orders WHERE is_bad IS NOT NULL")


def _eval(body: str, features=None, align="bin", extra: list[str] | None = None) -> str:
    return with_wide(body, DERIVED_CTE, SPLIT_CTE, *eval_ctes(features or C.EVAL_FEATURES, align=align),
                     *(extra or []))


def _profile_cte() -> str:
    parts = []
    for pos, name, dtype, cls in [*PROFILED, (len(WIDE_COLUMNS), *CANDIDATE)]:
        sample = ("(SELECT string_agg(v, '|' ORDER BY v) FROM (SELECT DISTINCT CAST(" + name + " AS VARCHAR) AS v FROM wp "
                  f"WHERE {name} IS NOT NULL ORDER BY v LIMIT 30) t)" if cls == "categorical" else "CAST(NULL AS VARCHAR)")
        card = (f"CAST(least(count(DISTINCT {name}), 30) AS BIGINT)" if cls == "categorical"
                else "CAST(NULL AS BIGINT)")
        nd = f"count(DISTINCT {name})" if cls == "categorical" else "CAST(NULL AS BIGINT)"
        parts.append(
            f"SELECT '{name}' AS name, {pos} AS position, '{dtype}' AS data_type, true AS nullable, "
            f"'{'overdue in month 3' if name == CANDIDATE[0] else ''}' AS comment, '{cls}' AS col_type, {r(f'sum(CASE WHEN {name} IS NULL THEN 1 ELSE 0 END) / count(*)', 4)} "
            f"AS missing_rate, regexp_matches('{name}', '\\bt[0-9]|m[0-9]|mob|逾期|违约|default') AS is_target_candidate, "
            f"{card} AS cardinality_estimate, {nd} AS n_distinct, {sample} AS sample_values FROM wp")
    return PROFILE_TABLE + ", prof AS (" + " UNION ALL ".join(parts) + ")"


USABLE = ("((col_type IN ('numeric', 'categorical') AND missing_rate < 0.9) OR col_type = 'time') "
          "AND NOT is_target_candidate AND name <> 'is_bad'")


def _category(name: str) -> str:
    return (f"SELECT '{name}' AS name, CAST(max(nd) AS BIGINT) AS n_distinct, "
            f"CAST(count(*) FILTER (WHERE rn <= 30) AS BIGINT) AS cardinality_estimate, "
            f"string_agg(v, '|' ORDER BY v) FILTER (WHERE rn <= 30) AS sample_values FROM "
            f"(SELECT v, row_number() OVER (ORDER BY v) AS rn, count(*) OVER () AS nd FROM "
            f"(SELECT DISTINCT CAST({name} AS VARCHAR) AS v FROM wide_orders WHERE {name} IS NOT NULL) a) b")


def _derive_all() -> str:
    fixed = ["pid", "lend_tm", "is_bad"]
    sources: list[str] = []
    for spec in C.TEMPLATE_SPEC.values():
        for s in spec["sources"]:
            if s not in fixed and s not in sources:
                sources.append(s)
    feats = [f"{TEMPLATE_SQL[k][1]} AS {TEMPLATE_SQL[k][0]}" for k in C.TEMPLATE_SPEC]
    return _labelled(", ".join(fixed + sources + feats))


def _auto() -> str:
    fields = ["totalprice", "acctbal", "n_items", "sum_qty", "sum_price", "sum_disc", "max_tax",
              "returned_amt", "ord_cnt_90d", "ord_cnt_360d"]
    cols = ["pid", "lend_tm", "is_bad"]
    cols += [f"{r(f'CASE WHEN {f} + 1 > 0 THEN ln({f} + 1) END', 10)} AS feat_log_{f}" for f in fields[:5]]
    cols += [f"{a} / NULLIF({b}, 0) AS feat_ratio_{a}_div_{b}" for a, b in
             [(fields[0], fields[1]), (fields[2], fields[3]), (fields[4], fields[5])]]
    return _labelled(", ".join(cols))


def _bins(edges_cte: str) -> str:
    feats = C.EVAL_FEATURES
    lg = " UNION ALL ".join(f"SELECT '{f}' AS feature, CAST({f} AS DOUBLE) AS v FROM d" for f in feats)
    return with_wide(
        f"SELECT l.feature, {bin_sql('l.v', 'e.e')} AS bin, count(*) AS n_rows, min(l.v) AS min_value, "
        f"max(l.v) AS max_value FROM lg l LEFT JOIN ed e ON e.feature = l.feature GROUP BY 1, 2",
        DERIVED_CTE, f"lg AS ({lg})", edges_cte)


EQ_EDGES = (f"ed AS (SELECT feature, list_sort(list_distinct(quantile_cont(v, {deciles()}))) AS e "
            f"FROM lg WHERE v IS NOT NULL GROUP BY feature)")
WIDTH_EDGES = ("ed AS (SELECT feature, list_transform(range(11), lambda i: CASE WHEN i = 0 THEN mn - (mx - mn) * 0.001 "
               "WHEN i = 10 THEN mx ELSE i * ((mx - mn) / 10) + mn END) AS e FROM "
               "(SELECT feature, min(v) AS mn, max(v) AS mx FROM lg GROUP BY feature) m)")

SCORE_N_ITEMS = "SELECT y, CAST(coalesce(n_items, 0) AS DOUBLE) AS score FROM d"
SCORE_SHARE = "SELECT y, coalesce(feat_return_share, 0.0) AS score FROM d"


def _auc(score_sql: str, cols: str) -> str:
    return with_wide(
        f"SELECT {cols} FROM (SELECT CAST(max(P) + max(N) AS BIGINT) AS n, "
        f"CASE WHEN max(P) > 0 AND max(N) > 0 THEN {r('CAST(sum(CAST(neg AS HUGEINT) * (2 * (pos_ge - pos) + pos)) AS DOUBLE) / (2.0 * CAST(max(P) AS DOUBLE) * CAST(max(N) AS DOUBLE))', 4)} ELSE 0.0 END AS auc, "
        f"CASE WHEN max(P) > 0 AND max(N) > 0 THEN {r('max(abs(pos_ge / P - neg_ge / N))', 4)} ELSE 0.0 END AS ks, "
        f"max(P) > 0 AND max(N) > 0 AS ok FROM c) z",
        DERIVED_CTE, f"s AS ({score_sql})",
        "h AS (SELECT score, sum(y) AS pos, sum(1 - y) AS neg FROM s GROUP BY score)",
        "c AS (SELECT score, pos, neg, sum(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS pos_ge, "
        "sum(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS neg_ge, "
        "sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM h)")


GINI = f"CASE WHEN ok THEN {r('2 * auc - 1', 4)} ELSE 0.0 END AS gini"

MODEL_SPLIT = (f"ms AS (SELECT *, CASE WHEN rn <= {TRAIN_CUT} THEN 'train' WHEN rn <= {VAL_CUT} THEN 'val' "
               f"ELSE 'test' END AS split FROM sp)")
# integer-typed evaluated columns: imputed only when they hold nulls in the labelled rows
INT_FEATURES = ["n_items", "rare_cnt"]
# training rows are the first 60 % in (time, id) order, i.e. the PSI base rows
SELECTION_CTES = [
    "sel AS (SELECT feature, position FROM fg WHERE grade IN ('excellent', 'usable') "
    "QUALIFY row_number() OVER (ORDER BY CASE WHEN grade = 'excellent' THEN 0 ELSE 1 END, position) <= 50)",
    "fl AS (SELECT s.feature, s.position FROM sel s JOIN lg l ON l.feature = s.feature "
    "GROUP BY s.feature, s.position HAVING s.feature NOT IN (" + ", ".join(f"'{f}'" for f in INT_FEATURES)
    + ") OR sum(CASE WHEN l.v IS NULL THEN 1 ELSE 0 END) > 0)",
    "med AS (SELECT f.feature, f.position, m.median FROM fl f LEFT JOIN (SELECT feature, "
    "quantile_cont(v, 0.5) AS median FROM lg WHERE is_base AND v IS NOT NULL GROUP BY feature) m "
    "ON m.feature = f.feature)",
    "st AS (SELECT m.feature, avg(coalesce(l.v, m.median)) AS mean, stddev_samp(coalesce(l.v, m.median)) AS std "
    "FROM med m JOIN lg l ON l.feature = m.feature WHERE l.is_base GROUP BY m.feature)",
]


def _trailing(key: str, day: str, measures: dict[str, str], stats: tuple[str, ...], prefix: str = "win") -> str:
    """Window columns as range frames over the rows of ``key``; ``day`` is a whole number."""
    cols = []
    for n in C.EVENT_WINDOWS:
        w = f"OVER (PARTITION BY {key} ORDER BY {day} RANGE BETWEEN {n} PRECEDING AND 1 PRECEDING)"
        if "cnt" in stats:
            cols.append(f"count(*) {w} AS {prefix}_cnt_{n}d")
        for m, v in measures.items():
            total = r(f"sum({v}) {w}", 4)
            made = {"sum": total, "min": f"CAST(min({v}) {w} AS DOUBLE)", "max": f"CAST(max({v}) {w} AS DOUBLE)",
                    "avg": r(f"{total} / NULLIF(count({v}) {w}, 0)", 4)}
            cols += [f"{made[s]} AS {prefix}_{m}_{s}_{n}d" for s in stats if s in made]
    last = f"RANGE BETWEEN {max(C.EVENT_WINDOWS)} PRECEDING AND 1 PRECEDING"
    cols.append(f"CAST({day} - max({day}) OVER (PARTITION BY {key} ORDER BY {day} {last}) AS INTEGER) AS {prefix}_days_since")
    return ", ".join(cols)


ORDER_DAYS = "(SELECT *, date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS d FROM orders)"
EVENT_DAYS = ("(SELECT user_id, CAST(ts AS DATE) AS day, date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS d, "
              "CASE WHEN event_type = 'purchase' THEN value END AS spent, "
              "CASE WHEN event_type = 'error' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS err FROM events)")

ORACLE: dict[str, str] = {
    "window_orders": f"SELECT o_orderkey AS pid, {_trailing('o_custkey', 'd', {'price': 'o_totalprice'}, ('cnt', 'sum', 'min', 'max', 'avg'))} "
                     f"FROM {ORDER_DAYS}",
    "window_events": "SELECT DISTINCT * FROM (SELECT user_id, strftime(day, '%Y-%m-%d') AS day, "
                     f"{_trailing('user_id', 'd', {'spent': 'spent', 'errors': 'err'}, ('cnt', 'sum', 'max', 'avg'))} FROM {EVENT_DAYS})",
    "window_features": with_wide(
        "SELECT pid, is_bad, win_cnt_7d - win_cnt_90d AS feat_cnt_7d_minus_90d, "
        "(win_price_sum_30d / 30.0) / NULLIF(win_price_sum_90d / 90.0, 0) AS feat_price_rate_30_vs_90 "
        "FROM wide_orders JOIN win USING (pid) WHERE is_bad IS NOT NULL",
        f"win AS (SELECT o_orderkey AS pid, {_trailing('o_custkey', 'd', {'price': 'o_totalprice'}, ('cnt', 'sum'))} FROM {ORDER_DAYS})"),
    "scan_limit": "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders "
                  "WHERE o_totalprice > 1000 ORDER BY o_orderkey LIMIT 500",
    "row_count": with_wide(" UNION ALL ".join(
        [f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in ("orders", "customer", "lineitem")]
        + ["SELECT 'wide_orders' AS table_name, count(*) AS n_rows FROM wide_orders"])),
    "feature_matrix": with_wide("SELECT pid, lend_tm, is_bad, n_items, feat_net_price, acctbal FROM d", DERIVED_CTE),
    "feature_matrix_newest": with_wide("SELECT pid, lend_tm, is_bad, n_items, feat_net_price, acctbal FROM d "
                                       "ORDER BY lend_tm DESC, pid LIMIT 5000", DERIVED_CTE),
    "distinct_sample": with_wide("SELECT DISTINCT acctbal AS value FROM wide_orders WHERE acctbal IS NOT NULL "
                                 "ORDER BY value LIMIT 30"),
    "derived_sink": _labelled("'feat_derived_eval' AS table_name, count(*) AS row_count, "
                              "CASE WHEN count(*) > 0 THEN 'ok' ELSE 'empty' END AS status"),
    "table_replaced": with_wide("SELECT pid, is_bad, feat_net_price, CAST(feat_net_price < 0 AS INTEGER) AS feat_is_refund FROM d", DERIVED_CTE),
    "result_sink": _eval(
        f"SELECT 'schema_analysis' AS artifact, CAST({len(PROFILED) + 1} AS BIGINT) AS n_rows UNION ALL "
        f"SELECT 'feature_design', {len(C.EVAL_SPEC)} UNION ALL SELECT 'eval_results', count(*) FROM fg UNION ALL "
        "SELECT 'bins', count(*) FROM woe2 UNION ALL "
        "SELECT 'monthly', count(*) FROM (SELECT DISTINCT feature, strftime(lend_tm, '%Y-%m') FROM lg) a UNION ALL "
        f"SELECT 'source_field_trends', count(*) * {len(C.SOURCE_FEATURES)} FROM (SELECT DISTINCT strftime(lend_tm, '%Y-%m') FROM d) b"),
    "chosen_target": "SELECT * FROM (VALUES ('is_bad', 'is_bad'), (NULL, 'mob3_flag')) t(given, chosen)",
    "missing_sampled": with_wide(" UNION ALL ".join(
        f"SELECT '{n}' AS name, {i} AS position, "
        f"{r(f'sum(CASE WHEN {n} IS NULL THEN 1 ELSE 0 END) / count(*)', 4)} AS missing_rate FROM drawn"
        for i, (_, n, _, _) in enumerate(PROFILED)),
        "drawn AS (SELECT * FROM wide_orders ORDER BY md5('7:' || CAST(pid AS VARCHAR)), pid LIMIT 10000)"),
    "model_roundtrip": with_wide(
        "SELECT m AS model, (SELECT count(*) FROM ms WHERE split = 'test') AS n_scored, CAST(0 AS DOUBLE) AS max_abs_diff "
        "FROM (VALUES ('gbt'), ('lr')) t(m)", DERIVED_CTE, SPLIT_CTE, MODEL_SPLIT),
    "spec_source": _derive_all(),
    "model_samples": with_wide(
        "SELECT m AS model, CAST(sum(CASE WHEN split = 'train' THEN 1 ELSE 0 END) AS BIGINT) AS train_samples, "
        "CAST(sum(CASE WHEN split = 'val' THEN 1 ELSE 0 END) AS BIGINT) AS val_samples, "
        "CAST(sum(CASE WHEN split = 'test' THEN 1 ELSE 0 END) AS BIGINT) AS test_samples, "
        f"{r("avg(CASE WHEN split = 'train' THEN CAST(y AS DOUBLE) END)", 4)} AS positive_rate, "
        "CAST(sum(CASE WHEN split = 'val' THEN 1 ELSE 0 END) AS BIGINT) AS val_scored, "
        "CAST(sum(CASE WHEN split = 'test' THEN 1 ELSE 0 END) AS BIGINT) AS test_scored "
        "FROM ms, (VALUES ('gbt'), ('lr')) t(m) GROUP BY m", DERIVED_CTE, SPLIT_CTE, MODEL_SPLIT),
    "score_checks": with_wide(
        "SELECT m AS model, (SELECT count(*) FROM ms WHERE split = 'test') AS n_scored, true AS in_bounds, true AS auc_agrees "
        "FROM (VALUES ('gbt'), ('lr')) t(m)", DERIVED_CTE, SPLIT_CTE, MODEL_SPLIT),
    "boost_checks": "SELECT true AS least_rows_ok, true AS rows_ok, true AS leaves_ok, true AS importance_ok, "
                    "true AS best_prefix_ok, true AS patience_ok",
    "lr_checks": _eval("SELECT feature, true AS gradient_zero, true AS scores_agree FROM sel UNION ALL "
                       "SELECT '(intercept)', true, true", None, "bin", SELECTION_CTES),
    "metric_checks": with_wide(
        "SELECT m AS model, split, n, true AS rows_agree, true AS auc_agrees, true AS ks_agrees, true AS gini_agrees "
        "FROM (VALUES ('gbt'), ('lr')) t(m), (SELECT split, count(*) AS n FROM ms WHERE split <> 'train' GROUP BY split) s",
        DERIVED_CTE, SPLIT_CTE, MODEL_SPLIT),
    "report_checks": _eval(
        "SELECT count(*) AS total, count(*) FILTER (WHERE grade = 'excellent') AS excellent_cnt, "
        "count(*) FILTER (WHERE grade = 'usable') AS usable_cnt, CAST(2 AS BIGINT) AS n_cards, CAST(1 AS BIGINT) AS n_best, "
        "(SELECT count(*) FROM ms WHERE split = 'train') AS train_samples, (SELECT count(*) FROM ms WHERE split = 'test') AS test_samples, "
        "true AS cards_agree, true AS best_auc_agrees FROM fg", None, "bin", [MODEL_SPLIT]),
    "importance_checks": _eval(
        "SELECT CAST(least(20, count(*)) AS BIGINT) AS n_features, true AS ranks_ok, true AS falling, true AS top_is_100, "
        "true AS best_is_max FROM fg WHERE grade IN ('excellent', 'usable')"),
    "profile": with_wide("SELECT * FROM prof", _profile_cte()),
    "missing_recent": with_wide(" UNION ALL ".join(
        f"SELECT '{n}' AS name, {i} AS position, "
        f"{r(f'sum(CASE WHEN {n} IS NULL THEN 1 ELSE 0 END) / count(*)', 4)} AS missing_rate FROM recent"
        for i, (_, n, _, _) in enumerate(PROFILED)),
        "recent AS (SELECT * FROM wide_orders ORDER BY lend_tm DESC, pid LIMIT 5000)"),
    "category_profile": with_wide(f"{_category('mktsegment')} UNION ALL {_category('orderpriority')}"),
    "usable_fields": with_wide(f"SELECT name, position, col_type FROM prof WHERE {USABLE}", _profile_cte()),
    "profile_summary": with_wide(
        f"SELECT (SELECT count(*) FROM wide_orders) AS total_rows, CAST({len(WIDE_COLUMNS) + 1} AS BIGINT) AS total_columns, "
        + ", ".join(f"CAST(coalesce(sum(CASE WHEN {USABLE} AND col_type = '{k}' THEN 1 ELSE 0 END), 0) AS BIGINT) AS {k}_cnt"
                    for k in ("numeric", "categorical", "time"))
        + ", CAST(coalesce(sum(CASE WHEN is_target_candidate THEN 1 ELSE 0 END), 0) AS BIGINT) AS candidate_cnt "
          "FROM prof", _profile_cte()),
    **{k: _labelled(f"pid, {e} AS {n}") for k, (n, e) in TEMPLATE_SQL.items()},
    "derive_table": _derive_all(),
    "auto_features": _auto(),
    "label_binary": with_wide(
        "SELECT pid, y_text, CASE WHEN regexp_replace(y_text, '^\\s+|\\s+$', '', 'g') IN ("
        + ", ".join(f"'{t}'" for t in ["1", "是", "Y", "y", "True", "true", "yes"])
        + ") THEN 1 ELSE 0 END AS y_from_text, CASE WHEN is_bad = 1 THEN 1 ELSE 0 END AS y_from_number FROM "
          "(SELECT pid, is_bad, CASE WHEN is_bad IS NOT NULL THEN ["
        + ", ".join(f"'{t}'" for t in C.TEXT_LABELS)
        + f"][pid % {len(C.TEXT_LABELS)} + 1] END AS y_text FROM wide_orders) t"),
    "split_psi": with_wide(f"SELECT pid, CASE WHEN rn <= {BASE_CUT} THEN 'base' ELSE 'recent' END AS split FROM sp",
                           DERIVED_CTE, SPLIT_CTE),
    "split_decimal_id": with_wide(f"SELECT pid, CASE WHEN rn <= {BASE_CUT} THEN 'base' ELSE 'recent' END AS split FROM "
                                  "(SELECT pid, row_number() OVER (ORDER BY CAST(pid AS HUGEINT) % 7, CAST(pid AS HUGEINT)) AS rn, count(*) OVER () AS n_all FROM d)",
                                  DERIVED_CTE),
    "split_model": with_wide("SELECT pid, split FROM ms", DERIVED_CTE, SPLIT_CTE, MODEL_SPLIT),
    "split_positional": with_wide(
        f"SELECT pid, CASE WHEN rn <= {TRAIN_CUT} THEN 'train' WHEN rn <= {VAL_CUT} THEN 'val' ELSE 'test' END "
        "AS split FROM (SELECT pid, row_number() OVER (ORDER BY pid) AS rn, count(*) OVER () AS n_all FROM d) x",
        DERIVED_CTE),
    "split_summary": with_wide(f"SELECT split, count(*) AS n_rows, {r('avg(CAST(y AS DOUBLE))', 4)} AS positive_rate "
                               "FROM ms GROUP BY split", DERIVED_CTE, SPLIT_CTE, MODEL_SPLIT),
    "bins_equal_freq": _bins(EQ_EDGES),
    "bins_equal_width": _bins(WIDTH_EDGES),
    "bins_single": _labelled("'mktsegment' AS feature, CASE WHEN mktsegment IS NOT NULL THEN 0 END AS bin, "
                             "count(*) AS n_rows") + " GROUP BY 1, 2",
    "woe_bins": _eval(f"SELECT feature, bin, CAST(cnt AS BIGINT) AS count, CAST(ev AS BIGINT) AS event, "
                      f"CAST(cnt - ev AS BIGINT) AS non_event, {r('ev / greatest(cnt, 1)', 4)} AS event_rate, "
                      f"{r('woe_raw', 4)} AS woe, {r('iv_raw', 4)} AS iv FROM woe2 WHERE bin IS NOT NULL"),
    "woe_null_bin": _eval(f"SELECT feature, CAST(cnt AS BIGINT) AS count, CAST(ev AS BIGINT) AS event, "
                          f"CAST(cnt - ev AS BIGINT) AS non_event, {r('ev / greatest(cnt, 1)', 4)} AS event_rate "
                          f"FROM woe2 WHERE bin IS NULL"),
    "iv": _eval("SELECT feature, iv FROM fg"),
    "psi": _eval("SELECT feature, psi FROM fg"),
    "psi_by_rank": _eval("SELECT feature, psi FROM fg", align="rank"),
    "missing_rate": _eval("SELECT feature, missing_rate FROM fg"),
    "monthly_means_large": with_wide(
        f"SELECT feature, coalesce(strftime(lend_tm, '%Y-%m'), 'NaT') AS ym, {r('avg(CASE WHEN v IS NULL THEN 1.0 ELSE 0.0 END)', 4)} AS missing_rate, "
        f"{r(exact_mean('v'), 4)} AS mean FROM (SELECT 'big' AS feature, lend_tm, 123456789012.12345::DOUBLE + sum_price AS v FROM wide_orders "
        "UNION ALL SELECT 'small', lend_tm, sum_price / 1e9::DOUBLE FROM wide_orders) GROUP BY 1, 2"),
    "formula_nested": _labelled(
        "pid, sum_price, n_items, " + ", ".join(f"{r(e, 6)} AS {n}" for n, e in (
            ("feat_avg_or_none", "avg(sum_price) OVER (PARTITION BY coalesce(n_items % 3, -1))"),
            ("feat_max_abs", "max(abs(coalesce(sum_price, 0))) OVER (PARTITION BY n_items)"),
            ("feat_share_large", "sum_price / nullif(sum(sum_price) FILTER (WHERE n_items > 3) OVER (PARTITION BY n_items), 0)"),
            ("feat_range", "abs(max(greatest(sum_price, coalesce(abs(sum_price - 3), 0))) OVER () - min(sum_price) OVER (PARTITION BY n_items, n_items % 2))")))),
    "monthly_metrics": _eval(
        f"SELECT feature, coalesce(strftime(lend_tm, '%Y-%m'), 'NaT') AS ym, "
        f"{r('avg(CASE WHEN v IS NULL THEN 1.0 ELSE 0.0 END)', 4)} AS missing_rate, {r(exact_mean('v'), 4)} AS mean "
        f"FROM lg GROUP BY 1, 2"),
    "feature_grade": _eval("SELECT feature, iv, psi, missing_rate, grade FROM fg"),
    "feature_eval": _eval("SELECT feature, iv, psi, missing_rate, n_bins, grade FROM fg"),
    "source_eval": _eval("SELECT feature, iv, psi, missing_rate, grade FROM fg", C.SOURCE_FEATURES),
    "iv_gain": with_wide(
        f"SELECT f.feature, f.iv, m.max_source_iv, {r('f.iv - m.max_source_iv', 4)} AS iv_gain FROM fg f JOIN "
        "(SELECT p.feature, max(s.iv) AS max_source_iv FROM pairs p JOIN s_fg s ON s.feature = p.source "
        "GROUP BY p.feature) m ON m.feature = f.feature",
        DERIVED_CTE, SPLIT_CTE, *eval_ctes(C.EVAL_FEATURES), *eval_ctes(C.SOURCE_FEATURES, "s_"),
        "pairs AS (SELECT * FROM (VALUES " + ", ".join(
            f"('{f['name']}', '{s}')" for f in C.EVAL_SPEC for s in f["sources"]) + ") v(feature, source))"),
    "grade_normalise": _eval(
        "SELECT feature, t AS grade_text, CASE WHEN t IN ('优质', 'excellent') THEN 'excellent' "
        "WHEN t IN ('可用', 'usable') THEN 'usable' ELSE 'discard' END AS grade FROM "
        "(SELECT feature, [" + ", ".join("NULL" if w is None else f"'{w}'" for w in C.GRADE_TEXTS)
        + f"][position % {len(C.GRADE_TEXTS)} + 1] AS t FROM fg) x"),
    "eval_summary": _eval(
        f"SELECT count(*) AS total, CAST(sum(CASE WHEN grade = 'excellent' THEN 1 ELSE 0 END) AS BIGINT) AS excellent_cnt, "
        f"CAST(sum(CASE WHEN grade = 'usable' THEN 1 ELSE 0 END) AS BIGINT) AS usable_cnt, "
        f"CAST(sum(CASE WHEN grade = 'discard' THEN 1 ELSE 0 END) AS BIGINT) AS discard_cnt, "
        f"{r('sum(CASE WHEN grade IN (' + chr(39) + 'excellent' + chr(39) + ', ' + chr(39) + 'usable' + chr(39) + ') THEN 1 ELSE 0 END) / greatest(count(*), 1)', 3)} AS usable_rate FROM fg"),
    "top_features": _eval("SELECT row_number() OVER (ORDER BY iv DESC, position) AS rank, feature, iv, psi, "
                          "missing_rate, grade FROM fg ORDER BY iv DESC, position LIMIT 5"),
    "model_gate": _eval(
        f"SELECT usable_rate, n_usable, usable_rate <> 0 AND n_usable >= 2 AS train_model FROM "
        f"(SELECT {r('sum(CASE WHEN grade <> ' + chr(39) + 'discard' + chr(39) + ' THEN 1 ELSE 0 END) / greatest(count(*), 1)', 3)} AS usable_rate, "
        f"CAST(sum(CASE WHEN grade <> 'discard' THEN 1 ELSE 0 END) AS BIGINT) AS n_usable FROM fg) x"),
    "select_features": _eval(
        "SELECT row_number() OVER (ORDER BY CASE WHEN grade = 'excellent' THEN 0 ELSE 1 END, position) AS rank, "
        "feature, grade FROM fg WHERE grade IN ('excellent', 'usable') QUALIFY rank <= 50"),
    "impute_median": _eval("SELECT feature, median FROM med", None, "bin", SELECTION_CTES),
    "clip_sigma": _eval(
        f"SELECT feature, {r('mean', 6)} AS mean, {r('std', 6)} AS std, "
        f"CASE WHEN std > 0 THEN {r('mean - 5 * std', 6)} END AS lo, "
        f"CASE WHEN std > 0 THEN {r('mean + 5 * std', 6)} END AS hi FROM st", None, "bin", SELECTION_CTES),
    "coerce_numeric": _labelled("pid, coalesce(TRY_CAST(orderpriority AS DOUBLE), 0.0) AS orderpriority, "
                                "coalesce(TRY_CAST(ord_cnt_90d AS DOUBLE), 0.0) AS ord_cnt_90d"),
    "train_gate": with_wide("SELECT count(*) AS n_train, count(DISTINCT y) AS n_classes, "
                            "count(*) >= 100 AND count(DISTINCT y) >= 2 AS trainable FROM ms WHERE split = 'train'",
                            DERIVED_CTE, SPLIT_CTE, MODEL_SPLIT),
    "pos_weight": with_wide(
        f"SELECT n_pos, n_neg, {r('greatest(n_neg / greatest(n_pos, 1), 1.0)', 6)} AS pos_weight FROM "
        "(SELECT CAST(sum(y) AS BIGINT) AS n_pos, CAST(sum(1 - y) AS BIGINT) AS n_neg FROM ms WHERE split = 'train') x",
        DERIVED_CTE, SPLIT_CTE, MODEL_SPLIT),
    "class_weights": with_wide(
        f"SELECT y, n_class, {r('CAST(n AS DOUBLE) / (2.0 * n_class)', 6)} AS weight FROM "
        "(SELECT y, count(*) AS n_class, sum(count(*)) OVER () AS n FROM ms WHERE split = 'train' GROUP BY y) x",
        DERIVED_CTE, SPLIT_CTE, MODEL_SPLIT),
    "auc": _auc(SCORE_N_ITEMS, "n, auc"),
    "ks": _auc(SCORE_N_ITEMS, "n, ks"),
    "gini": _auc(SCORE_N_ITEMS, f"n, auc, {GINI}"),
    "ks_signed": with_wide(
        f"SELECT {r('greatest(max(pos_ge / P - neg_ge / N), 0.0)', 4)} AS ks FROM c",
        DERIVED_CTE, f"s AS ({SCORE_N_ITEMS})",
        "h AS (SELECT score, sum(y) AS pos, sum(1 - y) AS neg FROM s GROUP BY score)",
        "c AS (SELECT score, pos, neg, sum(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS pos_ge, "
        "sum(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS neg_ge, "
        "sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM h)"),
    "auc_share": _auc(SCORE_SHARE, f"n, auc, ks, {GINI}"),
    "report_features": _eval(
        "SELECT row_number() OVER (ORDER BY f.iv DESC, f.position) AS rank, f.feature, f.iv, f.psi, f.missing_rate, "
        "coalesce(t.template, '') AS template, f.grade, "
        "CAST(least(100.0, round_even(f.iv / greatest((SELECT coalesce(max(iv), 0.5) FROM fg), 0.01) * 100.0, 0)) "
        "AS BIGINT) AS bar_pct FROM fg f LEFT JOIN (VALUES " + ", ".join(
            f"('{s['name']}', '{s['template']}')" for s in C.EVAL_SPEC) + ") t(feature, template) "
        "ON t.feature = f.feature"),
    "report_headline": _eval(
        "SELECT count(*) AS total, CAST(sum(CASE WHEN grade = 'excellent' THEN 1 ELSE 0 END) AS BIGINT) AS excellent_cnt, "
        "CAST(sum(CASE WHEN grade = 'usable' THEN 1 ELSE 0 END) AS BIGINT) AS usable_cnt, "
        "CAST(NULL AS DOUBLE) AS best_auc FROM fg"),
}
