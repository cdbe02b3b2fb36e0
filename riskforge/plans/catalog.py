"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the driver's tables (via the wide table built from
``orders``, ``customer`` and ``lineitem``), over whole tables. Expensive shared
steps (the wide table, the derived table, the evaluation, the model run) are
materialised once per session and data folder under the shared checkpoint
folder and reused by the queries that need them.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable
from decimal import Decimal

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskforge.functions import templates as T
from riskforge.functions.columns import fround, label_binary
from riskforge.operators import evaluate as E
from riskforge.operators import prep as P
from riskforge.operators import profile as PR
from riskforge.operators import report as R
from riskforge.operators.binning import bin_of, equal_width_edges, single_bin
from riskforge.operators.derive import derive_table
from riskforge.operators.metrics import evaluate, monthly_metrics
from riskforge.operators.model import GBT_PARAMS, LR_C, add_weights, lr_coefficients, lr_gradient, lr_score, score, train_models
from riskforge.operators.ranking import auc_ks, signed_ks
from riskforge.operators.split import split_model, split_psi, split_summary
from riskforge.operators.windows import trailing
from riskforge.plans.flow import run
from riskforge.session import checkpoint_root, materialize
from riskforge.sources import readers as S
from riskforge.sources.sinks import default_model_dir, load_model, replace_table, save_derived, save_model, save_results
from riskforge.sources.tables import read_table, wide_orders

TARGET, ID, TIME = "is_bad", "pid", "lend_tm"

# The evaluated design: five derived features and four raw columns.
EVAL_SPEC = [
    T.ratio("feat_price_per_qty", "sum_price", "sum_qty", "price per unit"),
    T.diff("feat_net_price", "sum_price", "sum_disc", "price net of discounts"),
    T.ratio("feat_return_share", "returned_amt", "sum_price", "share of returned value"),
    T.log_transform("feat_log_totalprice", "totalprice", "log order value"),
    T.ratio("feat_bal_to_price", "acctbal", "totalprice", "balance over order value"),
]
EVAL_KEEP = ["n_items", "rare_cnt"]
EVAL_FEATURES = ["n_items", "feat_price_per_qty", "feat_net_price", "returned_amt", "feat_return_share",
                 "feat_log_totalprice", "acctbal", "feat_bal_to_price", "rare_cnt"]
SOURCE_FEATURES = ["sum_price", "sum_qty", "sum_disc", "returned_amt", "totalprice", "acctbal"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]

# One feature per template.
TEMPLATE_SPEC = {
    "tpl_ratio": T.ratio("feat_price_per_qty", "sum_price", "sum_qty"),
    "tpl_diff": T.diff("feat_net_price", "sum_price", "sum_disc"),
    "tpl_log": T.log_transform("feat_log_totalprice", "totalprice"),
    "tpl_window_diff": T.time_window_diff("feat_cnt_90d_minus_360d", "ord_cnt_90d", "ord_cnt_360d"),
    "tpl_window_compare": T.window_compare("feat_amt_rate_90_vs_360", "amt_90d", 90, "amt_360d", 360),
    "tpl_normalized": T.normalized("feat_totalprice_z", "totalprice", "mktsegment"),
    "tpl_flag": T.binary_flag("feat_is_urgent", "orderpriority", "`orderpriority` = '1-URGENT'"),
    "tpl_ordinal": T.ordinal_encode("feat_priority_rank", "orderpriority", PRIORITIES),
    "tpl_frequency": T.frequency_encode("feat_segment_freq", "mktsegment"),
    "fn_sqrt": T.sqrt("feat_sqrt_acctbal", "acctbal"),
}
FORMULA = T.spec("feat_price_per_item",
                 "CASE WHEN n_items > 3 THEN sum_price / n_items ELSE NULL END",
                 ["n_items", "sum_price"], "formula")
# digits kept in outputs of features computed with transcendental / moment functions
ROUND_DIGITS = {"feat_log_totalprice": 10, "feat_totalprice_z": 6}

_MEMO: dict = {}


def _memo(spark: SparkSession, sf_dir: str, what: str, fn: Callable):
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), what)
    if key not in _MEMO:
        _MEMO[key] = fn()
    return _MEMO[key]


def wide(spark, sf):
    return _memo(spark, sf, "wide", lambda: materialize(wide_orders(spark, sf), "wide_orders"))


def derived(spark, sf):
    return _memo(spark, sf, "derived", lambda: materialize(
        derive_table(wide(spark, sf), EVAL_SPEC, TARGET, ID, TIME, keep=EVAL_KEEP), "feat_derived_eval"))


def split_frame(spark, sf):
    """Derived table with the base / recent flag of the PSI split, shared by the evaluations of
    derived and source columns. The flag is a comparison with the cut key: no further copy is written."""
    return _memo(spark, sf, "split", lambda: split_psi(derived(spark, sf), TIME, ID)
                 .withColumn("is_base", F.col("split") == "base").drop("split"))


def evaluation(spark, sf):
    return _memo(spark, sf, "eval", lambda: evaluate(split_frame(spark, sf), EVAL_FEATURES, TARGET, TIME, ID,
                                                     base_col="is_base", write_input=False))


def source_evaluation(spark, sf):
    return _memo(spark, sf, "source_eval", lambda: evaluate(split_frame(spark, sf), SOURCE_FEATURES, TARGET,
                                                            TIME, ID, base_col="is_base", write_input=False))


def with_candidate(spark, sf):
    """The wide table with a further label column, commented, as a warehouse table would have."""
    flag = F.when(F.col("amt_90d").isNotNull(), (F.col(ID) % 3 == 0).cast("int"))
    return wide(spark, sf).withColumn("mob3_flag", flag.alias("mob3_flag", metadata={"comment": "overdue in month 3"}))


def wide_profile(spark, sf):
    return _memo(spark, sf, "profile", lambda: PR.profile(with_candidate(spark, sf)).cache())


def model_frame(spark, sf):
    """Derived table with y and a train / val / test split by time (a projection of the derived table)."""
    def build():
        d = derived(spark, sf)
        return split_model(d.withColumn("y", label_binary(F.col(TARGET), d.schema[TARGET].dataType)), TIME, ID)
    return _memo(spark, sf, "model_frame", build)


def selected(spark, sf) -> list[str]:
    return _memo(spark, sf, "selected", lambda: [
        r["feature"] for r in E.select_features(evaluation(spark, sf).features).orderBy("rank").collect()])


def prep_stats(spark, sf):
    def build():
        mf = model_frame(spark, sf)
        return P.fit_prep(mf.where(F.col("split") == "train"), selected(spark, sf), mf)
    return _memo(spark, sf, "prep", build)


def prepared(spark, sf):
    return _memo(spark, sf, "prepared", lambda: materialize(
        P.apply_prep(model_frame(spark, sf), selected(spark, sf), prep_stats(spark, sf))
        .select(ID, TIME, "y", "split", *selected(spark, sf)), "model_input"))


def model_run(spark, sf):
    return _memo(spark, sf, "run", lambda: train_models(
        prepared(spark, sf), selected(spark, sf)))


def _derive_one(spark, sf, key):
    spec = TEMPLATE_SPEC[key] if key in TEMPLATE_SPEC else FORMULA
    d = derive_table(wide(spark, sf), [spec], TARGET, ID, TIME)
    name = spec["name"]
    v = F.col(name)
    if name in ROUND_DIGITS:
        v = fround(v, ROUND_DIGITS[name])
    return d.select(ID, v.alias(name))


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[fround(F.col(c), ROUND_DIGITS[c]).alias(c) if c in ROUND_DIGITS else F.col(c)
                       for c in df.columns])


# ----------------------------------------------------------------- sources
def q_scan_limit(spark, sf):
    return S.scan(read_table(spark, sf, "orders"), ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"],
                  where="o_totalprice > 1000", order_by=["o_orderkey"], limit=500)


def q_row_count(spark, sf):
    parts = [S.row_count(read_table(spark, sf, t)).select(F.lit(t).alias("table_name"), "n_rows")
             for t in ("orders", "customer", "lineitem")]
    parts.append(S.row_count(wide(spark, sf)).select(F.lit("wide_orders").alias("table_name"), "n_rows"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_feature_matrix(spark, sf):
    return S.feature_matrix(derived(spark, sf), ["n_items", "feat_net_price", "acctbal", "n_items"],
                            TARGET, ID, TIME)


def q_feature_matrix_newest(spark, sf):
    return S.feature_matrix(derived(spark, sf), ["n_items", "feat_net_price", "acctbal"],
                            TARGET, ID, TIME, limit=5000)


def q_distinct_sample(spark, sf):
    return S.distinct_sample(wide(spark, sf), "acctbal", 30)


def q_derived_sink(spark, sf):
    d = derive_table(wide(spark, sf), EVAL_SPEC, TARGET, ID, TIME, keep=EVAL_KEEP)
    path = f"{checkpoint_root(spark).rstrip('/')}/derived-{spark.sparkContext.applicationId}/feat_derived_eval"
    _, status = save_derived(d, "eval", path=path)
    return status


def q_table_replaced(spark, sf):
    """The derived table under a name of the catalogue, replaced by one with a further column: the rows read by name."""
    name = "feat_derived_replaced_" + spark.sparkContext.applicationId.replace("-", "_") + f"_{zlib.crc32(sf.rstrip('/').encode()):08x}"
    d = derived(spark, sf).select(ID, TARGET, "feat_net_price")
    save_derived(d, name, as_table=True)
    return replace_table(d.withColumn("feat_is_refund", (F.col("feat_net_price") < 0).cast("int")), name, expect_rows=d.count())


def q_result_sink(spark, sf):
    ev = evaluation(spark, sf)
    out = f"{checkpoint_root(spark).rstrip('/')}/results-{spark.sparkContext.applicationId}"
    design = spark.createDataFrame([tuple(f[c] for c in S.SPEC_SCHEMA.names) for f in EVAL_SPEC], S.SPEC_SCHEMA)
    return save_results({"schema_analysis": wide_profile(spark, sf), "feature_design": design, "eval_results": ev.features,
                         "bins": ev.bins, "monthly": ev.monthly, "source_field_trends": source_evaluation(spark, sf).monthly}, out)


def q_spec_source(spark, sf):
    """A feature design read from a JSON file and derived."""
    path = f"{checkpoint_root(spark).rstrip('/')}/spec-{spark.sparkContext.applicationId}"
    text = json.dumps({"features": list(TEMPLATE_SPEC.values())}, ensure_ascii=False)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return _rounded(derive_table(wide(spark, sf), S.read_spec(spark, path), TARGET, ID, TIME))


def q_chosen_target(spark, sf):
    """The caller's label, and the one chosen where none is given."""
    prof = wide_profile(spark, sf)
    return spark.createDataFrame([(TARGET, PR.choose_target(prof, TARGET)), (None, PR.choose_target(prof))], "given string, chosen string")


def q_run_flow(spark, sf):
    """The whole flow to files: every artefact with its row count."""
    out = f"{checkpoint_root(spark).rstrip('/')}/flow-{spark.sparkContext.applicationId}-{zlib.crc32(sf.encode())}"
    return run(wide(spark, sf), EVAL_SPEC, TARGET, ID, TIME, name="flow", out_dir=out)["artifacts"]


def q_model_roundtrip(spark, sf):
    run = model_run(spark, sf)
    data = prepared(spark, sf).where(F.col("split") == "test")
    rows = []
    for name, model in run.models.items():
        path = save_model(model, default_model_dir(spark, f"{spark.sparkContext.applicationId}-{name}"))
        a = score(model, data).select(ID, F.col("score").alias("s1"))
        b = score(load_model(path), data).select(ID, F.col("score").alias("s2"))
        rows.append(a.join(b, ID).agg(F.lit(name).alias("model"), F.count(F.lit(1)).alias("n_scored"),
                                      F.max(F.abs(F.col("s1") - F.col("s2"))).alias("max_abs_diff")))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


# ----------------------------------------------------------------- profile
def q_profile(spark, sf):
    return wide_profile(spark, sf)


def q_missing_recent(spark, sf):
    w = wide(spark, sf)
    cols = [c for c in w.columns if c not in PR.SYSTEM_COLUMNS]
    return PR.missing_rates(PR.newest(w, TIME, ID, PR.RECENT_ROWS), cols)


def q_missing_sampled(spark, sf):
    w = wide(spark, sf)
    return PR.sampled_missing_rates(w, [c for c in w.columns if c not in PR.SYSTEM_COLUMNS])


def q_category_profile(spark, sf):
    return PR.category_profile(wide(spark, sf), ["mktsegment", "orderpriority"])


def q_usable_fields(spark, sf):
    return PR.usable_fields(wide_profile(spark, sf), TARGET)


def q_profile_summary(spark, sf):
    return PR.profile_summary(with_candidate(spark, sf), wide_profile(spark, sf), TARGET)


# ----------------------------------------------------------------- derivation
def _tpl(key):
    return lambda spark, sf: _derive_one(spark, sf, key)


def q_derive_table(spark, sf):
    return _rounded(derive_table(wide(spark, sf), list(TEMPLATE_SPEC.values()), TARGET, ID, TIME))


def q_auto_features(spark, sf):
    fields = [r["name"] for r in PR.usable_fields(wide_profile(spark, sf), TARGET)
              .where(F.col("col_type") == "numeric").orderBy("position").collect()]
    spec = T.auto_features(fields)
    out = derive_table(wide(spark, sf), spec, TARGET, ID, TIME, include_sources=False)
    return out.select(*[fround(F.col(c), 10).alias(c) if c.startswith("feat_log_") else F.col(c)
                        for c in out.columns])


# ----------------------------------------------------------------- label / split
TEXT_LABELS = ["1", "0", "是", "否", "Y", "n", " true ", "True", "1.0", "yes"]


def q_label_binary(spark, sf):
    w = wide(spark, sf)
    texts = F.array(*[F.lit(t) for t in TEXT_LABELS])
    y_text = F.when(F.col(TARGET).isNotNull(), F.element_at(texts, (F.col(ID) % len(TEXT_LABELS) + 1).cast("int")))
    return (w.select(ID, TARGET, y_text.alias("y_text"))
            .select(ID, "y_text", label_binary(F.col("y_text"), w.schema["mktsegment"].dataType).alias("y_from_text"),
                    label_binary(F.col(TARGET), w.schema[TARGET].dataType).alias("y_from_number")))


def q_split_psi(spark, sf):
    return split_psi(derived(spark, sf).select(ID, TIME), TIME, ID).select(ID, "split")


def q_split_decimal_id(spark, sf):
    """Order keys of 38 digits: a remainder with 20 decimal places, then an id beyond 64 bits."""
    d = derived(spark, sf).select(ID, (F.col(ID) % 7).cast("decimal(38,20)").alias("t"),
                                  (F.col(ID).cast("decimal(20,0)") + F.lit(Decimal(10 ** 30)).cast("decimal(31,0)")).alias("long_id"))
    return split_psi(d, "t", "long_id").select(ID, "split")


def q_split_model(spark, sf):
    return model_frame(spark, sf).select(ID, "split")


def q_split_positional(spark, sf):
    return split_model(derived(spark, sf).select(ID), None, ID).select(ID, "split")


def q_split_summary(spark, sf):
    s = split_summary(model_frame(spark, sf))
    return s.select("split", "n_rows", fround(F.col("positive_rate"), 4).alias("positive_rate"))


# ----------------------------------------------------------------- binning / metrics
def _bin_stats(d: DataFrame, feats: list[str], bins: dict) -> DataFrame:
    parts = []
    for f in feats:
        v = F.col(f).cast("double")
        parts.append(d.select(F.lit(f).alias("feature"), bins[f](v).alias("bin"), v.alias("v")))
    long = parts[0]
    for p in parts[1:]:
        long = long.unionByName(p)
    return (long.groupBy("feature", "bin")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.min("v").alias("min_value"), F.max("v").alias("max_value")))


def q_bins_equal_freq(spark, sf):
    ev = evaluation(spark, sf)
    d = derived(spark, sf)
    return _bin_stats(d, EVAL_FEATURES, {f: (lambda v, e=ev.edges[f]: bin_of(v, e)) for f in EVAL_FEATURES})


def q_bins_equal_width(spark, sf):
    d = derived(spark, sf)
    edges = equal_width_edges(d, {f: F.col(f).cast("double") for f in EVAL_FEATURES})
    return _bin_stats(d, EVAL_FEATURES, {f: (lambda v, e=edges[f]: bin_of(v, e)) for f in EVAL_FEATURES})


def q_bins_single(spark, sf):
    w = wide(spark, sf).where(F.col(TARGET).isNotNull())
    return (w.select(F.lit("mktsegment").alias("feature"), single_bin(F.col("mktsegment")).alias("bin"))
            .groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("n_rows")))


def q_woe_bins(spark, sf):
    return evaluation(spark, sf).bins.where(F.col("bin").isNotNull())


def q_woe_null_bin(spark, sf):
    return (evaluation(spark, sf).bins.where(F.col("bin").isNull())
            .select("feature", "count", "event", "non_event", "event_rate"))


def q_iv(spark, sf):
    return evaluation(spark, sf).features.select("feature", "iv")


def q_psi(spark, sf):
    return evaluation(spark, sf).features.select("feature", "psi")


def q_psi_by_rank(spark, sf):
    ev = evaluate(derived(spark, sf), EVAL_FEATURES, TARGET, TIME, ID, psi_align="rank")
    return ev.features.select("feature", "psi")


def q_missing_rate(spark, sf):
    return evaluation(spark, sf).missing


def q_monthly_means_large(spark, sf):
    """Means near 1e11 and near 1e-4, where the order of a plain sum would show."""
    rows = wide(spark, sf).select(TIME, (F.lit(123456789012.12345) + F.col("sum_price")).alias("big"), (F.col("sum_price") / F.lit(1e9)).alias("small"))
    return monthly_metrics(rows, ["big", "small"], TIME)


def q_formula_nested(spark, sf):
    """Window aggregates with nested calls, FILTER and computed keys."""
    formulas = {"feat_avg_or_none": "avg(sum_price) OVER (PARTITION BY coalesce(n_items % 3, -1))",
                "feat_max_abs": "max(abs(coalesce(sum_price, 0))) OVER (PARTITION BY n_items)",
                "feat_share_large": "sum_price / nullif(sum(sum_price) FILTER (WHERE n_items > 3) OVER (PARTITION BY n_items), 0)",
                "feat_range": "abs(max(greatest(sum_price, coalesce(abs(sum_price - 3), 0))) OVER () - min(sum_price) OVER (PARTITION BY n_items, n_items % 2))"}
    out = derive_table(wide(spark, sf), [{"name": n, "formula": f, "sources": ["sum_price", "n_items"]} for n, f in formulas.items()], TARGET, ID, None)
    return out.select(ID, "sum_price", "n_items", *(fround(F.col(n), 6).alias(n) for n in formulas))


EVENT_WINDOWS = (7, 30, 90)


def q_window_orders(spark, sf):
    """Per order, what its customer ordered in the 7, 30 and 90 days before."""
    orders = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    points = orders.select(F.col("o_orderkey").alias(ID), "o_custkey", "o_orderdate")
    return trailing(points, orders, "o_custkey", "o_orderdate", "o_custkey", "o_orderdate",
                    {"price": F.col("o_totalprice")}, EVENT_WINDOWS).drop("o_custkey", "o_orderdate")


def q_window_events(spark, sf):
    """Per user and day with an event, the purchases and errors of the 7, 30 and 90 days before."""
    ev = read_table(spark, sf, "events").select("user_id", "ts", "event_type", "value")
    points = ev.select("user_id", F.to_date("ts").alias("day")).distinct()
    spent = F.when(F.col("event_type") == "purchase", F.col("value"))
    errors = F.when(F.col("event_type") == "error", F.lit(1)).otherwise(F.lit(0))
    return trailing(points, ev, "user_id", "day", "user_id", "ts", {"spent": spent, "errors": errors}, EVENT_WINDOWS,
                    stats=("cnt", "sum", "max", "avg")).withColumn("day", F.date_format("day", "yyyy-MM-dd"))


def q_window_features(spark, sf):
    """Features designed on top of raw event windows: the window columns are the sources of the templates."""
    orders = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    keys = orders.select(F.col("o_orderkey").alias(ID), "o_custkey", "o_orderdate")
    win = trailing(keys, orders, "o_custkey", "o_orderdate", "o_custkey", "o_orderdate",
                   {"price": F.col("o_totalprice")}, EVENT_WINDOWS, stats=("cnt", "sum")).drop("o_custkey", "o_orderdate")
    spec = [T.time_window_diff("feat_cnt_7d_minus_90d", "win_cnt_7d", "win_cnt_90d"),
            T.window_compare("feat_price_rate_30_vs_90", "win_price_sum_30d", 30, "win_price_sum_90d", 90)]
    return derive_table(wide(spark, sf).join(win, ID), spec, TARGET, ID, TIME, include_sources=False).drop(TIME)


def q_monthly_metrics(spark, sf):
    return evaluation(spark, sf).monthly


def q_feature_grade(spark, sf):
    return evaluation(spark, sf).features.select("feature", "iv", "psi", "missing_rate", "grade")


def q_feature_eval(spark, sf):
    return evaluation(spark, sf).features.select("feature", "iv", "psi", "missing_rate", "n_bins", "grade")


def q_source_eval(spark, sf):
    return source_evaluation(spark, sf).features.select("feature", "iv", "psi", "missing_rate", "grade")


def q_iv_gain(spark, sf):
    return E.iv_gain(evaluation(spark, sf).features, source_evaluation(spark, sf).features, EVAL_SPEC, spark)


# words as they come from either language, an unknown one and none
GRADE_TEXTS = ["优质", "usable", "废弃", "excellent", "可用", "unheard of", None, "discard"]


def q_grade_normalise(spark, sf):
    f = evaluation(spark, sf).features
    words = F.array(*map(F.lit, GRADE_TEXTS))
    text = F.element_at(words, (F.col("position") % len(GRADE_TEXTS) + 1).cast("int"))
    return f.select("feature", text.alias("grade_text"), E.grade_normalise(text).alias("grade"))


def q_eval_summary(spark, sf):
    return E.eval_summary(evaluation(spark, sf).features)


def q_top_features(spark, sf):
    return E.top_features(evaluation(spark, sf).features)


def q_model_gate(spark, sf):
    return E.model_gate(E.eval_summary(evaluation(spark, sf).features))


# ----------------------------------------------------------------- modelling
def q_select_features(spark, sf):
    return E.select_features(evaluation(spark, sf).features)


def q_impute_median(spark, sf):
    st = prep_stats(spark, sf)
    rows = [(c, float(st.medians[c]) if st.medians.get(c) is not None else None) for c in st.float_like]
    return spark.createDataFrame(rows, "feature string, median double")


def q_clip_sigma(spark, sf):
    st = prep_stats(spark, sf)
    rows = []
    for c in st.float_like:
        b = st.bounds(c)
        rows.append((c, st.means[c], st.stds[c], b[0] if b else None, b[1] if b else None))
    df = spark.createDataFrame(rows, "feature string, mean double, std double, lo double, hi double")
    return df.select("feature", *[fround(F.col(c), 6).alias(c) for c in ("mean", "std", "lo", "hi")])


def q_coerce_numeric(spark, sf):
    w = wide(spark, sf).where(F.col(TARGET).isNotNull())
    st = P.PrepStats(float_like=[], medians={}, means={}, stds={})
    return P.apply_prep(w.select(ID, "orderpriority", "ord_cnt_90d"), ["orderpriority", "ord_cnt_90d"], st)


def _train(spark, sf):
    return model_frame(spark, sf).where(F.col("split") == "train")


def q_train_gate(spark, sf):
    return P.train_gate(_train(spark, sf))


def q_pos_weight(spark, sf):
    return P.pos_weight(_train(spark, sf)).select("n_pos", "n_neg", fround(F.col("pos_weight"), 6).alias("pos_weight"))


def q_class_weights(spark, sf):
    return P.class_weights(_train(spark, sf)).select("y", "n_class", fround(F.col("weight"), 6).alias("weight"))


def q_model_gbt(spark, sf):
    return model_run(spark, sf).metrics.where(F.col("model") == "gbt")


def q_model_lr(spark, sf):
    return model_run(spark, sf).metrics.where(F.col("model") == "lr")


def q_model_score(spark, sf):
    run = model_run(spark, sf)
    data = prepared(spark, sf).where(F.col("split") == "test")
    return score(run.models[run.best or "gbt"], data).select(ID, "split", "score")


def _scored_rows(spark, sf):
    d = derived(spark, sf)
    return d.select(label_binary(F.col(TARGET), d.schema[TARGET].dataType).alias("y"),
                    F.coalesce(F.col("n_items"), F.lit(0)).alias("score"))


def q_auc(spark, sf):
    return auc_ks(_scored_rows(spark, sf), F.col("y"), F.col("score")).select("n", "auc")


def q_ks(spark, sf):
    return auc_ks(_scored_rows(spark, sf), F.col("y"), F.col("score")).select("n", "ks")


def q_ks_signed(spark, sf):
    return signed_ks(_scored_rows(spark, sf), F.col("y"), F.col("score"))


def q_gini(spark, sf):
    return auc_ks(_scored_rows(spark, sf), F.col("y"), F.col("score")).select("n", "auc", "gini")


def q_auc_share(spark, sf):
    d = derived(spark, sf)
    s = d.select(label_binary(F.col(TARGET), d.schema[TARGET].dataType).alias("y"),
                 F.coalesce(F.col("feat_return_share"), F.lit(0.0)).alias("score"))
    return auc_ks(s, F.col("y"), F.col("score"))


def q_importance(spark, sf):
    return model_run(spark, sf).importance


def q_boost_curve(spark, sf):
    """Validation AUC after every boosting round that was tried; the rounds up to the best are kept."""
    model = model_run(spark, sf).models["gbt"]
    return spark.createDataFrame([(i, auc, i <= model.rounds) for i, auc in enumerate(model.curve, 1)], "round int, val_auc double, kept boolean")


def q_boost_trees(spark, sf):
    """Every node of the kept trees, read back from the written model."""
    model = model_run(spark, sf).models["gbt"]
    path = save_model(model, default_model_dir(spark, f"{spark.sparkContext.applicationId}-trees"))
    return load_model(path).table(spark)


def q_boost_checks(spark, sf):
    """The written trees against the training rules and the reported importance, from the tables alone."""
    trees = q_boost_trees(spark, sf).where("tree >= 0")
    kids = trees.where("left >= 0").select("tree", "n", F.explode(F.array("left", "right")).alias("node"))
    sums = (kids.join(trees.select("tree", "node", F.col("n").alias("child_n"), "value"), ["tree", "node"]))
    whole = sums.agg((F.min("child_n") >= GBT_PARAMS["min_rows"]).alias("least_rows_ok"))
    pairs = sums.groupBy("tree", "n").agg(F.sum("child_n").alias("c"), F.count(F.lit(1)).alias("k"))
    split = trees.where("feature IS NOT NULL").groupBy("feature").agg(F.count(F.lit(1)).alias("k"))
    share = split.select("feature", fround(F.col("k") / F.sum("k").over(Window.partitionBy()), 4).alias("share"))    # one row per feature
    same = share.join(model_run(spark, sf).importance, "feature", "full").agg(
        F.bool_and(F.coalesce(F.col("share"), F.lit(0.0)) == F.col("importance")).alias("importance_ok"))
    size = trees.groupBy("tree").agg(F.sum((F.col("left") < 0).cast("int")).alias("leaves"))
    curve = q_boost_curve(spark, sf)
    kept = curve.agg((F.max_by("round", F.struct("val_auc", -F.col("round"))) == F.sum(F.col("kept").cast("int"))).alias("best_prefix_ok"),
                     (F.count(F.lit(1)) - F.sum(F.col("kept").cast("int")) <= GBT_PARAMS["patience"]).alias("patience_ok"))
    return (whole.crossJoin(pairs.agg(F.bool_and(F.col("c") == F.col("n") * F.col("k") / 2).alias("rows_ok")))      # one row each
            .crossJoin(size.agg((F.max("leaves") <= GBT_PARAMS["leaves"]).alias("leaves_ok"))).crossJoin(same).crossJoin(kept))


def q_model_metrics(spark, sf):
    return model_run(spark, sf).metrics


def q_best_model(spark, sf):
    run = model_run(spark, sf)
    return spark.createDataFrame([(run.best, float(run.best_test_auc))], "best_model string, best_test_auc double")


def q_model_samples(spark, sf):
    """Rows of each part and the training positive rate, as the model cards show them."""
    run_ = model_run(spark, sf)
    rate = _train(spark, sf).agg(fround(F.avg(F.col("y").cast("double")), 4)).first()[0]
    cards = R.report_models(run_, spark, rate)
    rows = run_.metrics.groupBy("model").agg(F.sum(F.when(F.col("split") == "val", F.col("n"))).alias("val_scored"),
                                             F.sum(F.when(F.col("split") == "test", F.col("n"))).alias("test_scored"))
    return cards.join(rows, "model").select("model", "train_samples", "val_samples", "test_samples", "positive_rate",
                                            "val_scored", "test_scored")


def q_score_checks(spark, sf):
    """Per model, on the stored test scores: rows, bounds, and the reported AUC against Spark ML's own evaluator."""
    run_ = model_run(spark, sf)
    test = prepared(spark, sf).where(F.col("split") == "test")
    reported = {r["model"]: r["auc"] for r in run_.metrics.where("split = 'test'").collect()}
    own = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="y", numBins=0)
    parts = []
    for name, model in run_.models.items():
        s = score(model, test)
        parts.append(s.agg(F.lit(name).alias("model"), F.count(F.lit(1)).alias("n_scored"),
                           ((F.min("score") >= 0) & (F.max("score") <= 1)).alias("in_bounds"),
                           F.lit(abs(own.evaluate(s) - reported[name]) < 1e-4).alias("auc_agrees")))
    return parts[0].unionByName(parts[1])


def q_lr_coefficients(spark, sf):
    """The trained logistic regression: standardisation and coefficient of every feature, and the intercept."""
    run_ = model_run(spark, sf)
    return lr_coefficients(run_.models["lr"], run_.features)


def q_lr_checks(spark, sf):
    """Per coefficient, whether the gradient of the penalised loss vanishes over the training rows, and whether the
    scores computed from the table alone are the model's."""
    run_ = model_run(spark, sf)
    table = q_lr_coefficients(spark, sf)
    rows = prepared(spark, sf)
    train = rows.where(F.col("split") == "train")
    weighted = add_weights(rows, train).where(F.col("split") == "train")
    gradient = lr_gradient(weighted, table, F.col("w_bal"), 1.0 / (LR_C * max(run_.samples["train"], 1)))
    own = score(run_.models["lr"], rows.where(F.col("split") == "test")).withColumn("again", lr_score(table))
    same = own.agg(F.max(F.abs(F.col("score") - F.col("again"))).alias("off")).first()["off"]
    return gradient.select("feature", (F.abs(F.col("gradient")) < 1e-4).alias("gradient_zero"),
                           F.lit(same is not None and same < 1e-9).alias("scores_agree"))


SCORE_PARTS = 1 << 16


def q_metric_checks(spark, sf):
    """Per model and split: rows, and the reported AUC, KS and Gini recomputed from the scores alone. KS is the largest
    gap of the two shares at any score, AUC the share of (positive, negative) pairs in order; both from one row per
    score, ordered inside one of SCORE_PARTS equal parts of [0, 1], with the sums of the parts below."""
    run_ = model_run(spark, sf)
    rows = prepared(spark, sf).where(F.col("split").isin("val", "test"))
    parts = [score(m, rows).select(F.lit(n).alias("model"), "split", "y", "score") for n, m in run_.models.items()]
    part = ["model", "split", "part"]
    per = (parts[0].unionByName(parts[1]).groupBy("model", "split", F.floor(F.col("score") * SCORE_PARTS).alias("part"), "score")
           .agg(F.sum("y").cast("double").alias("p"), F.sum(1 - F.col("y")).cast("double").alias("q")))
    before, all_ = Window.partitionBy("model", "split").orderBy("part"), Window.partitionBy("model", "split")
    sums = per.groupBy(*part).agg(F.sum("p").alias("sp"), F.sum("q").alias("sq"))      # at most SCORE_PARTS + 1 rows a model and split
    sums = sums.select(*part, (F.sum("sp").over(before) - F.col("sp")).alias("bp"), (F.sum("sq").over(before) - F.col("sq")).alias("bq"),
                       F.sum("sp").over(all_).alias("tp"), F.sum("sq").over(all_).alias("tq"))
    up = Window.partitionBy(*part).orderBy("score").rowsBetween(Window.unboundedPreceding, 0)
    per = per.join(sums, part).select("model", "split", "p", "q", "tp", "tq", (F.col("bp") + F.sum("p").over(up)).alias("cp"),
                                      (F.col("bq") + F.sum("q").over(up)).alias("cq"))
    own = per.groupBy("model", "split").agg(
        (F.max("tp") + F.max("tq")).cast("long").alias("n_own"), F.max(F.abs(F.col("cp") / F.col("tp") - F.col("cq") / F.col("tq"))).alias("ks_own"),
        (F.sum(F.col("p") * (F.col("cq") - F.col("q") / 2)) / F.max("tp") / F.max("tq")).alias("auc_own"))
    near = 5.1e-5
    return run_.metrics.join(own, ["model", "split"]).select(
        "model", "split", "n", (F.col("n") == F.col("n_own")).alias("rows_agree"),
        (F.abs(F.col("auc") - F.col("auc_own")) < near).alias("auc_agrees"), (F.abs(F.col("ks") - F.col("ks_own")) < near).alias("ks_agrees"),
        (F.abs(F.col("gini") - (2 * F.col("auc_own") - 1)) < 4 * near).alias("gini_agrees"))


def q_report_checks(spark, sf):
    """The headline of a run with models, and the model cards: the best AUC is that of the one card marked best."""
    run_ = model_run(spark, sf)
    head = R.report_headline(E.eval_summary(evaluation(spark, sf).features), run_)
    rate = _train(spark, sf).agg(F.avg("y")).first()[0]
    cards = R.report_models(run_, spark, round(float(rate), 4))
    test = run_.metrics.where("split = 'test'")
    same = cards.join(test.select("model", *[F.col(c).alias(f"m_{c}") for c in ("auc", "ks", "gini")]), "model")
    checks = same.agg(F.count(F.lit(1)).alias("n_cards"), F.sum(F.col("is_best").cast("int")).cast("long").alias("n_best"),
                      F.max("train_samples").alias("train_samples"), F.max("test_samples").alias("test_samples"),
                      F.bool_and((F.col("auc") == F.col("m_auc")) & (F.col("ks") == F.col("m_ks")) & (F.col("gini") == F.col("m_gini"))).alias("cards_agree"),
                      F.max(F.when(F.col("is_best"), F.col("auc"))).alias("card_auc"), F.max("auc").alias("top_auc"))
    return head.crossJoin(checks).select(        # one row each
        "total", "excellent_cnt", "usable_cnt", "n_cards", "n_best", "train_samples", "test_samples", "cards_agree",
        ((F.col("best_auc") == F.col("card_auc")) & (F.col("best_auc") == F.col("top_auc"))).alias("best_auc_agrees"))


def q_importance_checks(spark, sf):
    """Ranks without gaps, falling importances that sum to one, the largest at 100 percent, best model by test AUC."""
    run_ = model_run(spark, sf)
    top = R.report_importance(run_)
    steps = top.withColumn("up", F.col("importance") > F.lag("importance").over(Window.orderBy("rank")))   # at most 20 rows
    best = run_.metrics.where("split = 'test'").agg(F.max("auc")).first()[0]
    return steps.agg(F.count(F.lit(1)).alias("n_features"), (F.max("rank") == F.count(F.lit(1))).alias("ranks_ok"),
                     (~F.max(F.coalesce("up", F.lit(False)))).alias("falling"), (F.max("pct") == 100).alias("top_is_100"),
                     F.lit(run_.best_test_auc == best).alias("best_is_max"))


# ----------------------------------------------------------------- report
def q_report_features(spark, sf):
    return R.report_features(evaluation(spark, sf).features, EVAL_SPEC, spark)


def q_report_headline(spark, sf):
    return R.report_headline(E.eval_summary(evaluation(spark, sf).features), None)


def q_report_models(spark, sf):
    run = model_run(spark, sf)
    pr = _train(spark, sf).agg(F.avg("y")).first()[0]
    return R.report_models(run, spark, round(float(pr), 4))


def q_report_importance(spark, sf):
    return R.report_importance(model_run(spark, sf))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_limit": q_scan_limit,
    "row_count": q_row_count,
    "feature_matrix": q_feature_matrix,
    "feature_matrix_newest": q_feature_matrix_newest,
    "distinct_sample": q_distinct_sample,
    "derived_sink": q_derived_sink,
    "table_replaced": q_table_replaced,
    "result_sink": q_result_sink,
    "spec_source": q_spec_source,
    "chosen_target": q_chosen_target,
    "run_flow": q_run_flow,
    "model_roundtrip": q_model_roundtrip,
    "profile": q_profile,
    "missing_recent": q_missing_recent,
    "missing_sampled": q_missing_sampled,
    "category_profile": q_category_profile,
    "usable_fields": q_usable_fields,
    "profile_summary": q_profile_summary,
    **{k: _tpl(k) for k in TEMPLATE_SPEC},
    "formula_expr": _tpl("formula_expr"),
    "derive_table": q_derive_table,
    "auto_features": q_auto_features,
    "label_binary": q_label_binary,
    "split_psi": q_split_psi,
    "split_decimal_id": q_split_decimal_id,
    "split_model": q_split_model,
    "split_positional": q_split_positional,
    "split_summary": q_split_summary,
    "bins_equal_freq": q_bins_equal_freq,
    "bins_equal_width": q_bins_equal_width,
    "bins_single": q_bins_single,
    "woe_bins": q_woe_bins,
    "woe_null_bin": q_woe_null_bin,
    "iv": q_iv,
    "psi": q_psi,
    "psi_by_rank": q_psi_by_rank,
    "missing_rate": q_missing_rate,
    "monthly_metrics": q_monthly_metrics,
    "monthly_means_large": q_monthly_means_large,
    "formula_nested": q_formula_nested,
    "window_orders": q_window_orders,
    "window_events": q_window_events,
    "window_features": q_window_features,
    "feature_grade": q_feature_grade,
    "feature_eval": q_feature_eval,
    "source_eval": q_source_eval,
    "iv_gain": q_iv_gain,
    "grade_normalise": q_grade_normalise,
    "eval_summary": q_eval_summary,
    "top_features": q_top_features,
    "model_gate": q_model_gate,
    "select_features": q_select_features,
    "impute_median": q_impute_median,
    "clip_sigma": q_clip_sigma,
    "coerce_numeric": q_coerce_numeric,
    "train_gate": q_train_gate,
    "pos_weight": q_pos_weight,
    "class_weights": q_class_weights,
    "model_gbt": q_model_gbt,
    "model_lr": q_model_lr,
    "boost_curve": q_boost_curve,
    "boost_trees": q_boost_trees,
    "boost_checks": q_boost_checks,
    "model_score": q_model_score,
    "auc": q_auc,
    "ks": q_ks,
    "gini": q_gini,
    "ks_signed": q_ks_signed,
    "auc_share": q_auc_share,
    "importance": q_importance,
    "model_samples": q_model_samples,
    "score_checks": q_score_checks,
    "importance_checks": q_importance_checks,
    "lr_coefficients": q_lr_coefficients,
    "lr_checks": q_lr_checks,
    "metric_checks": q_metric_checks,
    "report_checks": q_report_checks,
    "model_metrics": q_model_metrics,
    "best_model": q_best_model,
    "report_features": q_report_features,
    "report_headline": q_report_headline,
    "report_models": q_report_models,
    "report_importance": q_report_importance,
}
