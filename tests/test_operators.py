"""Order statistics, splits, ranking metrics, labels, derivation and profiling."""

import datetime as dt
import math
import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

import riskforge.operators.quantiles as Q
from riskforge.functions import templates as T
from riskforge.functions.columns import label_binary
from riskforge.operators.derive import derive_table
from riskforge.operators.profile import category_profile, profile
from riskforge.operators.ranking import auc_ks
from riskforge.operators.split import split_model, split_psi


@pytest.fixture
def narrow_path(monkeypatch):
    """Force several rounds on small data."""
    monkeypatch.setattr(Q, "SPLITTERS", 8)
    monkeypatch.setattr(Q, "KEEP", 4)


def _values(seed, n):
    rnd = random.Random(seed)
    vals = [rnd.randint(-500, 500) / 4 for _ in range(n)]
    vals[: n // 3] = [7.25] * (n // 3)          # a hot value holding a third of the rows
    rnd.shuffle(vals)
    return vals


@pytest.mark.parametrize("path", ["histogram", "narrow"])
def test_order_stats_match_sort(spark, request, path):
    if path == "narrow":
        request.getfixturevalue("narrow_path")
    a, b = _values(1, 900), _values(2, 900)
    b = [None if i % 5 == 0 else v for i, v in enumerate(b)]
    df = spark.createDataFrame(list(zip(a, b, range(900))), "a double, b double, k long")
    groups = {"a": F.col("a"), "b": F.col("b"), "k": F.col("k")}
    counts = Q.group_counts(df, groups)
    ranks = {g: [0, 1, n // 3, n // 2, n - 2, n - 1] for g, n in counts.items()}
    got = Q.order_stats(df, groups, ranks, counts)
    for g, col in (("a", a), ("b", b), ("k", list(range(900)))):
        s = np.sort(np.array([v for v in col if v is not None]))
        for r in ranks[g]:
            value, n_lt = got[(g, r)]
            assert value == s[r]
            assert n_lt == int((s < s[r]).sum())


def test_interpolated_quantiles_match_numpy(spark, narrow_path):
    vals = _values(3, 400)
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    probs = np.linspace(0, 1, 11).tolist()
    got = Q.interpolated_quantiles(df, {"x": F.col("x")}, probs)["x"]
    want = np.quantile(np.array(vals), probs)
    assert np.allclose(got, want, rtol=0, atol=1e-12)


def _split_frame(spark):
    rnd = random.Random(5)
    rows = []
    for i in range(300):
        day = None if i % 50 == 7 else dt.datetime(2024, 1, 1) + dt.timedelta(days=rnd.randint(0, 9))
        rows.append((rnd.randint(0, 10**9) * 1000 + i, day))
    return spark.createDataFrame(rows, "pid long, lend_tm timestamp_ntz"), rows


def test_split_follows_time_then_id_nulls_last(spark):
    df, rows = _split_frame(spark)
    out = {r["pid"]: r["split"] for r in split_model(df, "lend_tm", "pid").collect()}
    order = sorted(rows, key=lambda r: (r[1] is None, r[1] or dt.datetime.min, r[0]))
    n = len(order)
    k1, k2 = int(n * 0.6), int(n * (0.6 + 0.2))
    want = {r[0]: ("train" if i < k1 else "val" if i < k2 else "test") for i, r in enumerate(order)}
    assert out == want


def test_split_psi_counts(spark, narrow_path):
    df, rows = _split_frame(spark)
    got = dict(split_psi(df, "lend_tm", "pid").groupBy("split").count().collect())
    assert got == {"base": int(300 * 0.6), "recent": 300 - int(300 * 0.6)}


def test_auc_ks_with_ties(spark):
    y = [1, 1, 0, 1, 0, 0, 1, 0]
    s = [.9, .8, .8, .6, .5, .5, .5, .1]
    df = spark.createDataFrame(list(zip(y, s)), "y int, s double")
    r = auc_ks(df, F.col("y"), F.col("s")).first()
    # 0.78125 exactly: rounded half away from zero like SQL engines
    assert (r["auc"], r["ks"], r["gini"]) == (0.7813, 0.5, 0.5626)


def test_auc_symmetry_and_single_class(spark):
    rnd = random.Random(9)
    rows = [(rnd.randint(0, 1), float(rnd.randint(0, 30))) for _ in range(500)]
    df = spark.createDataFrame(rows, "y int, s double")
    a = auc_ks(df, F.col("y"), F.col("s")).first()["auc"]
    b = auc_ks(df, F.col("y"), -F.col("s")).first()["auc"]
    assert abs(a + b - 1.0) <= 1e-4
    one = spark.createDataFrame([(1, 0.3), (1, 0.5)], "y int, s double")
    r = auc_ks(one, F.col("y"), F.col("s")).first()
    assert (r["auc"], r["ks"], r["gini"]) == (0.0, 0.0, 0.0)


def test_label_binary_text_and_numbers(spark):
    texts = ["1", "0", "是", "否", "Y", "n", " true ", "True", "1.0", "yes", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(label_binary(F.col("t"), df.schema["t"].dataType)).collect()]
    assert got == [1, 0, 1, 0, 1, 0, 1, 1, 0, 1, 0]
    nums = spark.createDataFrame([(1.0,), (0.0,), (None,)], "v double")
    assert [r[0] for r in nums.select(label_binary(F.col("v"), nums.schema["v"].dataType)).collect()] == [1, 0, 0]


def test_monthly_means(spark):
    from riskforge.operators.metrics import monthly_metrics
    inf = float("inf")
    rows = [("2024-01-05", 0.00004999, inf, 1e33, True), ("2024-01-06", 0.00004999, 2.0, 1e33, False), (None, 1.0, 2.0, None, None)]
    df = spark.createDataFrame(rows, "t string, a double, b double, c double, d boolean").withColumn("t", F.col("t").cast("timestamp"))
    got = {(r["feature"], r["ym"]): r["mean"] for r in monthly_metrics(df, ["a", "b", "c", "d"], "t").collect()}
    assert got == {("a", "2024-01"): 0.0, ("b", "2024-01"): inf, ("c", "2024-01"): 1e33, ("d", "2024-01"): 0.5,
                   ("a", "NaT"): 1.0, ("b", "NaT"): 2.0, ("c", "NaT"): None, ("d", "NaT"): None}


def test_monthly_means_do_not_depend_on_the_order(spark):
    from fractions import Fraction

    from riskforge.operators.metrics import monthly_metrics
    rnd = random.Random(4)
    values = [rnd.choice([1e-9, 1.0, 1e6, 1e11, 1e15]) * rnd.uniform(-1, 1) for _ in range(500)] + [123456789012.12345, -4503599627370.5]
    want = float(sum(map(Fraction, values)) / len(values))
    for seed in (0, 1):
        random.Random(seed).shuffle(values)
        df = spark.createDataFrame([("2024-01-05", v) for v in values], "t string, v double").repartition(5).withColumn("t", F.col("t").cast("date"))
        assert monthly_metrics(df, ["v"], "t").first()["mean"] == pytest.approx(want, rel=1e-15, abs=1e-4)
    for v in (123456789012.12345, 4503599627370.5, -0.00015, 0.78125):
        one = spark.createDataFrame([("2024-01-05", v)] * 3, "t string, v double").withColumn("t", F.col("t").cast("date"))
        assert monthly_metrics(one, ["v"], "t").first()["mean"] == math.copysign(math.floor(abs(v) * 1e4 + 0.5) / 1e4, v)


def test_decimal_ids_are_split_exactly(spark):
    from riskforge.operators.split import split_by_order
    big = 10 ** 18
    cases = [("decimal(38,0)", [Decimal(big * big // 10 + i) for i in range(50)]), ("decimal(19,0)", [Decimal(big + i) for i in range(50)]),
             ("decimal(38,20)", [Decimal(i - 25) + Decimal(i).scaleb(-20) for i in range(50)]),
             ("decimal(38,30)", [Decimal(f"-{(10 ** 30 - i) // 10 ** 30}.{(10 ** 30 - i) % 10 ** 30:030d}") for i in range(50)]),
             ("decimal(9,2)", [Decimal(i - 25).scaleb(-2) for i in range(50)]), ("decimal(38,2)", [(i - 25) * Decimal(10) ** 33 for i in range(50)])]
    for kind, ids in cases:
        ids = [*ids, None]
        rows = list(enumerate(ids))
        random.Random(1).shuffle(rows)
        df = spark.createDataFrame(rows, f"place int, pid {kind}")
        parts = split_by_order(df, ["pid"], [0.6, 0.2], ["a", "b", "c"]).groupBy("split").agg(F.min("place"), F.max("place")).collect()
        assert sorted(map(tuple, parts)) == [("a", 0, 29), ("b", 30, 39), ("c", 40, 50)], kind


def test_formulas_of_any_nesting(spark):
    from riskforge.operators.derive import derive_table, split_windows
    rows = [(i, 1, float(i % 7) if i % 5 else None, "ab"[i % 2] if i % 3 else None) for i in range(40)]
    df = spark.createDataFrame(rows, "pid int, y int, x double, g string")
    formulas = ["AVG(x) OVER (PARTITION BY coalesce(g, 'z'))", "MAX(abs(coalesce(x, 0))) OVER (PARTITION BY g)",
                "coalesce(x, 0) / nullif(SUM(x) FILTER (WHERE x > 3) OVER (PARTITION BY g), 0)",
                "CASE WHEN g = 'SUM(x) OVER ()' THEN -1 ELSE round(abs(min(x + 1) OVER () - max(greatest(x, abs(x - 3))) OVER (PARTITION BY g, y)), 3) END"]
    out = derive_table(df, [{"name": f"f{i}", "formula": f, "sources": ["x", "g"]} for i, f in enumerate(formulas)], "y", time_col=None)
    plain = [f.replace("SUM(x) FILTER (WHERE x > 3)", "SUM(CASE WHEN x > 3 THEN x END)") for f in formulas]    # Spark's windows know no FILTER
    want = df.select("pid", *(F.expr(f).alias(f"f{i}") for i, f in enumerate(plain)))
    names = [c for c in out.columns if c.startswith("f")]
    assert len(names) == 4
    assert sorted(map(tuple, out.select("pid", *names).collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    for bad in ("SUM(x) OVER (PARTITION BY g ORDER BY pid)", "ROW_NUMBER() OVER (ORDER BY x)", "SUM(x) OVER (ROWS UNBOUNDED PRECEDING)"):
        with pytest.raises(ValueError):
            split_windows(bad)


def test_boolean_feature_is_evaluated_as_a_number(spark):
    from riskforge.operators.metrics import evaluate
    rows = [(i, i % 5 < 2, int((i % 5 < 2) == (i % 7 != 0))) for i in range(350)]
    df = spark.createDataFrame(rows, "pid long, b boolean, y int").withColumn("n", F.col("b").cast("int"))
    got = {r["feature"]: (r["iv"], r["n_bins"]) for r in evaluate(df, ["b", "n"], "y", None).features.collect()}
    assert got["b"] == got["n"] and got["b"][0] > 0 and got["b"][1] == 2


def test_split_with_text_ids_and_ties(spark):
    rnd = random.Random(4)
    ids = ["", "a", "ab", "abcdefg", "abcdefgh", "abcdef", "é", "漢字", "Z" * 30, "Z" * 31] + [f"L-{rnd.randrange(10**9):012d}" for _ in range(190)]
    rows = [(p, rnd.randrange(4) if rnd.random() < .9 else None) for p in ids] + [(None, 1)]
    df = spark.createDataFrame(rows, "pid string, t int")
    order = sorted(rows, key=lambda r: (r[1] is None, r[1] or 0, r[0] is None, (r[0] or "").encode()))
    got = {r["pid"]: r["split"] for r in split_model(df, "t", "pid").collect()}
    n = len(rows)
    assert [got[p] for p, _ in order] == ["train"] * int(n * .6) + ["val"] * (int(n * .8) - int(n * .6)) + ["test"] * (n - int(n * .8))


def _spec(name, formula, sources, template):
    from riskforge.functions import templates as T
    return T.spec(name, formula, sources, template)


def test_formulas_run_whatever_their_template(spark):
    df = spark.createDataFrame([(i, 1, float(i), i % 3) for i in range(30)], "pid long, y int, x double, k int")
    feats = [_spec("a", "x / NULLIF(k, 0)", ["x", "k"], "normalized"),
             _spec("b", "COUNT(x) OVER (PARTITION BY k) / 10.0D", ["x", "k"], "frequency_encode"),
             _spec("c", "x - AVG(x) OVER ()", ["x"], "normalized"),
             _spec("d", "CASE WHEN 'SUM(x) OVER (ORDER BY x)' = '' THEN 1 ELSE MAX(x + k) OVER (partition by k, x > 15) END", ["x", "k"], "formula")]
    rows = derive_table(df, feats, "y", "pid", None).collect()
    for r in rows:
        assert r["feat_a"] == (None if r["k"] == 0 else r["x"] / r["k"]) and r["feat_b"] == 1.0 and r["feat_c"] == r["x"] - 14.5
        assert r["feat_d"] == max(i + i % 3 for i in range(30) if i % 3 == r["k"] and (i > 15) == (r["x"] > 15))
    for bad in ("SUM(x) OVER (ORDER BY x)", "SUM(x) OVER (PARTITION BY k ORDER BY x)"):
        with pytest.raises(ValueError):
            derive_table(df, [_spec("e", bad, ["x"], "formula")], "y", "pid", None)
    with pytest.raises(ValueError):
        derive_table(df, [_spec("e", "x", ["nope"], "formula")], "y", "pid", None)


def test_few_keys_do_not_shuffle_rows_and_hot_keys_of_many_are_kept_apart(spark, monkeypatch):
    from riskforge.functions import templates as T
    from riskforge.operators import derive
    df = spark.range(2000).select(F.col("id").alias("pid"), F.lit(1).alias("y"), (F.col("id") % 7).cast("double").alias("x"),
                                  F.when(F.col("id") < 700, 0).otherwise(F.col("id")).alias("k"))
    spec = [T.frequency_encode("f", "k"), T.normalized("z", "x", "k")]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = derive_table(df, spec, "y", "pid", None)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        plain = sorted(map(tuple, derive_table(df, spec, "y", "pid", None).collect()))
        monkeypatch.setattr(derive, "BROADCAST_KEYS", 5)
        salted = derive_table(df, spec, "y", "pid", None)
        assert "SortMergeJoin" in salted._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, salted.collect())) == plain and {r["feat_f"] for r in salted.collect()} == {1, 700}
        monkeypatch.setattr(derive, "HOT_ROWS", 100)          # the key with 700 rows stays out of the shuffle
        hot = derive_table(df, spec, "y", "pid", None)
        plan = hot._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" in plan and sorted(map(tuple, hot.collect())) == plain
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_window_compare_on_integers_and_quoted_order(spark):
    from riskforge.functions import templates as T
    df = spark.createDataFrame([(1, 1, 1, 1, "it's"), (2, 1, 3, 0, "a\\b"), (3, 1, 2, 4, "x")], "pid long, y int, a int, b int, s string")
    rows = derive_table(df, [T.window_compare("w", "a", 90, "b", 360), T.ordinal_encode("o", "s", ["it's", "a\\b"])], "y", "pid", None).collect()
    assert [(r["feat_w"], r["feat_o"]) for r in rows] == [(4.0, 1), (None, 2), (2.0, None)]


def test_nulls_outside_the_training_rows_count(spark):
    from riskforge.operators.prep import apply_prep, fit_prep
    df = spark.createDataFrame([(i, i, "train") for i in range(1, 6)] + [(6, None, "test")], "pid long, n int, split string")
    stats = fit_prep(df.where("split = 'train'"), ["n"], df)
    assert [r["n"] for r in apply_prep(df, ["n"], stats).orderBy("pid").collect()] == [1.0, 2.0, 3.0, 4.0, 5.0, 3.0]


def test_derive_templates_and_names(spark):
    df = spark.createDataFrame(
        [(1, 10.0, 0.0, "A", 1), (2, 4.0, 2.0, "A", 0), (3, None, 1.0, "B", 1), (4, 1.0, 1.0, None, None)],
        "pid long, a double, b double, seg string, y int")
    spec = [T.ratio("r", "a", "b"), T.frequency_encode("feat_f", "seg"), T.normalized("feat z!", "a", "seg"),
            T.ratio("r", "b", "a")]
    out = derive_table(df, spec, "y", time_col=None)
    assert out.columns == ["pid", "y", "a", "b", "seg", "feat_r", "feat_f", "feat_z_", "feat_r_2"]
    rows = {r["pid"]: r for r in out.collect()}
    assert set(rows) == {1, 2, 3}                       # null target dropped
    assert rows[1]["feat_r"] is None and rows[2]["feat_r"] == 2.0
    assert rows[1]["feat_f"] == 2 and rows[3]["feat_f"] == 1
    assert rows[3]["feat_z_"] is None                    # one value in segment B: stddev null


def test_auto_features_rule():
    spec = T.auto_features([f"c{i}" for i in range(12)])
    names = [f["name"] for f in spec]
    assert names == ["feat_log_c0", "feat_log_c1", "feat_log_c2", "feat_log_c3", "feat_log_c4",
                     "feat_ratio_c0_div_c1", "feat_ratio_c2_div_c3", "feat_ratio_c4_div_c5"]


def test_profile_classes_and_categories(spark):
    df = spark.createDataFrame(
        [(1, True, Decimal("1.50"), dt.date(2024, 1, 1), [1], "x", 1), (2, False, None, None, None, "y", 0)],
        "pid long, flag boolean, amt decimal(18,2), d date, arr array<int>, cat string, m2_overdue int")
    prof = {r["name"]: r for r in profile(df).collect()}
    assert prof["flag"]["col_type"] == "other" and prof["arr"]["col_type"] == "other"
    assert prof["amt"]["col_type"] == "numeric" and prof["d"]["col_type"] == "time"
    assert prof["amt"]["missing_rate"] == 0.5
    assert prof["m2_overdue"]["is_target_candidate"] and not prof["cat"]["is_target_candidate"]
    assert "pid" not in prof
    cats = category_profile(df, ["cat"], sample_size=1).first()
    assert (cats["n_distinct"], cats["cardinality_estimate"], cats["sample_values"]) == (2, 1, "x")


def test_derive_stream_matches_batch(spark, tmp_path):
    from riskforge.streaming.derive_stream import derive_stream
    df = spark.createDataFrame([(i, float(i % 7), float(i % 3), i % 2 if i % 5 else None) for i in range(60)],
                               "pid long, a double, b double, y int")
    src = str(tmp_path / "src")
    df.repartition(3).write.parquet(src)
    spec = [T.ratio("r", "a", "b"), T.diff("d", "a", "b")]
    q = derive_stream(spark, src, df.schema, spec, "y", str(tmp_path / "out"), str(tmp_path / "ckpt"),
                      time_col=None)
    q.awaitTermination(120)
    got = sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    want = sorted(tuple(r) for r in derive_table(df, spec, "y", time_col=None).collect())
    assert got == want
    with pytest.raises(ValueError):
        derive_stream(spark, src, df.schema, [T.frequency_encode("f", "a")], "y", str(tmp_path / "o2"),
                      str(tmp_path / "c2"), time_col=None)
