"""Hand cases for binning, WOE / IV, PSI and monthly metrics (expected values
worked out by hand / with numpy; see FIXTURES.md section 3)."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskforge.functions.arrays import with_count_below
from riskforge.operators.binning import bin_from_count
from riskforge.operators.metrics import _bin_numbers, evaluate


def _frame(spark, xs, ys, base=None, times=None):
    rows = []
    for i, (x, y) in enumerate(zip(xs, ys)):
        rows.append((i, None if times is None else times[i], y, None if x is None else float(x),
                     True if base is None else base[i]))
    return spark.createDataFrame(rows, "pid long, lend_tm timestamp, y int, x double, is_base boolean")


def _bins(ev):
    return {r["bin"]: r for r in ev.bins.collect()}


def test_plain_bins_four(spark):
    xs = list(range(1, 21))
    ys = [0] * 5 + [1, 0] * 5 + [1] * 5
    ev = evaluate(_frame(spark, xs, ys), ["x"], "y", time_col=None, n_bins=4)
    b = _bins(ev)
    assert [b[i]["event"] for i in range(4)] == [0, 3, 2, 5]
    assert [b[i]["count"] for i in range(4)] == [5, 5, 5, 5]
    assert [b[i]["woe"] for i in range(4)] == [-22.3327, 0.4055, -0.4055, 22.3327]
    assert ev.features.first()["iv"] == 22.4138
    assert None not in b            # no null values, no NULL bin row


def test_plain_bins_ten(spark):
    xs = list(range(1, 21))
    ys = [0] * 5 + [1, 0] * 5 + [1] * 5
    ev = evaluate(_frame(spark, xs, ys), ["x"], "y", time_col=None, n_bins=10)
    b = _bins(ev)
    assert [b[i]["event"] for i in range(10)] == [0, 0, 1, 1, 1, 1, 1, 1, 2, 2]
    assert ev.features.first()["iv"] == 17.1331


def test_constant_column_has_only_null_bin(spark):
    ev = evaluate(_frame(spark, [1.0] * 4, [0, 1, 0, 1]), ["x"], "y", time_col=None)
    b = _bins(ev)
    assert list(b) == [None] and b[None]["count"] == 4
    f = ev.features.first()
    assert f["iv"] == 0.0 and f["n_bins"] == 0 and f["psi"] == 0.0


def test_rare_flag_one_bin_and_flag_two_bins(spark):
    ev = evaluate(_frame(spark, [0.0] * 98 + [1.0] * 2, [0, 1] * 50), ["x"], "y", time_col=None)
    assert ev.features.first()["n_bins"] == 1
    ev = evaluate(_frame(spark, [0.0] * 60 + [1.0] * 40, [0, 1] * 50), ["x"], "y", time_col=None)
    assert ev.edges["x"] == pytest.approx([0.0, 0.4, 1.0], abs=1e-12)
    assert sorted(k for k in _bins(ev) if k is not None) == [0, 1]


def test_three_values_skip_an_empty_bin(spark):
    ev = evaluate(_frame(spark, [0.0] * 50 + [1.0] * 30 + [2.0] * 20, [0, 1] * 50), ["x"], "y", time_col=None)
    assert sorted(k for k in _bins(ev) if k is not None) == [0, 1, 3]


def test_null_bin_counted_not_in_iv(spark):
    xs = [None, None] + list(range(1, 21))
    ys = [1, 1] + [0] * 5 + [1, 0] * 5 + [1] * 5
    ev = evaluate(_frame(spark, xs, ys), ["x"], "y", time_col=None, n_bins=4)
    b = _bins(ev)
    assert b[None]["count"] == 2 and b[None]["event"] == 2 and b[None]["woe"] is None
    assert ev.features.first()["missing_rate"] == round(2 / 22, 4)


def test_psi_out_of_range_values_dropped(spark):
    base = list(range(100))
    recent = [5, 15, 25, 95, 200, -3]
    xs = [float(v) for v in base + recent]
    flags = [True] * 100 + [False] * 6
    ev = evaluate(_frame(spark, xs, [0, 1] * 53, base=flags), ["x"], "y", time_col=None, base_col="is_base")
    rows = ev.psi_bins.where(F.col("actual") > 1e-9).collect()
    assert sorted(r["bin"] for r in rows) == [0, 1, 2, 9]
    assert all(abs(r["actual"] - 0.25) < 1e-12 for r in rows)


@pytest.mark.parametrize("align,expected", [("bin", 4.923), ("rank", 0.0887)])
def test_psi_alignment(spark, align, expected):
    xs = [float(v) for v in range(1, 101)] + [10.0] * 30 + [60.0] * 40 + [90.0] * 30
    flags = [True] * 100 + [False] * 100
    ev = evaluate(_frame(spark, xs, [0, 1] * 100, base=flags), ["x"], "y", time_col=None, n_bins=4,
                  psi_align=align, base_col="is_base")
    assert ev.features.first()["psi"] == expected


def test_psi_of_identical_sides_is_zero(spark):
    xs = [float(v % 37) for v in range(200)]
    flags = [i % 2 == 0 for i in range(200)]
    ev = evaluate(_frame(spark, xs, [0, 1] * 100, base=flags), ["x"], "y", time_col=None, base_col="is_base")
    assert ev.features.first()["psi"] == 0.0


def test_monthly_null_time_is_nat(spark):
    times = [dt.datetime(2024, 1, 5), None]
    ev = evaluate(_frame(spark, [1.0, 3.0], [0, 1], times=times), ["x"], "y", time_col="lend_tm")
    months = {r["ym"]: r for r in ev.monthly.collect()}
    assert set(months) == {"2024-01", "NaT"}
    assert months["2024-01"]["mean"] == 1.0 and months["NaT"]["mean"] == 3.0


def test_text_feature_single_bin(spark):
    df = spark.createDataFrame([(i, i % 2, "a" if i % 3 else None) for i in range(30)],
                               "pid long, y int, s string")
    ev = evaluate(df, ["s"], "y", time_col=None)
    b = _bins(ev)
    assert sorted(b, key=lambda k: -1 if k is None else k) == [None, 0]
    assert ev.features.first()["psi"] == 0.0


def test_grades_follow_thresholds(spark):
    from riskforge.operators.metrics import grade_column
    df = spark.createDataFrame([(0.10, 0.20, 0.10), (0.0999, 0.2, 0.1), (0.02, 0.9, 0.25), (0.5, 0.91, 0.0)],
                               "iv double, m double, p double")
    got = [r[0] for r in df.select(grade_column(F.col("iv"), F.col("m"), F.col("p"))).collect()]
    assert got == ["excellent", "usable", "usable", "discard"]


def test_missing_feature_raises(spark):
    with pytest.raises(ValueError):
        evaluate(_frame(spark, [1.0], [1]), ["nope"], "y", time_col=None)


def test_rows_are_binned_once(spark):
    """Spark did not find the counts per bin in its cache: IV, PSI and missing rate each binned all rows again."""
    ev = evaluate(_frame(spark, [1, 2, None, 4, 5, 6], [0, 1, 0, 1, 0, 1]), ["x"], "y", time_col=None, n_bins=2, base_col="is_base")
    plan = ev.features._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "MapInArrow" not in plan and "is_base" not in plan
    assert ev.features.first()["missing_rate"] == 0.1667


def test_bins_of_a_batch_are_those_of_the_rule(spark):
    """Edges with duplicates removed, none, one, and not a number (between infinite values); values on, between and beyond them."""
    inf, nan = float("inf"), float("nan")
    values = [None, -inf, -1.0, -0.0, 0.0, 0.5, 1.0, 2.0, 2.5, 3.0, inf]
    v = np.array([0.0 if x is None else x for x in values])
    df = spark.createDataFrame([(i, x) for i, x in enumerate(values)], "i int, v double")
    for edges in ([], [1.0], [0.0, 1.0, 2.5], [-1.0, 0.0, 3.0], [-inf, nan, 1.0, inf], [nan, nan], [0.0, 2.0, nan]):
        rows = with_count_below(df.withColumn("e", F.array(*map(F.lit, edges)).cast("array<double>")), "e", F.col("v"), "n", 11)
        want = [r["b"] for r in rows.select("i", bin_from_count(F.col("v"), "e", "n").alias("b")).orderBy("i").collect()]
        got = _bin_numbers(v, np.array([x is None for x in values]), edges)
        assert [None if b == 0 else b - 1 for b in got.tolist()] == want, edges
