"""Exact order statistics: many high-cardinality features, hot values, extreme values, few rounds."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskforge.operators import quantiles as Q

PROBS = np.linspace(0, 1, 11).tolist()


def check(spark, frame, probs=PROBS):
    df = spark.createDataFrame(frame).repartition(4)
    got = Q.interpolated_quantiles(df, {c: F.col(c) for c in frame}, probs)
    for c in frame:
        assert got[c] == pytest.approx(np.quantile(frame[c].dropna().astype(float), probs).tolist(), rel=1e-12, abs=1e-300), c


def test_forty_features_with_limits_scaled_down(spark, monkeypatch):
    """1e5 rows with limits a thousandth: as 1e8 rows; the rounds do not depend on the number of features."""
    monkeypatch.setattr(Q, "SPLITTERS", 64)
    monkeypatch.setattr(Q, "SUMMARY", 10)
    monkeypatch.setattr(Q, "KEEP", 8)
    rounds = []
    plain = Q._round
    monkeypatch.setattr(Q, "_round", lambda *a: rounds.append(1) or plain(*a))
    rng = np.random.default_rng(0)
    frame = pd.DataFrame({f"f{i}": rng.normal(scale=10.0 ** (i % 9 - 4), size=100_000) for i in range(40)})
    df = spark.createDataFrame(frame).repartition(8)
    got = Q.interpolated_quantiles(df, {c: F.col(c) for c in frame}, PROBS)
    assert all(got[c] == np.quantile(frame[c], PROBS).tolist() or np.allclose(got[c], np.quantile(frame[c], PROBS), rtol=1e-12) for c in frame)
    assert len(rounds) <= 6


def test_hot_values_ties_and_extremes(spark, monkeypatch):
    monkeypatch.setattr(Q, "SPLITTERS", 64)
    monkeypatch.setattr(Q, "SUMMARY", 10)
    monkeypatch.setattr(Q, "KEEP", 4)
    rng = np.random.default_rng(1)
    n = 20_000
    frame = pd.DataFrame({
        "hot": np.where(rng.random(n) < 0.6, 7.0, rng.normal(size=n)), "two": rng.integers(0, 2, n).astype(float),
        "constant": np.full(n, 3.5), "huge": rng.normal(size=n) * 1e300, "tiny": rng.integers(-5, 5, n) * 5e-324,
        "gaps": np.where(rng.random(n) < 0.3, np.nan, rng.exponential(size=n))})
    check(spark, frame)


def test_long_ranks_are_exact(spark, monkeypatch):
    monkeypatch.setattr(Q, "SPLITTERS", 64)
    monkeypatch.setattr(Q, "SUMMARY", 10)
    monkeypatch.setattr(Q, "KEEP", 4)
    base = (1 << 62) + np.arange(5000, dtype=np.int64)
    values = np.concatenate([base, [-(1 << 63), (1 << 63) - 1]])
    df = spark.createDataFrame(pd.DataFrame({"v": np.random.default_rng(2).permutation(values)}))
    ranks = [0, 1, 2500, 4999, 5001]
    got = Q.order_stats(df, {"v": F.col("v")}, {"v": ranks})
    assert [got["v", r] for r in ranks] == [(int(np.sort(values)[r]), r) for r in ranks]


def test_summaries_settle_ranks_in_two_scans(spark, monkeypatch):
    """No round follows, whatever the type: doubles, longs with ties, a constant, infinities."""
    monkeypatch.setattr(Q, "_round", None)
    rng = np.random.default_rng(2)
    n = 30_000
    frame = pd.DataFrame({"a": rng.normal(size=n), "b": rng.integers(0, 50, n) + (1 << 50), "c": np.full(n, 7.5),
                          "d": np.where(rng.random(n) < .3, np.inf, rng.random(n))})
    df = spark.createDataFrame(frame).repartition(6)
    ranks = {c: [0, 1, n // 3, n // 2, n - 2, n - 1] for c in frame}
    got = Q.order_stats(df, {c: F.col(c) for c in frame}, ranks)
    for c in frame:
        order = np.sort(frame[c].to_numpy())
        assert {r: got[c, r] for r in ranks[c]} == {r: (order[r].item(), int(np.searchsorted(order, order[r]))) for r in ranks[c]}, c


def test_many_intervals_are_not_searched_row_by_row(spark, monkeypatch):
    """Over 16 open intervals a group were filtered as an array for every row: 160 s a scan of 9 million rows."""
    def refuse(*_):
        raise AssertionError("an array is filtered for every row")

    for name, value in (("SPLITTERS", 64), ("SUMMARY", 40), ("KEEP", 4)):
        monkeypatch.setattr(Q, name, value)
    monkeypatch.setattr(F, "filter", refuse)
    check(spark, pd.DataFrame({"a": np.random.default_rng(3).permutation(20_000).astype(float)}), np.linspace(0, 1, 30).tolist())


def test_long_keys_beyond_doubles(spark):
    """Neighbouring values above 2^53 stay apart."""
    df = spark.range(1000).repartition(3)
    got = Q.order_stats(df, {"g": F.col("id") + F.lit(1 << 60)}, {"g": [0, 501, 999]})
    assert got == {("g", r): ((1 << 60) + r, r) for r in (0, 501, 999)}
