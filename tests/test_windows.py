"""Window features from raw events against a plain loop."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from riskforge.operators.windows import trailing

START = dt.date(2023, 1, 1)


def rounded(x):
    return math.copysign(math.floor(abs(x) * 1e4 + 0.5) / 1e4, x) + 0.0


def plain(points, events, windows):
    out = []
    for pid, key, day in points:
        row = {"pid": pid}
        mine = [] if key is None or day is None else [(d, v) for k, d, v in events if k == key and d is not None and d < day]
        for n in windows:
            inside = [(d, v) for d, v in mine if (day - d).days <= n]
            known = [v for _, v in inside if v is not None]
            row[f"win_cnt_{n}d"] = None if key is None or day is None else len(inside)
            row[f"win_x_sum_{n}d"] = rounded(sum(known)) if known else None
            row[f"win_x_min_{n}d"] = min(known, default=None)
            row[f"win_x_max_{n}d"] = max(known, default=None)
            row[f"win_x_avg_{n}d"] = rounded(sum(known) / len(known)) if known else None
        late = [d for d, _ in mine if (day - d).days <= max(windows)]
        row["win_days_since"] = (day - max(late)).days if late else None
        out.append(row)
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [1, 40, 366])
def test_trailing_equals_plain_loop(spark, block):
    """A customer with a third of all events, nulls anywhere, blocks shorter and longer than the windows."""
    rnd = random.Random(5)

    def day():
        return None if rnd.random() < 0.03 else START + dt.timedelta(days=rnd.randint(0, 500))

    def key():
        return rnd.choice([7] * 4 + [1, 2, 3, 4, 5, 6, 8, None])
    events = [(key(), day(), rnd.choice([None, 0.25, 1.5, -2.0, 8.0])) for _ in range(900)]
    points = [(i, key(), day()) for i in range(150)] + [(0, 7, START)] * 2
    windows = (7, 30, 90)
    ev = spark.createDataFrame(events, "k long, t date, x double")
    pt = spark.createDataFrame(points, "pid long, k long, t date")
    got = trailing(pt, ev, "k", "t", "k", "t", {"x": F.col("x")}, windows, block_days=block).drop("k", "t")
    assert sorted((r.asDict() for r in got.collect()), key=repr) == plain(points, events, windows)


def test_trailing_edges(spark):
    ev = spark.createDataFrame([("a", dt.datetime(2024, 1, 1, 23, 59), float("nan")), ("a", dt.datetime(2024, 1, 2), 1.0)],
                               "k string, t timestamp_ntz, x double")
    pt = spark.createDataFrame([("a", dt.date(2024, 1, 2)), ("b", dt.date(2024, 1, 2))], "who string, d date")
    got = {r["who"]: r for r in trailing(pt, ev, "who", "d", "k", "t", {"x": F.col("x")}, (1,)).collect()}
    assert (got["a"]["win_cnt_1d"], got["a"]["win_x_sum_1d"], got["a"]["win_days_since"]) == (1, None, 1)   # not the own day
    assert (got["b"]["win_cnt_1d"], got["b"]["win_days_since"]) == (0, None)
    empty = trailing(pt, ev.limit(0), "who", "d", "k", "t", {"x": F.col("x")}, (1,)).collect()
    assert [r["win_cnt_1d"] for r in empty] == [0, 0]
    assert trailing(pt.limit(0), ev, "who", "d", "k", "t", (), (1,)).count() == 0
    with pytest.raises(ValueError, match="whole numbers"):
        trailing(pt, ev, "who", "d", "k", "t", None, (0,))
    with pytest.raises(ValueError, match="exist already"):
        trailing(pt.withColumnRenamed("d", "win_days_since"), ev, "who", "win_days_since", "k", "t")
