"""Window features from raw events: what a key did in the N days before a point in time.

``trailing`` gives every row of ``points`` (a loan, an order) the count, sum,
least, largest and mean of the events of its key in the N days before its own
day, and the days since the last one in the longest window.

Events are first reduced to one row per (key, day) with partial sums in the
tasks, and so are the points' days. The timeline of a key is then cut into
blocks at least as long as the longest window; a day's row goes to its own
block and, where a window reaches over the border, to the next. Every window
lies in one block, so a window task holds at most two blocks of days of a key,
however many events the key has and however long its timeline is, and a key
with a third of all events is spread over its blocks. The results are joined to
the points by (key, day), one row each, so that a skewed side of that join can
be split. Work grows with the days times the longest window.

Defined results: events with a null key or time count nowhere; a null value is
counted as an event but not in sum, min, max and mean; NaN is a null value; a point with a null key or time gets
nulls; a point without earlier events gets count 0 and nulls; repeated points
get the same values; events of the point's own day are not included.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskforge.functions.columns import as_metric_value, fround

BLOCK_DAYS = 366
STATS = ("cnt", "sum", "min", "max", "avg")


def _day(col: str) -> Column:
    return F.unix_date(F.to_date(F.col(col)))


def daily(events: DataFrame, key: str, time: str, measures: dict[str, Column]) -> DataFrame:
    """One row per key (``k``) and day (``d``): n, and s_ / c_ / lo_ / hi_ of every measure."""
    base = events.select(F.col(key).alias("k"), _day(time).alias("d"), *[m.alias(f"v_{name}") for name, m in measures.items()])
    base = base.where(F.col("k").isNotNull() & F.col("d").isNotNull())
    aggs = [F.count(F.lit(1)).alias("n")]
    for name in measures:
        v = as_metric_value(F.col(f"v_{name}"), base.schema[f"v_{name}"].dataType)
        aggs += [F.sum(v).alias(f"s_{name}"), F.count(v).alias(f"c_{name}"), F.min(v).alias(f"lo_{name}"), F.max(v).alias(f"hi_{name}")]
    return base.groupBy("k", "d").agg(*aggs)


def _over(days: int, measures: dict[str, Column], prefix: str, digits: int, stats: tuple[str, ...]) -> list[Column]:
    w = Window.partitionBy("k", "block").orderBy("d").rangeBetween(-days, -1)
    out = [F.coalesce(F.sum("n").over(w), F.lit(0)).cast("long").alias(f"{prefix}_cnt_{days}d")] if "cnt" in stats else []
    for name in measures:
        total, known = F.sum(f"s_{name}").over(w), F.sum(f"c_{name}").over(w)
        made = {"sum": fround(total, digits), "min": F.min(f"lo_{name}").over(w), "max": F.max(f"hi_{name}").over(w),
                "avg": fround(fround(total, digits) / F.nullif(known, F.lit(0)), digits)}
        out += [made[s].alias(f"{prefix}_{name}_{s}_{days}d") for s in stats if s in made]
    return out


def trailing(points: DataFrame, events: DataFrame, point_key: str, point_time: str, event_key: str, event_time: str,
             measures: dict[str, Column] | None = None, windows: tuple[int, ...] = (7, 30, 90), prefix: str = "win",
             digits: int = 4, stats: tuple[str, ...] = STATS, block_days: int = BLOCK_DAYS) -> DataFrame:
    """``points`` with ``<prefix>_cnt_<n>d``, ``<prefix>_<measure>_<stat>_<n>d`` and ``<prefix>_days_since``.

    ``measures`` maps names to expressions over ``events``; sums and means are rounded to ``digits``."""
    measures = measures or {}
    if not windows or min(windows) < 1:
        raise ValueError("windows are whole numbers of days from 1 on")
    if unknown := set(stats) - set(STATS):
        raise ValueError(f"unknown statistics {sorted(unknown)}")
    longest = max(windows)
    span = max(longest, block_days)
    day = daily(events, event_key, event_time, measures)
    block = F.floor(F.col("d") / span)
    ahead = F.floor((F.col("d") + longest) / span)
    day = day.withColumn("block", F.explode(F.array_distinct(F.array(block, ahead)))).withColumn("mark", F.lit(False))
    marks = (points.select(F.col(point_key).alias("k"), _day(point_time).alias("d")).where("k IS NOT NULL AND d IS NOT NULL")
             .distinct().withColumn("block", block).withColumn("mark", F.lit(True)))
    seen = F.max(F.when(~F.col("mark"), F.col("d"))).over(
        Window.partitionBy("k", "block").orderBy("d").rangeBetween(-longest, -1))
    cols = [c for n in windows for c in _over(n, measures, prefix, digits, stats)]
    made = (day.unionByName(marks, allowMissingColumns=True)
            .select("k", "d", "mark", *cols, (F.col("d") - seen).alias(f"{prefix}_days_since"))
            .where("mark").drop("mark"))
    names = [c for c in made.columns if c not in ("k", "d")]
    if clash := set(names) & set(points.columns):
        raise ValueError(f"columns exist already: {sorted(clash)}")
    made = made.select(F.col("k").alias("__win_k"), F.col("d").alias("__win_d"), *names)
    on = (F.col(point_key) == F.col("__win_k")) & (_day(point_time) == F.col("__win_d"))
    return points.join(made, on, "left").select(*points.columns, *names)
