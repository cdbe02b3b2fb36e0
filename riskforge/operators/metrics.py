"""Feature metrics for many features in one distributed pass.

``evaluate`` computes, for every feature: WOE / IV bins (with a NULL bin),
IV, PSI between the older and newer part of the data, missing rate, monthly
missing rate and mean, and a grade.

Plan shape (no row is shuffled):
  scan -> exact decile edges (few aggregate passes, see ``quantiles``)
       -> (feature, bin, psi bin, part, is-null) counted in the tasks, a batch at once
       -> exchange of at most features x bins x bins x 4 rows a task -> final aggregate
  The small aggregate ("cells") is written and feeds IV, PSI and missing rate.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from riskforge.functions.columns import as_metric_value, fround, is_numeric_type, label_binary, month_key
from riskforge.functions.arrays import small_table
from riskforge.operators.binning import equal_freq_edges, equal_width_edges
from riskforge.operators.quantiles import group_counts
from riskforge.operators.split import split_psi
from riskforge.session import materialize

# Fixed values that must equal the reference's behaviour.
EPS = 1e-9
DEFAULT_THRESHOLDS = {
    "excellent": {"iv_min": 0.10, "missing_rate_max": 0.20, "psi_max": 0.10},
    "usable": {"iv_min": 0.02, "missing_rate_max": 0.90, "psi_max": 0.25},
}
GRADES = ["excellent", "usable", "discard"]
WHOLE = float(1 << 62)       # values below this have a whole part of 64 bits
PLACES = float(1 << 52)      # their rest is counted in units of 1 / PLACES


@dataclass
class Evaluation:
    features: DataFrame          # feature, iv, psi, missing_rate, n_bins, grade
    bins: DataFrame              # feature, bin, count, event, non_event, event_rate, woe, iv
    psi_bins: DataFrame          # feature, bin, expected, actual, psi
    monthly: DataFrame           # feature, ym, missing_rate, mean
    missing: DataFrame           # feature, missing_rate
    edges: dict = field(default_factory=dict)
    base_edges: dict = field(default_factory=dict)
    cached: list = field(default_factory=list)

    def release(self) -> None:
        """Drop the cached small tables; the frames stay usable and are computed again."""
        for df in self.cached:
            df.unpersist()


def grade_column(iv: Column, missing: Column, psi: Column, thresholds: dict | None = None) -> Column:
    """excellent / usable / discard from the (already rounded) metrics."""
    th = thresholds or DEFAULT_THRESHOLDS
    exc, use = th["excellent"], th["usable"]
    return (F.when((iv >= exc["iv_min"]) & (missing <= exc["missing_rate_max"]) & (psi <= exc["psi_max"]),
                   F.lit("excellent"))
            .when((iv >= use["iv_min"]) & (missing <= use["missing_rate_max"]) & (psi <= use["psi_max"]),
                  F.lit("usable"))
            .otherwise(F.lit("discard")))


def woe_table(cells: DataFrame) -> DataFrame:
    """WOE / IV per bin from (feature, bin, count, event) cells.

    Totals count every labelled row (also rows whose feature is null).
    Rows with a NULL bin are shown with NULL woe / iv and do not enter IV.
    ``cells`` is a small table; the per-feature totals are a window over it.
    """
    per_bin = cells.groupBy("feature", "bin").agg(F.sum("count").alias("count"),
                                                  F.sum("event").alias("event"))
    w = Window.partitionBy("feature")
    per_bin = per_bin.withColumn("_n", F.sum("count").over(w)).withColumn("_te", F.sum("event").over(w))
    te = F.greatest(F.col("_te").cast("double"), F.lit(EPS))
    tn = F.greatest((F.col("_n") - F.col("_te")).cast("double"), F.lit(EPS))
    p_ev = F.greatest(F.col("event").cast("double"), F.lit(EPS)) / te
    p_non = F.greatest((F.col("count") - F.col("event")).cast("double"), F.lit(EPS)) / tn
    woe = F.when(F.col("bin").isNotNull(), F.log(p_ev / p_non))
    return per_bin.select("feature", "bin",
                          F.col("count").cast("long").alias("count"),
                          F.col("event").cast("long").alias("event"),
                          (F.col("count") - F.col("event")).cast("long").alias("non_event"),
                          (F.col("event") / F.greatest(F.col("count"), F.lit(1))).alias("event_rate_raw"),
                          woe.alias("woe_raw"),
                          F.when(F.col("bin").isNotNull(), (p_ev - p_non) * woe).alias("iv_raw"))


def psi_table(cells: DataFrame, align: str = "bin") -> DataFrame:
    """PSI terms per bin from (feature, bin, expected count, actual count).

    ``align="bin"`` pairs bins by id and gives missing shares EPS.
    ``align="rank"`` pairs the k-th present bin of each side (the reference's
    positional pairing, which shifts after an empty bin).
    """
    w = Window.partitionBy("feature")
    cells = cells.withColumn("_e", F.sum("expected").over(w)).withColumn("_a", F.sum("actual").over(w))
    if align == "rank":
        # at most n_bins rows per feature: a per-feature window is small
        e = (cells.where(F.col("expected") > 0).select("feature", "bin", "expected", "_e", "_a")
             .withColumn("k", F.row_number().over(Window.partitionBy("feature").orderBy("bin"))))
        a = (cells.where(F.col("actual") > 0).select("feature", F.col("bin").alias("abin"), "actual")
             .withColumn("k", F.row_number().over(Window.partitionBy("feature").orderBy("abin"))))
        paired = e.join(a, ["feature", "k"]).select("feature", "bin", "expected", "actual", "_e", "_a")
    elif align == "bin":
        paired = cells.select("feature", "bin", "expected", "actual", "_e", "_a")
    else:
        raise ValueError("align must be 'bin' or 'rank'")
    e_share = F.col("expected") / F.greatest(F.col("_e"), F.lit(1))
    a_share = F.col("actual") / F.greatest(F.col("_a"), F.lit(1))
    e_s = F.when(e_share == 0, F.lit(EPS)).otherwise(e_share)
    a_s = F.when(a_share == 0, F.lit(EPS)).otherwise(a_share)
    return (paired.where((F.col("_e") > 0) & (F.col("_a") > 0))
            .select("feature", "bin", e_s.alias("expected"), a_s.alias("actual"),
                    ((a_s - e_s) * F.log(a_s / e_s)).alias("psi")))


def evaluate(df: DataFrame, features: list[str], target_col: str, time_col: str | None = "lend_tm",
             id_col: str = "pid", n_bins: int = 10, thresholds: dict | None = None,
             psi_align: str = "bin", base_ratio: float = 0.6, binning: str = "quantile",
             base_col: str | None = None, write_input: bool = True) -> Evaluation:
    """Evaluate many features at once (IV, WOE bins, PSI, missing rate, monthly metrics, grade).

    Only rows with a non-null target are used. Features missing from ``df``
    raise an error. ``base_col`` names a boolean column marking the base
    (older) rows for PSI; without it the 60 / 40 split by time is computed.
    ``write_input=False`` skips writing the pruned input (for inputs that are
    already files, e.g. a materialised split frame).
    """
    missing_cols = [f for f in features if f not in df.columns]
    if missing_cols:
        raise ValueError(f"features not in the table: {missing_cols}")
    features = list(dict.fromkeys(features))
    schema = df.schema
    keep = list(dict.fromkeys([c for c in [id_col, time_col, target_col, base_col] if c] + features))
    data = (df.where(F.col(target_col).isNotNull()).select(*keep)
            .withColumn("_y", label_binary(F.col(target_col), schema[target_col].dataType)))
    if base_col:
        # the caller already marked the base rows (e.g. shared by several evaluations)
        data = data.withColumn("split", F.when(F.col(base_col), F.lit("base")).otherwise(F.lit("recent")))
    else:
        data = split_psi(data, time_col, id_col, base_ratio)
    # The quantile step scans this frame several times: write the pruned,
    # labelled and split rows once (this also cuts the lineage), unless the
    # caller passes a frame that is already written (``write_input=False``).
    data = data.withColumn("_base", F.col("split") == F.lit("base")).drop("split")
    if write_input:
        data = materialize(data, "eval_input")
    is_base = F.col("_base")

    numeric = [f for f in features if is_numeric_type(schema[f].dataType)]
    values = {f: as_metric_value(F.col(f), schema[f].dataType) for f in numeric}

    groups = {}
    for f in numeric:
        groups[f"all:{f}"] = values[f]
        groups[f"base:{f}"] = F.when(is_base, values[f])
    counts = group_counts(data, groups)
    if binning == "quantile":
        edges_any = equal_freq_edges(data, groups, n_bins, counts)
    elif binning == "width":
        edges_any = equal_width_edges(data, groups, n_bins)
    else:
        raise ValueError("binning must be 'quantile' or 'width'")
    edges = {f: edges_any[f"all:{f}"] for f in numeric}
    base_edges = {f: edges_any[f"base:{f}"] for f in numeric}

    spark = data.sparkSession
    parts = [_cells(data, values, edges, base_edges)] if numeric else []
    text = [f for f in features if f not in values]
    if text:
        long = (data.select("_y", "_base", *[F.col(f).isNull().alias(f) for f in text])
                .unpivot(["_y", "_base"], text, "feature", "is_null"))
        parts.append(long.groupBy("feature", F.when(~F.col("is_null"), F.lit(0)).alias("bin"),
                                  F.lit(None).cast("int").alias("pbin"), F.col("_base").alias("base"), "is_null")
                     .agg(F.count(F.lit(1)).alias("count"), F.sum("_y").alias("event")))
    # at most features x (bins + 1)^2 x 4 rows, written: where a plan meets a cached table more than once Spark
    # renames its columns, does not find it in the cache any more and would bin all rows again for every part below
    cells = materialize(parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1]), "eval_cells")

    bins = woe_table(cells.select("feature", "bin", "count", "event"))
    psi_cells = (cells.where(F.col("pbin").isNotNull())
                 .groupBy("feature", F.col("pbin").alias("bin"))
                 .agg(F.sum(F.when(F.col("base"), F.col("count")).otherwise(0)).alias("expected"),
                      F.sum(F.when(~F.col("base"), F.col("count")).otherwise(0)).alias("actual")))
    psi_bins = psi_table(psi_cells, psi_align)
    miss = (cells.groupBy("feature")
            .agg((F.sum(F.when(F.col("is_null"), F.col("count")).otherwise(0)).cast("double")
                  / F.sum("count")).alias("missing_raw")))

    iv = (bins.where(F.col("bin").isNotNull()).groupBy("feature")
          .agg(F.sum("iv_raw").alias("iv_raw"), F.count(F.lit(1)).alias("n_bins")))
    psi = psi_bins.groupBy("feature").agg(F.sum("psi").alias("psi_raw"))
    per_feature = (miss.unionByName(iv, allowMissingColumns=True).unionByName(psi, allowMissingColumns=True)
                   .groupBy("feature").agg(*[F.max(c).alias(c) for c in ("missing_raw", "iv_raw", "n_bins",
                                                                         "psi_raw")]))
    feat_list = small_table(spark, [(f, i) for i, f in enumerate(features)],
                            T.StructType([T.StructField("feature", T.StringType()),
                                          T.StructField("position", T.IntegerType())]))
    out = (per_feature.join(F.broadcast(feat_list), "feature")
           .select("feature", "position",
                   fround(F.coalesce(F.col("iv_raw"), F.lit(0.0)), 4).alias("iv"),
                   fround(F.coalesce(F.col("psi_raw"), F.lit(0.0)), 4).alias("psi"),
                   fround(F.col("missing_raw"), 4).alias("missing_rate"),
                   F.coalesce(F.col("n_bins"), F.lit(0)).cast("long").alias("n_bins")))
    out = out.withColumn("grade", grade_column(F.col("iv"), F.col("missing_rate"), F.col("psi"), thresholds))

    bins_out = bins.select("feature", "bin", "count", "event", "non_event",
                           fround(F.col("event_rate_raw"), 4).alias("event_rate"),
                           fround(F.col("woe_raw"), 4).alias("woe"),
                           fround(F.col("iv_raw"), 4).alias("iv"))
    monthly = monthly_metrics(data, features, time_col).cache() if time_col else None
    # small results (one row per feature / bin / month), read by many reports
    out, bins_out, psi_bins = out.cache(), bins_out.cache(), psi_bins.cache()
    miss_out = out.select("feature", "missing_rate")
    held = [df for df in (out, bins_out, psi_bins, monthly) if df is not None]
    return Evaluation(out, bins_out, psi_bins, monthly, miss_out, edges, base_edges, held)


def _bin_numbers(v: np.ndarray, missing: np.ndarray, edges: list[float]) -> np.ndarray:
    """``bin_of`` plus one for a whole batch, 0 where there is no bin. As in Spark, NaN is above all numbers."""
    e = np.array(edges, dtype=np.float64)
    if len(e) < 2 or np.isnan(e[0]):
        return np.zeros(len(v), dtype=np.int64)
    n = np.maximum(np.searchsorted(e[~np.isnan(e)], v), 1)
    return np.where(missing | (v < e[0]) | (v > e[-1]), 0, n)


def _cells(data: DataFrame, values: dict[str, Column], edges: dict, base_edges: dict) -> DataFrame:
    """(feature, bin, pbin, base, is_null, count, event) of numeric features. A batch's values are placed among the
    edges by binary search and counted where they lie; a task gives its counts only."""
    steps = [(f, edges[f], base_edges[f]) for f in values]

    def scan(batches):
        total = [0] * len(steps)
        for b in batches:
            y, base = b.column(0).to_numpy(), b.column(1).to_numpy()
            for i, (_, e, pe) in enumerate(steps):
                c = b.column(i + 2)
                missing = c.is_null().to_numpy(zero_copy_only=False)
                v = c.fill_null(0.0).to_numpy()
                at = _bin_numbers(v, missing, e) * (len(pe) + 1) + _bin_numbers(v, missing, pe)
                total[i] += np.bincount(((at * 3 + base) * 2 + missing) * 2 + y, minlength=(len(e) + 1) * (len(pe) + 1) * 12)
        for (f, _, pe), n in zip(steps, total):
            if np.ndim(n):
                count, event = n[::2] + n[1::2], n[1::2]
                at = np.flatnonzero(count)
                bin_, pbin, base = at // 6 // (len(pe) + 1), at // 6 % (len(pe) + 1), at // 2 % 3
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f] * len(at), pa.string()), pa.array(bin_ - 1, pa.int32(), mask=bin_ == 0),
                     pa.array(pbin - 1, pa.int32(), mask=pbin == 0), pa.array(base == 1, pa.bool_(), mask=base == 2),
                     pa.array(at % 2 == 1), pa.array(count[at], pa.int64()), pa.array(event[at], pa.int64())],
                    ["feature", "bin", "pbin", "base", "is_null", "count", "event"])

    keys = ["feature", "bin", "pbin", "base", "is_null"]
    rows = data.select(F.col("_y").cast("long").alias("y"), F.coalesce(F.col("_base").cast("long"), F.lit(2).cast("long")).alias("base"),
                       *[c.alias(f"v{i}") for i, c in enumerate(values.values())])
    return (rows.mapInArrow(scan, "feature string, bin int, pbin int, base boolean, is_null boolean, count long, event long")
            .groupBy(*keys).agg(F.sum("count").alias("count"), F.sum("event").alias("event")))


HALF = 31                    # a part is summed as two longs, its upper and lower bits


def _parts(v: Column) -> list[Column]:
    """Whole part of a double, its rest in units of 2^-52, and what is left of that in units of 2^-104."""
    low = F.when(F.abs(v) < F.lit(WHOLE), F.floor(F.abs(v)).cast("double") * F.signum(v))
    upper = (v - low) * F.lit(PLACES)
    cut = F.floor(F.abs(upper)).cast("double") * F.signum(upper)
    return [c.cast("long") for c in (low, cut, F.rint((upper - cut) * F.lit(PLACES)))]


def _exact_mean(i: int) -> Column:
    """Mean of feature ``i`` from its parts' sums per partition, whatever the order of the rows.

    Integers are added and divided once. Where a value of 2^62 or more, or an infinite one,
    is among them it is the plain average.
    """
    def total(part: str) -> Column:
        high, low = (F.sum(F.col(f"{part}{end}{i}").cast("decimal(20,0)")) for end in "hl")
        return (high * F.lit(1 << HALF).cast("decimal(11,0)") + low).cast("decimal(38,0)")

    whole, rest, last = total("w"), total("r"), total("l")
    n = F.nullif(F.sum(f"n{i}"), F.lit(0))
    share = F.call_function("div", whole, n.cast("decimal(20,0)"))
    left = (whole - (share.cast("decimal(20,0)") * n.cast("decimal(18,0)")).cast("decimal(38,0)")).cast("double")
    mean = share.cast("double") + (left + (rest.cast("double") + last.cast("double") / F.lit(PLACES)) / F.lit(PLACES)) / n
    return F.when(F.max(f"top{i}") >= F.lit(WHOLE), F.sum(f"s{i}") / n).otherwise(mean)


def monthly_metrics(df: DataFrame, features: list[str], time_col: str) -> DataFrame:
    """Missing rate and mean per feature and calendar month, from one aggregate.

    Means are those of ``_exact_mean``, rounded once; an infinite value makes its
    month's mean infinite. Text features get a NULL mean. Rows with a null
    time form the month 'NaT'.
    """
    schema = df.schema
    cols, sums, aggs, numeric = [], [], [], []
    for i, f in enumerate(features):
        v = F.col(f)
        if is_numeric_type(schema[f].dataType):
            v = as_metric_value(v, schema[f].dataType)
            cols += [c.alias(f"{k}{i}") for k, c in zip("wrl", _parts(v))]
            sums += [F.sum(F.shiftright(f"{k}{i}", HALF)).alias(f"{k}h{i}") for k in "wrl"]
            sums += [F.sum(F.col(f"{k}{i}").bitwiseAND(F.lit((1 << HALF) - 1))).alias(f"{k}l{i}") for k in "wrl"]
            sums += [F.max(F.abs(f"v{i}")).alias(f"top{i}"), F.sum(f"v{i}").alias(f"s{i}")]
            aggs.append(_exact_mean(i).alias(f"a{i}"))
            numeric.append(i)
        cols.append(v.alias(f"v{i}"))
        sums.append(F.count(f"v{i}").alias(f"n{i}"))
        aggs.append(((F.sum("rows") - F.sum(f"n{i}")) / F.sum("rows")).alias(f"m{i}"))
    # sums per partition fit a long; what is added up as decimals has one row per month and partition
    parts = (df.select(month_key(F.col(time_col)).alias("ym"), F.spark_partition_id().alias("p"), *cols)
             .groupBy("ym", "p").agg(F.count(F.lit(1)).alias("rows"), *sums))
    wide = parts.groupBy("ym").agg(*aggs)
    structs = []
    for i, _ in enumerate(features):
        mean = F.col(f"a{i}") if i in numeric else F.lit(None).cast("double")
        structs.append(F.struct(F.col(f"m{i}").alias("m"), mean.alias("a")).alias(f"f{i}"))
    names = {f"f{i}": f for i, f in enumerate(features)}
    fname = F.create_map(*[x for k, v in names.items() for x in (F.lit(k), F.lit(v))])
    return (wide.select("ym", *structs).unpivot(["ym"], list(names), "_f", "_s")
            .select(F.element_at(fname, F.col("_f")).alias("feature"), "ym",
                    fround(F.col("_s.m"), 4).alias("missing_rate"), fround(F.col("_s.a"), 4).alias("mean")))
