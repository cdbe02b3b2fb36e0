"""AUC, KS and Gini of a score column, computed from a score histogram.

Rows are first reduced to one row per distinct score (positives, negatives),
with partial aggregation before the shuffle. The cumulative counts over scores
are then built in two levels so that no task sees all distinct scores:

1. the distinct scores are range-partitioned by (group, score), as many ranges as
   the session's shuffle makes of their size, and written with their range
   number (written, because a recomputed range partitioning may draw other bounds);
2. the sums per (group, range) are a small table whose running sums are the ranges' offsets;
3. a window partitioned by (group, range) adds the running count inside the range.

AUC counts ties as one half and is summed in exact integer (DECIMAL(38,0))
arithmetic; KS = max |TPR - FPR| over the thresholds; Gini = 2 * AUC - 1 from
the rounded AUC. A single-class input gives 0 for all three (as the reference).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskforge.functions.columns import fround
from riskforge.session import materialize


def _nz(name: str) -> Column:
    return F.when(F.col(name) != 0, F.col(name))


def score_histogram(df: DataFrame, label: Column, score: Column, by: list[str] | None = None) -> DataFrame:
    """(by..., score, pos, neg, pos_ge, neg_ge, pos_total, neg_total) per group and
    distinct score; ``*_ge`` count rows of the group with a score >= this score."""
    by = list(by or [])
    if not by:   # one group: a constant key keeps every join an equi-join
        return score_histogram(df.withColumn("_g", F.lit(0)), label, score, ["_g"]).drop("_g")
    hist = (df.select(*by, score.cast("double").alias("score"), label.cast("long").alias("y"))
            .where(F.col("score").isNotNull())
            .groupBy(*by, "score")
            .agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg")))
    ranged = materialize(hist.repartitionByRange(*by, "score").withColumn("r", F.spark_partition_id()), "score_histogram")
    sums = ranged.groupBy(*by, "r").agg(F.sum("pos").alias("rp"), F.sum("neg").alias("rn"))
    # one row per (group, range): offsets are the sums of the higher ranges
    group = Window.partitionBy(*by)
    above = group.orderBy(F.col("r").desc()).rowsBetween(Window.unboundedPreceding, 0)
    offsets = sums.select(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(by)], F.col("r").alias("_or"),
                          (F.sum("rp").over(above) - F.col("rp")).alias("op"), (F.sum("rn").over(above) - F.col("rn")).alias("on"),
                          F.sum("rp").over(group).alias("pos_total"), F.sum("rn").over(group).alias("neg_total"))
    match = F.col("r") == F.col("_or")
    for i, c in enumerate(by):
        match = match & F.col(c).eqNullSafe(F.col(f"_o{i}"))
    w = (Window.partitionBy(*by, "r").orderBy(F.col("score").desc())
         .rowsBetween(Window.unboundedPreceding, 0))
    return ranged.join(offsets, match).select(
        *by, "score", "pos", "neg", (F.col("op") + F.sum("pos").over(w)).alias("pos_ge"),
        (F.col("on") + F.sum("neg").over(w)).alias("neg_ge"), "pos_total", "neg_total")


def auc_ks(df: DataFrame, label: Column, score: Column, by: list[str] | None = None) -> DataFrame:
    """One row per group: (by..., n, auc, ks, gini), rounded to 4 places."""
    by = list(by or [])
    h = score_histogram(df, label, score, by)
    pos_gt = F.col("pos_ge") - F.col("pos")
    num = (F.col("neg").cast("decimal(38,0)")
           * (F.lit(2).cast("decimal(38,0)") * pos_gt.cast("decimal(38,0)") + F.col("pos").cast("decimal(38,0)")))
    P, N = F.col("pos_total").cast("double"), F.col("neg_total").cast("double")
    tpr_fpr = F.abs(F.col("pos_ge") / _nz("pos_total") - F.col("neg_ge") / _nz("neg_total"))
    agg = h.groupBy(*by).agg(F.sum(num).alias("num"), F.max(tpr_fpr).alias("ks_raw"),
                             F.first("pos_total").alias("pos_total"), F.first("neg_total").alias("neg_total"))
    two_class = (F.col("pos_total") > 0) & (F.col("neg_total") > 0)
    auc = F.when(two_class, fround(F.col("num").cast("double") / (F.lit(2.0) * P * N), 4)).otherwise(F.lit(0.0))
    ks = F.when(two_class, fround(F.col("ks_raw"), 4)).otherwise(F.lit(0.0))
    out = agg.select(*by, (F.col("pos_total") + F.col("neg_total")).alias("n"), auc.alias("auc"), ks.alias("ks"),
                     two_class.alias("_ok"))
    gini = F.when(F.col("_ok"), fround(F.lit(2.0) * F.col("auc") - F.lit(1.0), 4)).otherwise(F.lit(0.0))
    return out.withColumn("gini", gini).drop("_ok")


def signed_ks(df: DataFrame, label: Column, score: Column) -> DataFrame:
    """max(TPR - FPR) (the reference's unused signed form)."""
    h = score_histogram(df, label, score)
    d = F.col("pos_ge") / _nz("pos_total") - F.col("neg_ge") / _nz("neg_total")
    return h.agg(fround(F.greatest(F.max(d), F.lit(0.0)), 4).alias("ks"))
