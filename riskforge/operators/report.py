"""Report tables (the reference renders these as a web page; here they are
DataFrames that a notebook, dashboard or file sink can show)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from riskforge.functions.arrays import small_table
from riskforge.operators.model import ModelRun

DEFAULT_MAX_IV = 0.5
TOP_IMPORTANCE = 20


def report_features(features: DataFrame, spec: list[dict], spark: SparkSession) -> DataFrame:
    """rank (IV desc, ties in original order), feature, iv, psi, missing_rate,
    template, grade, bar_pct = min(100, round(iv / max(max_iv, 0.01) * 100))."""
    tpl = small_table(spark, [(f["name"], f.get("template", "")) for f in spec],
                      T.StructType([T.StructField("feature", T.StringType()),
                                    T.StructField("template", T.StringType())]))
    max_iv = features.agg(F.max("iv")).first()[0]
    max_iv = DEFAULT_MAX_IV if max_iv is None else float(max_iv)
    w = Window.orderBy(F.col("iv").desc(), F.col("position"))   # one row per feature: small
    bar = F.least(F.lit(100.0), F.bround(F.col("iv") / F.lit(max(max_iv, 0.01)) * 100.0, 0))
    return (features.join(F.broadcast(tpl), "feature", "left")
            .select(F.row_number().over(w).alias("rank"), "feature", "iv", "psi", "missing_rate",
                    F.coalesce(F.col("template"), F.lit("")).alias("template"), "grade",
                    bar.cast("long").alias("bar_pct")))


def report_headline(summary: DataFrame, run: ModelRun | None = None) -> DataFrame:
    """total, excellent, usable and the best test AUC (NULL when no model ran)."""
    best = run.best_test_auc if (run is not None and run.best) else None
    return summary.select("total", "excellent_cnt", "usable_cnt",
                          F.lit(best).cast("double").alias("best_auc"))


def report_models(run: ModelRun, spark: SparkSession, positive_rate: float | None = None) -> DataFrame:
    """One card per model: test AUC / KS / Gini, best flag, sample counts."""
    test = run.metrics.where(F.col("split") == "test")
    s = run.samples
    return test.select("model", "auc", "ks", "gini",
                       (F.col("model") == F.lit(run.best or "")).alias("is_best"),
                       F.lit(s.get("train", 0)).cast("long").alias("train_samples"),
                       F.lit(s.get("val", 0)).cast("long").alias("val_samples"),
                       F.lit(s.get("test", 0)).cast("long").alias("test_samples"),
                       F.lit(positive_rate).cast("double").alias("positive_rate"))


def report_importance(run: ModelRun) -> DataFrame:
    """Top 20 importances with the percent of the largest one."""
    imp = run.importance.where(F.col("rank") <= TOP_IMPORTANCE)
    mx = imp.agg(F.max("importance")).first()[0] or 0.0
    pct = F.bround(F.col("importance") / F.lit(float(mx)) * 100.0, 0) if mx else F.lit(None)
    return imp.select("rank", "feature", "importance", pct.cast("long").alias("pct"))
