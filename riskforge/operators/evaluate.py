"""Tables over the per-feature evaluation (small: one row per feature)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from riskforge.functions.arrays import small_table
from riskforge.functions.columns import fround

# Fixed values that must equal the reference's behaviour.
# Grade words accepted from outside sources (English and Chinese) -> our code.
GRADE_WORDS = {
    "excellent": "excellent", "usable": "usable", "discard": "discard",
    "优质": "excellent", "可用": "usable", "废弃": "discard",
}
# The reference's own grade words, by our code.
GRADE_WORDS_ZH = {"excellent": "优质", "usable": "可用", "discard": "废弃"}
MAX_MODEL_FEATURES = 50
TOP_N = 5


def grade_normalise(col) -> F.Column:
    """Map a grade word to excellent / usable / discard; unknown or null -> discard."""
    m = F.create_map(*[x for k, v in GRADE_WORDS.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.element_at(m, F.coalesce(col, F.lit(""))), F.lit("discard"))


def grade_word_zh(col) -> F.Column:
    m = F.create_map(*[x for k, v in GRADE_WORDS_ZH.items() for x in (F.lit(k), F.lit(v))])
    return F.element_at(m, col)


def eval_summary(features: DataFrame) -> DataFrame:
    """total, count per grade, usable_rate (3 places)."""
    g = F.col("grade")
    return features.agg(
        F.count(F.lit(1)).alias("total"),
        F.sum((g == "excellent").cast("long")).alias("excellent_cnt"),
        F.sum((g == "usable").cast("long")).alias("usable_cnt"),
        F.sum((g == "discard").cast("long")).alias("discard_cnt"),
    ).select("total",
             F.coalesce("excellent_cnt", F.lit(0)).alias("excellent_cnt"),
             F.coalesce("usable_cnt", F.lit(0)).alias("usable_cnt"),
             F.coalesce("discard_cnt", F.lit(0)).alias("discard_cnt"),
             fround((F.coalesce("excellent_cnt", F.lit(0)) + F.coalesce("usable_cnt", F.lit(0)))
                    / F.greatest(F.col("total"), F.lit(1)), 3).alias("usable_rate"))


def model_gate(summary: DataFrame) -> DataFrame:
    """Model only when usable_rate > 0 and at least two features are usable."""
    n_ok = F.col("excellent_cnt") + F.col("usable_cnt")
    return summary.select("usable_rate", n_ok.alias("n_usable"),
                          ((F.col("usable_rate") != 0) & (n_ok >= 2)).alias("train_model"))


def top_features(features: DataFrame, n: int = TOP_N) -> DataFrame:
    """The ``n`` features with the highest IV (ties: original order)."""
    w = Window.orderBy(F.col("iv").desc(), F.col("position"))  # one row per feature: small
    return (features.orderBy(F.col("iv").desc(), F.col("position")).limit(n)
            .withColumn("rank", F.row_number().over(w))
            .select("rank", "feature", "iv", "psi", "missing_rate", "grade"))


def select_features(features: DataFrame, limit: int = MAX_MODEL_FEATURES) -> DataFrame:
    """Excellent features first, then usable, each in original order, at most ``limit``."""
    rank = F.when(F.col("grade") == "excellent", 0).otherwise(1)
    w = Window.orderBy(rank, F.col("position"))   # one row per feature: small
    return (features.where(F.col("grade").isin("excellent", "usable"))
            .withColumn("rank", F.row_number().over(w))
            .where(F.col("rank") <= limit)
            .select("rank", "feature", "grade"))


def iv_gain(features: DataFrame, sources: DataFrame, spec: list[dict], spark: SparkSession) -> DataFrame:
    """IV of each derived feature minus the best IV among its source columns."""
    rows = [(f["name"], s) for f in spec for s in f.get("sources", [])]
    pairs = small_table(spark, rows, T.StructType([T.StructField("feature", T.StringType()),
                                                   T.StructField("source", T.StringType())]))
    best = (pairs.join(sources.select(F.col("feature").alias("source"), F.col("iv").alias("siv")), "source")
            .groupBy("feature").agg(F.max("siv").alias("max_source_iv")))
    return (features.select("feature", "iv").join(best, "feature")
            .select("feature", "iv", "max_source_iv",
                    fround(F.col("iv") - F.col("max_source_iv"), 4).alias("iv_gain")))
