"""Model preprocessing: median imputation, 5-sigma clipping, numeric coercion,
class weights and the trainability gate.

Statistics are fitted on the training rows only (the reference fits them on
all rows, which leaks the test period) and applied to every row. Medians are
exact (distributed order statistics); mean / stddev come from one aggregate.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskforge.operators.quantiles import interpolated_quantiles

SIGMAS = 5.0
MIN_TRAIN_ROWS = 100


@dataclass
class PrepStats:
    float_like: list[str]
    medians: dict
    means: dict
    stds: dict

    def bounds(self, c):
        s = self.stds.get(c)
        if s is None or not s > 0:
            return None
        return self.means[c] - SIGMAS * s, self.means[c] + SIGMAS * s


def float_like_columns(df: DataFrame, features: list[str]) -> list[str]:
    """Fractional columns, and integer columns holding nulls (these become
    floats in the reference's frames and are imputed there too)."""
    schema = df.schema
    ints = [c for c in features if isinstance(schema[c].dataType,
                                              (T.ByteType, T.ShortType, T.IntegerType, T.LongType))]
    with_nulls = set()
    if ints:
        row = df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(f"n{i}") for i, c in enumerate(ints)]).first()
        with_nulls = {c for i, c in enumerate(ints) if (row[f"n{i}"] or 0) > 0}
    return [c for c in features
            if isinstance(schema[c].dataType, (T.FloatType, T.DoubleType, T.DecimalType)) or c in with_nulls]


def fit_prep(train: DataFrame, features: list[str], every: DataFrame | None = None) -> PrepStats:
    """Medians, means and deviations of the training rows. Which integer columns
    hold nulls, and so are imputed, is judged on ``every`` row (default: the
    training rows)."""
    fl = float_like_columns(train if every is None else every, features)
    vals = {c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in fl}
    med = {c: (q[0] if q else None) for c, q in interpolated_quantiles(train, vals, [0.5]).items()} if fl else {}
    means, stds = {}, {}
    if fl:
        filled = {c: F.coalesce(vals[c], F.lit(med[c]).cast("double")) if med[c] is not None else vals[c]
                  for c in fl}
        row = train.agg(*[x for i, c in enumerate(fl) for x in
                          (F.avg(filled[c]).alias(f"m{i}"), F.stddev_samp(filled[c]).alias(f"s{i}"))]).first()
        means = {c: row[f"m{i}"] for i, c in enumerate(fl)}
        stds = {c: row[f"s{i}"] for i, c in enumerate(fl)}
    return PrepStats(fl, med, means, stds)


def apply_prep(df: DataFrame, features: list[str], stats: PrepStats) -> DataFrame:
    """Imputed, clipped / coerced DOUBLE feature columns (other columns kept)."""
    cols = []
    for c in features:
        if c in stats.float_like:
            v = F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
            if stats.medians.get(c) is not None:
                v = F.coalesce(v, F.lit(float(stats.medians[c])))
            b = stats.bounds(c)
            if b is not None:
                v = F.least(F.greatest(v, F.lit(float(b[0]))), F.lit(float(b[1])))
        else:
            v = F.coalesce(F.col(c).try_cast("double"), F.lit(0.0))
        cols.append(v.alias(c))
    others = [F.col(c) for c in df.columns if c not in features]
    return df.select(*others, *cols)


def pos_weight(train: DataFrame, label: str = "y") -> DataFrame:
    """n_pos, n_neg and the positive-class weight max(n_neg / n_pos, 1)."""
    agg = train.agg(F.sum(F.col(label)).cast("long").alias("n_pos"),
                    F.sum(1 - F.col(label)).cast("long").alias("n_neg"))
    w = F.greatest(F.col("n_neg") / F.greatest(F.col("n_pos"), F.lit(1)), F.lit(1.0))
    return agg.select(F.coalesce("n_pos", F.lit(0)).alias("n_pos"),
                      F.coalesce("n_neg", F.lit(0)).alias("n_neg"), w.alias("pos_weight"))


def class_weights(train: DataFrame, label: str = "y") -> DataFrame:
    """Balanced weights n / (2 * n_class) per label value."""
    n = train.count()
    return (train.groupBy(F.col(label).alias("y")).agg(F.count(F.lit(1)).alias("n_class"))
            .select("y", "n_class", (F.lit(float(n)) / (F.lit(2.0) * F.col("n_class"))).alias("weight")))


def train_gate(train: DataFrame, label: str = "y") -> DataFrame:
    """Enough rows (>= 100) and both label values in the training part."""
    return (train.agg(F.count(F.lit(1)).alias("n_train"),
                      F.countDistinct(F.col(label)).alias("n_classes"))
            .withColumn("trainable", (F.col("n_train") >= MIN_TRAIN_ROWS) & (F.col("n_classes") >= 2)))
