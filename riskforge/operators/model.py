"""Model training and model metrics with Spark ML.

* boosted trees: ``boosting.fit``, leaf-wise trees with leaf penalties, feature
  and row sampling, validation AUC after every round with a patience, the best
  prefix kept; positives weighted by max(n_neg / n_pos, 1).
* logistic regression: standardisation (mean and scale) then L2 logistic
  regression with balanced class weights; sklearn's C = 0.1 maps to
  regParam = 1 / (C * sum of weights) = 10 / n.

Metrics (AUC / KS / Gini) come from the distributed histogram method of
``ranking``. The best model has the highest test AUC (> 0); the boosted model
wins ties, as in the reference.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskforge.functions.columns import fround
from riskforge.operators import boosting
from riskforge.operators.ranking import auc_ks

SEED = 42
# Fixed values that must equal the reference's behaviour: rounds, learning rate, leaves, least rows of a
# leaf, sampling shares, penalties, patience, seed. ``gbt_params`` of ``train_models`` takes others.
GBT_PARAMS = dict(rounds=500, rate=0.05, leaves=31, min_rows=50, feature_share=0.8, row_share=0.8, row_every=5,
                  l1=0.1, l2=0.1, patience=50, max_bins=255, seed=SEED)
SHORT_RUN = dict(rounds=30, patience=10)
LR_C = 0.1
LR_MAX_ITER = 1000
TOP_IMPORTANCE = 30


@dataclass
class ModelRun:
    models: dict = field(default_factory=dict)      # name -> BoostedModel or PipelineModel
    metrics: DataFrame | None = None                # model, split, n, auc, ks, gini
    importance: DataFrame | None = None             # feature, importance, rank
    best: str | None = None
    best_test_auc: float = 0.0
    samples: dict = field(default_factory=dict)
    rounds: int = 0                                 # boosting rounds kept
    features: list = field(default_factory=list)


def lr_pipeline(features: list[str], n_train: int) -> Pipeline:
    return Pipeline(stages=[
        VectorAssembler(inputCols=features, outputCol="raw", handleInvalid="keep"),
        StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True),
        LogisticRegression(featuresCol="features", labelCol="y", weightCol="w_bal",
                           regParam=1.0 / (LR_C * max(n_train, 1)), elasticNetParam=0.0,
                           standardization=False, maxIter=LR_MAX_ITER, tol=1e-6)])


def score(model: PipelineModel | boosting.BoostedModel, df: DataFrame) -> DataFrame:
    """Adds ``score`` = P(y = 1)."""
    if isinstance(model, boosting.BoostedModel):
        return model.transform(df)
    return (model.transform(df)
            .withColumn("score", vector_to_array(F.col("probability"))[1])
            .drop("features", "raw", "rawPrediction", "probability", "prediction"))


def lr_coefficients(model: PipelineModel, features: list[str]) -> DataFrame:
    """The logistic regression as a table: feature, position, mean, std, coefficient; the intercept
    stands at position -1. score = 1 / (1 + exp(-(intercept + sum of coefficient * (x - mean) / std)));
    a feature with deviation 0 counts as 0."""
    _, scaler, lr = model.stages
    rows = [(f, i, float(m), float(s), float(c)) for i, (f, m, s, c) in
            enumerate(zip(features, scaler.mean.toArray(), scaler.std.toArray(), lr.coefficients.toArray()))]
    return SparkSession.active().createDataFrame([("(intercept)", -1, 0.0, 1.0, float(lr.intercept)), *rows],
                                                 "feature string, position int, mean double, std double, coefficient double")


def _standardised(row: dict) -> Column:
    return (F.col(row["feature"]) - F.lit(row["mean"])) / F.lit(row["std"]) if row["std"] else F.lit(0.0)


def lr_score(coefficients: DataFrame) -> Column:
    """P(y = 1) from the table of ``lr_coefficients`` (one row per feature)."""
    total = F.lit(0.0)
    for r in (r.asDict() for r in coefficients.orderBy("position").collect()):
        total = total + (F.lit(r["coefficient"]) if r["position"] < 0 else F.lit(r["coefficient"]) * _standardised(r))
    return 1.0 / (1.0 + F.exp(-total))


def lr_gradient(train: DataFrame, coefficients: DataFrame, weight: Column, penalty: float) -> DataFrame:
    """Gradient of the penalised, weighted mean log loss at the coefficients: (feature, gradient).
    All are 0 at the optimum. One aggregate over the training rows, whatever the number of features."""
    rows = [r.asDict() for r in coefficients.orderBy("position").collect()]
    miss = weight * (lr_score(coefficients) - F.col("y"))
    sums = train.agg(F.sum(weight).alias("w"), *[F.sum(miss if r["position"] < 0 else miss * _standardised(r)).alias(f"g{i}")
                                                 for i, r in enumerate(rows)])
    each = F.array(*[F.struct(F.lit(r["feature"]).alias("feature"),
                              (F.col(f"g{i}") / F.col("w") + F.lit(0.0 if r["position"] < 0 else penalty * r["coefficient"])).alias("gradient"))
                     for i, r in enumerate(rows)])
    return sums.select(F.inline(each))


def add_weights(df: DataFrame, train: DataFrame) -> DataFrame:
    row = train.agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("p")).first()
    n, p = int(row["n"]), int(row["p"] or 0)
    neg = n - p
    pw = max(neg / max(p, 1), 1.0)
    w_pos = F.when(F.col("y") == 1, F.lit(pw)).otherwise(F.lit(1.0))
    w1 = n / (2.0 * p) if p else 0.0
    w0 = n / (2.0 * neg) if neg else 0.0
    w_bal = F.when(F.col("y") == 1, F.lit(w1)).otherwise(F.lit(w0))
    return df.withColumn("w_pos", w_pos).withColumn("w_bal", w_bal)


def train_models(prepared: DataFrame, features: list[str], which=("gbt", "lr"),
                 gbt_params: dict | None = None) -> ModelRun:
    """``prepared`` holds y (0/1), split (train / val / test) and DOUBLE features."""
    data = prepared
    train = data.where(F.col("split") == "train")
    counts = {r["split"]: r["n"] for r in data.groupBy("split").agg(F.count(F.lit(1)).alias("n")).collect()}
    data = add_weights(data, train)
    run = ModelRun(features=features,
                   samples={k: int(counts.get(k, 0)) for k in ("train", "val", "test")})
    scored_parts = []
    for name in which:
        if name == "gbt":
            model = boosting.fit(data, features, **dict(GBT_PARAMS, **(gbt_params or {})))
        else:
            model = lr_pipeline(features, run.samples["train"]).fit(data.where(F.col("split") == "train"))
        run.models[name] = model
        scored_parts.append(score(model, data.where(F.col("split").isin("val", "test")))
                            .select(F.lit(name).alias("model"), "split", "y", "score"))
    scored = scored_parts[0]
    for p in scored_parts[1:]:
        scored = scored.unionByName(p)
    # all (model, split) metrics from one grouped histogram pass
    run.metrics = auc_ks(scored, F.col("y"), F.col("score"), by=["model", "split"]).cache()
    metrics = [(r["model"], r["split"], r["n"], r["auc"], r["ks"], r["gini"]) for r in run.metrics.collect()]
    spark = prepared.sparkSession
    # in the order of ``which``: the boosted model comes first and wins ties
    test_auc = {name: auc for name, part, _, auc, _, _ in metrics if part == "test"}
    best, best_auc = None, 0.0
    for name in which:
        if test_auc.get(name, 0.0) > best_auc:
            best, best_auc = name, test_auc[name]
    run.best, run.best_test_auc = best, best_auc
    if "gbt" in run.models:
        run.rounds = run.models["gbt"].rounds
        imp = run.models["gbt"].split_counts()
        # how often a feature is split, as shares of the total (at least 1), ranked and limited by Spark
        table = spark.createDataFrame([(f, float(imp[f]), i) for i, f in enumerate(features)],
                                      "feature string, v double, i int")
        share = F.col("v") / F.greatest(F.sum("v").over(Window.partitionBy()), F.lit(1.0))
        rank = F.row_number().over(Window.orderBy(F.col("v").desc(), "i"))
        run.importance = (table.select("feature", fround(share, 4).alias("importance"), rank.alias("rank"))
                          .where(F.col("rank") <= TOP_IMPORTANCE))
    return run
