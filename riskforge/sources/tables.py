"""Input tables: the driver's Parquet files and the wide loan-style table built from them.

``wide_orders`` plays the reference's wide table: one row per order (a
"loan"), key ``pid``, time ``lend_tm``, numeric / categorical columns, window
counts per customer, and a planted 0/1 label ``is_bad``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskforge.functions.columns import fround

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _day(col):
    return F.unix_date(F.to_date(col))


def customer_windows(orders: DataFrame, windows: tuple[int, ...] = (90, 360)) -> DataFrame:
    """Orders and amounts of the same customer in the previous N days (excluding the day itself).

    Orders are first reduced to one row per (customer, day), so a customer with
    a huge share of all orders has at most one row per calendar day in its
    window partition; the range windows then run over days.
    """
    daily = (orders.select("o_custkey", _day(F.col("o_orderdate")).alias("d"), "o_totalprice")
             .groupBy("o_custkey", "d")
             .agg(F.count(F.lit(1)).alias("cnt"), F.sum("o_totalprice").alias("amt")))
    cols = [F.col("o_custkey"), F.col("d")]
    for n in windows:
        w = Window.partitionBy("o_custkey").orderBy("d").rangeBetween(-n, -1)
        cols.append(F.coalesce(F.sum("cnt").over(w), F.lit(0)).cast("long").alias(f"ord_cnt_{n}d"))
        cols.append(fround(F.sum("amt").over(w), 2).alias(f"amt_{n}d"))
    return daily.select(*cols)


def wide_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide input table (one row per order), built with joins and aggregates only."""
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    li = read_table(spark, sf_dir, "lineitem")
    price = F.col("l_extendedprice")
    li_agg = li.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_items"),
        F.sum("l_quantity").alias("sum_qty"),
        fround(F.sum(price), 2).alias("sum_price"),
        fround(F.sum(F.when(F.col("l_discount") != 0, F.col("l_discount")) * price), 4).alias("sum_disc"),
        F.max("l_tax").alias("max_tax"),
        fround(F.sum(F.when(F.col("l_returnflag") == "R", price)), 2).alias("returned_amt"),
        F.sum(F.when((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "F")
                     & (F.col("l_quantity") > 45), F.lit(1))).cast("long").alias("rare_cnt"))
    hist = customer_windows(orders)
    o = orders.withColumn("d", _day(F.col("o_orderdate")))
    joined = (o.join(customer, o.o_custkey == customer.c_custkey)
              .join(li_agg, o.o_orderkey == li_agg.l_orderkey, "left")
              .join(hist, ["o_custkey", "d"]))
    score = (F.coalesce(F.col("sum_qty"), F.lit(0.0)) * F.lit(0.5)
             + F.coalesce(F.col("returned_amt"), F.lit(0.0)) / F.lit(4000.0)
             + F.col("o_totalprice") / F.lit(50000.0)
             - F.col("c_acctbal") / F.lit(2000.0)
             + (F.col("o_orderkey") * F.lit(7919) % F.lit(1000)).cast("double") / F.lit(25.0))
    is_bad = (F.when(F.col("o_orderkey") % F.lit(97) == 0, F.lit(None).cast("int"))
              .when(score > F.lit(80.0), F.lit(1)).otherwise(F.lit(0)))
    return joined.select(
        F.col("o_orderkey").alias("pid"), F.col("o_orderdate").alias("lend_tm"),
        F.col("o_totalprice").alias("totalprice"), F.col("c_acctbal").alias("acctbal"),
        F.col("c_mktsegment").alias("mktsegment"), F.col("o_orderpriority").alias("orderpriority"),
        "n_items", "sum_qty", "sum_price", "sum_disc", "max_tax", "returned_amt", "rare_cnt",
        "ord_cnt_90d", "ord_cnt_360d", "amt_90d", "amt_360d", is_bad.alias("is_bad"))
