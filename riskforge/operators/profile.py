"""Column profiling (schema exploration) from one aggregate over the table.

The reference issues one query per column; here a single ``agg`` computes the
missing rate of every column, and one distinct-value plan computes the
cardinality and a sorted sample of every categorical column.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from riskforge.functions.arrays import small_table
from riskforge.functions.columns import classify_type, fround

# Fixed values that must equal the reference's behaviour.
SYSTEM_COLUMNS = ["pid", "lend_tm", "t_5", "t_10", "m2_mob4", "created_time", "id", "update_time"]
TARGET_NAME_PATTERN = r"\bt[0-9]|m[0-9]|mob|逾期|违约|default"
SAMPLE_SIZE = 30
RECENT_ROWS = 5000
USABLE_MISSING_MAX = 0.90


def is_target_candidate(name: str) -> bool:
    return re.search(TARGET_NAME_PATTERN, name.lower()) is not None


def newest(df: DataFrame, time_col: str, id_col: str, limit: int | None) -> DataFrame:
    """The newest ``limit`` rows (time desc, nulls last, ties by id); all rows for None.

    ``orderBy().limit()`` plans as TakeOrderedAndProject: each task keeps its
    own top ``limit`` rows, no full sort.
    """
    if limit is None:
        return df
    return df.orderBy(F.col(time_col).desc_nulls_last(), F.col(id_col).asc_nulls_last()).limit(limit)


def missing_rates(df: DataFrame, columns: list[str]) -> DataFrame:
    """(name, position, missing_rate) for every column, from one aggregate."""
    row = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.sum(F.col(c).isNull().cast("long")).alias(f"m{i}") for i, c in enumerate(columns)])
    stacked = row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("name"), F.lit(i).alias("position"),
                 (F.col(f"m{i}").cast("double") / F.col("_n")).alias("mr"))
        for i, c in enumerate(columns)])).alias("s"))
    return stacked.select("s.name", "s.position", fround(F.col("s.mr"), 4).alias("missing_rate"))


def sampled_missing_rates(df: DataFrame, columns: list[str], rows: int = 10_000, seed: int = 7, id_col: str = "pid") -> DataFrame:
    """Missing rates on ``rows`` rows drawn by a seeded hash of the id: the
    same rows on any number of partitions (a per-task top-k, no full sort)."""
    draw = F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))
    return missing_rates(df.withColumn("_draw", draw).orderBy("_draw", id_col).limit(rows), columns)


def category_profile(df: DataFrame, columns: list[str], sample_size: int = SAMPLE_SIZE) -> DataFrame:
    """(name, n_distinct, cardinality_estimate, sample_values) of text columns.

    ``sample_values`` holds the ``sample_size`` smallest distinct non-null
    values joined by '|'; ``cardinality_estimate`` is the size of that sample,
    as in the reference (capped). The distinct step is a shuffle of distinct
    (column, value) pairs, pre-aggregated per task; the per-column top values
    use a window with a row-number limit, which Spark plans with a partial
    group limit before the exchange.
    """
    if not columns:
        return df.sparkSession.createDataFrame(
            [], "name string, n_distinct bigint, cardinality_estimate bigint, sample_values string")
    long = (df.select(*[F.col(c).cast("string").alias(f"c{i}") for i, c in enumerate(columns)])
            .unpivot([], [f"c{i}" for i in range(len(columns))], "k", "value")
            .where(F.col("value").isNotNull())
            .groupBy("k", "value").agg(F.count(F.lit(1)).alias("cnt")))
    names = F.create_map(*[x for i, c in enumerate(columns) for x in (F.lit(f"c{i}"), F.lit(c))])
    n_distinct = long.groupBy("k").agg(F.count(F.lit(1)).alias("n_distinct"))
    top = (long.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("value")))
           .where(F.col("rn") <= sample_size)
           .groupBy("k").agg(F.array_join(F.array_sort(F.collect_list("value")), "|").alias("sample_values"),
                             F.count(F.lit(1)).alias("cardinality_estimate")))
    return (n_distinct.join(top, "k")
            .select(F.element_at(names, F.col("k")).alias("name"), "n_distinct",
                    F.col("cardinality_estimate").cast("long").alias("cardinality_estimate"),
                    "sample_values"))


def profile(df: DataFrame, exclude: list[str] | None = None, time_col: str | None = "lend_tm",
            id_col: str = "pid", recent_rows: int | None = None) -> DataFrame:
    """One row per column: name, position, data_type, nullable, comment, col_type, missing_rate,
    is_target_candidate, cardinality_estimate, n_distinct, sample_values. The comment is
    the field's ``comment`` metadata, empty if there is none.

    ``recent_rows`` limits the missing rate to the newest rows (the reference
    uses 5,000); None uses the whole table.
    """
    excl = set(SYSTEM_COLUMNS if exclude is None else exclude)
    fields = [(i, f) for i, f in enumerate(df.schema.fields) if f.name not in excl]
    spark = df.sparkSession
    meta = small_table(
        spark, [(f.name, i, f.dataType.simpleString(), f.nullable, f.metadata.get("comment", ""), classify_type(f.dataType),
                 is_target_candidate(f.name)) for i, f in fields],
        T.StructType([T.StructField("name", T.StringType()), T.StructField("position", T.IntegerType()),
                      T.StructField("data_type", T.StringType()), T.StructField("nullable", T.BooleanType()),
                      T.StructField("comment", T.StringType()), T.StructField("col_type", T.StringType()),
                      T.StructField("is_target_candidate", T.BooleanType())]))
    src = newest(df, time_col, id_col, recent_rows) if (recent_rows and time_col) else df
    miss = missing_rates(src, [f.name for _, f in fields]).drop("position")
    cats = category_profile(df, [f.name for _, f in fields if classify_type(f.dataType) == "categorical"])
    return (meta.join(miss, "name").join(cats, "name", "left")
            .select("name", "position", "data_type", "nullable", "comment", "col_type", "missing_rate",
                    "is_target_candidate", "cardinality_estimate", "n_distinct", "sample_values"))


def choose_target(prof: DataFrame, target_col: str | None = None) -> str:
    """The caller's label column, else the first label candidate."""
    first = target_col or prof.where("is_target_candidate").agg(F.min_by("name", "position")).first()[0]
    if first is None:
        raise ValueError("no target column given and no label candidate found")
    return first


def usable_fields(prof: DataFrame, target_col: str | None = None,
                  missing_max: float = USABLE_MISSING_MAX) -> DataFrame:
    """Numeric / categorical columns with missing rate below ``missing_max``, plus
    all time columns. The target and label candidates are left out."""
    keep = ((F.col("col_type").isin("numeric", "categorical") & (F.col("missing_rate") < missing_max))
            | (F.col("col_type") == "time"))
    out = prof.where(keep & ~F.col("is_target_candidate"))
    if target_col:
        out = out.where(F.col("name") != target_col)
    return out.select("name", "position", "col_type")


def profile_summary(df: DataFrame, prof: DataFrame, target_col: str | None = None,
                    missing_max: float = USABLE_MISSING_MAX) -> DataFrame:
    """Rows, columns, usable columns per class and label candidates, one row
    (one aggregate over the small profile table; the row count is one scalar)."""
    total_rows = df.count()
    usable = ((F.col("col_type").isin("numeric", "categorical") & (F.col("missing_rate") < missing_max))
              | (F.col("col_type") == "time")) & ~F.col("is_target_candidate")
    if target_col:
        usable = usable & (F.col("name") != target_col)
    return prof.agg(
        F.lit(total_rows).cast("long").alias("total_rows"),
        F.lit(len(df.columns)).cast("long").alias("total_columns"),
        *[F.coalesce(F.sum((usable & (F.col("col_type") == k)).cast("long")), F.lit(0)).alias(f"{k}_cnt")
          for k in ("numeric", "categorical", "time")],
        F.coalesce(F.sum(F.col("is_target_candidate").cast("long")), F.lit(0)).alias("candidate_cnt"))
