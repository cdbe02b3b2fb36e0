"""Read-side operators: scans, counts, the feature matrix, distinct samples and
the feature-spec source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPEC_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("formula", T.StringType()),
    T.StructField("sources", T.ArrayType(T.StringType())),
    T.StructField("template", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("expected_iv_range", T.StringType()),
])


def scan(df: DataFrame, columns: list[str] | None = None, where: str | None = None,
         order_by: list[str] | None = None, limit: int | None = 500) -> DataFrame:
    """Read-only scan: projection, filter, optional order and row limit.

    Projection and filter reach the Parquet reader (column pruning, pushed
    filters); ``order_by`` + ``limit`` plans as a per-task top-k.
    """
    out = df.select(*columns) if columns else df
    if where:
        out = out.where(F.expr(where))
    if order_by:
        out = out.orderBy(*order_by)
    return out.limit(limit) if limit is not None else out


def jdbc_table(spark: SparkSession, url: str, table: str, properties: dict | None = None,
               partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
               num_partitions: int | None = None) -> DataFrame:
    """A warehouse table over JDBC (e.g. the MySQL protocol). Give a numeric
    ``partition_column`` with bounds to read in parallel slices."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column:
        reader = (reader.option("partitionColumn", partition_column).option("lowerBound", lower)
                  .option("upperBound", upper).option("numPartitions", num_partitions or 8))
    return reader.load()


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def feature_matrix(df: DataFrame, features: list[str], target_col: str, id_col: str = "pid",
                   time_col: str | None = "lend_tm", limit: int | None = None) -> DataFrame:
    """id, time, target and the features (de-duplicated, order kept), rows with a
    non-null target; with ``limit`` only the newest rows (time desc, then id)."""
    cols = list(dict.fromkeys([c for c in [id_col, time_col, target_col] if c] + features))
    out = df.where(F.col(target_col).isNotNull()).select(*cols)
    if limit is not None:
        order = ([F.col(time_col).desc_nulls_last()] if time_col else []) + [F.col(id_col).asc_nulls_last()]
        out = out.orderBy(*order).limit(limit)
    return out


def distinct_sample(df: DataFrame, col: str, limit: int = 30) -> DataFrame:
    """The ``limit`` smallest distinct non-null values of ``col``."""
    return (df.select(F.col(col).alias("value")).where(F.col("value").isNotNull())
            .distinct().orderBy("value").limit(limit))


def read_spec(spark: SparkSession, path: str) -> list[dict]:
    """Feature spec from JSON ``{"features": [...]}`` (multi-line) or JSON lines.

    The spec is metadata (one row per feature), so it is returned as a list.
    """
    raw = spark.read.option("multiLine", True).json(path)
    if "features" in raw.columns:
        rows = (spark.read.schema(T.StructType([T.StructField("features", T.ArrayType(SPEC_SCHEMA))]))
                .option("multiLine", True).json(path)
                .select(F.explode("features").alias("f")).select("f.*").collect())
    else:
        rows = spark.read.schema(SPEC_SCHEMA).json(path).collect()
    return [{k: (list(v) if isinstance(v, list) else v) for k, v in r.asDict().items()} for r in rows]
