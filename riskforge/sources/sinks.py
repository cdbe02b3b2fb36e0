"""Sinks: the derived feature table, result tables and models.

Paths default to the shared folder of ``spark.checkpoint.dir`` (see
``riskforge.session``); pass an explicit path or catalog table name in
production.
"""

from __future__ import annotations

import re
import time
import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskforge.operators.boosting import BoostedModel
from riskforge.session import checkpoint_root

# Fixed values that must equal the reference's behaviour.
DERIVED_PREFIX = "feat_derived_"


def derived_table_name(name: str) -> str:
    """Force the ``feat_derived_`` prefix on the last part of a table name."""
    parts = name.split(".")
    last = re.sub(r"[^\w]", "_", parts[-1])
    if not last.startswith(DERIVED_PREFIX):
        last = DERIVED_PREFIX + last
    return ".".join(parts[:-1] + [last])


def replace_table(df: DataFrame, table: str, root: str | None = None, expect_rows: int | None = None,
                  keep_versions: int = 2) -> DataFrame:
    """Replace a catalogue table in one step: readers see the old rows or the new ones, never a part.

    The rows go to a new version folder beside the old ones and are read back and checked there (schema, the
    number of rows if ``expect_rows`` tells it, and that every row group can be counted); then the name, a
    view of the version folder, is pointed at it by one catalogue statement (one writer at a time). A write or check that fails
    leaves the old version in place and raises. The newest ``keep_versions`` versions stay, for readers that
    still run on an older one; versions that no successful replacement named are removed with the older ones.
    A name that belongs to a stored table is refused: it cannot be swapped without a gap.
    """
    spark = df.sparkSession
    if keep_versions < 1:
        raise ValueError("at least the current version is kept")
    known = spark.catalog.tableExists(table)
    if known and spark.catalog.getTable(table).tableType != "VIEW":
        raise ValueError(f"{table} is a stored table, not a replaceable one: drop or rename it first")
    home = f"{(root or checkpoint_root(spark)).rstrip('/')}/versions/{table}"
    fs, path = _file_system(spark, home)
    folder = f"{home}/v-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    df.write.mode("error").parquet(folder)
    back = spark.read.parquet(folder)
    want = [(f.name, f.dataType) for f in df.schema.fields]
    if [(f.name, f.dataType) for f in back.schema.fields] != want:
        raise ValueError(f"{table}: the written columns differ from those given")
    n = back.count()
    if expect_rows is not None and n != expect_rows:
        raise ValueError(f"{table}: {n} rows were written, {expect_rows} expected")
    quoted = ".".join(f"`{p}`" for p in table.split("."))
    spark.sql(f"CREATE OR REPLACE VIEW {quoted} AS SELECT * FROM parquet.`{folder}`")
    versions = sorted(s.getPath().getName() for s in fs.listStatus(path))
    for old in versions[:-keep_versions]:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{home}/{old}"), True)
    return spark.table(table)


def _file_system(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def save_derived(df: DataFrame, name: str, path: str | None = None, mode: str = "overwrite",
                 as_table: bool = False) -> tuple[DataFrame, DataFrame]:
    """Write the derived table, read it back and report (table_name, row_count, status).

    ``mode="overwrite"`` replaces an older table of the same name,
    ``mode="error"`` refuses it. Status is ``ok`` or ``empty``. With ``as_table`` the name is one of the
    catalogue, replaced in one step (``replace_table``; ``path`` is then the folder of the versions).
    """
    spark = df.sparkSession
    table = derived_table_name(name)
    if as_table:
        if mode not in ("overwrite", "error"):
            raise ValueError(f"mode {mode!r}: overwrite or error")
        if mode == "error" and spark.catalog.tableExists(table):
            raise ValueError(f"{table} exists already")
        back = replace_table(df, table, path)
    else:
        path = path or f"{checkpoint_root(spark).rstrip('/')}/derived/{table}"
        df.write.mode(mode).parquet(path)
        back = spark.read.parquet(path)
    status = (back.agg(F.count(F.lit(1)).alias("row_count"))
              .select(F.lit(table).alias("table_name"), "row_count",
                      F.when(F.col("row_count") > 0, F.lit("ok")).otherwise(F.lit("empty")).alias("status")))
    return back, status


def save_results(results: dict[str, DataFrame], out_dir: str, fmt: str = "parquet") -> DataFrame:
    """Write each result table under ``out_dir/<name>`` and list (artifact, rows) read back."""
    spark = None
    listing = []
    for name, df in results.items():
        spark = df.sparkSession
        path = f"{out_dir.rstrip('/')}/{name}"
        df.write.mode("overwrite").format(fmt).save(path)
        listing.append((name, spark.read.format(fmt).load(path).count()))
    return spark.createDataFrame(listing, "artifact string, n_rows long")


def save_model(model: PipelineModel | BoostedModel, path: str) -> str:
    """Boosted trees are written as tables, pipelines by Spark ML; an older model at the path is replaced."""
    if isinstance(model, BoostedModel):
        model.save(SparkSession.active(), path)
    else:
        model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel | BoostedModel:
    spark = SparkSession.active()
    fs, folder = _file_system(spark, f"{path}/trees")
    if fs.exists(folder):
        return BoostedModel.load(spark, path)
    return PipelineModel.load(path)


def default_model_dir(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_root(spark).rstrip('/')}/models/{name}"
