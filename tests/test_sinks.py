"""Catalogue tables that are replaced in one step."""

import pytest
from pyspark.sql import functions as F

from riskforge.sources.sinks import replace_table, save_derived


def test_replacement_is_whole_or_not_at_all(spark, tmp_path):
    root = str(tmp_path)
    first = spark.range(10).withColumn("x", F.col("id") * 2)
    assert replace_table(first, "swap_a", root).count() == 10
    # a write that dies half-way: the first rows are written, a later partition fails
    broken = spark.range(0, 1000, 1, 4).withColumn("x", F.when(F.col("id") == 900, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        replace_table(broken, "swap_a", root)
    assert [r["x"] for r in spark.table("swap_a").orderBy("id").collect()] == [2 * i for i in range(10)]
    with pytest.raises(ValueError, match="10 rows were written, 11 expected"):
        replace_table(first, "swap_a", root, expect_rows=11)
    assert spark.table("swap_a").columns == ["id", "x"]
    # other columns; the table is built from its own old version
    after = replace_table(spark.table("swap_a").where("id < 4").select(F.col("x").cast("string").alias("y")), "swap_a", root, expect_rows=4)
    assert after.columns == ["y"] and spark.table("swap_a").count() == 4
    for _ in range(3):
        replace_table(spark.table("swap_a"), "swap_a", root)
    assert len(list((tmp_path / "versions" / "swap_a").iterdir())) == 2
    assert spark.table("swap_a").count() == 4
    spark.sql("DROP VIEW swap_a")


def test_table_sink_modes(spark, tmp_path):
    rows = spark.range(3)
    _, status = save_derived(rows, "swap_b", str(tmp_path), as_table=True)
    assert status.first().asDict() == {"table_name": "feat_derived_swap_b", "row_count": 3, "status": "ok"}
    with pytest.raises(ValueError, match="exists already"):
        save_derived(rows, "swap_b", str(tmp_path), mode="error", as_table=True)
    _, status = save_derived(rows.limit(0), "swap_b", str(tmp_path), as_table=True)
    assert status.first()["status"] == "empty"
    with pytest.raises(ValueError, match="overwrite or error"):
        save_derived(rows, "swap_b", str(tmp_path), mode="append", as_table=True)
    spark.sql("DROP VIEW feat_derived_swap_b")


def test_stored_tables_are_refused(spark, tmp_path):
    folder = str(tmp_path / "stored")
    spark.sql(f"CREATE TABLE swap_c (id BIGINT) USING parquet LOCATION '{folder}'")
    with pytest.raises(ValueError, match="stored table"):
        replace_table(spark.range(3), "swap_c", str(tmp_path))
    spark.sql("DROP TABLE swap_c")
