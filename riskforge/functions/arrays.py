"""Helpers for small per-group lookup arrays joined to large data.

``with_count_below`` counts the elements of a small sorted array column below
a value (binary search; generated code whose size does not depend on the
number of groups or values). ``small_table`` builds a tiny DataFrame from
driver-side metadata in the JVM (no Python worker round trip).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

def small_table(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A DataFrame of a few metadata rows (bin edges, bracket bounds ...), built
    from literals. Only for small, bounded inputs."""
    if not rows:
        return spark.createDataFrame([], schema)
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(r, schema.fields)])
               for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def count_below(arr: Column, x: Column, max_len: int, strict: bool = True) -> Column:
    """Number of elements of the sorted array ``arr`` that are < x (``strict``)
    or <= x, as one expression (a null x gives 0). Only for short arrays: the
    expression has one comparison per element."""
    terms = []
    for k in range(1, max(max_len, 1) + 1):
        e = F.try_element_at(arr, F.lit(k))
        hit = (e < x) if strict else (e <= x)
        terms.append(F.coalesce(hit, F.lit(False)).cast("int"))
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def with_count_below(df: DataFrame, arr: str, x: Column, out: str, max_len: int,
                     strict: bool = True) -> DataFrame:
    """``df`` with ``out`` = number of elements of the sorted array column
    ``arr`` that are < x (``strict``) or <= x; a null x gives 0.

    Short arrays (<= 16) use one comparison per element. Longer ones use a
    branch-free binary search (about log2(max_len) comparisons per row, one
    projection per step so that generated code stays small).
    """
    if max_len <= 16:
        return df.withColumn(out, count_below(F.col(arr), x, max_len, strict))
    step = 1
    while step * 2 <= max_len:
        step *= 2
    df = df.withColumn(out, F.lit(0))
    while step >= 1:
        cand = F.col(out) + F.lit(step)
        e = F.try_element_at(F.col(arr), cand)
        hit = (e < x) if strict else (e <= x)
        ok = (cand <= F.size(F.col(arr))) & F.coalesce(hit, F.lit(False))
        df = df.withColumn(out, F.when(ok, cand).otherwise(F.col(out)))
        step //= 2
    return df
