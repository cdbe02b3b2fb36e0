"""Structured Streaming form of the derivation step.

The reference has no streaming operators. New loan rows arriving as files can
still be turned into derived features continuously: formula features are a
stateless projection, so the same ``derive_table`` plan runs on a file stream
and appends Parquet files. Templates that need statistics over other rows
(``frequency_encode``, ``normalized``) are not incremental and are refused.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riskforge.operators.derive import derive_table, split_windows


def derive_stream(spark: SparkSession, source_dir: str, schema: T.StructType, features: list[dict],
                  target_col: str, out_dir: str, checkpoint_dir: str, id_col: str = "pid",
                  time_col: str | None = "lend_tm", available_now: bool = True) -> StreamingQuery:
    """Start a query that derives ``features`` for every new Parquet file in
    ``source_dir`` and appends them to ``out_dir`` (exactly once through the
    checkpoint in ``checkpoint_dir``, which must be on shared storage)."""
    stateful = [f["name"] for f in features if split_windows(f["formula"])[1]]
    if stateful:
        raise ValueError(f"templates needing whole-table statistics cannot stream: {stateful}")
    src = spark.readStream.schema(schema).parquet(source_dir)
    derived = derive_table(src, features, target_col, id_col, time_col)
    writer = (derived.writeStream.format("parquet").option("path", out_dir)
              .option("checkpointLocation", checkpoint_dir).outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
