"""Session helpers: building a local session for tests / bench, and the
shared folder used to cut lineage (``spark.checkpoint.dir``)."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(cpus: int | str = "*", shuffle_partitions: int | None = None,
                  app: str = "riskforge", memory: str = "8g") -> SparkSession:
    """Local session used by tests and ``bench.py``. Cluster users bring their own."""
    parts = shuffle_partitions or (8 if cpus == "*" else max(int(cpus), 1))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.default.parallelism", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    It is read from the session; only when it is unset and Spark runs in local
    mode (tests) a folder of our own is created and registered. On a cluster an
    unset folder is an error: executors must write to shared storage.
    """
    sc = spark.sparkContext
    path = sc.getCheckpointDir()
    if not path:
        path = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
            "spark.checkpoint.dir", None)
        if not path:
            if sc.master != "local" and not sc.master.startswith("local["):   # not local-cluster[...]
                raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage")
            path = tempfile.mkdtemp(prefix="riskforge-ckpt-")   # local mode only (tests)
        sc.setCheckpointDir(path)
        path = sc.getCheckpointDir() or path
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    This cuts lineage (a lost executor re-reads files instead of recomputing the
    whole plan) and gives later passes a columnar, prunable input.
    """
    spark = df.sparkSession
    root = checkpoint_root(spark).rstrip("/")
    path = f"{root}/tables/{name}-{uuid.uuid4().hex[:12]}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
