"""Spark session and shared-folder helpers."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def _default_driver_memory() -> str:
    """Local mode: the driver is the executor; use ~60% of RAM, at most 16g."""
    try:
        with open("/proc/meminfo") as fh:
            kb = next(int(line.split()[1]) for line in fh if line.startswith("MemTotal"))
        return f"{max(1, min(16, int(kb * 0.6 / 1024 / 1024)))}g"
    except (OSError, StopIteration, ValueError):
        return "4g"


def get_spark(master: str | None = None, shuffle_partitions: int = 8, app: str = "docflow") -> SparkSession:
    """Local/test session: UTC, AQE with skew handling, UI off.

    On a cluster the session comes from the launcher; operators never call this.
    """
    builder = (
        SparkSession.builder.master(master or os.environ.get("SPARK_MASTER", "local[8]"))
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", _default_driver_memory()))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written intermediate tables.

    Uses ``spark.checkpoint.dir`` (or the context's checkpoint dir) as set by the
    cluster. Only when neither is set (local tests) a folder is created here.
    """
    sc = spark.sparkContext
    current = None
    try:
        current = sc.getCheckpointDir()
    except Exception:  # pragma: no cover - older API
        current = None
    if not current:
        current = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
        if not current:
            if not re.fullmatch(r"local(\[.*\])?", sc.master):
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            current = tempfile.mkdtemp(prefix="docflow-ckpt-")
            spark.conf.set("spark.checkpoint.dir", current)
        sc.setCheckpointDir(current)
        current = sc.getCheckpointDir() or current
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder (never machine-local on a cluster)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/docflow-{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a table in the shared folder and read it back: cuts the
    lineage and survives the loss of executors. Row groups are small, so that
    tasks which unfold the rows (an index into postings) share a file."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("parquet.block.size", str(4 << 20)).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def recommended_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Cluster settings sized from the data: scan splits of ``target`` bytes,
    initial shuffle partitions so each holds about ``target`` bytes (at least
    2 waves of the cores; AQE coalesces them at run time),
    skew handling on. Apply with ``SparkSession.builder.config(map=...)``."""
    shuffle = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
