"""Keyed update of a target table without a transactional catalog."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.session import written


def upsert(target: DataFrame, updates: DataFrame, key: str | list[str], order_col: str | None = None) -> DataFrame:
    """Apply ``updates`` to ``target`` by key (update matching rows, insert new keys).

    Columns present in ``updates`` replace the target value — including with
    NULL (an update marker decides, not ``coalesce``). Columns missing from
    ``updates`` keep the target value. Duplicate update keys are resolved to
    the row with the greatest ``order_col``; without it a repeated key is an error.
    Re-applying the same updates gives the same result (idempotent).
    """
    keys = [key] if isinstance(key, str) else list(key)
    upd_cols = [c for c in updates.columns if c not in keys and c != order_col]
    if order_col:
        latest = updates.groupBy(*keys).agg(
            F.max_by(F.struct(*upd_cols), F.col(order_col)).alias("__u")
        )
        updates = latest.select(*keys, *[F.col(f"__u.{c}").alias(c) for c in upd_cols])
    elif upd_cols:
        once = updates.groupBy(*keys).agg(F.first(F.struct(*upd_cols)).alias("__u"), F.count(F.lit(1)).alias("__n"))
        checked = F.when(F.col("__n") > 1, F.raise_error(F.lit("update keys repeat: give order_col"))).otherwise(F.col("__u"))
        updates = once.withColumn("__u", checked).select(*keys, *[F.col(f"__u.{c}").alias(c) for c in upd_cols])
    u = updates.select(*keys, *[F.col(c).alias(f"__u_{c}") for c in upd_cols], F.lit(True).alias("__upd"))
    j = target.join(u, keys, "full_outer")
    out = []
    for c in target.columns:
        if c in keys:
            out.append(F.col(c))
        elif c in upd_cols:
            out.append(F.when(F.col("__upd"), F.col(f"__u_{c}")).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    new_cols = [F.col(f"__u_{c}").alias(c) for c in upd_cols if c not in target.columns]
    return j.select(*out, *new_cols)


def write_upsert(spark, target_path: str, updates: DataFrame, key, out_path: str, fmt: str = "parquet") -> str:
    """Write-new-then-swap: the merged table goes to ``out_path`` (never over
    the path being read); the caller swaps its pointer to the returned path."""
    if out_path.rstrip("/") == target_path.rstrip("/"):
        raise ValueError("out_path must differ from target_path")
    merged = upsert(spark.read.format(fmt).load(target_path), updates, key)
    merged.write.mode("errorifexists").format(fmt).save(out_path)
    return out_path


def key_range_part(key: str | Column, low: int, width: int) -> Column:
    """Number of the key range of ``width`` keys that holds ``key``, counted from ``low``."""
    return F.floor((F.col(key) if isinstance(key, str) else key) / F.lit(width) - F.lit(low / width)).cast("int")


def write_upsert_touched(spark: SparkSession, path: str, updates: DataFrame, key: str, part: Column, part_col: str = "part", order_col: str | None = None) -> int:
    """Upsert into the Parquet table at ``path``, partitioned by the int column
    ``part_col`` = ``part`` of the key, reading and rewriting only the partitions
    that hold an update key; returns their number. The merged rows are written to
    the shared folder first, so a write that fails can be repeated from there.
    Readers should not run meanwhile: partitions are swapped one by one. A NULL
    key in the updates is an error; without updates nothing is written."""
    known = F.when(part.isNull(), F.raise_error(F.lit("update key is null"))).otherwise(part)
    updates = written(updates.withColumn(part_col, known.cast("int")), "upsert-updates")
    # at most one number per partition of the table
    touched = sorted(r[0] for r in updates.select(part_col).distinct().collect())
    if not touched:
        return 0
    old = spark.read.parquet(path).where(F.col(part_col).isin(touched))
    merged = written(upsert(old, updates, [part_col, key], order_col), "upsert-merged")
    merged.hint("rebalance", part_col).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part_col).parquet(path)
    return len(touched)
