"""Join recipes that are more than a single ``DataFrame.join`` call."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.operators.intervals import interval_join


def semi_join(df: DataFrame, keys: DataFrame, on, negate: bool = False) -> DataFrame:
    """``IN (SELECT DISTINCT ...)`` / collected-key filters as a semi (anti) join."""
    return df.join(keys, on, "left_anti" if negate else "left_semi")


def copartitioned_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Both sides hash-partitioned on ``key`` (AQE sizes the partitions) before the
    join, so the join itself adds no exchange and both partitionings can be
    reused by later operators on the same key."""
    return left.repartition(key).join(right.repartition(key), key, how)


def full_outer_merge(left: DataFrame, right: DataFrame, key: str, suffix: str = "_right") -> DataFrame:
    """Key merge of two sources: one row per key present on either side, all
    columns of both; clashing right-side names get ``suffix``."""
    rcols = {c: (c + suffix if c in left.columns else c) for c in right.columns if c != key}
    r = right.select(F.col(key).alias("__rk"), *[F.col(c).alias(a) for c, a in rcols.items()])
    j = left.join(r, left[key] == r["__rk"], "full_outer")
    return j.select(
        F.coalesce(left[key], r["__rk"]).alias(key),
        *[left[c] for c in left.columns if c != key],
        *[r[a] for a in rcols.values()],
    )


def full_outer_diff(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys present on one side only, with a side marker ('left_only'/'right_only')."""
    lk = left.select(F.col(key).alias("k"), F.lit(True).alias("in_left")).distinct()
    rk = right.select(F.col(key).alias("k"), F.lit(True).alias("in_right")).distinct()
    j = lk.join(rk, "k", "full_outer")
    return j.where(F.col("in_left").isNull() | F.col("in_right").isNull()).select(
        F.col("k").alias(key), F.when(F.col("in_left").isNull(), "right_only").otherwise("left_only").alias("side")
    )


def except_all_both(left: DataFrame, right: DataFrame, cols: list[str]) -> DataFrame:
    """Multiset difference both ways with a side tag (duplicates count): one scan
    per side and one aggregate of +1 / -1; NULLs are equal."""
    both = left.select(*cols, F.lit(1).alias("__n")).unionByName(right.select(*cols, F.lit(-1).alias("__n")))
    surplus = both.groupBy(*cols).agg(F.sum("__n").alias("__n")).where(F.col("__n") != 0)
    side = F.when(F.col("__n") > 0, "source_only").otherwise("target_only")
    copies = F.sequence(F.lit(1).cast("bigint"), F.abs("__n"))
    return surplus.select(*cols, side.alias("side"), F.explode(copies).alias("__copy")).drop("__copy")


def range_join(
    rows: DataFrame,
    ts: str,
    windows: DataFrame,
    start: str,
    end: str,
    bounds: str = "(]",
) -> DataFrame:
    """Assign each row to the window(s) whose bounds contain ``ts``: see ``intervals``."""
    return interval_join(rows, ts, windows, start, end, bounds)
