"""Time-bucket activity reports: N-hour / hourly / daily / cumulative counts,
overall and per system, with zero filling.

Every report aggregates with a partial (map-side) count before the shuffle,
so the shuffled volume is (#buckets x #systems) per task, independent of how
many rows one system or bucket holds.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docflow.functions.exprs import SYSTEM_ALIASES, between_bounds, col_, lookup, ts_lit, wall_hour, wall_text

UNITS = {"hour": "1 hour", "day": "1 day"}


def bucket_start(ts: str | Column, unit: str) -> Column:
    """Start of the epoch-aligned bucket holding ``ts``, by the wall clock: the
    session time zone and its clock changes play no part.

    ``unit`` is 'hour', 'day' or an interval such as '6 hours'. An invalid unit
    raises ValueError (the report type is validated, never silently ignored).
    A NULL time has a NULL bucket, or none where the interval does not divide a day.
    """
    hours = re.fullmatch(r"(\d+) hours?", UNITS.get(unit, unit))
    if unit == "day":
        return col_(ts).cast("timestamp_ntz").cast("date").cast("timestamp_ntz")
    if hours and int(hours[1]) and 24 % int(hours[1]) == 0:
        return wall_hour(ts, int(hours[1]))
    if unit.endswith("hours") or unit.endswith("minutes") or unit.endswith("hour"):
        return F.window(col_(ts).cast("timestamp_ntz"), unit).start
    raise ValueError(f"unsupported bucket unit {unit!r}; use 'hour', 'day' or 'N hours'")


def _range(df: DataFrame, ts: str, start, end, bounds: str) -> DataFrame:
    if start is None and end is None:
        return df
    lo = ts_lit(start) if start is not None else None
    hi = ts_lit(end) if end is not None else None
    return df.filter(between_bounds(ts, lo, hi, bounds))


def bucket_counts(
    df: DataFrame,
    ts: str,
    unit: str = "6 hours",
    system: str | None = None,
    start=None,
    end=None,
    bounds: str = "[)",
    where: Column | None = None,
) -> DataFrame:
    """(bucket, [system], n) — documents per bucket (and per system)."""
    if where is not None:
        df = df.filter(where)
    df = _range(df, ts, start, end, bounds)
    keys = [bucket_start(ts, unit).alias("bucket")]
    if system:
        keys.append(F.col(system).alias("system"))
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def six_hour_counts(df: DataFrame, ts: str, **kw) -> DataFrame:
    """N-hour bucket label (yyyy-MM-dd HH:00:00) and document count, bucket order."""
    unit = kw.pop("unit", "6 hours")
    c = bucket_counts(df, ts, unit=unit, **kw)
    return c.select(wall_text("bucket").alias("bucket"), F.col("n").alias("document_count"))


def flat_report(
    df: DataFrame,
    ts: str,
    system: str,
    unit: str = "6 hours",
    start=None,
    end=None,
    bounds: str = "[)",
    system_filter: str = "ALL",
    where: Column | None = None,
) -> DataFrame:
    """One row per (bucket, system): start, end, overall count, system, system count.

    The overall count is derived from the per-system counts (no second scan);
    the window runs over the already aggregated (bucket x system) rows.
    """
    if system_filter not in (None, "ALL"):
        df = df.filter(F.col(system) == F.lit(system_filter))
    c = bucket_counts(df, ts, unit=unit, system=system, start=start, end=end, bounds=bounds, where=where)
    step = UNITS.get(unit, unit)
    return c.select(
        wall_text("bucket").alias("start_time"),
        wall_text(F.col("bucket") + F.expr(f"INTERVAL {step}")).alias("end_time"),
        F.sum("n").over(Window.partitionBy("bucket")).alias("overall_count"),
        F.col("system").alias("system_name"),
        F.col("n").alias("system_count"),
    )


def bucket_system_nested(df: DataFrame, ts: str, system: str, unit: str = "6 hours", **kw) -> DataFrame:
    """Per bucket: overall count and the list of {system, count} (bounded by #systems)."""
    c = bucket_counts(df, ts, unit=unit, system=system, **kw)
    return c.groupBy("bucket").agg(
        F.sum("n").alias("overall_count"),
        F.sort_array(F.collect_list(F.struct(F.col("system").alias("system"), F.col("n").alias("count")))).alias(
            "system_counts"
        ),
    )


def system_bucket_nested(df: DataFrame, ts: str, system: str, unit: str = "day", **kw) -> DataFrame:
    """Per system: overall count and the list of {bucket, count} (bounded by #buckets in range)."""
    c = bucket_counts(df, ts, unit=unit, system=system, **kw)
    return c.groupBy("system").agg(
        F.sum("n").alias("overall_count"),
        F.sort_array(F.collect_list(F.struct(F.col("bucket").alias("bucket"), F.col("n").alias("count")))).alias(
            "time_buckets"
        ),
    )


def cumulative_counts(df: DataFrame, ts: str, unit: str = "day", **kw) -> DataFrame:
    """Per bucket count and running total in bucket order.

    The running window is over the aggregated series (one row per bucket in the
    requested range), so its single-partition sort is bounded by time, not data.
    """
    c = bucket_counts(df, ts, unit=unit, **kw)
    w = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return c.select("bucket", F.col("n").alias("bucket_count"), F.sum("n").over(w).alias("cumulative_count"))


def report(df: DataFrame, ts: str, report_type: str, **kw) -> DataFrame:
    """Report-type dispatch: 'hourly', 'daily' or 'cumulative'."""
    if report_type == "hourly":
        return bucket_counts(df, ts, unit="hour", **kw)
    if report_type == "daily":
        return bucket_counts(df, ts, unit="day", **kw)
    if report_type == "cumulative":
        return cumulative_counts(df, ts, unit="day", **kw)
    raise ValueError(f"unknown report type {report_type!r}")


def system_dimension(df: DataFrame, system: str, known: Iterable[str] = ()) -> DataFrame:
    """Distinct systems observed in the data, plus the known ones (one row each)."""
    observed = df.select(F.col(system).alias("system")).where(F.col("system").isNotNull()).distinct()
    known = list(known)
    if not known:
        return observed
    spark = df.sparkSession
    listed = spark.createDataFrame([(k,) for k in known], "system string")
    return observed.unionByName(listed).distinct()


def gap_filled_series(
    df: DataFrame,
    ts: str,
    system: str,
    start: str,
    end: str,
    unit: str = "hour",
    known_systems: Iterable[str] = (),
    aliases: Mapping[str, str] = SYSTEM_ALIASES,
) -> DataFrame:
    """Every bucket in [start, end] for every system, zero where no documents.

    The calendar is generated per system row (``explode(sequence)``), then the
    counts are left-joined on (system, bucket); no cartesian product.
    """
    if unit not in UNITS:
        raise ValueError(f"gap filling supports 'hour' or 'day', got {unit!r}")
    step = UNITS[unit]
    lo = bucket_start(ts_lit(start), unit)
    hi_excl = ts_lit(end) + F.expr("INTERVAL 1 DAY")
    counts = bucket_counts(
        df.filter((F.col(ts) >= lo) & (F.col(ts) < hi_excl)), ts, unit=unit, system=system
    )
    last = hi_excl - F.expr(f"INTERVAL {step}")
    systems = system_dimension(df, system, known_systems)
    # steps are counted and added by the wall clock (a sequence of timestamps
    # would follow the session zone's clock changes)
    days = F.datediff(last.cast("date"), lo.cast("date"))
    if unit == "hour":
        steps, added = days * 24 + F.hour(last) - F.hour(lo), F.make_dt_interval(F.lit(0), F.col("__i"))
    else:
        steps, added = days, F.make_dt_interval(F.col("__i"))
    calendar = systems.select("system", F.explode(F.sequence(F.lit(0), steps)).alias("__i"))
    calendar = calendar.select("system", (lo + added).alias("bucket"))
    label = F.translate(wall_text("bucket"), " ", "T") if unit == "hour" else F.col("bucket").cast("date").cast("string")
    return calendar.join(counts, ["system", "bucket"], "left").select(
        lookup(aliases, "system", keep_unknown=True).alias("system_name"),
        label.alias("time_bucket"),
        F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("count"),
    )


def zero_fill_systems(
    df: DataFrame, system: str, known_systems: Iterable[str], aliases: Mapping[str, str] = SYSTEM_ALIASES
) -> DataFrame:
    """Overall count per system; every known system listed, with 0 when absent."""
    totals = df.groupBy(F.col(system).alias("system")).agg(F.count(F.lit(1)).alias("n"))
    dim = system_dimension(df, system, known_systems)
    return dim.join(totals, "system", "left").select(
        lookup(aliases, "system", keep_unknown=True).alias("system_name"),
        F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("overall_count"),
    )


def report_grand_total(flat: DataFrame) -> DataFrame:
    """Grand total from a flattened report without double counting the
    overall value that repeats on each system row: sum of system counts."""
    per_bucket = flat.groupBy("start_time").agg(
        F.sum("system_count").alias("bucket_total"), F.max("overall_count").alias("overall_count")
    )
    return per_bucket.agg(
        F.count(F.lit(1)).alias("n_buckets"),
        F.sum("bucket_total").alias("grand_total"),
        F.sum(F.when(F.col("bucket_total") == F.col("overall_count"), 1).otherwise(0)).alias("consistent_buckets"),
    )


def time_report(
    df: DataFrame,
    ts: str,
    system: str,
    unit: str = "6 hours",
    start: str | None = None,
    end: str | None = None,
    bounds: str = "[)",
    fill: bool = False,
    known_systems: Iterable[str] = (),
    system_filter: str = "ALL",
) -> DataFrame:
    """One entry point for the activity report.

    ``fill=False``: flattened (bucket, system) rows with the overall count
    per bucket (``flat_report``). ``fill=True``: every hour / day bucket of
    [start, end] for every system, zero where empty (``gap_filled_series``;
    ``end`` is an inclusive calendar date there).
    """
    if fill:
        if start is None or end is None:
            raise ValueError("gap filling needs start and end")
        if system_filter not in (None, "ALL"):
            df = df.filter(F.col(system) == F.lit(system_filter))
        return gap_filled_series(df, ts, system, start, end, unit=unit, known_systems=known_systems)
    return flat_report(df, ts, system, unit=unit, start=start, end=end, bounds=bounds, system_filter=system_filter)
