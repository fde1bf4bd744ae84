"""Report queries over ``events`` (system = event_type, created = ts)."""

from __future__ import annotations

from pyspark.sql import functions as F

from docflow.functions.exprs import SYSTEM_ALIASES, wall_text
from docflow.operators import report as R
from docflow.plans.registry import query
from docflow.sources.tables import Tables

# The requested report range (the feature: it cuts rows at both ends); the
# inclusive end date becomes an exclusive bound one day later.
START, END = "2024-01-03", "2024-01-27"
END_EXCL = "2024-01-28"
KNOWN = sorted(SYSTEM_ALIASES)

_ALIAS_SQL = "CASE {c} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SYSTEM_ALIASES.items()) + " ELSE {c} END"
_KNOWN_SQL = ", ".join(f"('{k}')" for k in KNOWN)
_SIX = "time_bucket(INTERVAL '6 hours', ts, TIMESTAMP '1970-01-01')"


@query(
    "six_hour_counts",
    f"""SELECT strftime({_SIX}, '%Y-%m-%d %H:%M:%S') AS bucket, count(*) AS document_count
        FROM events GROUP BY 1""",
)
def six_hour_counts(spark, sf):
    return R.six_hour_counts(Tables(spark, sf).events, "ts")


@query(
    "hourly_counts",
    """SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS bucket, event_type AS system, count(*) AS n
       FROM events GROUP BY 1, 2""",
)
def hourly_counts(spark, sf):
    c = R.report(Tables(spark, sf).events, "ts", "hourly", system="event_type")
    return c.select(wall_text("bucket").alias("bucket"), "system", "n")


@query(
    "daily_counts",
    """SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS bucket, event_type AS system, count(*) AS n
       FROM events GROUP BY 1, 2""",
)
def daily_counts(spark, sf):
    c = R.report(Tables(spark, sf).events, "ts", "daily", system="event_type")
    return c.select(wall_text("bucket").alias("bucket"), "system", "n")


_FLAT_SQL = f"""
    WITH c AS (
      SELECT {_SIX} AS b, event_type AS system, count(*) AS n FROM events
      WHERE ts >= TIMESTAMP '{START}' AND ts < TIMESTAMP '{END_EXCL}'
      GROUP BY 1, 2)
    SELECT strftime(b, '%Y-%m-%d %H:%M:%S') AS start_time,
           strftime(b + INTERVAL 6 HOUR, '%Y-%m-%d %H:%M:%S') AS end_time,
           CAST(sum(n) OVER (PARTITION BY b) AS BIGINT) AS overall_count,
           system AS system_name, n AS system_count
    FROM c"""


def _flat(spark, sf):
    return R.flat_report(
        Tables(spark, sf).events, "ts", "event_type", unit="6 hours", start=START, end=END_EXCL, bounds="[)"
    )


@query("six_hour_report", _FLAT_SQL)
def six_hour_report(spark, sf):
    return _flat(spark, sf)


@query(
    "report_grand_total",
    f"""WITH f AS ({_FLAT_SQL}),
        b AS (SELECT start_time, sum(system_count) AS bucket_total, max(overall_count) AS overall_count
              FROM f GROUP BY 1)
        SELECT count(*) AS n_buckets, CAST(sum(bucket_total) AS BIGINT) AS grand_total,
               CAST(sum(CASE WHEN bucket_total = overall_count THEN 1 ELSE 0 END) AS BIGINT) AS consistent_buckets FROM b""",
)
def report_grand_total(spark, sf):
    return R.report_grand_total(_flat(spark, sf))


@query(
    "cumulative_counts",
    """WITH c AS (SELECT date_trunc('day', ts) AS b, count(*) AS n FROM events GROUP BY 1)
       SELECT strftime(b, '%Y-%m-%d') AS bucket, n AS bucket_count,
              CAST(sum(n) OVER (ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cumulative_count
       FROM c""",
)
def cumulative_counts(spark, sf):
    c = R.report(Tables(spark, sf).events, "ts", "cumulative")
    return c.select(F.col("bucket").cast("date").cast("string").alias("bucket"), "bucket_count", "cumulative_count")


@query(
    "bucket_system_nested",
    f"""WITH c AS (SELECT {_SIX} AS b, event_type AS system, count(*) AS n FROM events GROUP BY 1, 2)
        SELECT strftime(b, '%Y-%m-%d %H:%M:%S') AS bucket, CAST(sum(n) AS BIGINT) AS overall_count,
               string_agg(system || ':' || CAST(n AS VARCHAR), ',' ORDER BY system) AS system_counts
        FROM c GROUP BY b""",
)
def bucket_system_nested(spark, sf):
    n = R.bucket_system_nested(Tables(spark, sf).events, "ts", "event_type")
    return n.select(
        wall_text("bucket").alias("bucket"),
        "overall_count",
        F.array_join(
            F.transform("system_counts", lambda x: F.concat(x["system"], F.lit(":"), x["count"].cast("string"))), ","
        ).alias("system_counts"),
    )


@query(
    "system_bucket_nested",
    """WITH c AS (SELECT date_trunc('day', ts) AS b, event_type AS system, count(*) AS n FROM events GROUP BY 1, 2)
       SELECT system, CAST(sum(n) AS BIGINT) AS overall_count, count(*) AS n_buckets,
              string_agg(strftime(b, '%Y-%m-%d') || ':' || CAST(n AS VARCHAR), ',' ORDER BY b) AS time_buckets
       FROM c GROUP BY system""",
)
def system_bucket_nested(spark, sf):
    n = R.system_bucket_nested(Tables(spark, sf).events, "ts", "event_type", unit="day")
    return n.select(
        "system",
        "overall_count",
        F.size("time_buckets").cast("bigint").alias("n_buckets"),
        F.array_join(
            F.transform(
                "time_buckets",
                lambda x: F.concat(x["bucket"].cast("date").cast("string"), F.lit(":"), x["count"].cast("string")),
            ),
            ",",
        ).alias("time_buckets"),
    )


@query(
    "gap_filled_series",
    f"""WITH s AS (SELECT DISTINCT event_type AS system FROM events WHERE event_type IS NOT NULL
                   UNION SELECT * FROM (VALUES {_KNOWN_SQL}) v(system)),
        cal AS (SELECT system, unnest(generate_series(TIMESTAMP '{START}', TIMESTAMP '{END} 23:00:00',
                                                      INTERVAL 1 HOUR)) AS b FROM s),
        c AS (SELECT event_type AS system, date_trunc('hour', ts) AS b, count(*) AS n FROM events
              WHERE ts >= TIMESTAMP '{START}' AND ts < TIMESTAMP '{END_EXCL}' GROUP BY 1, 2)
        SELECT {_ALIAS_SQL.format(c='cal.system')} AS system_name,
               strftime(cal.b, '%Y-%m-%dT%H:%M:%S') AS time_bucket, coalesce(c.n, 0) AS count
        FROM cal LEFT JOIN c ON cal.system = c.system AND cal.b = c.b""",
)
def gap_filled_series(spark, sf):
    return R.gap_filled_series(Tables(spark, sf).events, "ts", "event_type", START, END, unit="hour", known_systems=KNOWN)


@query(
    "zero_fill_systems",
    f"""WITH s AS (SELECT DISTINCT event_type AS system FROM events WHERE event_type IS NOT NULL
                   UNION SELECT * FROM (VALUES {_KNOWN_SQL}) v(system)),
        t AS (SELECT event_type AS system, count(*) AS n FROM events GROUP BY 1)
        SELECT {_ALIAS_SQL.format(c='s.system')} AS system_name, coalesce(t.n, 0) AS overall_count
        FROM s LEFT JOIN t ON s.system = t.system""",
)
def zero_fill_systems(spark, sf):
    return R.zero_fill_systems(Tables(spark, sf).events, "event_type", KNOWN)


@query(
    "find_projection_range",
    f"""SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, event_type FROM events
       WHERE ts >= TIMESTAMP '{START}' AND ts < TIMESTAMP '{END_EXCL}'""",
)
def find_projection_range(spark, sf):
    """Find with a projection and a date range: only listed fields leave the scan."""
    e = Tables(spark, sf).events
    r = e.select("event_id", "ts", "event_type").filter(
        (F.col("ts") >= F.lit(START).cast("timestamp_ntz")) & (F.col("ts") < F.lit(END_EXCL).cast("timestamp_ntz"))
    )
    return r.select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"), "event_type")
