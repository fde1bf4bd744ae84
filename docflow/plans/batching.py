"""Batching, ledger, ordering and sampling queries over ``orders``."""

from __future__ import annotations

from pyspark.sql import functions as F

from docflow.operators import batches as B
from docflow.operators import upsert as U
from docflow.operators import validate as V
from docflow.operators.intervals import from_number, interval_join
from docflow.operators.selection import select_keys
from docflow.plans.registry import query
from docflow.sources.tables import Tables

BATCH = 5000  # rows per batch, independent of the scale factor

_RN_SQL = "row_number() OVER (ORDER BY o_orderdate, o_orderkey)"


@query("global_row_number", f"SELECT o_orderkey, {_RN_SQL} AS rn FROM orders")
def global_row_number(spark, sf):
    o = Tables(spark, sf).orders.select("o_orderkey", "o_orderdate")
    return B.global_row_number(o, ["o_orderdate", "o_orderkey"]).select("o_orderkey", "rn")


@query(
    "order_statistics",
    f"""SELECT rn AS rank, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderkey
        FROM (SELECT o_orderkey, o_orderdate, {_RN_SQL} AS rn FROM orders) WHERE rn % {BATCH} = 0""",
)
def order_statistics(spark, sf):
    """The keys that end each batch of rows, selected by counting."""
    o = Tables(spark, sf).orders.select("o_orderkey", "o_orderdate")
    cuts = select_keys(o, ["o_orderdate", "o_orderkey"], list(range(BATCH, o.count() + 1, BATCH)))
    keys = spark.createDataFrame([(below, *key) for key, below in cuts], "rank long, k long, o_orderkey long")
    day = from_number(F.col("k"), dict(o.dtypes)["o_orderdate"])
    return keys.select("rank", F.date_format(day, "yyyy-MM-dd").alias("o_orderdate"), "o_orderkey")


_ROWB_SQL = f"""
  rb AS (SELECT o_orderkey, o_orderdate, {_RN_SQL} AS rn FROM orders),
  rb2 AS (SELECT *, CAST(ceil(rn / {BATCH}) AS BIGINT) AS batch_no FROM rb),
  bs AS (SELECT batch_no, min(o_orderdate) AS s, max(o_orderdate) AS e, count(*) AS batch_size FROM rb2 GROUP BY 1)"""


def _row_batches(spark, sf):
    o = Tables(spark, sf).orders.select("o_orderkey", "o_orderdate")
    return B.row_batches(o, ["o_orderdate", "o_orderkey"], BATCH, "o_orderdate", run_id="RUN-1", create_date=F.lit(None))


@query(
    "row_batches",
    f"""WITH {_ROWB_SQL}
        SELECT rb2.o_orderkey, rb2.rn, rb2.batch_no,
               substr(md5('RUN-1|' || CAST(rb2.batch_no AS VARCHAR)), 1, 8) AS batch_id,
               strftime(bs.s, '%Y-%m-%d') AS batch_start_date, strftime(bs.e, '%Y-%m-%d') AS batch_end_date
        FROM rb2 JOIN bs USING (batch_no)""",
)
def row_batches(spark, sf):
    r = _row_batches(spark, sf)
    return r.select(
        "o_orderkey",
        "rn",
        "batch_no",
        "batch_id",
        F.date_format("batch_start_date", "yyyy-MM-dd").alias("batch_start_date"),
        F.date_format("batch_end_date", "yyyy-MM-dd").alias("batch_end_date"),
    )


@query(
    "batch_ledger",
    f"""WITH {_ROWB_SQL}
        SELECT batch_no, batch_size, strftime(s, '%Y-%m-%d') AS from_date, strftime(e, '%Y-%m-%d') AS to_date FROM bs""",
)
def batch_ledger(spark, sf):
    o = Tables(spark, sf).orders.select("o_orderkey", "o_orderdate")
    led = B.ledger_by_selection(o, ["o_orderdate", "o_orderkey"], BATCH)
    return led.select(
        "batch_no",
        "batch_size",
        F.date_format("from_date", "yyyy-MM-dd").alias("from_date"),
        F.date_format("to_date", "yyyy-MM-dd").alias("to_date"),
    )


@query(
    "id_range_batches",
    """WITH b AS (SELECT min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM orders),
            t AS (SELECT i AS batch_no, lo + i * 1000 AS start_id, lo + i * 1000 + 999 AS end_id
                  FROM b, range(0, CAST((hi - lo) // 1000 + 1 AS BIGINT)) r(i)),
            c AS (SELECT CAST(floor((o_orderkey - (SELECT lo FROM b)) / 1000) AS BIGINT) AS batch_no, count(*) AS n
                  FROM orders GROUP BY 1)
       SELECT t.batch_no, t.start_id, t.end_id, coalesce(c.n, 0) AS n FROM t LEFT JOIN c USING (batch_no)""",
)
def id_range_batches(spark, sf):
    rows, table = B.id_range_batches(Tables(spark, sf).orders, "o_orderkey", 1000)
    counts = rows.groupBy("batch_no").agg(F.count(F.lit(1)).alias("n"))
    return table.join(counts, "batch_no", "left").select(
        "batch_no", "start_id", "end_id", F.coalesce("n", F.lit(0)).alias("n")
    )


@query(
    "scan_id_range",
    """WITH b AS (SELECT min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM orders)
       SELECT o_orderkey, o_orderstatus FROM orders
       WHERE o_orderkey BETWEEN (SELECT lo + (hi - lo) // 4 FROM b) AND (SELECT lo + (hi - lo) // 2 FROM b)""",
)
def scan_id_range(spark, sf):
    """BETWEEN slice, the second quarter of the ids (the range is the feature),
    with bounds from a MIN/MAX probe (two scalars)."""
    o = Tables(spark, sf).orders
    b = o.agg(F.min("o_orderkey").alias("lo"), F.max("o_orderkey").alias("hi")).first()
    lo, hi = (b["lo"], b["hi"]) if b["lo"] is not None else (0, 0)
    return B.read_id_range(o, "o_orderkey", lo + (hi - lo) // 4, lo + (hi - lo) // 2).select("o_orderkey", "o_orderstatus")


# ---------------------------------------------------------- monthly ledger

_LEDGER_SQL = """
  months AS (SELECT unnest(generate_series(date_trunc('month', min(o_orderdate)), date_trunc('month', max(o_orderdate)),
                                           INTERVAL 1 MONTH)) AS batch_start FROM orders),
  ledger AS (SELECT strftime(batch_start, '%Y%m') AS batch_id, batch_start, batch_start + INTERVAL 1 MONTH AS batch_end,
                    CASE WHEN month(batch_start) % 3 = 0 THEN batch_start + INTERVAL 1 MONTH END AS reconcile_dttm
             FROM months)"""


def monthly_ledger(spark, sf):
    """Batch ledger of monthly windows; every third month already reconciled."""
    w = B.time_window_ledger(Tables(spark, sf).orders, "o_orderdate", "month")
    return w.withColumn(
        "reconcile_dttm", F.when(F.month("batch_start") % 3 == 0, F.col("batch_end")).cast("timestamp_ntz")
    )


@query(
    "pending_batches",
    f"""WITH {_LEDGER_SQL} SELECT batch_id, strftime(batch_start, '%Y-%m-%d') AS batch_start,
                                strftime(batch_end, '%Y-%m-%d') AS batch_end FROM ledger WHERE reconcile_dttm IS NULL""",
)
def pending_batches(spark, sf):
    p = B.pending_batches(monthly_ledger(spark, sf))
    return p.select(
        "batch_id",
        F.date_format("batch_start", "yyyy-MM-dd").alias("batch_start"),
        F.date_format("batch_end", "yyyy-MM-dd").alias("batch_end"),
    )


@query(
    "range_join_batches",
    f"""WITH {_LEDGER_SQL}
        SELECT l.batch_id, count(*) AS n, min(o.o_orderkey) AS min_key, max(o.o_orderkey) AS max_key
        FROM orders o JOIN ledger l ON o.o_orderdate >= l.batch_start AND o.o_orderdate < l.batch_end
        GROUP BY 1""",
)
def range_join_batches(spark, sf):
    from docflow.operators.joins import range_join

    o = Tables(spark, sf).orders.select("o_orderkey", "o_orderdate")
    j = range_join(o, "o_orderdate", monthly_ledger(spark, sf), "batch_start", "batch_end", bounds="[)")
    return j.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("min_key"), F.max("o_orderkey").alias("max_key")
    )


_OVERLAP_SQL = """
  WITH w AS (
    SELECT p_partkey,
           TIMESTAMP '2024-01-01' + to_minutes((p_partkey * 7919) % 43200)
             - CASE WHEN p_partkey % 100 = 0 THEN INTERVAL 20 YEAR ELSE INTERVAL 0 YEAR END AS s,
           TIMESTAMP '2024-01-01' + to_minutes((p_partkey * 7919) % 43200)
             + CASE WHEN p_partkey % 100 = 0 THEN INTERVAL 10 YEAR WHEN p_partkey % 10 = 1 THEN INTERVAL 3 DAY
                    ELSE to_minutes(p_partkey % 60) END AS e
    FROM part)
  SELECT p_partkey, count(*) AS n, min(event_id) AS first_event, max(event_id) AS last_event
  FROM events JOIN w ON ts > s AND ts <= e GROUP BY 1"""


def _overlapping(spark, sf, **form):
    """Windows of minutes, days and decades (start after, end included), one per part, over the events."""
    t = Tables(spark, sf)
    k = F.col("p_partkey")
    at = F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), (k * 7919 % 43200).cast("int"))
    years = F.when(k % 100 == 0, F.expr("INTERVAL 20 YEAR")).otherwise(F.expr("INTERVAL 0 YEAR"))
    end = (
        F.when(k % 100 == 0, F.col("at") + F.expr("INTERVAL 10 YEAR"))
        .when(k % 10 == 1, F.col("at") + F.expr("INTERVAL 3 DAY"))
        .otherwise(F.col("at") + F.make_dt_interval(F.lit(0), F.lit(0), (k % 60).cast("int")))
    )
    w = t.part.select("p_partkey", at.alias("at")).select("p_partkey", (F.col("at") - years).alias("s"), end.alias("e"))
    totals = {"n": ("count", None), "first_event": ("min", "event_id"), "last_event": ("max", "event_id")}
    j = interval_join(t.events.select("event_id", "ts"), "ts", w, "s", "e", "(]", totals=totals, **form)
    return j.groupBy("p_partkey").agg(F.sum("n").alias("n"), F.min("first_event").alias("first_event"), F.max("last_event").alias("last_event"))


@query("interval_join_overlapping", _OVERLAP_SQL)
def interval_join_overlapping(spark, sf):
    """Overlapping windows of any length; the size of the window table decides the form."""
    return _overlapping(spark, sf)


@query("interval_sweep_overlapping", _OVERLAP_SQL)
def interval_sweep_overlapping(spark, sf):
    """The same by the sweep over ranges of time, as for window tables of any size."""
    return _overlapping(spark, sf, max_windows=0, ranges=16)


@query(
    "ledger_update",
    f"""WITH {_LEDGER_SQL},
        c AS (SELECT strftime(o_orderdate, '%Y%m') AS batch_id, count(*) AS n FROM orders GROUP BY 1),
        u AS (SELECT l.batch_id, l.batch_end AS reconcile_dttm, coalesce(c.n, 0) AS source_count
              FROM ledger l LEFT JOIN c USING (batch_id) WHERE l.reconcile_dttm IS NULL)
        SELECT l.batch_id, strftime(coalesce(u.reconcile_dttm, l.reconcile_dttm), '%Y-%m-%d') AS reconcile_dttm,
               CAST(u.source_count AS VARCHAR) AS source_count, u.batch_id IS NOT NULL AS updated
        FROM ledger l LEFT JOIN u USING (batch_id)""",
)
def ledger_update(spark, sf):
    """Set completion time and counts of all pending batches in ONE upsert."""
    led = monthly_ledger(spark, sf)
    counts = Tables(spark, sf).orders.groupBy(F.date_format("o_orderdate", "yyyyMM").alias("batch_id")).agg(
        F.count(F.lit(1)).alias("source_count")
    )
    pending = B.pending_batches(led)
    updates = pending.join(counts, "batch_id", "left").select(
        "batch_id", F.col("batch_end").alias("reconcile_dttm"), F.coalesce("source_count", F.lit(0)).alias("source_count"),
        F.lit(True).alias("updated"),
    )
    merged = U.upsert(led.withColumn("source_count", F.lit(None).cast("bigint")).withColumn("updated", F.lit(None).cast("boolean")), updates, "batch_id")
    return merged.select(
        "batch_id",
        F.date_format("reconcile_dttm", "yyyy-MM-dd").alias("reconcile_dttm"),
        F.col("source_count").cast("string").alias("source_count"),
        F.coalesce("updated", F.lit(False)).alias("updated"),
    )


@query(
    "batch_status",
    f"""WITH s AS (SELECT o_orderkey, CAST(floor(o_orderkey / {BATCH}) AS BIGINT) AS batch_no,
                          CASE WHEN o_orderkey % 41 = 0 THEN 'not-a-date' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS t
                   FROM orders),
            p AS (SELECT batch_no, CASE WHEN try_strptime(t, '%Y-%m-%d') IS NULL THEN 'order_date' END AS err FROM s)
        SELECT batch_no, count(*) AS rows, count(err) AS failed_rows, min(err) AS first_error,
               CASE WHEN count(err) > 0 THEN 'FAILED' ELSE 'DONE' END AS status FROM p GROUP BY 1""",
)
def batch_status(spark, sf):
    o = Tables(spark, sf).orders
    k = F.col("o_orderkey")
    s = o.select(
        (F.floor(k / BATCH)).cast("bigint").alias("batch_no"),
        F.when(k % 41 == 0, F.lit("not-a-date")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("t"),
    )
    p = V.parse_with_errors(s, {"order_date": ("t", F.try_to_timestamp("t", F.lit("yyyy-MM-dd")))}, "error")
    return B.batch_status(p, "batch_no", "error")


@query(
    "union_all_batches",
    f"""SELECT CAST(floor(o_orderkey / {BATCH}) AS BIGINT) AS batch_no, o_orderstatus, count(*) AS n,
               round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1, 2""",
)
def union_all_batches(spark, sf):
    """The results of all batches and statuses as one table: one scan, one aggregate."""
    o = Tables(spark, sf).orders.withColumn("batch_no", F.floor(F.col("o_orderkey") / BATCH).cast("bigint"))
    return o.groupBy("batch_no", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


# ------------------------------------------------------ order / limit / sample


@query("ordered_output", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey")
def ordered_output(spark, sf):
    o = Tables(spark, sf).orders
    return o.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey")


@query("limit_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def limit_n(spark, sf):
    """Top 100 (the limit is the feature); ties broken by key -> deterministic."""
    o = Tables(spark, sf).orders
    return o.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(100)


def hash_bucket(c, m: int):
    """Deterministic bucket in [0, m) from the md5 of a key (portable to SQL)."""
    return F.pmod(F.conv(F.substring(F.md5(F.col(c).cast("string")), 1, 8), 16, 10).cast("bigint"), F.lit(m))


@query(
    "hash_sample",
    """SELECT o_orderkey FROM orders
       WHERE (CAST(('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8)) AS BIGINT) % 10) < 1""",
)
def hash_sample(spark, sf):
    """Reproducible ~10% sample: md5 bucket of the key."""
    o = Tables(spark, sf).orders
    return o.filter(hash_bucket("o_orderkey", 10) < 1).select("o_orderkey")


@query("bernoulli_sample")
def bernoulli_sample(spark, sf):
    """10% Bernoulli sample without replacement (random -> rows-only check)."""
    return Tables(spark, sf).orders.sample(False, 0.1, seed=42).select("o_orderkey")


@query(
    "bernoulli_sample_invariants",
    "SELECT true AS all_in_table, true AS no_repeats, true AS rate_in_bounds",
)
def bernoulli_sample_invariants(spark, sf):
    """Sampled keys are keys of the table, none twice, and their share is
    within six standard deviations of the rate."""
    o = Tables(spark, sf).orders.select("o_orderkey")
    picked = bernoulli_sample(spark, sf).groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("times"))
    j = o.withColumn("here", F.lit(True)).join(picked, "o_orderkey", "full_outer")
    n, taken = F.count("here"), F.coalesce(F.sum("times"), F.lit(0))
    return j.agg(
        (F.count_if(F.col("here").isNull()) == 0).alias("all_in_table"),
        (F.coalesce(F.max("times"), F.lit(1)) == 1).alias("no_repeats"),
        (F.abs(taken - n * 0.1) <= 6 * F.sqrt(n * 0.09)).alias("rate_in_bounds"),
    )
