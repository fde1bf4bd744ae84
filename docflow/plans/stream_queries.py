"""Streaming queries: the events table is staged as a file stream source in
the shared scratch folder and drained with ``availableNow``; the result is
the sink table after the last micro-batch."""

from __future__ import annotations

from pyspark.sql import functions as F

from docflow.functions.exprs import wall_text
from docflow.operators import batches as B
from docflow.operators import joins as J
from docflow.operators import report as R
from docflow.plans.batching import monthly_ledger
from docflow.plans.bindings import target_orders
from docflow.plans.registry import query
from docflow.session import scratch_path
from docflow.sources.tables import Tables
from docflow.streaming import streams as S


def _staged_events(spark, sf):
    e = Tables(spark, sf).events
    src = scratch_path(spark, "events-stream")
    delay = S.stage_files(e, "ts", src)
    return S.file_stream(spark, src, e.schema), delay


@query(
    "stream_six_hour_counts",
    """SELECT strftime(time_bucket(INTERVAL '6 hours', ts, TIMESTAMP '1970-01-01'), '%Y-%m-%d %H:%M:%S') AS bucket,
              count(*) AS document_count FROM events GROUP BY 1""",
)
def stream_six_hour_counts(spark, sf):
    """Six-hour counts computed incrementally (watermark + update mode; each
    micro-batch upserts the changed windows); equals the batch result once the
    input is drained."""
    stream, delay = _staged_events(spark, sf)
    counts = S.windowed_counts(stream, "ts", "6 hours", delay)
    out = S.upsert_stream(counts, ["bucket"], scratch_path(spark, "six-hour"), scratch_path(spark, "ckpt-six"))
    return out.select(wall_text("bucket").alias("bucket"), F.col("n").alias("document_count"))


@query(
    "stream_upsert",
    """SELECT user_id, arg_max(event_type, ts) AS last_event_type, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS last_ts,
              count(*) AS n_events FROM events GROUP BY 1""",
)
def stream_upsert(spark, sf):
    """Micro-batches of updates applied to a keyed target (latest event per
    user; of equal times the larger type): state in the state store, changed
    keys upserted per micro-batch."""
    stream, _ = _staged_events(spark, sf)
    latest = S.latest_per_key(stream, "user_id", "ts", "event_type")
    out = S.upsert_stream(latest, ["user_id"], scratch_path(spark, "latest"), scratch_path(spark, "ckpt-latest"))
    return out.select(
        "user_id",
        F.col("last_value").alias("last_event_type"),
        F.date_format("last_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("last_ts"),
        F.col("n").alias("n_events"),
    )


@query(
    "stream_ledger_poll",
    """WITH months AS (SELECT unnest(generate_series(date_trunc('month', min(o_orderdate)), date_trunc('month', max(o_orderdate)),
                                                      INTERVAL 1 MONTH)) AS batch_start FROM orders),
            ledger AS (SELECT strftime(batch_start, '%Y%m') AS batch_id, batch_start, batch_start + INTERVAL 1 MONTH AS batch_end,
                              month(batch_start) % 3 = 0 AS done FROM months),
            tgt AS (SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderkey % 97 <> 0
                    UNION ALL SELECT -o_orderkey - 1, o_orderdate FROM orders WHERE o_orderkey % 211 = 0),
            s AS (SELECT l.batch_id, count(o.o_orderkey) AS n FROM ledger l LEFT JOIN orders o
                  ON o.o_orderdate >= l.batch_start AND o.o_orderdate < l.batch_end WHERE NOT l.done GROUP BY 1),
            t AS (SELECT l.batch_id, count(o.o_orderkey) AS n FROM ledger l LEFT JOIN tgt o
                  ON o.o_orderdate >= l.batch_start AND o.o_orderdate < l.batch_end WHERE NOT l.done GROUP BY 1)
       SELECT s.batch_id, s.n AS source_count, t.n AS target_count,
              CASE WHEN s.n = t.n THEN 'MATCHED' ELSE 'NOT MATCHED' END AS count_status
       FROM s JOIN t USING (batch_id)""",
)
def stream_ledger_poll(spark, sf):
    """New ledger rows arrive as files; each micro-batch's pending batches are
    counted on both sides (stream-static range join) and recorded."""
    ledger = monthly_ledger(spark, sf)
    src = scratch_path(spark, "ledger-stream")
    ledger.write.parquet(src)
    stream = S.file_stream(spark, src, ledger.schema)
    t = Tables(spark, sf)
    source, target = t.orders.select("o_orderkey", "o_orderdate"), target_orders(t).select("o_orderkey", "o_orderdate")

    def process(batch):
        pending = B.pending_batches(batch).select("batch_id", "batch_start", "batch_end")
        # the span of the pending windows is pushed down to the scans
        span = pending.agg(F.min("batch_start").alias("lo"), F.max("batch_end").alias("hi")).first()
        in_span = (F.col("o_orderdate") >= F.lit(span["lo"])) & (F.col("o_orderdate") < F.lit(span["hi"]))
        cnt = []
        for name, side in (("source_count", source), ("target_count", target)):
            j = J.range_join(side.where(in_span), "o_orderdate", pending, "batch_start", "batch_end", bounds="[)")
            c = j.groupBy("batch_id").agg(F.count(F.lit(1)).alias(name))
            cnt.append(pending.select("batch_id").join(c, "batch_id", "left").fillna(0, [name]))
        both = cnt[0].join(cnt[1], "batch_id")
        return both.withColumn(
            "count_status", F.when(F.col("source_count") == F.col("target_count"), "MATCHED").otherwise("NOT MATCHED")
        )

    out = scratch_path(spark, "ledger-results")
    S.stream_process_batches(stream, process, out, scratch_path(spark, "ckpt-ledger"))
    return spark.read.parquet(out).select("batch_id", "source_count", "target_count", "count_status")


LATE_DELAY = "2 days"


@query(
    "stream_late_events",
    """WITH wm AS (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 2 DAY AS t FROM events WHERE event_id % 50 <> 0)
       SELECT strftime(time_bucket(INTERVAL '6 hours', ts, TIMESTAMP '1970-01-01'), '%Y-%m-%d %H:%M:%S') AS bucket,
              count(*) FILTER (NOT coalesce(event_id % 50 = 0 AND ts <= wm.t, false)) AS on_time,
              count(*) FILTER (coalesce(event_id % 50 = 0 AND ts <= wm.t, false)) AS late
       FROM events, wm GROUP BY 1""",
)
def stream_late_events(spark, sf):
    """Six-hour counts of events on time and late. Every fiftieth event comes in a
    second delivery, with repeats of every twentieth of the first; the second run
    starts from the checkpoint of the first."""
    e = Tables(spark, sf).events
    src, out, ckpt = (scratch_path(spark, n) for n in ("late-src", "late-on-time", "ckpt-late"))
    held_back = F.col("event_id") % 50 == 0
    for delivery in (e.where(~held_back), e.where(held_back | (F.col("event_id") % 20 == 0))):
        delivery.write.mode("append").parquet(src)
        on_time = S.on_time_events(S.file_stream(spark, src, e.schema), "event_id", "ts", LATE_DELAY, out, ckpt)
    late = S.late_events(spark.read.schema(e.schema).parquet(src), on_time, "event_id")
    both = on_time.select("ts", F.lit(1).alias("in_time")).unionByName(late.select("ts", F.lit(0).alias("in_time")))
    return both.groupBy(wall_text(R.bucket_start("ts", "6 hours")).alias("bucket")).agg(
        F.sum("in_time").alias("on_time"), F.sum(1 - F.col("in_time")).alias("late")
    )
