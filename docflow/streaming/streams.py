"""Structured Streaming operators: file sources, windowed counts with a
watermark, keyed upserts, ledger polling.

Incremental state lives in Spark's state store (streaming aggregation in
``update`` mode). Each micro-batch hands only the changed keys to a
``foreachBatch`` sink, which merges them into the keyed table and writes the
next version of it; a replayed micro-batch writes its own version again.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.operators.upsert import upsert


def stage_files(df: DataFrame, ts: str, path: str) -> str:
    """Write ``df`` as the files of a stream. Returns a watermark delay (the time
    that the data span) under which no row is late, in whatever order files come."""
    df.write.parquet(path)
    b = df.agg(F.min(ts).alias("lo"), F.max(ts).alias("hi")).first()
    hours = 1 if b["lo"] is None else math.ceil((b["hi"] - b["lo"]).total_seconds() / 3600) + 1
    return f"{hours} hours"


def upsert_stream(agg: DataFrame, keys: list[str], path: str, checkpoint: str) -> DataFrame:
    """Drain a streaming aggregate in update mode into a keyed table, kept as
    ``<path>/v<micro-batch>``; returns the last version. Each version is the one
    before with the changed keys updated or inserted, so a replay is idempotent."""
    spark, last = agg.sparkSession, []

    def handle(changed: DataFrame, batch: int) -> None:
        new = changed if batch == 0 else upsert(spark.read.parquet(f"{path}/v{batch - 1}"), changed, keys)
        new.write.mode("overwrite").parquet(f"{path}/v{batch}")
        last[:] = [batch]

    run_available_now(agg, handle, checkpoint, output_mode="update")
    return spark.read.parquet(f"{path}/v{last[0]}") if last else spark.createDataFrame([], agg.schema)


def start_stream(stream: DataFrame, handler: Callable[[DataFrame, int], None], checkpoint: str,
                 output_mode: str = "append", every: str | None = None):
    """Start a ``foreachBatch`` query: ``every=None`` drains what is available
    and stops (``availableNow``); ``every='5 minutes'`` keeps polling for new
    input at that interval (the caller owns the returned query)."""
    w = stream.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint).foreachBatch(handler)
    w = w.trigger(availableNow=True) if every is None else w.trigger(processingTime=every)
    return w.start()


def run_available_now(stream: DataFrame, handler: Callable[[DataFrame, int], None], checkpoint: str,
                      output_mode: str = "append") -> None:
    """Drain all available input in micro-batches, then stop."""
    q = start_stream(stream, handler, checkpoint, output_mode)
    q.awaitTermination()
    if q.exception() is not None:  # pragma: no cover - surfaced to caller
        raise RuntimeError(str(q.exception()))


def file_stream(spark: SparkSession, path: str, schema, max_files: int | None = None) -> DataFrame:
    """Files as they arrive; all that are there form one micro-batch unless ``max_files`` limits it."""
    r = spark.readStream.schema(schema)
    return (r if max_files is None else r.option("maxFilesPerTrigger", str(max_files))).parquet(path)


_EPOCH_NTZ = "1970-01-01 00:00:00"


def wall_clock_instant(ts: str) -> "F.Column":
    """A zone-free timestamp as an event-time instant whose epoch offset equals
    the wall clock (so windows align to wall-clock boundaries in any session
    time zone)."""
    t = F.col(ts)
    days = F.datediff(t.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    # seconds with their fraction as decimals: exact to the microsecond
    seconds = days * 86_400 + F.hour(t) * 3600 + F.minute(t) * 60
    return F.timestamp_micros(seconds * 1_000_000 + (F.extract(F.lit("SECOND"), t) * 1_000_000).cast("bigint"))


def instant_to_wall_clock(c) -> "F.Column":
    """Inverse of ``wall_clock_instant``: back to a zone-free timestamp."""
    seconds = F.unix_micros(c).cast("decimal(20, 0)") / F.lit(1_000_000).cast("decimal(7, 0)")
    return F.lit(_EPOCH_NTZ).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18, 6)"))


def windowed_counts(stream: DataFrame, ts: str, window: str, delay: str, key: str | None = None) -> DataFrame:
    """Tumbling-window counts with a watermark (state for closed windows is
    dropped). Zone-free event times are mapped to instants without using the
    session time zone; ``bucket`` comes back as a zone-free timestamp."""
    is_ntz = dict(stream.dtypes).get(ts) == "timestamp_ntz"
    et = wall_clock_instant(ts) if is_ntz else F.col(ts)
    s = stream.withColumn("__event_time", et).withWatermark("__event_time", delay)
    keys = [F.window("__event_time", window).start.alias("__start")] + ([F.col(key)] if key else [])
    agg = s.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    bucket = instant_to_wall_clock(F.col("__start")) if is_ntz else F.col("__start")
    return agg.select(bucket.alias("bucket"), *([key] if key else []), "n")


def latest_per_key(stream: DataFrame, key: str, ts: str, value: str) -> DataFrame:
    """Streaming aggregate: per key the latest ``value`` (by ``ts``), its time
    and the running count — kept in the state store, emitted when changed."""
    return stream.groupBy(key).agg(
        F.max_by(F.col(value), F.struct(ts, value)).alias("last_value"),
        F.max(ts).alias("last_ts"),
        F.count(F.lit(1)).alias("n"),
    )


def stream_process_batches(stream: DataFrame, process: Callable[[DataFrame], DataFrame], out_path: str,
                           checkpoint: str) -> None:
    """Poll a ledger stream: each micro-batch of ledger rows is processed as a
    set (``process``) and its results are written to ``out_path/epoch=<id>``
    (overwrite of its own epoch -> idempotent)."""

    def handle(batch: DataFrame, epoch: int) -> None:
        process(batch).write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/epoch={epoch}")

    run_available_now(stream, handle, checkpoint)


def on_time_events(stream: DataFrame, id_col: str, ts: str, delay: str, path: str, checkpoint: str) -> DataFrame:
    """Drain a stream of events into ``<path>/__epoch=<micro-batch>``: each event once,
    and only if it is no more than ``delay`` behind the latest event time of the
    micro-batches before its own. Repeats are dropped by the state store, which holds
    an id until the watermark has passed its time by ``delay``. A micro-batch that is
    replayed overwrites its own folder; a later call with the same checkpoint goes on
    with the files that came since. Returns all on-time events so far.

    Events without an id or time cannot be judged and never pass."""
    spark, schema = stream.sparkSession, stream.schema
    et = wall_clock_instant(ts) if dict(stream.dtypes)[ts] == "timestamp_ntz" else F.col(ts)
    known = stream.where(F.col(id_col).isNotNull() & F.col(ts).isNotNull()).withColumn("__event_time", et)
    once = known.withWatermark("__event_time", delay).dropDuplicatesWithinWatermark([id_col])

    def handle(batch: DataFrame, epoch: int) -> None:
        batch.drop("__event_time").write.mode("overwrite").parquet(f"{path}/__epoch={epoch}")

    # a folder to read from where no event ever came
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{path}/__epoch=-1")
    run_available_now(once, handle, checkpoint)
    return spark.read.schema(schema).parquet(path).drop("__epoch")


def late_events(delivered: DataFrame, on_time: DataFrame, id_col: str) -> DataFrame:
    """The delivered events that are not on time, repeats once: those that came behind
    the watermark, and every row without an id. With ``on_time_events`` each delivered
    id is in exactly one of both tables."""
    missed = delivered.join(on_time.select(id_col), id_col, "left_anti")
    with_id = missed.where(F.col(id_col).isNotNull()).dropDuplicates([id_col])
    return with_id.unionByName(missed.where(F.col(id_col).isNull()))
