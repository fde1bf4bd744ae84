"""Batching: global row numbers, row-count / id-range batches, batch ledger."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docflow.functions.exprs import short_id
from docflow.operators.intervals import from_number
from docflow.operators.selection import CELLS, range_number, select_keys

ROWS_PER_GROUP = 200_000


def global_row_number(df: DataFrame, order: list[str], n_partitions: int | None = None, name: str = "rn") -> DataFrame:
    """1-based row number over the whole frame in ``order`` (ascending, nulls first;
    the last column must make the order unique).

    The keys that cut the order into ``n_partitions`` groups (about ``ROWS_PER_GROUP`` rows
    each if left out, at most ``CELLS`` groups) are selected exactly by counting, without
    sorting or storing the rows. Rows find their group by search and are numbered
    inside it; a group's offset is known from the selection.
    """
    n = df.count()
    groups = n_partitions or min(CELLS, n // ROWS_PER_GROUP + 1)
    cuts = select_keys(df, order, [n * k // groups for k in range(1, groups)])
    if not cuts:  # one group, no larger than ROWS_PER_GROUP
        return df.withColumn(name, F.row_number().over(Window.orderBy(*order)).cast("long"))
    offsets = df.sparkSession.createDataFrame([(0, 0), *[(k + 1, below) for k, (_, below) in enumerate(cuts)]], "__g int, __off long")
    w = Window.partitionBy("__g").orderBy(*order)
    numbered = df.withColumn("__g", range_number(df, order, [c for c, _ in cuts])).withColumn("__rn", F.row_number().over(w))
    return numbered.join(F.broadcast(offsets), "__g").withColumn(name, F.col("__off") + F.col("__rn")).drop("__g", "__off", "__rn")


def number_batches(df: DataFrame, order: list[str], size: int, n_partitions: int | None = None) -> DataFrame:
    """``rn`` by global order and ``batch_no``: batch k holds ``(k-1)*size < rn <= k*size``."""
    numbered = global_row_number(df, order, n_partitions)
    return numbered.withColumn("batch_no", F.ceil(F.col("rn") / F.lit(size)).cast("bigint"))


def row_batches(
    df: DataFrame,
    order: list[str],
    size: int,
    ts: str,
    run_id: str = "run",
    create_date: Column | None = None,
    n_partitions: int | None = None,
) -> DataFrame:
    """Cut rows into batches of ``size`` by global order: batch k holds
    ``(k-1)*size < rn <= k*size`` (ceil; no empty trailing batch). Each row is
    stamped with batch id, the batch's min / max ``ts`` and a create date."""
    numbered = number_batches(df, order, size, n_partitions)
    stats = numbered.groupBy("batch_no").agg(
        F.min(ts).alias("batch_start_date"), F.max(ts).alias("batch_end_date"), F.count(F.lit(1)).alias("batch_size")
    )
    # one stats row per batch: Spark broadcasts it while it is small (AQE)
    return numbered.join(stats, "batch_no").withColumns(
        {
            "batch_id": short_id(F.lit(run_id), F.col("batch_no")),
            "batch_create_date": create_date if create_date is not None else F.current_timestamp(),
        }
    )


def id_range_batches(df: DataFrame, key: str, size: int) -> tuple[DataFrame, DataFrame]:
    """Id-range batches ``[start, start + size - 1]`` from the MIN/MAX of ``key``.

    Returns (rows with ``batch_no``, batch table with every range incl. empty
    ones). MIN and MAX are read once (two scalars); rows are assigned by
    arithmetic (no join, no shuffle), the batch table is a distributed range.
    """
    b = df.agg(F.min(key).alias("lo"), F.max(key).alias("hi")).first()
    lo, hi = (b["lo"], b["hi"]) if b["lo"] is not None else (0, -1)
    rows = df.withColumn("batch_no", F.floor((F.col(key) - F.lit(lo)) / F.lit(size)).cast("bigint"))
    table = df.sparkSession.range(-(-(hi - lo + 1) // size)).select(
        F.col("id").alias("batch_no"),
        (F.col("id") * size + lo).alias("start_id"),
        (F.col("id") * size + (lo + size - 1)).alias("end_id"),
    )
    return rows, table


def read_id_range(df: DataFrame, key: str, lo, hi) -> DataFrame:
    """``key BETWEEN lo AND hi`` slice (pushed to the scan)."""
    return df.filter(F.col(key).between(F.lit(lo), F.lit(hi)))


def batch_ledger(rows: DataFrame, batch: str, ts: str) -> DataFrame:
    """Ledger: one row per batch with size and from / to dates."""
    return rows.groupBy(batch).agg(
        F.count(F.lit(1)).alias("batch_size"), F.min(ts).alias("from_date"), F.max(ts).alias("to_date")
    )


def ledger_by_selection(df: DataFrame, order: list[str], size: int) -> DataFrame:
    """The ledger of ``number_batches`` (batch_no, batch_size, from_date, to_date by the
    first order column) from the keys at the batches' first and last ranks: rows
    are counted, never moved. Ledgers of more than ``CELLS`` / 2 batches number the rows."""
    n = df.count()
    batches = -(-n // size)
    if 2 * batches > CELLS:
        return batch_ledger(number_batches(df, order, size), "batch_no", order[0])
    ends = [(b + 1, b * size + 1, min((b + 1) * size, n)) for b in range(batches)]
    cuts = select_keys(df, order, sorted({r for _, lo, hi in ends for r in (lo, hi)}))
    counts = [below for _, below in cuts]
    rows = [(b, hi - lo + 1, *(cuts[bisect_left(counts, r)][0][0] for r in (lo, hi))) for b, lo, hi in ends]
    kind = dict(df.dtypes)[order[0]]
    ledger = df.sparkSession.createDataFrame(rows, "batch_no long, batch_size long, lo long, hi long")
    dates = [F.when(F.col(c) != F.lit(-(1 << 63)), from_number(F.col(c), kind)).alias(a) for c, a in (("lo", "from_date"), ("hi", "to_date"))]
    return ledger.select("batch_no", "batch_size", *dates)


def time_window_ledger(df: DataFrame, ts: str, unit: str = "month") -> DataFrame:
    """Contiguous ``[start, end)`` calendar windows covering the data."""
    if unit not in ("day", "month"):
        raise ValueError(f"unsupported window unit {unit!r}; use 'day' or 'month'")
    # calendar dates: no session time zone is involved
    first, last = (F.trunc(c, "month") if unit == "month" else c for c in (F.col("lo"), F.col("hi")))
    b = df.agg(F.min(ts).cast("date").alias("lo"), F.max(ts).cast("date").alias("hi"))
    step = F.expr(f"INTERVAL 1 {unit.upper()}")
    w = b.select(F.explode(F.sequence(first, last, step)).alias("day"))
    after = F.add_months("day", 1) if unit == "month" else F.date_add("day", 1)
    return w.select(
        F.date_format("day", "yyyyMM" if unit == "month" else "yyyyMMdd").alias("batch_id"),
        F.col("day").cast("timestamp_ntz").alias("batch_start"),
        after.cast("timestamp_ntz").alias("batch_end"),
    )


def pending_batches(ledger: DataFrame, done_col: str = "reconcile_dttm") -> DataFrame:
    return ledger.filter(F.col(done_col).isNull())


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """Union by column name of per-batch results (one plan)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), list(frames))


def batch_status(rows: DataFrame, batch: str, error_col: str) -> DataFrame:
    """Per-batch outcome: FAILED with the first error text when any row of the
    batch failed, else DONE. Failed batches are recorded, never dropped."""
    counts = rows.groupBy(batch).agg(F.count(F.lit(1)).alias("rows"), F.count(F.col(error_col)).alias("failed_rows"))
    # the error text is aggregated over the failed rows only (string buffers
    # cannot use the hash aggregate; the failed subset is small)
    errors = rows.where(F.col(error_col).isNotNull()).groupBy(batch).agg(F.min(error_col).alias("first_error"))
    agg = counts.join(errors, batch, "left")
    return agg.withColumn("status", F.when(F.col("failed_rows") > 0, "FAILED").otherwise("DONE"))
