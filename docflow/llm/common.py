"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.session import scratch_path
from docflow.sources.tables import table

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

# Bits of a pre-filter bitmap: 2 MiB whatever the table's size. A larger table
# only lets more rows through; the exact join that follows decides.
BITMAP_BITS = 1 << 24
_BITMAP_PAGE = 32_768

# Bytes of texts that go to a Python worker at once: a batch is held several times,
# by the executor and by the worker
BATCH_BYTES = 2 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
_CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def query(key: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    """Register a query of this subpackage, with its DuckDB SQL where there is one."""

    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql.strip()
        return fn

    return deco


def docs_of(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    """The documents table with the given columns only."""
    return table(spark, sf_dir, "documents").select(*cols)


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of ``BATCH_BYTES`` for the rest of the session, unless its own
    limit is lower."""
    own = spark.conf.get(_BATCH_CONF, None)
    if own is None or not own.isdigit() or int(own) > BATCH_BYTES:
        spark.conf.set(_BATCH_CONF, str(BATCH_BYTES))


@contextmanager
def without_shuffles(spark: SparkSession) -> Iterator[None]:
    """Jobs in this block remove their shuffle files when they end. Otherwise those of
    all written tables stay until the driver happens to collect its garbage."""
    own = spark.conf.get(_CLEANUP_CONF)
    spark.conf.set(_CLEANUP_CONF, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP_CONF, own)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a table in the shared checkpoint folder and read it back:
    cuts the lineage, and survives the loss of executors."""
    bounded_batches(df.sparkSession)
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bitmap_of(ids: DataFrame, column: str) -> np.ndarray:
    """Bitmap of ``BITMAP_BITS`` bits with the low bits of each value of a long
    column set (bit i of byte j stands for residue 8 * j + i). At most 512 rows
    of 4 KiB reach the driver, whatever the size of ``ids``."""
    pos = F.pmod(F.col(column), F.lit(BITMAP_BITS))
    pages = (
        ids.where(F.col(column).isNotNull())
        .select(pos.alias("p"))
        .groupBy(F.floor(F.col("p") / _BITMAP_PAGE).cast("long").alias("page"))
        .agg(F.bitmap_construct_agg((F.col("p") % _BITMAP_PAGE)).alias("bits"))
    )
    out = np.zeros(BITMAP_BITS // 8, dtype=np.uint8)
    step = _BITMAP_PAGE // 8
    for page, bits in pages.collect():
        out[page * step : (page + 1) * step] = np.frombuffer(bytes(bits), dtype=np.uint8)
    return out


def in_bitmap(bitmap: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which of the 64-bit values have their bit set."""
    pos = values.astype(np.int64).astype(np.uint64) & np.uint64(BITMAP_BITS - 1)
    return (bitmap[(pos >> np.uint64(3)).astype(np.int64)] >> (pos & np.uint64(7)).astype(np.uint8)) & 1 == 1


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit mixing (shifts and odd multipliers)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


@cache
def odd_keys(n: int, seed: int) -> np.ndarray:
    """``n`` fixed odd 64-bit multipliers drawn from ``seed``; not to be written to."""
    return np.random.default_rng(seed).integers(1, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def window_hashes(tokens: np.ndarray, width: int, seed: int = 7) -> np.ndarray:
    """Hashes of the windows of ``width`` consecutive 64-bit token hashes."""
    n = len(tokens) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    keys = odd_keys(width, seed)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        out += tokens[k : k + n] * keys[k]
    return mix64(out)
