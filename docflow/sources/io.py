"""Sources and sinks: JDBC specs, document collections, text folders, CSV /
JSON writers. Readers return lazy DataFrames; writers run executor-side (no
collect, no per-row inserts)."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docflow.functions.exprs import between_bounds

# ----------------------------------------------------------------------- JDBC


@dataclass(frozen=True)
class JdbcSpec:
    """Connection options supplied by the caller (never hard-coded credentials)."""

    url: str
    options: Mapping[str, str] = field(default_factory=dict)  # user, password, driver, fetchsize, ...

    def reader(self, spark: SparkSession):
        r = spark.read.format("jdbc").option("url", self.url)
        for k, v in self.options.items():
            r = r.option(k, v)
        return r


def read_jdbc_table(spark: SparkSession, spec: JdbcSpec, table: str, fetchsize: int = 10_000) -> DataFrame:
    """Whole table; filters / projections applied later are pushed to the source."""
    return spec.reader(spark).option("dbtable", table).option("fetchsize", str(fetchsize)).load()


def read_jdbc_query(spark: SparkSession, spec: JdbcSpec, sql: str, fetchsize: int = 10_000) -> DataFrame:
    """A sub-query as the table: only the rows / columns it selects leave the source."""
    return spec.reader(spark).option("query", sql).option("fetchsize", str(fetchsize)).load()


def read_jdbc_partitioned(
    spark: SparkSession,
    spec: JdbcSpec,
    table_or_subquery: str,
    column: str,
    lower: int,
    upper: int,
    num_partitions: int,
    fetchsize: int = 10_000,
) -> DataFrame:
    """Parallel range read (``num_partitions`` concurrent connections).

    ``table_or_subquery`` is a table name or an aliased sub-query
    ``(SELECT ...) t`` (the ``query`` option cannot be combined with
    ``partitionColumn``). Bounds only shape the partitions; rows outside them
    are still read (by the first / last partition).
    """
    return (
        spec.reader(spark)
        .option("dbtable", table_or_subquery)
        .option("partitionColumn", column)
        .option("lowerBound", str(lower))
        .option("upperBound", str(upper))
        .option("numPartitions", str(num_partitions))
        .option("fetchsize", str(fetchsize))
        .load()
    )


def read_jdbc_partitioned_auto(
    spark: SparkSession, spec: JdbcSpec, table: str, column: str, num_partitions: int, fetchsize: int = 10_000
) -> DataFrame:
    """Partitioned read whose bounds come from a MIN/MAX probe executed by the
    database itself (the aggregate sub-query returns one row)."""
    probe = read_jdbc_query(spark, spec, f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}").first()
    lo, hi = probe[0], probe[1]  # positional: databases may change the alias case
    if lo is None:
        return read_jdbc_table(spark, spec, table, fetchsize)
    return read_jdbc_partitioned(spark, spec, table, column, int(lo), int(hi) + 1, num_partitions, fetchsize)


def write_jdbc(df: DataFrame, spec: JdbcSpec, table: str, mode: str = "append", batchsize: int = 10_000) -> None:
    w = df.write.format("jdbc").option("url", spec.url).option("dbtable", table).option("batchsize", str(batchsize))
    for k, v in spec.options.items():
        w = w.option(k, v)
    w.mode(mode).save()


# ------------------------------------------------------------------ documents


@dataclass(frozen=True)
class DocumentSpec:
    """A document collection: format ('parquet', 'json', or a connector such as
    'mongodb' when its jar is on the cluster) + path / options."""

    format: str
    path: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)


def read_documents(spark: SparkSession, spec: DocumentSpec, schema: T.StructType | str | None = None) -> DataFrame:
    r = spark.read.format(spec.format).options(**dict(spec.options))
    if schema is not None:
        r = r.schema(schema)
    return r.load(spec.path) if spec.path else r.load()


def write_documents(df: DataFrame, spec: DocumentSpec, mode: str = "append", partition_by: list[str] | None = None) -> None:
    """Nested rows written by the executors. JSON omits NULL fields (a field
    that is NULL is absent from the document)."""
    w = df.write.format(spec.format).options(**dict(spec.options)).mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(spec.path) if spec.path else w.save()


def read_window(df: DataFrame, ts: str, start, end, bounds: str = "[)") -> DataFrame:
    """Time-window extraction with explicit bounds (typed literals -> pushed down)."""
    lo = F.lit(start).cast("timestamp_ntz") if isinstance(start, str) else start
    hi = F.lit(end).cast("timestamp_ntz") if isinstance(end, str) else end
    return df.filter(between_bounds(ts, lo, hi, bounds))


def read_text_folder(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """One row per file: (file_path, text). ``glob`` filters file names (e.g. '*.txt')."""
    r = spark.read
    if glob:
        r = r.option("pathGlobFilter", glob)
    df = r.text(path, wholetext=True)
    return df.select(F.col("_metadata.file_path").alias("file_path"), F.col("value").alias("text"), *[
        c for c in df.columns if c != "value"
    ])


def object_listing(spark: SparkSession, path: str, glob: str | None = None, server: int = 0) -> DataFrame:
    """(guid, server, length) for stored objects under ``path``: the file name
    without extension is the guid. Only metadata is read (the ``binaryFile``
    source skips file contents when ``content`` is not selected). Zero-length
    files produce no split and are absent from the listing — retrieval
    validation treats absent and empty objects alike (FAILURE)."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    files = r.load(path).select("path", "length")
    name = F.regexp_extract("path", r"([^/]+?)(\.[^./]*)?$", 1)
    return files.select(name.alias("guid"), F.lit(server).alias("server"), F.col("length").cast("bigint").alias("length"))


# --------------------------------------------------------------------- sinks


def cluster_for_partitioned_write(df: DataFrame, by: list[str]) -> DataFrame:
    """Bring the rows of an output partition together, so that not every task
    writes a small file for every value. AQE sizes the tasks from the data: it
    splits a hot value (one holding a third of all rows) and joins small ones."""
    return df.hint("rebalance", *[F.col(c) for c in by])


def write_csv(df: DataFrame, path: str, sep: str = ",", header: bool = True, mode: str = "overwrite",
              partition_by: list[str] | None = None) -> None:
    w = df.write.option("sep", sep).option("header", str(header).lower()).mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, sep: str = ",", header: bool = True) -> DataFrame:
    return spark.read.schema(schema).option("sep", sep).option("header", str(header).lower()).csv(path)


def to_json_records(df: DataFrame, cols: list[str | Column] | None = None, keep: list[str] | None = None) -> DataFrame:
    """One JSON object per row (NULL fields omitted); ``keep`` columns stay alongside."""
    cols = cols or [F.col(c) for c in df.columns]
    return df.select(*(keep or []), F.to_json(F.struct(*cols)).alias("json"))
