"""Profiling and catalogue aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docflow.session import scratch_path


def _as_text(df: DataFrame, path: str) -> Column:
    """The value at a dotted path as text; arrays and structs as JSON."""
    kind = df.select(path).schema[0].dataType
    if isinstance(kind, (T.ArrayType, T.StructType)):
        return F.to_json(F.col(path), {"ignoreNullFields": "false"})
    return F.col(path).cast("string")


def field_value_profile(sources: Sequence[tuple[DataFrame, str, Sequence[str]]]) -> DataFrame:
    """Long (field, value, n) frequency table of many fields in ONE scan per source.

    Each row is unpivoted to (field, value) pairs with ``inline`` and counted
    with a partial aggregate, so a field with few values ships few rows per
    task. NULL is a value of its own. Sort by ``n`` desc within field to read.
    A field may be a dotted path; through an array of structs it gives the
    array of the values, counted by its JSON text (NULL elements kept).
    """
    parts = []
    for df, prefix, fields in sources:
        pairs = F.array(*[F.struct(F.lit(f"{prefix}.{f}").alias("field"), _as_text(df, f).alias("value")) for f in fields])
        parts.append(df.select(F.inline(pairs)))
    allp = reduce(lambda a, b: a.unionByName(b), parts)
    return allp.groupBy("field", "value").agg(F.count(F.lit(1)).alias("n"))


def profile_report(profile: DataFrame, top: int | None = None) -> DataFrame:
    """Presentation: rank values by count within each field (optionally the
    ``top`` most frequent per field — a map-side limited window)."""
    ranked = profile.withColumn("rank", F.row_number().over(Window.partitionBy("field").orderBy(F.desc("n"), "value")))
    return ranked.where(F.col("rank") <= top) if top else ranked


def collection_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Document count per collection as one union of per-table counts."""
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("collection"), "n") for name, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def run_named_queries(spark: SparkSession, views: Mapping[str, DataFrame], catalog: Mapping[str, str]) -> DataFrame:
    """Run each named SQL of a catalogue over temp views; union tagged results."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    parts = [spark.sql(sql).withColumn("name", F.lit(name)) for name, sql in catalog.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


CELLS = 65_536  # counters per field, whatever the number of its values


def _field_values(df: DataFrame, fields: Sequence[str], cells: int) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), _as_text(df, f).alias("value")) for f in fields])
    return df.select(F.inline(pairs)).withColumn("cell", F.pmod(F.xxhash64("value"), F.lit(cells)))


def _top_values(counted: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("field").orderBy(F.desc("n"), F.asc_nulls_first("value"))
    return counted.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def open_cells(values: DataFrame, per_cell: DataFrame, top: int) -> DataFrame:
    """(field, cell) of the cells that can hold one of the ``top`` values of a field.

    No value is more frequent than its cell. The values of the ``4 * top`` fullest
    cells are counted exactly; the count of the ``top``-th of them is reached by the
    true one, so cells below it are out. With fewer values found, all stay."""
    fullest = Window.partitionBy("field").orderBy(F.desc("n"), "cell")
    first = per_cell.withColumn("r", F.row_number().over(fullest)).where(F.col("r") <= 4 * top).select("field", "cell")
    counted = values.join(F.broadcast(first), ["field", "cell"], "left_semi").groupBy("field", "value").agg(F.count(F.lit(1)).alias("n"))
    least = _top_values(counted, top).groupBy("field").agg(F.when(F.count(F.lit(1)) == top, F.min("n")).otherwise(1).alias("least"))
    return per_cell.join(F.broadcast(least), "field").where(F.col("n") >= F.col("least")).select("field", "cell")


def heavy_values(df: DataFrame, fields: Sequence[str], top: int, cells: int = CELLS) -> DataFrame:
    """(field, value, n, rank): the ``top`` most frequent values of each field with
    their exact counts, as ``profile_report(field_value_profile(...), top)`` gives them
    (NULL is a value; equal counts by value, NULL first), for fields of many values.

    The first pass counts ``cells`` hash cells a field, so a task ships at most that many
    rows a field however many values there are; later passes group only the values of
    cells that can hold a result. Where counts are uneven these are few; where all
    values are about as frequent, nearly all are counted, as any exact method must.
    The broadcast sides hold at most ``cells`` rows a field."""
    values = _field_values(df, fields, cells)
    path = scratch_path(df.sparkSession, "value-cells")
    values.groupBy("field", "cell").agg(F.count(F.lit(1)).alias("n")).write.parquet(path)
    per_cell = df.sparkSession.read.schema("field string, cell long, n long").parquet(path)
    kept = values.join(F.broadcast(open_cells(values, per_cell, top)), ["field", "cell"], "left_semi")
    return _top_values(kept.groupBy("field", "value").agg(F.count(F.lit(1)).alias("n")), top)
