"""Schema discovery of a collection of JSON documents: the kinds of value found at
every path with their counts, the paths whose kinds conflict, and a read with the
types that the collection itself shows.

Every document is read; nothing is sampled. Only one schema text reaches the driver.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.session import scratch_path

# Kinds that one numeric type can hold.
_NUMBERS = ("BIGINT", "DECIMAL", "DOUBLE")
_PLAIN_KEY = r"^[A-Za-z_][A-Za-z0-9_]*$"


def _kind(value: Column) -> Column:
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)


def _child_path(path: Column, key: Column) -> Column:
    """``a.b`` for plain keys, ``a['b c']`` for others, ``a[]`` for array items."""
    quoted = F.concat(path, F.lit("['"), F.replace(key, F.lit("'"), F.lit("\\'")), F.lit("']"))
    plain = F.concat_ws(".", F.nullif(path, F.lit("$")), key)
    return F.when(key.isNull(), F.concat(path, F.lit("[]"))).when(key.rlike(_PLAIN_KEY), plain).otherwise(quoted)


def _children(spark: SparkSession, level: DataFrame) -> DataFrame:
    """(path, value) of the fields and items of the objects and arrays of a level."""
    inside = level.where(_kind("value").isin("OBJECT", "ARRAY")).withColumnRenamed("value", "parent")
    parts = spark.tvf.variant_explode(F.col("parent").outer())
    return inside.lateralJoin(parts).select(_child_path(F.col("path"), F.col("key")).alias("path"), "value")


def value_kinds(df: DataFrame, json_col: str) -> DataFrame:
    """(path, kind, n): how many values of each kind stand at each path.

    The document is ``$``; a text that is no JSON counts there as ``INVALID``, a NULL
    text not at all. JSON null is the kind ``VOID``. One pass per level of nesting,
    each counts map-side and shuffles one row per task, path and kind; a level is
    opened only if the one above holds objects or arrays."""
    spark = df.sparkSession
    texts = df.where(F.col(json_col).isNotNull())
    level = texts.select(F.lit("$").alias("path"), F.try_parse_json(json_col).alias("value"))
    found = []
    while True:
        kind = F.coalesce(_kind("value"), F.lit("INVALID")).alias("kind")
        path = scratch_path(spark, "value-kinds")
        level.groupBy("path", kind).agg(F.count(F.lit(1)).alias("n")).write.parquet(path)
        found.append(spark.read.schema("path string, kind string, n long").parquet(path))
        if found[-1].where(F.col("kind").isin("OBJECT", "ARRAY")).isEmpty():
            return reduce(DataFrame.unionByName, found)
        level = _children(spark, level)


def kind_conflicts(kinds: DataFrame) -> DataFrame:
    """(path, kinds, n, n_minority) of the paths whose values are of kinds that no one
    type holds: ``kinds`` sorted, ``n`` values that are not null, ``n_minority`` those
    that are not of the most frequent kind. Kinds of numbers count as one."""
    real = kinds.where(~F.col("kind").isin("VOID", "INVALID"))
    family = F.when(F.col("kind").isin(*_NUMBERS), "NUMBER").otherwise(F.col("kind"))
    per_kind = real.groupBy("path", family.alias("kind")).agg(F.sum("n").alias("n"))
    out = per_kind.groupBy("path").agg(
        F.sort_array(F.collect_list("kind")).alias("kinds"), F.sum("n").alias("n"), (F.sum("n") - F.max("n")).alias("n_minority")
    )
    return out.where(F.size("kinds") > 1)


def discovered_type(df: DataFrame, json_col: str) -> str:
    """The type that holds every document, as DDL: the union of all fields, numbers
    widened, ``VARIANT`` where kinds conflict, text where only null was seen."""
    agg = F.schema_of_variant_agg(F.try_parse_json(json_col))
    found = df.where(F.col(json_col).isNotNull()).agg(agg.alias("t")).first()["t"]
    names = {"OBJECT<": "STRUCT<", "VOID": "STRING"}
    # quoted field names stay as they are, and so do plain ones, which a colon ends
    return re.sub(r"`(?:[^`]|``)*`|OBJECT<(?!>)|OBJECT<>|VOID(?!:)", lambda m: "VARIANT" if m[0] == "OBJECT<>" else names.get(m[0], m[0]), found or "VOID")


def read_discovered(df: DataFrame, json_col: str, out: str = "doc") -> DataFrame:
    """``df`` with the documents of ``json_col`` as ``out``, typed by what the whole
    collection holds. Texts that are no JSON and NULL texts give NULL; a field that a
    document lacks is NULL; values at conflicting paths stay variants, so none is lost."""
    return df.withColumn(out, F.try_variant_get(F.try_parse_json(json_col), "$", discovered_type(df, json_col)))
