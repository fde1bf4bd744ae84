"""End-to-end document migration as ONE lazy plan and ONE write job:
read -> assemble -> derive -> validate -> write (accepted / rejected side by
side) -> ledger row. The ledger counts are read from the written
collection's partition column (file metadata), not from extra passes over
the source plan."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.operators.validate import validate


def migrate_documents(
    spark: SparkSession,
    docs: DataFrame,
    schema: Mapping,
    out_path: str,
    batch_id: str,
    derive: Mapping[str, Column] | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Validate and write one migration batch; returns the ledger row.

    ``derive`` columns are applied in order (each sees the previous ones).
    Rows are written once, partitioned by ``outcome`` (accepted / rejected,
    rejected rows keep their ``violations``), so the data is computed in a
    single job; the returned ledger row is a lazy aggregate over what was
    written.
    """
    for name, col in (derive or {}).items():
        docs = docs.withColumn(name, col)
    v = validate(docs, schema)
    ok = F.size("violations") == 0
    staged = v.withColumn("outcome", F.when(ok, "accepted").otherwise("rejected"))
    staged.write.mode("errorifexists").partitionBy("outcome").format(fmt).save(out_path)
    written = spark.read.format(fmt).load(out_path).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))
    per = written.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total"),
        F.coalesce(F.sum(F.when(F.col("outcome") == "accepted", F.col("n"))), F.lit(0)).cast("bigint").alias("accepted"),
    )
    return per.select(
        F.lit(batch_id).alias("batch_id"),
        "total",
        "accepted",
        (F.col("total") - F.col("accepted")).alias("rejected"),
        F.when(F.col("total") > 0, "DONE").otherwise("EMPTY").alias("status"),
    )
