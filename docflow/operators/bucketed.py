"""Tables stored in buckets of a join key, so that later joins need no shuffle.

Both sides are written with the same number of buckets, by the key and a salt, sorted
inside each bucket. The salt is 0 but for hot keys: keys of the many-rows side that hold
more rows than a bucket should. Their rows are dealt to ``SALTS`` salts when they are
written, and their rows of the other side are written once per salt. A join on key and
salt is then the join on the key.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.session import scratch_path

ROWS_PER_BUCKET = 1_000_000
MAX_BUCKETS = 8192
SALTS = 16
SALT = "bucket_salt"


@dataclass
class StoredPair:
    """Names of two stored tables; ``many`` holds every row once, ``one`` repeats the
    rows of hot keys per salt."""

    spark: SparkSession
    many: str
    one: str
    key: str

    def join(self, how: str = "inner") -> DataFrame:
        """Rows of ``many`` with those of ``one``; inner, left and semi joins keep their
        meaning (a row of ``many`` meets its key's rows under its own salt only)."""
        if how not in ("inner", "left", "left_semi", "left_anti"):
            raise ValueError(f"no {how!r} join of a stored pair: rows of hot keys are stored once per salt")
        return self.spark.table(self.many).join(self.spark.table(self.one), [self.key, SALT], how).drop(SALT)

    def drop(self) -> None:
        for name in (self.many, self.one):
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def _store(df: DataFrame, name: str, key: str, buckets: int) -> None:
    # dealt as the buckets are: one file per bucket
    dealt = df.repartition(buckets, key, SALT)
    dealt.write.bucketBy(buckets, key, SALT).sortBy(key, SALT).option("path", scratch_path(df.sparkSession, name)).format("parquet").saveAsTable(name)


def store_pair(many: DataFrame, one: DataFrame, key: str, buckets: int | None = None, hot_rows: int | None = None) -> StoredPair:
    """Store two tables for joins on ``key``. ``hot_rows``: a key with more rows in ``many``
    is salted (rows per bucket if left out; then fewer keys than buckets can be hot)."""
    spark = many.sparkSession
    n = many.count()
    buckets = buckets or max(1, min(MAX_BUCKETS, -(-n // ROWS_PER_BUCKET)))
    limit = max(1, n // buckets if hot_rows is None else hot_rows)
    counts = many.groupBy(F.col(key).alias("__hot")).agg(F.count(F.lit(1)).alias("__n")).where((F.col("__n") > limit) & F.col("__hot").isNotNull()).select("__hot")
    deal = F.pmod(F.xxhash64(*[F.col(c) for c, t in many.dtypes if "map<" not in t]), F.lit(SALTS)).cast("int")
    salted = many.join(counts, many[key] == F.col("__hot"), "left").withColumn(SALT, F.when(F.col("__hot").isNull(), 0).otherwise(deal)).drop("__hot")
    every = F.when(F.col("__hot").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    repeated = one.join(counts, one[key] == F.col("__hot"), "left").withColumn(SALT, F.explode(every)).drop("__hot")
    tag = uuid.uuid4().hex[:12]
    pair = StoredPair(spark, f"docflow_many_{tag}", f"docflow_one_{tag}", key)
    _store(salted, pair.many, key, buckets)
    _store(repeated, pair.one, key, buckets)
    return pair
