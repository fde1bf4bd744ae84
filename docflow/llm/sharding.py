"""Balanced label propagation of documents into shards (DataFrame functions only).

Links join documents of equal text, as a star: a document meets its group, never
every other member. Documents start dealt out round-robin in hash order, so
counts differ by at most one. In each round a linked document wants the shard
where most of its neighbours are (for a group larger than a shard: one of as
many shards as the group fills). Moves are exchanges under quotas: for each pair
of shards as many documents go one way as the other, those of the largest gain
first, and documents without links, or settled ones of a group with several
shards, make room. So counts never change, and cut links only fall.

Defined results: a null text counts as empty (size 16); null or repeated ids are
rows like any other. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docflow.llm.common import docs_of, query, written

BLOCK = 100_000  # rows numbered in one task; the number of blocks follows the table
ROUNDS = 12
FILL = 0.9  # share of a shard that one group may be given


def number_rows(rows: DataFrame, hash_col: str, order: list[str], n: int) -> DataFrame:
    """``pos``: gapless numbers from 0 in hash order, counted by block."""
    blocks = max(1, -(-n // BLOCK))
    rows = rows.withColumn("__b", F.pmod(F.col(hash_col), F.lit(blocks)))
    before = Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    # one row per block: the block sizes are what a single task adds up
    starts = rows.groupBy("__b").count().select("__b", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__s"))
    local = F.row_number().over(Window.partitionBy("__b").orderBy(hash_col, *order)) - 1
    return rows.withColumn("__r", local).join(starts, "__b").withColumn("pos", F.col("__s") + F.col("__r")).drop("__b", "__s", "__r")


def propagate(state: DataFrame, shards: int, n: int, rounds: int = ROUNDS) -> DataFrame:
    """Move the rows of ``state`` (pos, g, linked, shard, ...) towards their groups."""
    capacity = n / shards
    salts = max(1, n // (BLOCK * shards))
    columns = state.columns
    for r in range(rounds):
        here = state.where("linked").groupBy("g", "shard").count()
        targets = here.groupBy("g").agg(
            F.sum("count").alias("members"),
            F.array_sort(F.collect_list(F.struct((-F.col("count")).alias("less"), "shard"))).alias("by_size"),
        )
        wide = F.greatest(F.lit(1), F.ceil(F.col("members") / F.lit(FILL * capacity)).cast("int"))
        targets = targets.select("g", F.slice("by_size", F.lit(1), F.least(wide, F.lit(shards))).alias("aims"))
        aims = F.col("aims")
        aim = F.element_at(aims, (F.pmod(F.col("pos") + r, F.size(aims)) + 1).cast("int"))
        settled = F.exists(aims, lambda a: a["shard"] == F.col("shard"))
        # not yet settled: a wish to move; settled in a group of several shards: room for another
        linked = (
            state.where("linked")
            .join(targets, "g")
            .select("pos", F.col("shard").alias("src"), aim["shard"].alias("dst"), (-aim["less"]).alias("gain"), (~settled).alias("wants"))
            .where("src <> dst")
            .withColumn("gain", F.when(F.col("wants"), F.col("gain")).otherwise(0))
        )
        step = F.pmod(F.xxhash64("pos", F.lit(r)), F.lit(shards - 1)) + 1
        room = state.where(~F.col("linked")).select(
            "pos", F.col("shard").alias("src"), F.pmod(F.col("shard") + step, F.lit(shards)).cast("int").alias("dst"),
            F.lit(0).cast("long").alias("gain"), F.lit(False).alias("wants"),
        )
        lane = ["src", "dst", "salt"]
        offers = linked.unionByName(room).withColumn("salt", F.pmod(F.xxhash64("pos"), F.lit(salts)))
        ranked = offers.withColumn("rank", F.row_number().over(Window.partitionBy(*lane, "wants").orderBy(F.desc("gain"), "pos")))
        sums = offers.groupBy(*lane).agg(
            F.count(F.when(F.col("wants"), 1)).alias("w"), F.count(F.when(~F.col("wants"), 1)).alias("f")
        )
        back = sums.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "salt", F.col("w").alias("w2"), F.col("f").alias("f2"))
        quota = sums.join(back, lane, "left").select(
            *lane,
            F.least("w", F.coalesce("w2", F.lit(0)) + F.coalesce("f2", F.lit(0))).alias("q_wants"),
            F.least("f", F.greatest(F.coalesce("w2", F.lit(0)) - F.col("w"), F.lit(0))).alias("q_room"),
        )
        moved = written(
            ranked.join(quota, lane).where(F.col("rank") <= F.when(F.col("wants"), F.col("q_wants")).otherwise(F.col("q_room"))).select("pos", "dst"),
            "shard-moves",
        )
        if moved.isEmpty():
            break
        state = written(
            state.join(moved, "pos", "left").withColumn("shard", F.coalesce("dst", "shard")).select(*columns), "shard-state"
        )
    return state


def balanced_shards(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, size, text_crc32, shard, slot: row counts of shards at most one apart,
    equal texts together as far as the quotas allow."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("crc"),
        F.unhex(F.sha2(text, 256)).alias("g"),
    ).withColumn("h", F.xxhash64("id", "g"))
    rows = written(rows, "shard-rows")
    n = rows.count()
    groups = rows.groupBy("g").count().where("count > 1").select("g", F.lit(True).alias("__l"))
    start = (
        number_rows(rows, "h", ["id", "size"], n)
        .join(groups, "g", "left")
        .select("pos", "id", "size", "crc", "g", F.coalesce("__l", F.lit(False)).alias("linked"),
                F.pmod("pos", F.lit(shards)).cast("int").alias("shard"))
    )
    done = propagate(written(start, "shard-state"), shards, n)
    block = F.floor(F.col("pos") / F.lit(BLOCK)).cast("long")
    done = done.withColumn("__b", block)
    before = Window.partitionBy("shard").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    starts = done.groupBy("shard", "__b").count().select("shard", "__b", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__s"))
    local = F.row_number().over(Window.partitionBy("shard", "__b").orderBy("pos")) - 1
    return (
        done.withColumn("__r", local)
        .join(starts, ["shard", "__b"])
        .select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "shard", (F.col("__s") + F.col("__r")).alias("slot"))
    )


@query("op6_sharding")
def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract columns for every row of documents, 40 shards, law ``rows``."""
    out = balanced_shards(docs_of(spark, sf_dir, "doc_id", "text"), 40)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
