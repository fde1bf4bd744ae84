"""Differences between two tables by a tree of range digests.

Every row falls into a node by the leading bits of a hash of its key. A level adds up, per
node and side, the number of rows and two independent 64-bit hashes of their
values (sums, so the order of the rows doesn't matter and repeated rows count). Only nodes
whose digests differ are cut into their ``FAN_OUT`` children on the next level; rows are
shuffled and compared one by one only below nodes that still differ when they are
expected to hold no more than ``LEAF_ROWS`` rows. Equal tables shuffle digests only; a few
differences shuffle the rows of a few leaves.

Different tables have equal digests in a node with a probability of about 2^-128. Each
level reads the key and value columns of both sides once; the nodes to open reach the scans
as a broadcast while they are at most ``MAX_OPEN``. If more differ, the tables have so
little in common that the full comparison is the shorter way, and the remaining nodes
are compared row by row at once, which gives the same rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.operators.recon import row_fingerprint

FAN_OUT_BITS = 12
LEAF_ROWS = 64
MAX_OPEN = 65_536
_HALF = (1 << 32) - 1


def _side(df: DataFrame, key: str, columns: list[str], types: list[str]) -> DataFrame:
    """(__k, __h, __a, __b): the key, its hash and two hashes of the row's values, all
    as the given types (equal values of different types hash differently)."""
    k, *values = [F.col(c).cast(t) for c, t in zip([key, *columns], types, strict=True)]
    values = [k, *values]
    return df.select(
        k.alias("__k"),
        F.xxhash64(F.lit("key"), k).alias("__h"),
        row_fingerprint([F.lit("first"), *values]).alias("__a"),
        row_fingerprint([*values, F.lit("second")]).alias("__b"),
    )


def _node(bits: int) -> Column:
    return F.shiftrightunsigned("__h", 64 - bits)


def _sums() -> list[Column]:
    """Order-free digest; halves, so that sums stay within a long for 2^31 rows a node."""
    out = [F.count(F.lit(1)).alias("n")]
    for c in ("__a", "__b"):
        out.append(F.sum(F.col(c).bitwiseAND(F.lit(_HALF))).alias(f"lo{c}"))
        out.append(F.sum(F.shiftrightunsigned(c, 32)).alias(f"hi{c}"))
    return out


def differing_nodes(source: DataFrame, target: DataFrame, bits: int) -> DataFrame:
    """(node, rows): nodes of a level whose digests differ between the sides."""
    s, t = (df.groupBy(_node(bits).alias("node")).agg(*_sums()) for df in (source, target))
    names = [c for c in s.columns if c != "node"]
    j = s.select("node", F.struct(*names).alias("s")).join(t.select("node", F.struct(*names).alias("t")), "node", "full_outer")
    rows = F.greatest(F.coalesce("s.n", F.lit(0)), F.coalesce("t.n", F.lit(0)))
    return j.where(~F.col("s").eqNullSafe(F.col("t"))).select("node", rows.alias("rows"))


def suspects(source: DataFrame, target: DataFrame, leaf_rows: int = LEAF_ROWS, max_open: int = MAX_OPEN) -> tuple[DataFrame, DataFrame, list[tuple[int, int]]]:
    """The rows of both sides (as ``_side`` gives them) in leaves that differ, and
    (bits, differing nodes) of each level."""
    spark, bits, levels = source.sparkSession, 0, []
    while True:
        bits += FAN_OUT_BITS
        nodes = differing_nodes(source, target, bits)
        found = nodes.limit(max_open + 1).collect()
        levels.append((bits, len(found)))
        if not found:
            return source.limit(0), target.limit(0), levels
        if len(found) > max_open:
            return source, target, levels
        wanted = F.broadcast(spark.createDataFrame([(r["node"],) for r in found], "__node long"))
        source, target = (df.withColumn("__node", _node(bits)).join(wanted, "__node", "left_semi").drop("__node") for df in (source, target))
        # a node that holds copies of few keys can't be cut below their hash
        if max(r["rows"] for r in found) <= leaf_rows or bits + FAN_OUT_BITS >= 64:
            return source, target, levels


def sides(source: DataFrame, target: DataFrame, key: str, fields: Mapping[str, tuple[str, str]]) -> tuple[DataFrame, DataFrame]:
    """Both tables as ``suspects`` takes them, with the source's types."""
    types = [source.select(F.col(c)).dtypes[0][1] for c in (key, *[a for a, _ in fields.values()])]
    return _side(source, key, [a for a, _ in fields.values()], types), _side(target, key, [b for _, b in fields.values()], types)


def digest_differences(source: DataFrame, target: DataFrame, key: str, fields: Mapping[str, tuple[str, str]], leaf_rows: int = LEAF_ROWS, max_open: int = MAX_OPEN) -> DataFrame:
    """(key, side, source_rows, target_rows): keys whose rows differ: ``missing`` in the
    target, ``extra`` in it, or ``changed`` (values or number of rows).
    ``fields``: name -> (source column, target column); null equals null. A null key is
    a key like others."""
    s, t, _ = suspects(*sides(source, target, key, fields), leaf_rows, max_open)
    s, t = (df.groupBy("__k").agg(*_sums()) for df in (s, t))
    names = [c for c in s.columns if c != "__k"]
    l, r = s.select(F.col("__k").alias("__sk"), F.struct(*names).alias("s")), t.select(F.col("__k").alias("__tk"), F.struct(*names).alias("t"))
    j = l.join(r, F.col("__sk").eqNullSafe(F.col("__tk")), "full_outer").where(~F.col("s").eqNullSafe(F.col("t")))
    side = F.when(F.col("t").isNull(), "missing").when(F.col("s").isNull(), "extra").otherwise("changed")
    return j.select(
        F.coalesce("__sk", "__tk").alias(key), side.alias("side"),
        F.coalesce("s.n", F.lit(0)).alias("source_rows"), F.coalesce("t.n", F.lit(0)).alias("target_rows"),
    )
