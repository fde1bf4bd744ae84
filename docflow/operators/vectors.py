"""Dense-embedding similarity: centroids and cosine top-k.

Items and queries are cut into blocks; a group scores one block of items
against one block of queries with a matrix product and keeps the best k per
query; the global top k comes from a window with a map-side group limit.
``cosine`` is the per-row JVM expression for pairwise use.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.functions.exprs import col_
from docflow.operators.text import top_k_per_group
from docflow.session import written

ITEM_BLOCK, QUERY_BLOCK = 8192, 512  # vectors multiplied together in one group


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(F.transform(a, lambda x: x.cast("double") * x.cast("double")), F.lit(0.0), lambda s, x: s + x))


def cosine(a: str | Column, b: str | Column) -> Column:
    """Cosine similarity in double precision; NULL for a zero vector."""
    a, b = col_(a), col_(b)
    den = norm(a) * norm(b)
    return F.when(den > 0, dot(a, b) / den)


def centroids(df: DataFrame, group: str | Column | None, vec: str) -> DataFrame:
    """Mean vector per group (dimension-wise average), as (group, centroid), in one pass."""
    g = F.lit("all") if group is None else col_(group)
    e = df.where(F.col(vec).isNotNull()).select(g.alias("grp"), array_to_vector(F.col(vec).cast("array<double>")).alias("v"))
    return e.groupBy("grp").agg(vector_to_array(Summarizer.mean(F.col("v"))).alias("centroid"))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in column.to_pylist()])


def embedding_top_k(items: DataFrame, id_col: str, vec: str, queries: DataFrame, qid: str, qvec: str, k: int) -> DataFrame:
    """(qid, id, score, rank): top ``k`` items per query by cosine similarity.

    Shuffled: every item once per block of ``QUERY_BLOCK`` queries, every query
    once per block of ``ITEM_BLOCK`` items, and k rows per query and block of
    items. Null and zero vectors have no cosine.
    """
    asked = queries.where(F.col(qvec).isNotNull()).select(F.col(qid).cast("string").alias("qid"), F.col(qvec).cast("array<double>").alias("qv"))
    asked = written(asked, "query-vectors")
    q_blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    i_blocks = max(1, -(-items.count() // ITEM_BLOCK))
    src = items.where(F.col(vec).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(vec).alias("v"))
    left = src.withColumn("__i", F.pmod(F.xxhash64("id"), F.lit(i_blocks)).cast("int")).withColumn("__q", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))))
    right = asked.withColumn("__q", F.pmod(F.xxhash64("qid"), F.lit(q_blocks)).cast("int")).withColumn("__i", F.explode(F.sequence(F.lit(0), F.lit(i_blocks - 1))))

    def score(block: pa.Table, asks: pa.Table) -> pa.Table:
        out_q, out_id, out_s = [], [], []
        if block.num_rows and asks.num_rows:
            ids, mat, qmat = block.column("id").to_numpy(), _matrix(block.column("v")), _matrix(asks.column("qv"))
            lengths = np.linalg.norm(mat, axis=1)
            for q, v in zip(asks.column("qid").to_pylist(), qmat, strict=True):
                den = lengths * np.linalg.norm(v)
                ok = np.flatnonzero(den > 0)
                cosine = (mat[ok] @ v) / den[ok]
                level = np.round(cosine, 9)
                if len(ok) > k:  # all that reach the k-th level
                    near = np.flatnonzero(level >= np.partition(level, -k)[-k])
                    ok, cosine, level = ok[near], cosine[near], level[near]
                best = np.lexsort((ids[ok], -level))[:k]
                out_q += [q] * len(best)
                out_id += ids[ok][best].tolist()
                out_s += cosine[best].tolist()
        return pa.table({"qid": pa.array(out_q, pa.string()), "id": pa.array(out_id, pa.int64()), "score": pa.array(out_s, pa.float64())})

    local = left.groupBy("__i", "__q").cogroup(right.groupBy("__i", "__q")).applyInArrow(score, "qid string, id long, score double")
    return top_k_per_group(local, "qid", "score", "id", k)
