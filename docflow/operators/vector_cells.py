"""Exact cosine top-k with pruning by cells.

Unit vectors are put into the cells of a k-means fit; a cell knows its centroid and
radius (the largest distance of a member from it). For a query q no member of a cell is
nearer than dist(q, centroid) - radius, which bounds the cosine from above
(1 - distance^2 / 2). A query opens its cells in the order of that bound, a few at
first and then more, and ends when no unopened cell can reach its k-th score. Only pairs
of a query and an opened cell are scored, a matrix product per block of a cell.

The fit is on at most ``SAMPLE`` vectors and only decides how much is pruned; every
vector is in a cell, and the result is that of the full search.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.operators.text import top_k_per_group
from docflow.session import written

SAMPLE = 50_000
MAX_CELLS = 1024
CELL_BLOCK = 8192  # members of a cell scored together
FIRST, GROWTH = 4, 4  # cells opened in the first round, and how the number grows
_SLACK = 4e-9  # scores are compared to nine digits


def _units(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(rows with a finite vector other than zero, their unit vectors)."""
    rows = [(i, v) for i, v in enumerate(column.to_pylist()) if v and None not in v]
    if not rows:
        return np.zeros(0, dtype=np.int64), np.zeros((0, 0))
    at, m = np.array([i for i, _ in rows]), np.array([v for _, v in rows], dtype=np.float64)
    length = np.linalg.norm(m, axis=1)
    ok = np.isfinite(length) & (length > 0)
    return at[ok], m[ok] / length[ok, None]


def _distances(u: np.ndarray, centres: np.ndarray) -> np.ndarray:
    square = (u * u).sum(axis=1)[:, None] + (centres * centres).sum(axis=1)[None, :] - 2 * u @ centres.T
    return np.sqrt(np.maximum(square, 0.0))


def cell_index(items: DataFrame, id_col: str, vec: str, cells: int | None = None, seed: int = 17) -> tuple[DataFrame, np.ndarray, np.ndarray, np.ndarray]:
    """(index, centres, radii, sizes): the index has (cell, id, u), one row per vector
    that has a direction, written in the order of the cells."""
    src = items.select(F.col(id_col).cast("long").alias("id"), F.col(vec).cast("array<double>").alias("v")).where("v is not null")

    def units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, u = _units(b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at)), pa.array(list(u), pa.list_(pa.float64()))], names=["id", "u"])

    unit = written(src.mapInArrow(units, "id long, u array<double>"), "unit-vectors")
    n = unit.count()
    if not n:
        return unit.select(F.lit(0).alias("cell"), "id", "u"), np.zeros((0, 0)), np.zeros(0), np.zeros(0, dtype=np.int64)
    k = max(1, min(cells or math.isqrt(n), MAX_CELLS, n))
    few = unit if n <= SAMPLE else unit.orderBy(F.xxhash64("id", "u")).limit(SAMPLE)
    if k > 1:
        model = KMeans(k=k, seed=seed, maxIter=10, initMode="random", featuresCol="f").fit(few.select(array_to_vector("u").alias("f")))
        centres = np.array(model.clusterCenters())
    else:
        centres = np.array([few.first()["u"]])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 1024):
                part = b.slice(lo, 1024)
                d = _distances(np.array(part.column(1).to_pylist()), centres)
                cell = d.argmin(axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), *part.columns, pa.array(d[np.arange(len(cell)), cell])], names=["cell", "id", "u", "d"])

    placed = written(unit.mapInArrow(assign, "cell int, id long, u array<double>, d double").repartition("cell", F.pmod(F.xxhash64("id"), F.lit(16))).sortWithinPartitions("cell"), "vector-cells")
    radii, sizes = np.zeros(len(centres)), np.zeros(len(centres), dtype=np.int64)
    for cell, r, m in placed.groupBy("cell").agg(F.max("d"), F.count(F.lit(1))).collect():  # one row per cell
        radii[cell], sizes[cell] = r, m
    return placed.select("cell", "id", "u"), centres, radii, sizes


def cell_top_k(items: DataFrame, id_col: str, vec: str, queries: DataFrame, qid: str, qvec: str, k: int, cells: int | None = None, report: dict | None = None) -> DataFrame:
    """(qid, id, score, rank): top ``k`` items per query by cosine, as ``embedding_top_k``.
    ``report`` receives the number of rounds and of scored pairs and of all pairs."""
    index, centres, radii, sizes = cell_index(items, id_col, vec, cells)
    blocks = np.maximum(1, -(-sizes // CELL_BLOCK))
    asked = queries.where(F.col(qvec).isNotNull()).select(F.col(qid).cast("string").alias("qid"), F.col(qvec).cast("array<double>").alias("v"))

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, u = _units(b.column(1))
            if len(at) and len(centres):
                reach = 1 - np.maximum(_distances(u, centres) - radii, 0.0) ** 2 / 2
                reach[:, sizes == 0] = -2.0
                order = np.argsort(-reach, axis=1, kind="stable")
                best = np.take_along_axis(reach, order, axis=1)
                arrays = [b.column(0).take(pa.array(at)), pa.array(list(u), pa.list_(pa.float64())), pa.array(list(order.astype(np.int32)), pa.list_(pa.int32())), pa.array(list(best), pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(arrays, names=["qid", "q", "cells", "reach"])

    plan = written(asked.mapInArrow(bounds, "qid string, q array<double>, cells array<int>, reach array<double>"), "query-cells")

    def score(block: pa.Table, asks: pa.Table) -> pa.Table:
        out_q, out_id, out_s = [], [], []
        if block.num_rows and asks.num_rows:
            ids, members = block.column("id").to_numpy(), np.array(block.column("u").to_pylist())
            for q, v in zip(asks.column("qid").to_pylist(), asks.column("q").to_pylist(), strict=True):
                cosine = members @ np.array(v)
                level = np.round(cosine, 9)
                near = np.arange(len(ids))
                if len(ids) > k:  # all that reach the k-th level
                    near = np.flatnonzero(level >= np.partition(level, -k)[-k])
                near = near[np.lexsort((ids[near], -level[near]))[:k]]
                out_q += [q] * len(near)
                out_id += ids[near].tolist()
                out_s += cosine[near].tolist()
        return pa.table({"qid": pa.array(out_q, pa.string()), "id": pa.array(out_id, pa.int64()), "score": pa.array(out_s, pa.float64())})

    spark = items.sparkSession
    top = spark.createDataFrame([], "qid string, id long, score double, rank int")
    counts = F.array(*[F.lit(int(x)) for x in blocks]) if len(blocks) else F.array(F.lit(1))
    members = F.array(*[F.lit(int(x)) for x in sizes]) if len(sizes) else F.array(F.lit(0))
    lo, step, scored, rounds = 0, FIRST, 0, 0
    while lo < len(centres):
        # the k-th score of each query so far; none while it has fewer than k
        kth = top.groupBy("qid").agg(F.min("score").alias("kth"), F.count(F.lit(1)).alias("have")).where(F.col("have") >= k).select("qid", "kth")
        ranked = plan.join(kth, "qid", "left").select("qid", "q", "kth", F.posexplode(F.arrays_zip("cells", "reach")).alias("pos", "e"))
        unopened = ranked.where((F.col("pos") >= lo) & (F.col("e.reach") > -2) & (F.col("kth").isNull() | (F.col("e.reach") >= F.col("kth") - _SLACK)))
        now = written(unopened.where(F.col("pos") < lo + step).select("qid", "q", F.col("e.cells").alias("cell")), "opened-cells")
        count = now.agg(F.sum(F.element_at(members, F.col("cell") + 1).cast("long"))).first()[0]
        if count is None:
            break  # bounds fall with the position: nothing further can reach the k-th score
        scored, rounds = scored + count, rounds + 1
        left = index.join(now.select("cell").distinct(), "cell", "left_semi").withColumn("block", F.pmod(F.xxhash64("id"), F.element_at(counts, F.col("cell") + 1)).cast("int"))
        right = now.withColumn("block", F.explode(F.sequence(F.lit(0), F.element_at(counts, F.col("cell") + 1) - 1)))
        found = left.groupBy("cell", "block").cogroup(right.groupBy("cell", "block")).applyInArrow(score, "qid string, id long, score double")
        top = written(top_k_per_group(found.unionByName(top.select("qid", "id", "score")), "qid", "score", "id", k).select("qid", "id", "score", F.col("rank").cast("int").alias("rank")), "nearest")
        lo, step = lo + step, step * GROWTH
    if report is not None:
        report.update(rounds=rounds, scored=scored, pairs=int(sizes.sum()) * plan.count())
    return top
