"""Whitening of embeddings by a weighted multiplicity covariance.

1. Every entry c becomes the long floor(256 * c); rows with equal x vectors form
   a group. A group is kept once, with its number of rows.
2. Fit weights are one per group (``weights="one"``) or its number of rows
   (``weights="count"``). Their sum n and the weighted sums S are exact integers.
3. Centred covariance by matrix products: each task multiplies the centred,
   weighted block of distinct vectors it holds; the d * d partial sums of the tasks
   are added by Spark. Only n, S and that matrix (bounded by the vectors' length,
   never by their number) reach the driver, which solves the eigenproblem.
4. Each distinct vector is whitened once and joined back to its rows. Vectors that
   hold more than 1 / ``HOT`` of all rows, at most ``HOT`` of them, are joined
   apart, so a vector that very many rows share does not land in one task.

Defined results: rows with a null vector, or with a null, NaN or infinite entry,
are dropped, empty vectors too (they have no components). Vectors of different
lengths are different spaces: each length is fitted and whitened on its own.
Components whose eigenvalue is not above the rounding error of the matrix (all of
them where all x vectors are equal) have no whitened value and give no rows. Of
equal eigenvalues any orthonormal basis is an answer; one is chosen, the same for
all rows. A component's sign makes its largest entry positive. Entries beyond a long
saturate; a deviation beyond a long is null. Rows that repeat stay, each with its
result; a null vec_id stays null. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.llm.common import query, written
from docflow.sources.tables import table

COMPONENTS = 4
SCALE = 256
HOT = 1000  # a vector of more than 1 / HOT of the rows is joined apart
_LONG = 1 << 63
_LOW = (1 << 32) - 1


def scaled(embeddings: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, dim, x): x the little-endian longs floor(SCALE * c) of a finite vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = b.column(1)
            sizes = np.nan_to_num(np.asarray(v.value_lengths().to_numpy(zero_copy_only=False), dtype=np.float64)).astype(np.int64)
            flat = v.flatten()
            c = flat.to_numpy(zero_copy_only=False).astype(np.float64)  # null entries become NaN
            ends = np.cumsum(sizes)
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(c))])
            ok = (sizes > 0) & (bad[ends] == bad[ends - sizes])
            with np.errstate(invalid="ignore", over="ignore"):
                y = np.floor(c * SCALE)
                x = np.where(y >= float(_LONG), _LONG - 1, np.where(y <= -float(_LONG), -_LONG, 0)).astype(np.int64)
                inside = np.abs(y) < float(_LONG)
                x[inside] = y[inside].astype(np.int64)
            keep = np.flatnonzero(ok)
            blobs = [x[ends[i] - sizes[i] : ends[i]].astype("<i8").tobytes() for i in keep]
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(keep)), pa.array(sizes[keep], pa.int32()), pa.array(blobs, pa.binary())], names=["id", "dim", "x"]
            )

    src = embeddings.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    return src.mapInArrow(run, "id long, dim int, x binary")


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, row numbers, matrix of longs) of a batch with columns dim and x."""
    dims = batch.column("dim").to_numpy()
    blobs = batch.column("x").to_pylist()
    for d in np.unique(dims):
        at = np.flatnonzero(dims == d)
        yield int(d), at, np.frombuffer(b"".join(blobs[i] for i in at), dtype="<i8").reshape(len(at), d)


def _exact_sum(x: np.ndarray, w: np.ndarray) -> list[int]:
    """Weighted column sums of longs, as Python integers."""
    if int(w.sum()) < 1 << 30:
        hi, lo = x >> 32, x & _LOW
        return [(int(h) << 32) + int(g) for h, g in zip(w @ hi, w @ lo, strict=True)]
    return [int(s) for s in (x.astype(object) * w[:, None]).sum(axis=0)]


def weighted_sums(distinct: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """length -> (n, S): the sum of the weights, and of the weighted vectors. One
    row per task, length and dimension is summed by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list[int]] = {}
        for b in batches:
            weights = b.column("w").to_numpy()
            for d, at, x in _by_length(b):
                add = [int(weights[at].sum()), *_exact_sum(x, weights[at])]
                total[d] = [p + q for p, q in zip(total.get(d, [0] * (d + 1)), add, strict=True)]
        for d, sums in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([d] * (d + 1), pa.int32()), pa.array(range(-1, d), pa.int32()), pa.array([Decimal(s) for s in sums], pa.decimal128(38, 0))], names=["dim", "i", "s"]
            )

    rows = distinct.mapInArrow(run, "dim int, i int, s decimal(38,0)").groupBy("dim", "i").agg(F.sum("s").alias("s")).collect()
    out: dict[int, dict[int, int]] = {}
    for d, i, s in rows:
        out.setdefault(d, {})[i] = int(s)
    return {d: (s[-1], [s[i] for i in range(d)]) for d, s in out.items()}


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exact: longs where they fit, Python integers elsewhere."""
    top = max([abs(s) for s in sums] + [0]) + n * max(abs(int(x.max())), abs(int(x.min()))) if x.size else 0
    if top < _LONG:
        return n * x - np.array(sums, dtype=np.int64)
    return x.astype(object) * n - np.array(sums, dtype=object)


def _square_sums(dev: np.ndarray) -> list[int | None]:
    """Sum of squares of each row, exact; None beyond a long."""
    if dev.dtype != object and dev.size and float(np.square(dev.astype(np.float64)).sum(axis=1).max()) < 9e18:
        return np.square(dev).sum(axis=1).tolist()
    exact = [sum(int(v) ** 2 for v in row) for row in dev]
    return [s if s < _LONG else None for s in exact]


def covariance(vectors: DataFrame, centred: Callable[[pa.RecordBatch], Iterator[tuple[int, np.ndarray, np.ndarray]]], totals: dict[int, float]) -> dict[int, np.ndarray]:
    """length -> covariance. ``centred`` gives (length, centred matrix, weights) of a
    batch; a task adds up the products of its blocks, Spark adds up the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for d, c, w in centred(b):
                total[d] = total.get(d, 0.0) + (c * w[:, None]).T @ c
        for d, m in total.items():
            i, j = np.triu_indices(m.shape[0])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), d), pa.int32()), pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(m[i, j], pa.float64())], names=["dim", "i", "j", "v"])

    out: dict[int, dict[tuple[int, int], float]] = {}
    for d, i, j, v in vectors.mapInArrow(run, "dim int, i int, j int, v double").groupBy("dim", "i", "j").agg(F.sum("v").alias("v")).collect():
        out.setdefault(d, {})[i, j] = v
    result = {}
    for d, entries in out.items():
        size = max(j for _, j in entries) + 1
        m = np.zeros((size, size))
        for (i, j), v in entries.items():
            m[i, j] = m[j, i] = v / totals[d]
        result[d] = m
    return result


def components_of(cov: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(eigenvalues, eigenvectors as columns, shares of the trace) of the first ``k``
    components whose eigenvalue is above the matrix's rounding error."""
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(-values, kind="stable")
    values, vectors = values[order], vectors[:, order]
    good = values > max(values[0], 0.0) * len(values) * 1e-13
    values, vectors = values[good][:k], vectors[:, good][:, :k]
    if vectors.shape[1]:
        vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    return values, vectors, values / np.trace(cov) if len(values) else values


def whiten(
    embeddings: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = COMPONENTS, weights: str = "one"
) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error): one row per
    row with a finite vector and component up to ``k``."""
    if weights not in ("one", "count"):
        raise ValueError("weights must be 'one' or 'count'")
    rows = written(scaled(embeddings, id_col, vec_col), "whiten-rows")
    groups = rows.groupBy("dim", "x").agg(F.count("*").alias("copies"))
    weight = F.lit(1).cast("long") if weights == "one" else F.col("copies")
    distinct = written(groups.withColumn("w", weight), "whiten-distinct")
    fit = weighted_sums(distinct)

    def centred(b: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        w = b.column("w").to_numpy()
        for d, at, x in _by_length(b):
            n, sums = fit[d]
            yield d, (_deviations(x, n, sums) / n).astype(np.float64), w[at]

    totals = {d: float(n) for d, (n, _) in fit.items()}
    basis = {d: components_of(v, k) for d, v in covariance(distinct, centred, totals).items()}

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims, xs, ws = b.column("dim"), b.column("x"), b.column("w")
            for d, at, x in _by_length(b):
                n, sums = fit[d]
                values, vectors, _ = basis[d]
                dev = _deviations(x, n, sums)
                z = (dev / n).astype(np.float64) @ vectors / np.sqrt(values)
                idx = pa.array(at)
                yield pa.RecordBatch.from_arrays(
                    [dims.take(idx), xs.take(idx), b.column("copies").take(idx), ws.take(idx), pa.array(_square_sums(dev), pa.int64()), pa.array(list(z), pa.list_(pa.float64()))],
                    names=["dim", "x", "copies", "w", "deviation", "z"],
                )

    white = written(distinct.mapInArrow(project, "dim int, x binary, copies long, w long, deviation long, z array<double>"), "whiten-vectors")

    means: dict[int, dict[int, float]] = {}
    for d, i, s in white.select("dim", "w", F.posexplode("z").alias("i", "v")).groupBy("dim", "i").agg(F.sum(F.col("v") * F.col("w"))).collect():
        means.setdefault(d, {})[i] = s / totals[d]

    def centred_white(b: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        dims, w, z = b.column("dim").to_numpy(), b.column("w").to_numpy(), b.column("z").to_pylist()
        for d in np.unique(dims):
            if int(d) in means:
                at = np.flatnonzero(dims == d)
                yield int(d), np.array([z[i] for i in at]) - np.array([means[d][i] for i in range(len(means[d]))]), w[at]

    error = {d: float(np.abs(m - np.eye(len(m))).max()) for d, m in covariance(white, centred_white, totals).items()}

    spark = embeddings.sparkSession
    facts = spark.createDataFrame(
        [(d, int(fit[d][0]), [float(s) for s in basis[d][2]], error.get(d)) for d in fit], "dim int, n long, shares array<double>, identity_error double"
    )  # one row per length
    limit = rows.count() // HOT
    hot = white.where(F.col("copies") > limit)
    usual = rows.join(F.broadcast(hot.select("dim", "x")), ["dim", "x"], "left_anti").join(white.where(F.col("copies") <= limit), ["dim", "x"])
    both = usual.unionByName(rows.join(F.broadcast(hot), ["dim", "x"]))
    return (
        both.join(F.broadcast(facts), "dim")
        .select("id", "n", "deviation", "shares", "identity_error", F.posexplode("z").alias("i", "whitened"))
        .select(
            F.col("id").alias(id_col), (F.col("i") + 1).alias("component"), "n", "deviation", "whitened",
            F.element_at("shares", F.col("i") + 1).alias("explained"), "identity_error",
        )
    )


@query("op11_embedding_whitening")
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract columns for every row of embeddings with a finite vector."""
    return whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
