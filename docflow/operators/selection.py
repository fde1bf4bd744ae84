"""Exact order statistics by histogram refinement: the keys at given ranks of an order
over several columns, without sorting or moving the rows.

Each pass counts the rows of the cells that still hold a wanted rank (counted in the
task, summed by Spark), notes their least and largest values and cuts these cells into
smaller ones, until a cell is one value; then the next order column is searched among the rows with that value.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.operators.intervals import as_number

CELLS = 1 << 16  # counted at once; also the most ranks of one call
_LOW, _HIGH = -(1 << 63), (1 << 63) - 1


def key_columns(df: DataFrame, order: list[str]) -> list[Column]:
    """Longs that sort as the columns do; null is the least. Dates, times and integers."""
    return [F.coalesce(as_number(df, c), F.lit(_LOW)).alias(f"k{i}") for i, c in enumerate(order)]


class _Cell:
    """Rows with fixed values of the first columns and the next one in [lo, hi]."""

    def __init__(self, fixed: tuple[int, ...], lo: int, hi: int, below: int, rows: int, ranks: list[int]):
        self.fixed, self.lo, self.hi, self.below, self.rows, self.ranks = fixed, lo, hi, below, rows, ranks
        self.width = 1

    @property
    def key(self) -> tuple[int, ...]:
        return (*self.fixed, self.lo)


def _before(limits: np.ndarray, keys: np.ndarray, or_equal: bool = False) -> np.ndarray:
    """How many of the sorted limits lie before each key (or are equal to it); rows of
    longs, compared column by column. One step of all binary searches at a time."""
    lo = np.zeros(len(keys), dtype=np.int64)
    hi = np.full(len(keys), len(limits), dtype=np.int64)
    while (lo < hi).any():
        mid = (lo + hi) // 2
        at = np.minimum(mid, len(limits) - 1)
        before = np.zeros(len(keys), dtype=bool)
        same = np.ones(len(keys), dtype=bool)
        for j in range(keys.shape[1]):
            limit = limits[at, j]
            before |= same & (limit < keys[:, j])
            same &= limit == keys[:, j]
        if or_equal:
            before |= same
        open_ = lo < hi
        lo = np.where(open_ & before, mid + 1, lo)
        hi = np.where(open_ & ~before, mid, hi)
    return lo


def _counts(keys: DataFrame, cells: list[_Cell], column: int) -> dict[int, list[tuple[int, int, int]]]:
    """cell -> (rows, least, largest value) of its sub-cells that have rows, in order; the
    sub-cells are of the cells' widths in ``column``, the cells are sorted by key."""
    limits = np.array([c.key for c in cells], dtype=np.int64).reshape(len(cells), column + 1)
    lo, hi = limits[:, column], np.array([c.hi for c in cells], dtype=np.int64)
    width = np.array([c.width for c in cells], dtype=np.uint64)
    starts = np.concatenate([[0], np.cumsum([-(-(c.hi - c.lo + 1) // c.width) for c in cells])]).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(starts[-1], dtype=np.int64)
        least, most = np.full(len(n), _HIGH), np.full(len(n), _LOW)
        for b in batches:
            k = np.stack([c.to_numpy() for c in b.columns], axis=1)
            c = _before(limits, k, or_equal=True) - 1 if len(limits) > 1 else np.zeros(len(k), dtype=np.int64)
            v, held = k[:, column], c >= 0
            held &= (limits[c, :column] == k[:, :column]).all(axis=1) & (v >= lo[c]) & (v <= hi[c])
            v, c = v[held], c[held]
            at = starts[c] + ((v.astype(np.uint64) - lo[c].astype(np.uint64)) // width[c]).astype(np.int64)
            n += np.bincount(at, minlength=len(n))
            np.minimum.at(least, at, v)
            np.maximum.at(most, at, v)
        at = np.flatnonzero(n)
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (at, n[at], least[at], most[at])], names=["at", "n", "least", "most"])

    rows = keys.select(*[f"k{i}" for i in range(column + 1)]).mapInArrow(run, "at long, n long, least long, most long")
    rows = rows.groupBy("at").agg(F.sum("n"), F.min("least"), F.max("most"))
    found: dict[int, list[tuple[int, int, int]]] = {}
    for at, *held in sorted(map(tuple, rows.collect())):  # at most CELLS rows and one per cell
        found.setdefault(int(np.searchsorted(starts, at, "right")) - 1, []).append(tuple(held))
    return found


def select_keys(df: DataFrame, order: list[str], ranks: list[int]) -> list[tuple[tuple[int, ...], int]]:
    """For each of the sorted 1-based ``ranks`` within the rows: (key, rows up to and
    with that key), the key as the longs of ``key_columns``. Where the order columns
    don't tell rows apart, equal rows lie on one side of a key, and the count says so."""
    if len(ranks) > CELLS:
        raise ValueError(f"at most {CELLS} ranks")
    keys = df.select(*key_columns(df, order))
    bounds = keys.agg(F.count(F.lit(1)), *[f(f"k{i}") for i in range(len(order)) for f in (F.min, F.max)]).first()
    n, spans = bounds[0], [(bounds[1 + 2 * i], bounds[2 + 2 * i]) for i in range(len(order))]
    ranks = sorted({r for r in ranks if 1 <= r <= n})
    if not ranks:
        return []
    done: list[_Cell] = []
    active = [_Cell((), *spans[0], 0, n, ranks)]
    while active:
        column = min(len(c.fixed) for c in active)
        now = [c for c in active if len(c.fixed) == column]
        later = [c for c in active if len(c.fixed) > column]
        now.sort(key=lambda c: (c.fixed, c.lo))
        share = max(2, CELLS // len(now))
        for c in now:
            c.width = max(1, -(-(c.hi - c.lo + 1) // share))
        found = _counts(keys, now, column)
        for i, c in enumerate(now):
            below, taken = c.below, 0
            for m, lo, hi in found.get(i, []):
                mine = c.ranks[taken : bisect_right(c.ranks, below + m, taken)]
                if mine:
                    taken += len(mine)
                    part = _Cell(c.fixed, lo, hi, below, m, mine)
                    if lo < hi:
                        later.append(part)
                    elif column + 1 < len(order) and (m > 1):
                        later.append(_Cell((*c.fixed, lo), *spans[column + 1], below, m, mine))
                    else:
                        done.append(part)
                below += m
                if taken == len(c.ranks):
                    break
        active = later
    return _whole_keys(keys, done, len(order))


def _whole_keys(keys: DataFrame, done: list[_Cell], size: int) -> list[tuple[tuple[int, ...], int]]:
    """Keys that were settled before their last column (one row) get the other columns."""
    short = [c for c in done if len(c.key) < size]
    full: dict[tuple[int, ...], tuple[int, ...]] = {}
    if short:
        spark = keys.sparkSession
        for width in {len(c.key) for c in short}:
            names = [f"k{i}" for i in range(width)]
            wanted = spark.createDataFrame([c.key for c in short if len(c.key) == width], ", ".join(f"{k} long" for k in names))
            for row in keys.join(F.broadcast(wanted), names, "left_semi").collect():  # one row per key, at most CELLS
                full[tuple(row[k] for k in names)] = tuple(row[f"k{i}"] for i in range(size))
    out = [(full.get(c.key, c.key), c.below + c.rows) for c in done]
    return sorted(set(out))


def range_number(df: DataFrame, order: list[str], cuts: list[tuple[int, ...]]) -> Column:
    """How many of the sorted cut keys lie before a row's key (binary search in Arrow batches)."""
    if not cuts:
        return F.lit(0)
    limits = np.array(cuts, dtype=np.int64).reshape(len(cuts), len(order))

    def number(*columns: pd.Series) -> pd.Series:
        ks = np.stack([c.to_numpy(dtype=np.int64) for c in columns], axis=1)
        return pd.Series(_before(limits, ks).astype(np.int32))

    return F.pandas_udf(number, "int")(*[k for k in key_columns(df, order)])
