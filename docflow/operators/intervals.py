"""Interval join: rows meet the windows whose bounds hold their time.

Few windows (a size that is checked): the window ends cut the time line into
segments. A row finds its segment by binary search and meets the windows
open there in an equi-join; rows are not shuffled for it while Spark broadcasts the
segments. Beyond that size: rows and windows are dealt to ranges of time that hold
about equally many rows, sorted, and one pass per range keeps the open windows. A
window of any length reaches a range once. A single instant that holds more rows
than a range is dealt to several ranges, which all see its windows.

Where only totals of the rows of each window are wanted (``totals``), the pairs, which
grow with both tables, are never made. Segments: rows are added up by segment before
the join. Sweep: rows of one instant are added up first; a window takes the ranges that
lie whole inside it from a binary tree over the ranges' totals, and asks only the two
ranges of its ends, each of which answers from such a tree over its instants.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docflow.session import written
from docflow.streaming.streams import instant_to_wall_clock, wall_clock_instant

MAX_WINDOWS = 4096  # of the segment form
MAX_SEGMENT_ROWS = 200_000  # (segment, window) pairs of it
ROWS_PER_RANGE = 500_000
MAX_RANGES = 4096
_PAIRS = 100_000  # joined rows per Arrow batch
_EDGE = 1 << 52  # times and keys beyond this lose exactness as doubles
# how parts of a total are put together, in Spark and numpy, and the part of no rows
_MERGE = {"sum": (F.sum, np.add, 0), "min": (F.min, np.minimum, (1 << 63) - 1), "max": (F.max, np.maximum, -(1 << 63))}


def as_number(df: DataFrame, name: str) -> Column:
    """A date, timestamp or integer column as a long (microseconds, by the wall
    clock for zone-free values); integers stay what they are."""
    kind = dict(df.dtypes)[name]
    if kind == "date":
        return F.datediff(F.col(name), F.lit("1970-01-01").cast("date")).cast("long") * 86_400_000_000
    if kind == "timestamp_ntz":
        return F.unix_micros(wall_clock_instant(name))
    if kind == "timestamp":
        return F.unix_micros(F.col(name))
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return F.col(name).cast("long")
    raise TypeError(f"no interval join on {name!r} of type {kind}")


def from_number(value: Column, kind: str) -> Column:
    """Inverse of ``as_number`` for a column of type ``kind``."""
    if kind == "date":
        return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(value / F.lit(86_400_000_000)).cast("int"))
    if kind == "timestamp_ntz":
        return instant_to_wall_clock(F.timestamp_micros(value))
    return F.timestamp_micros(value) if kind == "timestamp" else value.cast(kind)


def _half_open(windows: DataFrame, start: str, end: str, bounds: str) -> DataFrame:
    """Windows as lo <= t < hi in whole numbers; empty ones and those without an end are dropped."""
    lo = as_number(windows, start) + F.lit(0 if bounds[0] == "[" else 1)
    hi = as_number(windows, end) + F.lit(1 if bounds[1] == "]" else 0)
    return windows.withColumns({"__lo": lo, "__hi": hi}).where(F.col("__lo") < F.col("__hi"))


def _numbered(df: DataFrame, column: str, cuts: list[int], out: str) -> DataFrame:
    """``out``: how many of the sorted cut points are <= ``column``."""
    if not cuts:
        return df.withColumn(out, F.lit(0))
    splits = [-float("inf"), *[float(c) for c in cuts], float("inf")]
    d = df.withColumn("__as_double", F.col(column).cast("double"))
    return Bucketizer(splits=splits, inputCol="__as_double", outputCol=out).transform(d).withColumn(out, F.col(out).cast("int")).drop("__as_double")


def _by_segments(rows: DataFrame, spans: DataFrame, edges: list[int]) -> DataFrame:
    s = _numbered(_numbered(spans, "__lo", edges, "__a"), "__hi", edges, "__b")
    open_in = s.withColumn("__seg", F.explode(F.sequence("__a", F.col("__b") - 1))).drop("__a", "__b", "__lo", "__hi")
    return _numbered(rows, "__t", edges, "__seg").drop("__t").join(open_in, "__seg").drop("__seg")


def _range_cuts(rows: DataFrame, n: int) -> tuple[list[int], list[int]]:
    """(cuts, copies): ranges of time with about equally many rows; a range that is one
    instant with rows for several ranges has as many copies."""
    if n < 2:
        return [], [1]
    at = [k / n for k in range(1, n)]
    points = rows.agg(F.percentile_approx("__t", at, 10_000)).first()[0] or []
    times: dict[int, int] = {}
    for p in points:
        times[p] = times.get(p, 0) + 1
    cuts = sorted({c for p, m in times.items() for c in ((p, p + 1) if m > 1 else (p,))})
    return cuts, [1, *[times.get(c, 1) for c in cuts]]


def _by_sweep(rows: DataFrame, spans: DataFrame, ranges: int | None) -> DataFrame:
    row_cols = [c for c in rows.columns if c != "__t"]
    span_cols = [c for c in spans.columns if c not in ("__lo", "__hi")]
    n = ranges or min(MAX_RANGES, -(-rows.count() // ROWS_PER_RANGE))
    cuts, copies = _range_cuts(rows, n)
    table = F.array(*[F.lit(c) for c in copies])
    salt = F.xxhash64(*[F.to_json(F.col(c)) if "map<" in t else F.col(c) for c, t in rows.dtypes])
    r = _numbered(rows, "__t", cuts, "__r").withColumn("__copy", F.pmod(salt, F.element_at(table, F.col("__r") + 1)).cast("int"))
    s = _numbered(spans.withColumn("__last", F.col("__hi") - 1), "__last", cuts, "__to")
    s = _numbered(s, "__lo", cuts, "__from").withColumn("__r", F.explode(F.sequence("__from", "__to")))
    s = s.withColumn("__copy", F.explode(F.sequence(F.lit(0), F.element_at(table, F.col("__r") + 1) - 1)))
    row, span = F.struct(*row_cols), F.struct("__lo", "__hi", *span_cols)
    events = r.select("__r", "__copy", F.col("__t").alias("__at"), F.lit(1).alias("__kind"), row.alias("row"), F.lit(None).cast(s.select(span.alias("x")).schema["x"].dataType).alias("span"))
    events = events.unionByName(
        s.select("__r", "__copy", F.col("__lo").alias("__at"), F.lit(0).alias("__kind"), F.lit(None).cast(r.select(row.alias("x")).schema["x"].dataType).alias("row"), span.alias("span"))
    )
    dealt = events.repartition("__r", "__copy").sortWithinPartitions("__r", "__copy", "__at", "__kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, open_spans = None, None
        for b in batches:
            r, c, at, kind = (b.column(k).to_numpy() for k in range(4))
            turns = np.flatnonzero((np.diff(r) != 0) | (np.diff(c) != 0)) + 1
            for lo, hi in zip([0, *turns], [*turns, len(r)], strict=True):
                if lo == hi:
                    continue
                if (r[lo], c[lo]) != place:
                    place, open_spans = (r[lo], c[lo]), None
                part = b.slice(lo, hi - lo)
                here, times = np.flatnonzero(kind[lo:hi] == 1), at[lo:hi]
                new = pa.Table.from_batches([pa.RecordBatch.from_struct_array(part.column(5).take(pa.array(np.flatnonzero(kind[lo:hi] == 0))))])
                open_spans = new if open_spans is None else pa.concat_tables([open_spans, new]).combine_chunks()
                if len(here):
                    found = pa.RecordBatch.from_struct_array(part.column(4).take(pa.array(here)))
                    yield from _matches(found, times[here], open_spans)
                # windows that ended before this batch's last event are closed
                open_spans = open_spans.filter(pa.array(open_spans.column("__hi").to_numpy() > times[-1]))

    out = rows.select(*row_cols).schema
    for f in spans.select(*span_cols).schema:
        out = out.add(f)

    def _matches(found: pa.RecordBatch, t: np.ndarray, spans: pa.Table) -> Iterator[pa.RecordBatch]:
        first = np.searchsorted(t, spans.column("__lo").to_numpy(), "left")
        size = np.searchsorted(t, spans.column("__hi").to_numpy(), "left") - first
        some = np.flatnonzero(size > 0)
        first, size = first[some], size[some]
        ends = np.cumsum(size)
        for lo in range(0, int(ends[-1]) if len(ends) else 0, _PAIRS):
            pair = np.arange(lo, min(lo + _PAIRS, int(ends[-1])))
            which = np.searchsorted(ends, pair, "right")
            at = first[which] + pair - (ends[which] - size[which])
            left, right = found.take(pa.array(at)), spans.take(pa.array(some[which])).combine_chunks()
            cols = [left.column(i) for i in range(left.num_columns)] + [right.column(c).chunk(0) for c in span_cols]
            yield pa.RecordBatch.from_arrays(cols, names=[*row_cols, *span_cols])

    return dealt.mapInArrow(run, out)


class _Totals:
    """Totals of rows as parts that can be put together: name -> (kind, column), of kind
    "count" (rows, no column), "min" or "max" (of integers, dates or times; nulls are
    passed over)."""

    def __init__(self, rows: DataFrame, wanted: dict[str, tuple[str, str | None]]):
        kinds = dict(rows.dtypes)
        first: dict[tuple[str, str | None], Column] = {}
        names: dict[tuple[str, str | None], str] = {}

        def part(kind: str, column: str | None, value: Column) -> Column:
            name = names.setdefault((kind, column), f"__p{len(names)}")
            first[kind, column] = value.alias(name)
            return F.col(name)

        self.out = []
        for name, (kind, column) in wanted.items():
            if kind == "count" and column is None:
                self.out.append(part("sum", None, F.count(F.lit(1))).alias(name))
            elif kind in ("min", "max"):
                merge, _, none = _MERGE[kind]
                seen = part("sum", column, F.count(F.col(column)))
                value = part(kind, column, F.coalesce(merge(as_number(rows, column)), F.lit(none)))
                self.out.append(F.when(seen > 0, from_number(value, kinds[column])).alias(name))
            else:
                raise ValueError(f"unknown total {kind!r} of {column!r}")
        self.names = list(names.values())
        self.ops = [kind for kind, _ in names]
        self.first = list(first.values())
        self.merged = [_MERGE[op][0](n).alias(n) for n, op in zip(self.names, self.ops, strict=True)]


def _segment_totals(rows: DataFrame, spans: DataFrame, edges: list[int], totals: _Totals) -> DataFrame:
    by_segment = _numbered(rows, "__t", edges, "__seg").groupBy("__seg").agg(*totals.first)
    s = _numbered(_numbered(spans, "__lo", edges, "__a"), "__hi", edges, "__b")
    open_in = s.withColumn("__seg", F.explode(F.sequence("__a", F.col("__b") - 1))).select("__seg", "__lo", "__hi")
    return by_segment.join(open_in, "__seg").groupBy("__lo", "__hi").agg(*totals.merged)


def _levels(values: np.ndarray, op: str) -> list[np.ndarray]:
    """A binary tree over the values, its leaves first."""
    _, merge, none = _MERGE[op]
    levels = [values]
    while len(levels[-1]) > 1:
        v = levels[-1] if len(levels[-1]) % 2 == 0 else np.append(levels[-1], none)
        levels.append(merge(v[0::2], v[1::2]))
    return levels


def _over(levels: list[np.ndarray], op: str, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The total of the leaves [a, b), for arrays of both."""
    _, merge, none = _MERGE[op]
    out = np.full(len(a), none, dtype=np.int64)
    for v in levels:
        for at, shift in ((a, 0), (b, 1)):
            odd = np.flatnonzero((a < b) & (at % 2 == 1))
            out[odd] = merge(out[odd], v[at[odd] - shift])
        a, b = (a + 1) // 2, b // 2
    return out


def _sweep_totals(rows: DataFrame, spans: DataFrame, ranges: int | None, totals: _Totals) -> DataFrame:
    instants = written(rows.groupBy("__t").agg(*totals.first), "instants")
    ends = spans.select(F.explode(F.array("__lo", "__hi")).alias("__t"))
    points = instants.select("__t").unionByName(ends)
    n = ranges or min(MAX_RANGES, -(-points.count() // ROWS_PER_RANGE))
    cuts, copies = _range_cuts(points, n)
    table = F.array(*[F.lit(c) for c in copies])
    r = _numbered(instants, "__t", cuts, "__r")
    s = _numbered(spans.withColumn("__last", F.col("__hi") - 1), "__last", cuts, "__to").drop("__last")
    s = _numbered(s, "__lo", cuts, "__from")

    # ranges that lie whole inside a window: nodes of a binary tree over the ranges
    top = len(copies).bit_length()
    tree = r.groupBy("__r").agg(*totals.merged).withColumn("__level", F.explode(F.sequence(F.lit(0), F.lit(top))))
    tree = tree.withColumn("__node", F.expr("shiftright(__r, __level)")).groupBy("__level", "__node").agg(*totals.merged)
    inner = s.where("__from + 1 < __to").withColumn("__level", F.explode(F.sequence(F.lit(0), F.lit(top))))
    inner = inner.withColumns({"__a": F.expr("shiftright(__from + shiftleft(1, __level), __level)"), "__b": F.expr("shiftright(__to, __level)")}).where("__a < __b")
    odd = F.array_compact(F.array(F.expr("if(__a % 2 = 1, __a, null)"), F.expr("if(__b % 2 = 1, __b - 1, null)")))
    inner = inner.select("__lo", "__hi", "__level", F.explode(odd).alias("__node"))
    inner = inner.join(F.broadcast(tree), ["__level", "__node"]).select("__lo", "__hi", *totals.names)  # two nodes a range at most

    # the ranges of its ends: their instants, then the windows that ask
    dealt_rows = r.withColumn("__copy", F.explode(F.sequence(F.lit(0), F.element_at(table, F.col("__r") + 1) - 1)))
    asked = s.withColumn("__r", F.explode(F.array_distinct(F.array("__from", "__to"))))
    asked = asked.withColumn("__copy", F.pmod(F.xxhash64("__lo", "__hi"), F.element_at(table, F.col("__r") + 1)).cast("int"))
    zero = [F.lit(0).cast("long").alias(p) for p in totals.names]
    events = dealt_rows.select("__r", "__copy", F.lit(0).alias("__kind"), F.col("__t").alias("__at"), F.lit(0).cast("long").alias("__hi"), *totals.names)
    events = events.unionByName(asked.select("__r", "__copy", F.lit(1).alias("__kind"), F.col("__lo").alias("__at"), "__hi", *zero))
    dealt = events.repartition("__r", "__copy").sortWithinPartitions("__r", "__copy", "__kind", "__at")
    ops, names = totals.ops, ["__lo", "__hi", *totals.names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, held, trees, times = None, [], None, None
        for batch in batches:
            cols = [c.to_numpy() for c in batch.columns]
            turns = np.flatnonzero(np.any([np.diff(c) != 0 for c in cols[:3]], axis=0)) + 1
            for lo, hi in zip([0, *turns], [*turns, batch.num_rows], strict=True):
                if lo == hi:
                    continue
                if (cols[0][lo], cols[1][lo]) != place:
                    place, held, trees = (cols[0][lo], cols[1][lo]), [], None
                if cols[2][lo] == 0:
                    held.append([cols[3][lo:hi], *(c[lo:hi] for c in cols[5:])])
                    continue
                if trees is None:
                    times, *parts = (np.concatenate(c) for c in zip(*held, strict=True)) if held else [np.zeros(0, np.int64)] * (1 + len(ops))
                    held, trees = [], [_levels(v, op) for v, op in zip(parts, ops, strict=True)]
                starts, stops = cols[3][lo:hi], cols[4][lo:hi]
                a, b = np.searchsorted(times, starts, "left"), np.searchsorted(times, stops, "left")
                some = np.flatnonzero(a < b)
                found = [_over(v, op, a[some], b[some]) for v, op in zip(trees, ops, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (starts[some], stops[some], *found)], names=names)

    at_ends = dealt.mapInArrow(run, ", ".join(f"{c} long" for c in names))
    return inner.unionByName(at_ends).groupBy("__lo", "__hi").agg(*totals.merged)


def interval_join(
    rows: DataFrame,
    ts: str,
    windows: DataFrame,
    start: str,
    end: str,
    bounds: str = "(]",
    max_windows: int = MAX_WINDOWS,
    ranges: int | None = None,
    totals: dict[str, tuple[str, str | None]] | None = None,
) -> DataFrame:
    """Every pair of a row and a window whose bounds contain ``ts``, with all columns
    of both. ``max_windows`` and ``MAX_SEGMENT_ROWS`` bound the segment form, ``ranges``
    sets the ranges of the sweep (from the rows if left out). Null times and null ends
    match nothing. With ``totals`` (see ``_Totals``), every window row that has rows,
    once, with the totals over them in place of the rows' columns."""
    if bounds not in ("[)", "(]", "[]", "()"):
        raise ValueError(f"unknown bounds {bounds!r}")
    clash = set(rows.columns if totals is None else totals) & set(windows.columns)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    spans = _half_open(windows, start, end, bounds)
    timed = rows.withColumn("__t", as_number(rows, ts)).where(F.col("__t").isNotNull())
    few = spans.select("__lo", "__hi").limit(max_windows + 1).collect()
    edges = _segment_edges(few) if len(few) <= max_windows else None
    if totals is None:
        return _by_sweep(timed, spans, ranges) if edges is None else _by_segments(timed, spans, edges)
    parts, each = _Totals(rows, totals), spans.select("__lo", "__hi").distinct()
    each = _sweep_totals(timed, each, ranges, parts) if edges is None else _segment_totals(timed, each, edges, parts)
    return spans.join(each, ["__lo", "__hi"]).select(*windows.columns, *parts.out)


def _segment_edges(few: list[tuple[int, int]]) -> list[int] | None:
    """The sorted ends of the windows, if their segments are exact and few enough."""
    edges = sorted({e for w in few for e in w})
    at = {e: k for k, e in enumerate(edges)}
    exact = all(abs(e) < _EDGE for e in edges)
    return edges if exact and sum(at[hi] - at[lo] for lo, hi in few) <= MAX_SEGMENT_ROWS else None
