"""Interval joins and order statistics against plain Python."""

import contextlib
import datetime as dt
import io
import random

import pytest
from pyspark.sql import functions as F

from docflow.operators import batches as B
from docflow.operators import selection
from docflow.operators.intervals import interval_join
from docflow.operators.selection import range_number, select_keys

T0 = dt.datetime(2020, 3, 29, 1, 0, 0)


def pairs(rows, windows, bounds):
    out = []
    for i, t in rows:
        for w, s, e in windows:
            if t is None or s is None or e is None:
                continue
            if (t >= s if bounds[0] == "[" else t > s) and (t <= e if bounds[1] == "]" else t < e):
                out.append((i, w))
    return sorted(out)


@pytest.fixture(scope="module")
def data():
    rng = random.Random(5)
    times = [T0 + dt.timedelta(minutes=rng.randrange(60_000)) for _ in range(300)] + [T0 + dt.timedelta(days=3)] * 200 + [None, T0]
    rows = list(enumerate(times))
    lengths = [0, 1, 30, 1440, 10_000, 10_000_000, -5]
    windows = [(k, s, s + dt.timedelta(minutes=rng.choice(lengths))) for k in range(60) for s in [T0 + dt.timedelta(minutes=rng.randrange(-1000, 60_000))]]
    windows += [(900, T0 - dt.timedelta(days=9000), T0 + dt.timedelta(days=9000)), (901, None, T0), (902, T0, None), (903, T0, T0), (904, *windows[3][1:])]
    windows.append((905, T0 + dt.timedelta(days=3), T0 + dt.timedelta(days=3)))
    return rows, windows


@pytest.mark.parametrize("bounds", ["[)", "(]", "[]", "()"])
@pytest.mark.parametrize("form", [{}, {"max_windows": 0}, {"max_windows": 0, "ranges": 9}, {"max_windows": 0, "ranges": 64}])
def test_interval_join(spark, data, bounds, form):
    rows, windows = data
    r = spark.createDataFrame([(i, t, {"a": i}) for i, t in rows], "i long, t timestamp_ntz, m map<string,long>")
    w = spark.createDataFrame(windows, "w long, s timestamp_ntz, e timestamp_ntz")
    got = interval_join(r, "t", w, "s", "e", bounds, **form)
    assert got.columns == ["i", "t", "m", "w", "s", "e"]
    assert sorted((x.i, x.w) for x in got.collect()) == pairs(rows, windows, bounds)


@pytest.mark.parametrize("bounds", ["(]", "[)"])
@pytest.mark.parametrize("form", [{}, {"max_windows": 0}, {"max_windows": 0, "ranges": 9}, {"max_windows": 0, "ranges": 64}])
def test_interval_totals(spark, data, bounds, form):
    """Totals of each window row equal those of its pairs; windows that come twice stay two,
    null values are passed over, windows without rows are left out."""
    rows, windows = data
    windows = windows + windows[:5]
    value = {i: None if i % 7 == 0 else (i * 31) % 101 - 50 for i, _ in rows}
    r = spark.createDataFrame([(i, t, value[i]) for i, t in rows], "i long, t timestamp_ntz, v int")
    w = spark.createDataFrame([(*x, {"w": x[0]}) for x in windows], "w long, s timestamp_ntz, e timestamp_ntz, m map<string,long>")
    totals = {"n": ("count", None), "least": ("min", "v"), "most": ("max", "v"), "last": ("max", "t")}
    got = interval_join(r, "t", w, "s", "e", bounds, totals=totals, **form)
    assert got.columns == ["w", "s", "e", "m", "n", "least", "most", "last"]
    assert dict(got.dtypes)["least"] == "int" and dict(got.dtypes)["last"] == "timestamp_ntz"
    want, times = [], dict(rows)
    for x in windows:
        met = [i for i, _ in pairs(rows, [x], bounds)]
        values = [value[i] for i in met if value[i] is not None]
        if met:
            want.append((x[0], len(met), min(values, default=None), max(values, default=None), max(times[i] for i in met)))
    key = lambda x: tuple(str(v) for v in x)
    assert sorted([(x.w, x.n, x.least, x.most, x["last"]) for x in got.collect()], key=key) == sorted(want, key=key)


def test_interval_totals_make_no_pairs(spark):
    """200 million pairs of 20,000 rows and as many windows that hold half of them each."""
    rows = spark.range(20_000)
    w = rows.select(F.col("id").alias("w"), (F.col("id") - 10_000).alias("lo"))
    w = w.select("w", F.greatest("lo", F.lit(0)).alias("lo"), F.greatest("w", F.lit(10_000)).alias("hi"))
    for form in ({"max_windows": 0, "ranges": 16}, {}):
        got = interval_join(rows, "id", w, "lo", "hi", "[)", totals={"n": ("count", None), "a": ("min", "id"), "b": ("max", "id")}, **form)
        assert got.where("n <> hi - lo OR a <> lo OR b <> hi - 1").count() == 0 and got.count() == 20_000
    with pytest.raises(ValueError):
        interval_join(rows, "id", w, "lo", "hi", totals={"n": ("mean", "id")})


def test_interval_join_over_clock_changes_and_types(spark, data):
    """Zone-free times are joined by the wall clock in any session zone."""
    rows, windows = data
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        r = spark.createDataFrame([(i, t) for i, t in rows], "i long, t timestamp_ntz")
        w = spark.createDataFrame(windows, "w long, s timestamp_ntz, e timestamp_ntz")
        for form in ({}, {"max_windows": 0, "ranges": 5}):
            assert sorted((x.i, x.w) for x in interval_join(r, "t", w, "s", "e", "[)", **form).collect()) == pairs(rows, windows, "[)")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    n = spark.range(20)
    w = spark.createDataFrame([(3, 7), (5, 100), (9, 9)], "lo int, hi int")
    for form in ({}, {"max_windows": 0}):
        got = sorted((x.id, x.lo) for x in interval_join(n, "id", w, "lo", "hi", "[)", **form).collect())
        assert got == sorted([(i, 3) for i in range(3, 7)] + [(i, 5) for i in range(5, 20)])
    with pytest.raises(TypeError):
        interval_join(n.select(F.col("id").cast("string").alias("id")), "id", w, "lo", "hi")
    with pytest.raises(ValueError):
        interval_join(n.withColumnRenamed("id", "lo"), "lo", w, "lo", "hi")


def test_interval_join_of_empty_sides(spark):
    n, w = spark.range(0), spark.createDataFrame([(1, 2)], "lo long, hi long")
    for form in ({}, {"max_windows": 0}):
        assert interval_join(n, "id", w, "lo", "hi", **form).collect() == []
        assert interval_join(spark.range(5), "id", w.limit(0), "lo", "hi", **form).collect() == []
        for a, b in ((n, w), (spark.range(5), w.limit(0))):
            assert interval_join(a, "id", b, "lo", "hi", totals={"k": ("count", None)}, **form).collect() == []


def test_no_row_per_day_and_no_nested_loop(spark):
    """A window of a century adds rows per range, not per day, to the plan of either form."""
    rows = spark.range(1000).select("id", (F.lit("1990-01-01").cast("date") + F.col("id").cast("int")).alias("d"))
    w = spark.createDataFrame([(1, dt.date(1900, 1, 1), dt.date(2100, 1, 1))], "w int, s date, e date")
    for form in ({}, {"max_windows": 0, "ranges": 4}):
        j = interval_join(rows, "d", w, "s", "e", "[)", **form)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            j.explain("formatted")
        assert "NestedLoop" not in buf.getvalue() and "Cartesian" not in buf.getvalue()
        assert j.count() == 1000


@pytest.mark.parametrize("seed", range(3))
def test_select_keys(spark, seed):
    rng = random.Random(seed)
    day = dt.date(2001, 1, 1)
    rows = [(None if rng.random() < 0.02 else day + dt.timedelta(days=rng.choice([0, 0, 0, 1, 5, 4000])), rng.choice([-(1 << 62), 0, 7, 1 << 62]) + i) for i in range(500)]
    df = spark.createDataFrame(rows, "d date, k long")
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or day, r[1]))
    ranks = [1, 2, 17, 250, 251, 499, 500, 501, 0]
    got = select_keys(df, ["d", "k"], ranks)
    want = [(order[r - 1][1], r) for r in sorted(ranks) if 1 <= r <= 500]
    assert [(key[1], below) for key, below in got] == want
    cuts = [key for key, _ in got]
    numbers = df.withColumn("g", range_number(df, ["d", "k"], cuts)).collect()
    place = {r: i + 1 for i, r in enumerate(order)}
    for row in numbers:
        assert row.g == sum(1 for _, r in want if r < place[(row.d, row.k)])


def test_select_keys_with_equal_rows(spark):
    """Rows that the order can't tell apart lie on one side of a key."""
    df = spark.createDataFrame([(k,) for k in [1] * 10 + [2] * 30 + [3]], "k long")
    assert select_keys(df, ["k"], [5, 11, 40, 41]) == [((1,), 10), ((2,), 40), ((3,), 41)]
    assert select_keys(df.limit(0), ["k"], [1]) == []


@pytest.mark.parametrize("groups", [1, 2, 9, None])
def test_row_numbers_without_a_checkpoint(spark, groups, monkeypatch):
    rng = random.Random(1)
    rows = [(rng.choice(["2020-01-01", "2020-01-02", None]), k) for k in range(400)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "d string, k long").withColumn("d", F.col("d").cast("date"))
    monkeypatch.setattr(type(df), "checkpoint", None)
    got = B.global_row_number(df, ["d", "k"], n_partitions=groups)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        got.explain("formatted")
    assert "rangepartitioning" not in buf.getvalue()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    assert sorted((r.rn, r.k) for r in got.collect()) == [(i + 1, r[1]) for i, r in enumerate(order)]


@pytest.mark.parametrize("size", [1, 7, 100, 1000])
def test_ledger_by_selection_equals_the_numbered_one(spark, size):
    rng = random.Random(3)
    rows = [(dt.datetime(2020, 1, 1) + dt.timedelta(hours=rng.randrange(90)), k) for k in range(310)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, k long")
    a = B.ledger_by_selection(df, ["ts", "k"], size)
    b = B.batch_ledger(B.number_batches(df, ["ts", "k"], size), "batch_no", "ts")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.select(*a.columns).collect()))
    assert B.ledger_by_selection(df.limit(0), ["ts", "k"], size).collect() == []


def test_selection_reads_the_rows_a_few_times(spark, monkeypatch):
    """Cells shrink to the least and largest value found in them: sparse days of far-off
    years are settled by one pass, their keys by few more, whatever the number of ranks."""
    days = F.timestamp_micros(F.col("id") % 50 * 86_400_000_000 * 97).cast("timestamp_ntz")
    df = spark.range(5000).select(days.alias("d"), (F.col("id") * 1_000_000_007).alias("k"))
    passes, counts = [], selection._counts
    monkeypatch.setattr(selection, "_counts", lambda *a: passes.append(a[2]) or counts(*a))
    cuts = select_keys(df, ["d", "k"], list(range(10, 5001, 10)))
    want = sorted((i % 50 * 86_400_000_000 * 97, i * 1_000_000_007) for i in range(5000))
    assert cuts == [(want[r - 1], r) for r in range(10, 5001, 10)]
    assert passes.count(0) == 1 and passes.count(1) <= 2
