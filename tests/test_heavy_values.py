"""Most frequent values of wide fields against counts of all values."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from docflow.operators import profile as P

SCHEMA = "a string, b long, field string, cell long, n long, value string"


def frame(spark, rows):
    return spark.createDataFrame([(a, b, "x", 1, 2, "v") for a, b in rows], SCHEMA)


def exact(rows, top):
    out = set()
    for at, name in enumerate("ab"):
        counts = Counter(None if r[at] is None else str(r[at]) for r in rows)
        order = sorted(counts, key=lambda v: (-counts[v], v is not None, v or ""))
        out |= {(name, v, counts[v], k + 1) for k, v in enumerate(order[:top])}
    return out


@pytest.mark.parametrize("cells", [1, 7, 65_536])
def test_equal_counts_nulls_and_repeats(spark, cells):
    rng = random.Random(5)
    rows = [(f"w{int(rng.paretovariate(0.8)) % 900}", rng.randrange(400)) for _ in range(3_000)]
    rows += [(None, None)] * 300 + [("", -1)] * 40 + [("tie1", 7_000)] * 9 + [("tie2", 7_001)] * 9
    got = P.heavy_values(frame(spark, rows), ["a", "b"], 12, cells)
    assert {tuple(r) for r in got.select("field", "value", "n", "rank").collect()} == exact(rows, 12)


def test_few_values_and_none(spark):
    rows = [("p", 1), ("p", 2), (None, 2)]
    got = P.heavy_values(frame(spark, rows), ["a", "b"], 5)
    assert {tuple(r) for r in got.select("field", "value", "n", "rank").collect()} == exact(rows, 5)
    assert P.heavy_values(frame(spark, []), ["a", "b"], 5).count() == 0


def test_uneven_counts_open_few_cells(spark):
    """200,000 rows, a third of one value: few rows of the tail are grouped by value."""
    df = spark.range(200_000).select(F.when(F.col("id") % 3 == 0, -1).when(F.col("id") % 3 == 1, F.col("id") % 40).otherwise(F.col("id")).alias("v"))
    values = P._field_values(df, ["v"], P.CELLS)
    per_cell = values.groupBy("field", "cell").agg(F.count(F.lit(1)).alias("n"))
    opened = P.open_cells(values, per_cell, 20)
    distinct = values.join(opened, ["field", "cell"], "left_semi").select("value").distinct().count()
    assert distinct < 500  # of 66,708
    got = P.heavy_values(df, ["v"], 20).orderBy("rank").collect()
    assert (got[0].value, got[0].n) == ("-1", 66_667) and len(got) == 20 and all(0 <= int(r.value) < 40 for r in got[1:])
