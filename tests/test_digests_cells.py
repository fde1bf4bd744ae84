"""Digest-tree differences and pruned vector search against full comparisons."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from docflow.operators import digests as D
from docflow.operators import vector_cells as VC
from docflow.operators.vectors import embedding_top_k

FIELDS = {"a": ("a", "a"), "b": ("b", "other")}


def brute(source, target):
    from collections import Counter

    s, t = {}, {}
    for rows, side in ((source, s), (target, t)):
        for k, *v in rows:
            side.setdefault(k, Counter())[tuple(v)] += 1
    out = []
    for k in s.keys() | t.keys():
        if s.get(k) != t.get(k):
            kind = "missing" if k not in t else "extra" if k not in s else "changed"
            out.append((k, kind, sum(s.get(k, {}).values()), sum(t.get(k, {}).values())))
    return sorted(out, key=str)


def frames(spark, source, target):
    return spark.createDataFrame(source, "k long, a string, b int"), spark.createDataFrame(target, "k long, a string, other long")


@pytest.mark.parametrize("leaf", [1, 64])
@pytest.mark.parametrize("max_open", [3, D.MAX_OPEN])
def test_differences(spark, leaf, max_open):
    rng = random.Random(2)
    source = [(k % 3000, rng.choice(["x", "y", None]), rng.choice([1, 2, None])) for k in range(6000)]
    target = list(source)
    for at in rng.sample(range(len(target)), 40):
        target[at] = (target[at][0], "changed", 9)
    del target[17:25]
    target += [(10_000 + k, "new", 1) for k in range(7)] + [(None, "n", 1), source[5]]
    source += [(None, "n", 2), (77_777, None, None)]
    s, t = frames(spark, source, target)
    got = D.digest_differences(s, t, "k", FIELDS, leaf, max_open).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(source, target)


def test_swapped_values_and_repeats_are_seen(spark):
    """Order-free sums still see values that change places, and a row that is there twice more."""
    s, t = frames(spark, [(1, "p", 1), (2, "q", 2), (3, "r", 3)], [(1, "q", 2), (2, "p", 1), (3, "r", 3), (3, "r", 3), (3, "r", 3)])
    got = {r.k: (r.side, r.source_rows, r.target_rows) for r in D.digest_differences(s, t, "k", FIELDS).collect()}
    assert got == {1: ("changed", 1, 1), 2: ("changed", 1, 1), 3: ("changed", 1, 3)}


def test_equal_and_empty_tables(spark):
    rows = [(k, "x", k) for k in range(100)]
    s, t = frames(spark, rows, rows[::-1])
    assert D.digest_differences(s, t, "k", FIELDS).collect() == []
    assert D.digest_differences(s.limit(0), t.limit(0), "k", FIELDS).collect() == []
    assert len(D.digest_differences(s, t.limit(0), "k", FIELDS).collect()) == 100


def test_rows_compared_grow_with_the_differences(spark):
    base = spark.range(400_000).select(F.col("id").alias("k"), F.col("id").cast("string").alias("a"), (F.col("id") % 7).cast("int").alias("b"))
    read = {}
    for changed in (5, 50):
        other = base.select("k", F.when(F.col("k") % (400_000 // changed) == 3, "z").otherwise(F.col("a")).alias("a"), F.col("b").cast("long").alias("other"))
        s, t, levels = D.suspects(*D.sides(base, other, "k", FIELDS))
        read[changed] = s.count() + t.count()
        assert [bits for bits, _ in levels] == [12, 24] and levels[-1][1] <= changed
        assert D.digest_differences(base, other, "k", FIELDS).count() == changed
    assert read[5] <= 5 * 2 * D.LEAF_ROWS and read[5] < read[50] <= 50 * 2 * D.LEAF_ROWS


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 8)) * 3
    v = centres[rng.integers(0, 12, 1500)] + rng.normal(size=(1500, 8)) * 0.15
    rows = [(i, [float(x) for x in r]) for i, r in enumerate(v)]
    rows += [(2000 + i, rows[3][1]) for i in range(30)]  # ties
    rows += [(3000, None), (3001, [0.0] * 8), (3002, [float("nan")] * 8), (3003, [2 * x for x in rows[3][1]])]
    return rows


@pytest.mark.parametrize("cells", [None, 1, 7])
def test_cells_equal_the_full_search(spark, vectors, cells):
    items = spark.createDataFrame(vectors, "id long, v array<double>")
    clean = items.where("id <> 3002")
    queries = items.where("id % 100 = 3 or id > 2990").select(F.col("id").alias("q"), F.col("v").alias("w"))
    report = {}
    got = VC.cell_top_k(items, "id", "v", queries, "q", "w", 7, cells=cells, report=report)
    want = embedding_top_k(clean, "id", "v", queries.where("q <> 3002"), "q", "w", 7)
    key = lambda r: (r.qid, r.rank)
    a, b = sorted(got.collect(), key=key), sorted(want.collect(), key=key)
    assert [(r.qid, r.rank, r.id) for r in a] == [(r.qid, r.rank, r.id) for r in b]
    assert np.allclose([r.score for r in a], [r.score for r in b], atol=1e-9)
    if cells is None:  # clustered vectors: most cells stay closed
        assert report["scored"] < 0.3 * report["pairs"]


def test_cells_with_few_or_no_vectors(spark, vectors):
    items = spark.createDataFrame(vectors[:3], "id long, v array<double>")
    q = items.select(F.col("id").alias("q"), F.col("v").alias("w"))
    assert VC.cell_top_k(items, "id", "v", q, "q", "w", 5).count() == 9
    assert VC.cell_top_k(items.limit(0), "id", "v", q, "q", "w", 5).collect() == []
    assert VC.cell_top_k(items, "id", "v", q.limit(0), "q", "w", 5).collect() == []


def test_large_cells_are_split(spark, vectors, monkeypatch):
    monkeypatch.setattr(VC, "CELL_BLOCK", 100)
    items = spark.createDataFrame(vectors[:900], "id long, v array<double>")
    q = items.where("id < 5").select(F.col("id").alias("q"), F.col("v").alias("w"))
    got = VC.cell_top_k(items, "id", "v", q, "q", "w", 6, cells=2)
    want = embedding_top_k(items, "id", "v", q, "q", "w", 6)
    assert sorted((r.qid, r.rank, r.id) for r in got.collect()) == sorted((r.qid, r.rank, r.id) for r in want.collect())
