"""Near-duplicate groups whose buckets stay open after the first star."""

import random

import pytest

from docflow.llm import minhash
from tests.llm.test_operators import frame, near_components, shingle_sets


def chained(rng, n, size=100, edits=9):
    base = [f"w{rng.randrange(5000)}" for _ in range(size)]
    docs = []
    for i in range(n):
        w = list(base)
        for at in rng.sample(range(size), rng.randrange(0, edits)):
            w[at] = f"e{rng.randrange(10_000)}"
        docs.append((i, " ".join(w)))
    return docs


@pytest.mark.parametrize("pivots,block", [(8, 4096), (1, 16)])
def test_chained_copies(spark, monkeypatch, pivots, block):
    """Every link counts, whether rounds of pivots or blocks find it."""
    monkeypatch.setattr(minhash, "PIVOTS", pivots)
    monkeypatch.setattr(minhash, "BLOCK_DOCS", block)
    docs = chained(random.Random(pivots), 600)
    got = {r.doc_id: r.component_id for r in minhash.near_groups(frame(spark, docs), 4).collect()}
    assert got == near_components(shingle_sets(docs, 4))


def test_rows_of_a_large_open_bucket(spark, monkeypatch):
    """Members of the largest component are copied once per block of the others,
    not once per block of the bucket; pivots give PIVOTS rows a member at most."""
    monkeypatch.setattr(minhash, "BLOCK_DOCS", 100)
    n, others = 10_000, 30
    rows = [(0, 7, r, 50, 0 if r < n else r) for r in range(n + others)]
    placed = spark.createDataFrame(rows, "band int, key long, rep long, n long, component long")
    found = placed.select(placed["rep"].alias("node"), "component").distinct()
    rest = minhash._open_members(placed.drop("component"), found)
    assert rest.count() == n + others
    assert minhash._blocks(rest).count() == n + others * (n // 100 + 1)
    assert minhash._pivot_pairs(rest, 1).count() <= minhash.PIVOTS * (n + others)
    # every pair of two components meets in exactly one block pair
    monkeypatch.setattr(minhash, "BLOCK_DOCS", 3)
    few = [(0, 7, r, 50, r // 4 if r < 8 else r) for r in range(20)]
    placed = spark.createDataFrame(few, "band int, key long, rep long, n long, component long")
    rest = minhash._open_members(placed.drop("component"), placed.select(placed["rep"].alias("node"), "component"))
    comp, met, blocks = {r[2]: r[4] for r in few}, [], {}
    for r in minhash._blocks(rest).collect():
        blocks.setdefault((r.i, r.j), []).append((r.rep, r.part))
    for (i, j), held in blocks.items():
        met += [tuple(sorted((a, b))) for a, p in held for b, q in held if comp[a] != comp[b] and (a < b if i == j else p == i and q == j)]
    assert sorted(met) == sorted((a, b) for a in comp for b in comp if a < b and comp[a] != comp[b])


def test_buckets_without_rest(spark):
    placed = spark.createDataFrame([(0, 7, 1, 5), (0, 7, 2, 5)], "band int, key long, rep long, n long")
    found = spark.createDataFrame([(1, 1), (2, 1)], "node long, component long")
    assert minhash._open_members(placed, found).count() == 0
