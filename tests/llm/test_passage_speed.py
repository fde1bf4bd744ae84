"""op9's whole-array steps against their plain definitions."""

import random

import numpy as np

from docflow.llm import substring
from docflow.llm.common import mix64, window_hashes


def test_capped_windows_are_the_tree_nodes_of_each_document():
    rng = np.random.default_rng(3)
    for kinds, span in ((1000, 10), (6, 10), (10**9, substring.SPAN)):  # few kinds: many equal hashes
        sizes = [span - 1, span, 300, 0, 77, span + 1]
        gap = np.zeros(4, dtype=np.uint64)
        docs = [mix64(rng.integers(0, kinds, n).astype(np.uint64)) for n in sizes]
        all_ = np.concatenate([gap, *(x for d in docs for x in (d, gap))])
        ends = np.cumsum(np.array(sizes) + 4)
        starts = ends - sizes
        c, before, after = substring.capped_windows(all_, starts, ends, span)
        want = sorted((int(s + m), min(m - lo, span), min(hi - m, span)) for s, d in zip(starts, docs, strict=True) for lo, m, hi in substring.compact_windows(d, span).tolist())
        assert sorted(zip(c.tolist(), before.tolist(), after.tolist(), strict=True)) == want


def test_stretches_hold_the_minimum_inside_the_window():
    rng = np.random.default_rng(5)
    s = rng.integers(0, 1 << 60, 120, dtype=np.uint64)
    key = np.array([7, 9, 11], dtype=np.uint64)
    c, before, after = (np.array(x, dtype=np.int32) for x in ((0, 60, 119), (0, substring.SPAN, substring.SPAN), (substring.SPAN, 25, 1)))
    got = sorted((int(k), int(r)) for keys, rows in substring._stretches(s, key, c, before, after) for k, r in zip(keys, rows, strict=True))
    want = []
    for r in range(3):
        for level in substring.LEVELS:
            hashes = window_hashes(s, level, seed=31)
            for k in range(level):
                at = int(c[r]) - k
                if k <= before[r] and level - k <= after[r] and 0 <= at < len(hashes):
                    want.append((int(mix64(key[r : r + 1] ^ mix64(hashes[at : at + 1] + np.uint64(level * substring.SPAN + k)))[0]), r))
    assert got == sorted(want)


def test_pairs_compared_once_are_not_compared_again(spark):
    """A divided group that gives a pair the same alignments as the first pass."""
    rng = random.Random(4)
    word = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    passage = word(60)
    docs = spark.createDataFrame([(k, f"{word(30 + k)} {passage} {word(40 + k)}") for k in range(4)], "doc_id long, text string")
    members = substring.shared_windows(substring.written(substring.window_table(docs, "doc_id", "text"), "t"), "t")
    first = substring.written(substring.document_pairs(substring.with_heads(members)), "t-pairs")
    parts = substring.stretch_table(members, docs).cache()
    found = {(r.doc, r.other, tuple(r.shifts)) for r in first.collect()}
    assert found >= {(k, 0, (-k,)) for k in (1, 2, 3)}
    assert parts.count() > members.count()
    assert substring.stretch_pairs(parts, first).count() == 0
    again = substring.stretch_pairs(parts, first.where("doc = 3")).collect()
    assert {(r.doc, r.other, tuple(r.shifts)) for r in again} == {x for x in found if x[0] != 3} and not any(r.hits for r in again)
