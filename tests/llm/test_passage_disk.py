"""op9's disk and the steps that compare many pairs of documents at once."""

import random

import numpy as np
from pyspark.sql import functions as F

from docflow.llm import substring
from docflow.llm.common import without_shuffles, written


def _shuffle_files(spark) -> set[str]:
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(k).getName() for k in range(files.size()))
    return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}


def _documents(spark, n: int):
    rng = random.Random(4)
    word = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    inner = word(160)
    rows = [(k, f"{word(30 + k)} {inner} {word(40 + k)}") for k in range(n)]
    return spark.createDataFrame([*rows, (n, " ".join(inner.split()[20:90])), (n + 1, " ".join(inner.split()[60:118]))], "doc_id long, text string")


def test_written_tables_leave_no_shuffle_files(spark):
    before = _shuffle_files(spark)
    with without_shuffles(spark):
        got = written(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "t-cleanup")
    assert got.count() == 7
    held = written(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "t-cleanup")
    assert held.count() == 7
    docs = _documents(spark, 4)
    before |= _shuffle_files(spark)
    out = substring.repeated_passages(docs)
    assert _shuffle_files(spark) <= before  # every table but the result is written by now
    assert out.count() > 0
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_stretches_are_made_once_for_equal_windows(spark):
    docs = _documents(spark, 12)
    members = substring.shared_windows(written(substring.window_table(docs, "doc_id", "text"), "t"), "t")
    none = substring.document_pairs(substring.with_heads(members)).where("false")
    parts = written(substring.part_table(members, docs), "t-parts")
    assert parts.count() == members.count()
    few = written(substring.stretch_table(substring.part_heads(parts), docs), "t-few")
    all_ = written(substring.stretch_table(members, docs), "t-all")
    assert few.count() < 0.7 * all_.count()
    rows = lambda df: sorted((r.doc, r.other, tuple(r.shifts)) for r in df.collect())
    assert rows(substring.stretch_pairs(few, none, parts)) == rows(substring.stretch_pairs(all_, none))


def _plain_runs(a: list[int], b: list[int], shifts: list[int]) -> list[tuple[int, int, int]]:
    """The runs by their definition, one place after the other."""
    same = lambda i, j: 0 <= i < len(a) and 0 <= j < len(b) and a[i] == b[j]

    def length(i: int, j: int, step: int) -> int:
        n = 0
        while same(i + step * n, j + step * n):
            n += 1
        return n

    todo = [(i, i + s, length(i, i + s, 1)) for s in shifts for i in range(len(a)) if same(i, i + s) and not same(i - 1, i + s - 1)]
    out = set(todo)
    far = range(substring.GAP + 1)
    while todo:
        i, j, n = todo.pop()
        for x, y, step in ((i + n, j + n, 1), (i - 1, j - 1, -1)):
            best, known = None, set()
            for p in far:
                for q in far:
                    if same(x + step * p, y + step * q) and q - p not in known:
                        known.add(q - p)
                        m = length(x + step * p, y + step * q, step)
                        if best is None or m > best[2]:
                            best = (x + step * p - (m - 1) * (step < 0), y + step * q - (m - 1) * (step < 0), m)
            if best and best not in out:
                out.add(best)
                todo.append(best)
    return sorted(out)


def test_runs_of_many_pairs_are_those_of_each_pair():
    rng = np.random.default_rng(8)
    docs = [rng.integers(0, kinds, n).astype(np.uint64) for kinds, n in ((3, 40), (3, 25), (30, 90), (30, 120), (1, 12), (5, 0), (30, 1))]
    docs.append(np.concatenate([docs[2][:30], docs[3][:9], docs[2][33:]]))
    pairs = [(i, j) for i in range(len(docs)) for j in range(len(docs)) if i != j]
    shifts = [rng.choice(np.arange(-8, 9), 3, replace=False) for _ in pairs]
    both = substring._Pairs(docs, pairs)
    runs = both.runs(np.repeat(np.arange(len(pairs)), 3), np.concatenate(shifts))
    for k, (x, y) in enumerate(pairs):
        got = (runs[runs[:, 0] == k, 1:] - (both.a[k], both.b[k], 0)).tolist()
        assert [tuple(r) for r in got] == _plain_runs(docs[x].tolist(), docs[y].tolist(), shifts[k].tolist())
    alone = [substring.aligned_passages(docs[x], docs[y], s.tolist()) for (x, y), s in zip(pairs, shifts, strict=True)]
    assert substring.passages_of(docs, pairs, shifts) == alone and any(alone)


def test_similarity_is_that_of_the_sets_of_shingles():
    rng = np.random.default_rng(9)
    docs = [rng.integers(0, 40, n).astype(np.uint64) for n in (60, 50)]
    both = substring._Pairs(docs, [(0, 1)])
    for _ in range(200):
        (s, e), (t, u) = (sorted(rng.integers(0, n + 1, 2).tolist()) for n in (60, 50))
        x, y = set(docs[0][s:e].tolist()), set(docs[1][t:u].tolist())
        assert both.similarity(s, e, 60 + t, 60 + u) == len(x & y) / max(1, len(x | y))
