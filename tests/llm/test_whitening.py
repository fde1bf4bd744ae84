"""Whitening against exact integers and a dense eigen-decomposition."""

import math

import numpy as np
import pytest

from docflow.llm import whitening
from docflow.sources.tables import table
from tests.conftest import SF_MED

SCHEMA = "vec_id long, embedding array<float>, x int, n string, dim int, w int, component int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "n", 2, 3, 4) for i, v in rows], SCHEMA)


def brute(rows, k=4, weights="one"):
    xs = {}
    for i, v in rows:
        if v and all(c is not None and math.isfinite(c) for c in v):
            xs.setdefault(len(v), []).append((i, tuple(math.floor(256 * float(np.float32(c))) for c in v)))
    out = []
    for d, members in xs.items():
        counts = {}
        for _, x in members:
            counts[x] = counts.get(x, 0) + 1
        w = {x: 1 if weights == "one" else c for x, c in counts.items()}
        n = sum(w.values())
        sums = [sum(x[j] * w[x] for x in counts) for j in range(d)]
        centred = {x: np.array([(n * x[j] - sums[j]) / n for j in range(d)]) for x in counts}
        cov = sum(w[x] * np.outer(c, c) for x, c in centred.items()) / n
        values, vectors = np.linalg.eigh(cov)
        order = np.argsort(-values)
        for j in range(min(k, d)):
            e = values[order[j]]
            if e > values[order[0]] * d * 1e-13 and e > 0:
                for i, x in members:
                    dev = sum((n * x[q] - sums[q]) ** 2 for q in range(d))
                    out.append((i, j + 1, n, dev, abs(float(centred[x] @ vectors[:, order[j]])) / math.sqrt(e), e / np.trace(cov)))
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0, r[1], r[4]))


def check(got, want):
    got = sorted(got, key=lambda r: (r.vec_id is None, r.vec_id or 0, r.component, abs(r.whitened)))
    assert [(r.vec_id, r.component, r.n, r.deviation) for r in got] == [w[:4] for w in want]
    for r, w in zip(got, want, strict=True):
        assert abs(r.whitened) == pytest.approx(w[4], abs=1e-8)
        assert r.explained == pytest.approx(w[5], rel=1e-9)
        assert r.identity_error < 1e-8


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    base = rng.normal(0, 0.3, (60, 6)) * np.array([5, 3, 2, 1, 0.5, 0.1])
    out = [(i, [float(c) for c in v]) for i, v in enumerate(base)]
    out += [(1000 + i, out[7][1]) for i in range(400)]  # one vector with most rows
    out += [(2000 + i, [float(c) + 1e-5 for c in out[3][1]]) for i in range(5)]
    out += [(3, out[3][1]), (None, out[4][1]), (5000, None), (5001, []), (5002, [1.0, None, 2.0, 3.0, 4.0, 5.0]), (5003, [1.0, math.nan, 2.0, 3.0, 4.0, 5.0]), (5004, [math.inf] * 6)]
    out += [(6000 + i, [float(i % 3), float(i)]) for i in range(9)]  # another length
    return out


@pytest.mark.parametrize("weights", ["one", "count"])
def test_against_brute_force(spark, rows, weights):
    got = whitening.whiten(frame(spark, rows), weights=weights).collect()
    check(got, brute(rows, weights=weights))


def test_sign_and_order(spark, rows):
    got = whitening.whiten(frame(spark, rows)).toPandas()
    six = got[got["n"] > 10]
    shares = six.groupby("component")["explained"].first()
    assert list(shares) == sorted(shares, reverse=True)
    again = whitening.whiten(frame(spark, rows[::-1])).toPandas()
    a = six.groupby(["vec_id", "component"])["whitened"].first()
    b = again[again["n"] > 10].groupby(["vec_id", "component"])["whitened"].first()
    assert np.allclose(a, b, atol=1e-9)


def test_degenerate_inputs(spark):
    assert whitening.whiten(frame(spark, [])).collect() == []
    assert whitening.whiten(frame(spark, [(1, None), (2, [])])).collect() == []
    assert whitening.whiten(frame(spark, [(i, [1.0, 2.0]) for i in range(5)])).collect() == []  # no variance
    line = [(i, [float(i), 2.0 * i]) for i in range(5)]  # rank one
    got = whitening.whiten(frame(spark, line)).collect()
    assert {r.component for r in got} == {1} and got[0].explained == pytest.approx(1.0)
    with pytest.raises(ValueError):
        whitening.whiten(frame(spark, line), weights="two")


def test_entries_beyond_a_long(spark):
    big = [(1, [3e38, 1.0]), (2, [-3e38, 2.0]), (3, [1.0, 3.0])]
    got = whitening.whiten(frame(spark, big)).collect()
    assert {r.deviation for r in got} == {None} or all(r.deviation is None for r in got if r.vec_id != 3)


def test_query_on_the_whole_table(spark):
    src = [(r.vec_id, r.embedding) for r in table(spark, SF_MED, "embeddings").select("vec_id", "embedding").collect()]
    check(whitening.op11_embedding_whitening(spark, SF_MED).collect(), brute(src))
