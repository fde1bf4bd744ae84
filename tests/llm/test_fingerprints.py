"""Fingerprints: edited texts against Python, likeness against the true generalised
Jaccard similarity."""

import contextlib
import hashlib
import io
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from docflow.llm import fingerprints as P
from docflow.sources.tables import table
from tests.conftest import SF_SMALL

SCHEMA = "doc_id long, text string, n int, h string, i int, id int, text_sha string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "h", 2, 3, "s") for i, t in rows], SCHEMA)


def bag(text):
    return Counter(w for w in re.split("[ \t-\r]+", (text or "").lower()) if w)


def jaccard(a, b):
    return sum((a & b).values()) / sum((a | b).values()) if a or b else 1.0


def brute(rows):
    """(id, text) of distinct rows with distinct ids -> id -> (edited, next text)."""
    order = sorted(set(rows), key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = {}
    for k, (i, t) in enumerate(order):
        nxt = order[(k + 1) % len(order)][1] or ""
        t = t or ""
        m = len(t) // 2
        out[i] = (t[: len(t) - m] + nxt[:m], nxt)
    return out


def check(got, rows):
    want, texts = brute(rows), dict(rows)
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got) == sorted((i is None, i or 0) for i, _ in rows)
    errors, seen = [], {}
    for r in got:
        text, (edited, nxt) = texts[r.doc_id] or "", want[r.doc_id]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert seen.setdefault(text, r.fingerprint) == r.fingerprint
        assert seen.setdefault(edited, r.edited_fingerprint) == r.edited_fingerprint
        for near, other in ((r.near_edited, edited), (r.near_next, nxt)):
            a, b = bag(text), bag(other)
            assert 0 <= near <= 1 and (near == 1 if a == b else True)
            errors.append(near - jaccard(a, b))
        parts = [r.fingerprint[k : k + 7] for k in range(0, len(r.fingerprint), 7)]
        other = [r.edited_fingerprint[k : k + 7] for k in range(0, len(r.edited_fingerprint), 7)]
        assert len(parts) in (0, P.SAMPLES)
        if parts and other:
            assert r.near_edited == sum(x == y for x, y in zip(parts, other, strict=True)) / P.SAMPLES
    return errors


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    words = [f"w{i}" for i in range(60)] + ["É", "ß", "日本", "😀"]
    texts = [" ".join(rng.choices(words, k=rng.randrange(1, 120))) for _ in range(120)]
    texts += [None, "", " ", "\n\t ", "one", "ONE", "x" * 50_000, " lead and trail ", texts[3], texts[3], " ".join(rng.choices(words, k=60_000))]
    return [(3 * i, t) for i, t in enumerate(texts)] + [(None, "no id"), (-5, "a b c d")]


def test_against_brute_force(spark, rows):
    errors = check(P.edited_fingerprints(frame(spark, rows)).collect(), rows)
    assert abs(np.mean(errors)) < 0.02 and np.max(np.abs(errors)) < 0.45


def test_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()]
    errors = check(P.op13_document_fingerprints(spark, SF_SMALL).collect(), rows)
    assert abs(np.mean(errors)) < 0.015 and np.std(errors) < 0.5 / np.sqrt(P.SAMPLES)


def test_weights_count(spark):
    """Equal words, different counts: the collision rate is the generalised Jaccard similarity."""
    rng = random.Random(8)
    rows, truth = [], []
    for i in range(300):
        a = Counter({f"t{i}-{k}": rng.randrange(1, 9) for k in range(12)})
        b = Counter({w: rng.randrange(1, 9) for w in a})
        rows.append((i, " ".join(a.elements()), " ".join(b.elements())))
        truth.append(jaccard(a, b))
    df = spark.createDataFrame(rows, "k long, a string, b string")
    got = P.fingerprint_pairs(df, ["k"], "a", "b").select("k", P.likeness(F.col("first"), F.col("second")).alias("near")).orderBy("k").collect()
    errors = np.array([r.near for r in got]) - np.array(truth)
    assert abs(errors.mean()) < 0.02 and errors.std() < 0.11
    assert np.corrcoef([r.near for r in got], truth)[0, 1] > 0.4


def test_repeated_rows_and_small_tables(spark):
    assert P.edited_fingerprints(frame(spark, [])).collect() == []
    one = P.edited_fingerprints(frame(spark, [(1, "a b c d")])).collect()
    assert len(one) == 1 and one[0].near_next == 1.0 and one[0].edited_sha256 == hashlib.sha256(b"a b a b").hexdigest()
    rows = [(1, "p q r s"), (2, "t u v w")]
    got = P.edited_fingerprints(frame(spark, rows * 3)).collect()
    assert len(got) == 6 and len({tuple(r) for r in got}) == 2
    assert {r.edited_sha256 for r in got if r.doc_id == 2} == {hashlib.sha256(b"t u p q").hexdigest()}
    twice = P.edited_fingerprints(frame(spark, [(1, "a"), (1, "b"), (None, None), (None, "c")])).collect()
    assert sorted(str(r.doc_id) for r in twice) == ["1", "1", "None", "None"]


def test_neighbours_across_ranges(spark):
    """More ranges than documents, empty ranges included."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = [(i * i, f"text number {i} of all") for i in range(9)]
        check(P.edited_fingerprints(frame(spark, rows)).collect(), rows)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_main_path_is_native(spark, monkeypatch):
    plans, written = [], P.written

    def spy(df, name):
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        plans.append(buf.getvalue())
        return written(df, name)

    monkeypatch.setattr(P, "written", spy)
    P.op13_document_fingerprints(spark, SF_SMALL)
    text = "".join(plans)
    assert len(plans) == 4
    assert not any(w in text for w in ("Python", "Pandas", "InArrow", "CartesianProduct", "NestedLoop"))
