"""Phrase collocations against counting every phrase."""

import random
import re
from collections import Counter

import pytest

from docflow.llm import phrases

SCHEMA = "lang string, text string, rank int, w1 string, f int, phrase string"


def frame(spark, rows):
    return spark.createDataFrame([(g, t, 1, "w", 2, "p") for g, t in rows], SCHEMA)


def brute(rows, top):
    counts = {}
    for lang, text in rows:
        c = counts.setdefault(lang or "und", Counter())
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            words = re.findall("[^ \t]+", piece)
            for k in (1, 2, 3, 4):
                c.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, c in counts.items():
        n = sum(v for p, v in c.items() if len(p) == 1)
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= 30}
        held = {p[i : i + k] for p, f in cand.items() for k in range(2, len(p)) for i in range(len(p) - k + 1) if 100 * f >= 80 * c[p[i : i + k]]}
        rows_ = []
        for p, a in cand.items():
            if p not in held:
                score, _, left, right = min((2_000_000 * a // (c[p[:k]] + c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
                rows_.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (s, a, p, left, right) in enumerate(sorted(rows_)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -s))
    return sorted(out)


def corpus(seed, docs=250):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(25)] + ["É", "ß", "a-b", "x y"]
    weights = [1 / (i + 1) for i in range(len(words))]
    fixed = [rng.choices(words, k=rng.randrange(2, 7)) for _ in range(25)]
    rows = []
    for i in range(docs):
        out = []
        for _ in range(rng.randrange(1, 25)):
            part = rng.choice(fixed) if rng.random() < 0.5 else rng.choices(words, weights, k=rng.randrange(1, 9))
            out.append(rng.choice([" ", "\t", "  "]).join(part) + rng.choice([".", " ", ", ", "\n", "!?", "\r\n", " : "]))
        text = "".join(out)
        rows.append((rng.choice(["en", "en", "de", None, "und"]), text.upper() if i % 9 == 0 else text))
    return rows + [("en", None), ("en", ""), ("fr", ".,;"), ("fr", " \t"), rows[0], rows[0]]


@pytest.mark.parametrize(("seed", "top"), [(1, 2000), (2, 3), (3, 20), (4, 60)])
def test_against_brute_force(spark, seed, top):
    rows = corpus(seed)
    got = phrases.collocations(frame(spark, rows), top=top).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, top)
    assert len(got) >= top or top == 2000


def test_search_opens_a_part_of_the_nodes(spark, monkeypatch):
    """A low frontier leaves nodes unopened, and the result is that of a full search."""
    rows, opened = corpus(5, 600), []
    written = phrases.written

    def spy(df, name):
        out = written(df, name)
        if name in ("phrase-opened", "phrase-nodes"):
            opened.append((name, out.count()))
        return out

    monkeypatch.setattr(phrases, "written", spy)
    got = phrases.collocations(frame(spark, rows), top=2).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, 2)
    last = dict(opened)
    assert 0 < last["phrase-opened"] < 0.6 * last["phrase-nodes"]


def test_equal_hashes_lead_to_another_seed(spark):
    rows = corpus(6, 60)
    got = phrases.collocations(frame(spark, rows), top=50, bits=12).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, 50)
    with pytest.raises(RuntimeError):
        phrases.collocations(frame(spark, rows), bits=3)


def test_empty_table(spark):
    assert phrases.collocations(frame(spark, [])).collect() == []
    assert phrases.collocations(frame(spark, [(None, None)])).collect() == []


def test_long_texts_are_sliced_at_pieces(spark, monkeypatch):
    monkeypatch.setattr(phrases, "SLICE_BYTES", 64)
    text = b"one two three. " * 50 + b"x" * 300 + b" y, z"
    parts = list(phrases.slices(text))
    assert len(parts) > 5 and b"".join(parts) == text.replace(b".", b"\xff").replace(b",", b"\xff")
    assert all(p.endswith(b"\xff") for p in parts[:-1])
    long = [("en", "the very same words again. " * 40_000)]
    assert sorted(tuple(r) for r in phrases.collocations(frame(spark, long)).collect()) == brute(long, 2000)
