"""Schema discovery on drifting documents."""

import json
from collections import Counter

from pyspark.sql import functions as F

from docflow.operators import discover as D

DOCS = [
    '{"id": 1, "price": 2.5, "tags": ["a", 1, null], "in": {"x": 1}}',
    '{"id": 2, "price": "2.5", "tags": [], "in": {"x": 1.5, "y z": true}}',
    '{"id": 3, "price": null, "tags": [[1, "b"], {"k": "v"}], "late": {"deep": [{"q": 1}, {"q": "one"}]}}',
    '{"id": 1, "price": 2.5, "tags": ["a", 1, null], "in": {"x": 1}}',
    '{"nothing": null, "empty": {}, "VOID": 1}',
    "[1, 2]",
    '"text"',
    "{broken",
    "",
    None,
]


def frame(spark, docs):
    return spark.createDataFrame([(d, 1, "p") for d in docs], "body string, n int, path string")


def walk(value, path, out):
    kinds = {dict: "OBJECT", list: "ARRAY", str: "STRING", bool: "BOOLEAN", int: "BIGINT", float: "DECIMAL", type(None): "VOID"}
    out[path, kinds[type(value)]] += 1
    if isinstance(value, dict):
        for k, v in value.items():
            walk(v, f"{path}['{k}']" if " " in k else k if path == "$" else f"{path}.{k}", out)
    if isinstance(value, list):
        for v in value:
            walk(v, f"{path}[]", out)


def test_value_kinds_equal_a_walk(spark):
    want = Counter()
    for d in DOCS:
        try:
            walk(json.loads(d), "$", want)
        except (TypeError, ValueError):
            want["$", "INVALID"] += d is not None
    got = D.value_kinds(frame(spark, DOCS), "body").collect()
    assert {(r.path, r.kind): r.n for r in got} == dict(want) and len(got) == len(want)
    assert D.value_kinds(frame(spark, []), "body").count() == 0
    assert D.value_kinds(frame(spark, [None]), "body").count() == 0


def test_conflicts_count_what_no_type_holds(spark):
    got = {r.path: (r.kinds, r.n, r.n_minority) for r in D.kind_conflicts(D.value_kinds(frame(spark, DOCS[:4]), "body")).collect()}
    assert got == {
        "price": (["NUMBER", "STRING"], 3, 1),
        "tags[]": (["ARRAY", "NUMBER", "OBJECT", "STRING"], 6, 4),
        "tags[][]": (["NUMBER", "STRING"], 2, 1),
        "late.deep[].q": (["NUMBER", "STRING"], 2, 1),
    }


def test_typed_read_loses_no_value(spark):
    got = D.read_discovered(frame(spark, [*DOCS[:5], "{broken", None]), "body")
    rows = got.orderBy("doc.id", F.col("body")).select("body", "doc.id", F.col("doc.in.x").cast("double").alias("x"), F.to_json("doc").alias("j")).collect()
    assert len(rows) == 7 and dict(got.select("doc.*").dtypes)["id"] == "bigint" and dict(got.select("doc.*").dtypes)["price"] == "variant"
    for r in rows:
        if r.body in (None, "{broken"):
            assert r.j is None
            continue
        want = json.loads(r.body)
        assert r.id == want.get("id") and r.x == want.get("in", {}).get("x")
        back = json.loads(r.j)
        for key in ("price", "tags"):
            assert (back.get(key) or None) == (want.get(key) or None)
        assert back.get("VOID") == want.get("VOID")


def test_collections_of_nulls_and_nothing(spark):
    assert D.read_discovered(frame(spark, []), "body").count() == 0
    assert [r.doc for r in D.read_discovered(frame(spark, [None, "null"]), "body").collect()] == [None, None]
