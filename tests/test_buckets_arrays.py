"""Bucketed joins, rules on array items, codes filled from a model."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from docflow.operators import bucketed as BU
from docflow.operators import validate as V


def tree(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_bucketed_join_equals_the_plain_one(spark, no_broadcast, how):
    many = spark.range(3000).select(F.when(F.col("id") < 1000, 7).when(F.col("id") % 50 == 0, None).otherwise(F.col("id") % 90).alias("k"), F.col("id").alias("v"))
    one = spark.range(80).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w")).unionByName(spark.createDataFrame([(7, -1), (None, 5)], "k long, w long"))
    pair = BU.store_pair(many, one, "k", buckets=6)
    try:
        got = pair.join(how)
        assert "Exchange" not in tree(got) and "SortMergeJoin" in tree(got)
        want = many.join(one, "k", how)
        assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
        salts = spark.table(pair.many).where("k = 7").groupBy(BU.SALT).count().collect()
        assert len(salts) == BU.SALTS and max(r["count"] for r in salts) < 300
        assert spark.table(pair.many).where(f"{BU.SALT} <> 0 and k <> 7").count() == 0
        again = got.groupBy("k").count() if how == "inner" else got
        assert "SortMergeJoin" in tree(again)
    finally:
        pair.drop()


def test_bucketed_join_keeps_outer_joins_out(spark):
    pair = BU.StoredPair(spark, "a", "b", "k")
    with pytest.raises(ValueError):
        pair.join("full")


SCHEMA = {
    "properties": {
        "a": {
            "bsonType": "array", "minItems": 2, "maxItems": 3,
            "items": {"bsonType": ["object", "array", "string"], "enum": ["x", "y"], "required": ["b"], "properties": {"b": {"bsonType": "int"}}, "items": {"bsonType": "bool"}},
        }
    }
}


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ('{"a":[{"b":1},{"b":2}]}', []),
        ('{"a":[{"b":1}]}', ["minItems:a"]),
        ('{"a":[]}', ["minItems:a"]),
        ('{"a":["x","y","x","z"]}', ["enum:a[3]", "maxItems:a"]),
        ('{"a":[1,{"b":"t"},{}]}', ["required:a[2].b", "type:a[0]", "type:a[1].b"]),
        ('{"a":[[true,false],[true,1,"q"]]}', ["type:a[1][1]", "type:a[1][2]"]),
        ('{"a":{"b":1}}', ["type:a"]),
        ('{"a":null}', []),
        ('{"a":[null,{"b":null}]}', ["required:a[1].b"]),
        ("[1]", []),
        ("{", ["json:$"]),
        (None, ["required:$"]),
    ],
)
def test_rules_on_array_items(spark, text, want):
    df = spark.createDataFrame([(text,)], "body string")
    assert sorted(V.validate_json(df, "body", SCHEMA).first()["violations"]) == want


def test_unknown_keywords_in_items_are_errors(spark):
    df = spark.createDataFrame([("{}",)], "body string")
    with pytest.raises(ValueError):
        V.validate_json(df, "body", {"properties": {"a": {"items": {"minimum": 3}}}})
