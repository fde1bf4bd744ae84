"""Small fixtures: JSON value rules, decode errors, dotted profiles, nested
reconciliation keys, the ledger write-back and its report."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from docflow.functions.udf import decode_column, utf8_decode
from docflow.operators import nesting as N
from docflow.operators import profile as P
from docflow.operators import recon as R
from docflow.operators import upsert as U
from docflow.operators import validate as V

SCHEMA = {
    "bsonType": "object",
    "required": ["a"],
    "properties": {"a": {"bsonType": ["int", "long"]}, "b": {"bsonType": "object", "required": ["c"], "properties": {"c": {"bsonType": "string", "enum": ["x"]}}}},
}


@pytest.mark.parametrize(
    "text, want",
    [
        ('{"a": 1}', []),
        ('{"a": "1"}', ["type:a"]),
        ('{"a": 1.5}', ["type:a"]),
        ('{"a": null}', ["required:a"]),
        ("{}", ["required:a"]),
        ("[1]", ["type:$"]),
        ("{", ["json:$"]),
        (None, ["required:$"]),
        ('{"a": 1, "b": {"c": "x"}}', []),
        ('{"a": 1, "b": {"c": "y"}}', ["enum:b.c"]),
        ('{"a": 1, "b": {"c": 2}}', ["type:b.c"]),
        ('{"a": 1, "b": {}}', ["required:b.c"]),
        ('{"a": 1, "b": [2]}', ["type:b"]),
        ('{"a": 1, "b.c": 2}', []),
    ],
)
def test_json_rules_look_at_each_value(spark, text, want):
    df = spark.createDataFrame([(text,)], "body string")
    assert sorted(V.validate_json(df, "body", SCHEMA).first()["violations"]) == want


def test_json_rules_reject_unknown_keywords_and_keep_columns(spark):
    df = spark.createDataFrame([], "body string, violations_of_law int")
    assert V.validate_json(df, "body", SCHEMA).columns == ["body", "violations_of_law", "violations"]
    for bad in ({"properties": {"a": {"pattern": "x"}}}, {"properties": {"a": {"bsonType": "uuid"}}}):
        with pytest.raises(ValueError):
            V.validate_json(df, "body", bad)


def test_decoder_reports_the_error(spark):
    df = spark.createDataFrame([(1, bytearray(b"ok")), (2, bytearray(b"\xff")), (3, None)], "id int, blob binary")
    rows = df.select("id", decode_column("blob", utf8_decode).alias("d")).orderBy("id").collect()
    assert [(r["d"]["value"], r["d"]["error"]) for r in rows] == [("ok", None), (None, "UnicodeDecodeError"), (None, None)]


def test_profile_paths_into_structs_and_arrays(spark):
    df = spark.createDataFrame([(("u",), [("p",), (None,)]), ((None,), []), (None, None)], "s struct<x: string>, a array<struct<y: string>>")
    got = {(r["field"], r["value"]): r["n"] for r in P.field_value_profile([(df, "d", ["s.x", "a.y"])]).collect()}
    assert got == {("d.s.x", "u"): 1, ("d.s.x", None): 2, ("d.a.y", '["p",null]'): 1, ("d.a.y", "[]"): 1, ("d.a.y", None): 1}


def test_two_sided_counts_through_structs(spark):
    s = spark.createDataFrame([("a", 1), ("a", 1), (None, 2)], "k string, v int")
    t = spark.createDataFrame([(("a", 1),), ((None, 2),), (("b", None),)], "doc struct<k: string, v: int>")
    got = R.two_sided_counts(s, t, {"k": ("k", "doc.k"), "v": ("v", "doc.v")}).collect()
    assert sorted(tuple(r) for r in got) == [("a", 1, 2, 1), ("b", None, 0, 1)]


def _results(spark, per_rows, checked_rows):
    start = dt.datetime(2024, 3, 10, 1)
    pending = spark.createDataFrame([("b1", start), ("b2", start)], "batch_id string, batch_end timestamp_ntz")
    per = spark.createDataFrame(per_rows, "batch_id string, source_count long, target_count long, mismatched long, missing long")
    checked = spark.createDataFrame(checked_rows, "batch_id string, id int, status string")
    return pending, R.batch_results(pending, per, checked, F.timestamp_add("HOUR", F.lit(2), F.col("batch_end")))


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles"])
def test_batch_results_and_report(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        pending, res = _results(spark, [("b1", 2, 2, 0, 0)], [("b1", 7, "SUCCESS"), ("b1", 5, "FAILURE")])
        rows = {r["batch_id"]: r for r in res.collect()}
        assert rows["b1"]["reconcile_check"] == "MATCHED"
        assert rows["b1"]["retrieval_validation"] == "5:FAILURE,7:SUCCESS"
        assert (rows["b2"]["reconcile_check"], rows["b2"]["retrieval_validation"], rows["b2"]["source_count"]) == ("NOT MATCHED", "FAILURE", 0)
        rep = R.reconciliation_report(res.join(pending, "batch_id"), F.col("batch_end")).first()
        # two hours on the wall clock, also over the clock change
        assert tuple(rep) == (2, 2, 0.5, 0.0, 0.5, 7200.0)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_report_of_an_empty_ledger_has_null_rates(spark):
    pending, res = _results(spark, [], [])
    rep = R.reconciliation_report(res.join(pending, "batch_id").where("false"), F.col("batch_end")).first()
    assert tuple(rep) == (0, None, None, None, None, None)


def test_upsert_rewrites_only_touched_ranges(spark, tmp_path):
    path = str(tmp_path / "t")
    part = U.key_range_part("k", 0, 10)
    spark.createDataFrame([(1, "a"), (11, "b"), (12, "c"), (21, "d")], "k long, v string").withColumn("part", part).write.partitionBy("part").parquet(path)

    def files(p):
        return sorted(f.name for f in (tmp_path / "t" / f"part={p}").glob("*.parquet"))

    before = {p: files(p) for p in (0, 1, 2)}
    upd = spark.createDataFrame([(11, None), (15, "n"), (35, "m"), (-5, "z")], "k long, v string")
    for _ in range(2):  # the same updates again change nothing
        assert U.write_upsert_touched(spark, path, upd, "k", part) == 3
        got = {r["k"]: (r["v"], r["part"]) for r in spark.read.parquet(path).collect()}
        assert got == {1: ("a", 0), 11: (None, 1), 12: ("c", 1), 15: ("n", 1), 21: ("d", 2), 35: ("m", 3), -5: ("z", -1)}
    assert (files(0), files(2)) == (before[0], before[2])
    assert files(1) != before[1]
    assert U.write_upsert_touched(spark, path, upd.limit(0), "k", part) == 0
    with pytest.raises(Exception, match="update key is null"):
        U.write_upsert_touched(spark, path, spark.createDataFrame([(None, "q")], "k long, v string"), "k", part)
    with pytest.raises(Exception, match="update keys repeat"):
        U.write_upsert_touched(spark, path, upd.union(upd), "k", part)
    assert spark.read.parquet(path).count() == 7


def test_child_flags(spark):
    main = spark.createDataFrame([(1,), (2,), (3,), (None,)], "k int")
    a = spark.createDataFrame([(1, "x"), (1, "y"), (None, "z")], "pk int, v string")
    got = {r["k"]: (r["a"], r["b"]) for r in N.flag_children(main, "k", {"a": (a, "pk"), "b": (a.where("v = 'q'"), "pk")}).collect()}
    assert got == {1: (True, False), 2: (False, False), 3: (False, False), None: (False, False)}
