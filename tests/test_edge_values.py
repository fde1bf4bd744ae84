"""Values that the generated tables don't hold."""

import types

import pytest
from pyspark.sql import functions as F

from docflow.functions import exprs as X
from docflow.operators.upsert import upsert
from docflow.session import ensure_checkpoint_dir


def test_list_separator_is_literal(spark):
    df = spark.createDataFrame([("a|b||c",), (None,), ("x.y",)], "s string")
    assert [r[0] for r in df.select(X.split_list("s", "|")).collect()] == [["a", "b", "c"], [], ["x.y"]]
    assert df.select(X.split_list("s", ".")).collect()[2][0] == ["x", "y"]


def test_title_with_line_feed(spark):
    base, ext = X.split_title("t", "m")
    got = spark.createDataFrame([("one\ntwo.pdf", "text/plain")], "t string, m string").select(base, ext).first()
    assert tuple(got) == ("one\ntwo", "pdf")


def test_prefixed_uuid_behind_a_long_text(spark):
    status, uid = X.parse_prefixed_uuid("s", "P::")
    rows = [("P::00000000-0000-0000-0000-00000000000A",), ("P::" + "x" * 2_000_000,), ("Q",)]
    got = spark.createDataFrame(rows, "s string").select(status, uid).collect()
    assert [tuple(r) for r in got] == [("ok", "00000000-0000-0000-0000-00000000000a"), ("bad_uuid", None), ("bad_format", None)]


def test_repeated_update_keys(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    updates = spark.createDataFrame([(1, "x", 1), (1, "y", 2), (3, "z", 1)], "k long, v string, at int")
    got = {r.k: r.v for r in upsert(target, updates, "k", "at").collect()}
    assert got == {1: "y", 2: "b", 3: "z"}
    with pytest.raises(Exception, match="repeat"):
        upsert(target, updates.drop("at"), "k").collect()
    once = upsert(target, updates.drop("at").where(F.col("v") == "z"), "k").collect()
    assert {r.k: r.v for r in once} == {1: "a", 2: "b", 3: "z"}


def test_a_cluster_needs_a_shared_folder():
    sc = types.SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: {}, master="spark://host:7077")
    session = types.SimpleNamespace(sparkContext=sc, conf={})
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(session)
