"""Hand-written fixtures for edge cases (nulls, empty arrays, ties, bounds)."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from docflow.functions import exprs as X
from docflow.operators import batches as B
from docflow.operators import joins as J
from docflow.operators import nesting as N
from docflow.operators import recon as R
from docflow.operators import report as RP
from docflow.operators import text as T
from docflow.operators import upsert as U
from docflow.operators import validate as V
from docflow.operators import vectors as VE
from tests.conftest import SF_MED


def test_split_title_fixture(spark):
    rows = [
        ("report.final.v2.txt", "text/plain"),
        ("minutes", "application/pdf"),
        (None, "image/jpeg"),
        ("bundle", "application/zip"),
        ("ends with dot.", "text/plain"),
        ("two\nlines.txt", "text/plain"),
    ]
    df = spark.createDataFrame(rows, "documentTitle string, mimeType string")
    base, ext = X.split_title("documentTitle", "mimeType")
    got = [tuple(r) for r in df.select(base, ext).collect()]
    assert got == [
        ("report.final.v2", "txt"),
        ("minutes", "pdf"),
        (None, "jpg"),
        ("bundle", None),
        ("ends with dot", ""),
        ("two\nlines", "txt"),
    ]


def test_split_list_and_wide_to_array(spark):
    df = spark.createDataFrame([(None,), ("",), (" Alex , Emily ",), ("a,,b",)], "k string")
    got = [r[0] for r in df.select(X.split_list("k")).collect()]
    assert got == [[], [], ["Alex", "Emily"], ["a", "b"]]
    w = spark.createDataFrame([("x", None, ""), (None, None, None)], "a string, b string, c string")
    assert [r[0] for r in w.select(X.wide_to_array("a", "b", "c")).collect()] == [["x"], []]


def _tenants(spark):
    schema = "id int, tenants array<struct<domain:string,division:string>>"
    rows = [
        (1, [("ABC", "ABC")]),
        (2, [("ABC", "X"), ("Y", "ABC")]),  # conditions met by different elements
        (3, []),
        (4, None),
        (5, [("ABC", None)]),
        (6, [None]),
    ]
    return spark.createDataFrame(rows, schema)


def test_elem_match_needs_one_element(spark):
    df = _tenants(spark)
    got = sorted(r.id for r in df.filter(X.elem_match("tenants", domain="ABC", division="ABC")).collect())
    assert got == [1]


def test_ne_or_missing(spark):
    df = spark.createDataFrame([("a",), (None,), ("loader",)], "m string")
    assert [r[0] for r in df.select(X.ne_or_missing("m", "loader")).collect()] == [True, True, False]
    t = _tenants(spark)
    got = dict(t.select("id", X.ne_or_missing_array(N.array_field("tenants", "domain"), "ABC")).collect())
    assert got == {1: False, 2: False, 3: True, 4: True, 5: False, 6: True}


def test_required_fields_array_elements(spark):
    df = _tenants(spark)
    pred = N.required_fields([], arrays={"tenants": ["domain", "division"]})
    assert sorted(r.id for r in df.filter(pred).collect()) == [1, 2]


def test_first_element_empty_and_null(spark):
    df = _tenants(spark)
    got = dict(df.select("id", N.first_element("tenants")["domain"]).collect())
    assert got[3] is None and got[4] is None and got[1] == "ABC"


def test_differing_fields_null_semantics(spark):
    df = spark.createDataFrame(
        [(1, "a", "a"), (2, "a", "b"), (3, None, "b"), (4, None, None)], "k int, s string, t string"
    )
    diff = X.differing_fields({"f": (F.col("s"), F.col("t"))})
    got = dict(df.select("k", F.size(diff)).collect())
    assert got == {1: 0, 2: 1, 3: 1, 4: 0}


def test_reconcile_by_batch_decisions(spark):
    src = spark.createDataFrame(
        [("b1", 1, "x"), ("b1", 2, "y"), ("b2", 3, "z"), ("b3", 4, "w"), ("b4", 5, "v"), ("b4", 5, "v")],
        "batch string, id int, v string",
    )
    tgt = spark.createDataFrame([("b1", 1, "x"), ("b1", 2, "y"), ("b2", 3, None), ("b4", 5, "v")], "batch string, id int, v string")
    res = {r.batch_id: r for r in R.reconcile_by_batch(src, tgt, "id", "batch", {"v": ("v", "v")}).collect()}
    assert res["b1"].reconcile_check == "MATCHED"
    assert res["b2"].reconcile_check == "MISMATCHED"  # value vs NULL is a difference
    assert res["b3"].reconcile_check == "NOT MATCHED"  # target side empty
    assert res["b4"].count_status == "NOT MATCHED"  # duplicated source row


def test_two_sided_counts_multiplicity(spark):
    s = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "k int, v string")
    t = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "k int, v string")
    got = sorted(tuple(r) for r in R.two_sided_counts(s, t, ["k", "v"]).collect())
    assert got == [(1, "a", 2, 1), (3, "c", 0, 1)]


def test_missing_extra(spark):
    s = spark.createDataFrame([(1,), (2,)], "k int")
    t = spark.createDataFrame([(2,), (3,)], "k int")
    assert sorted(tuple(r) for r in R.missing_extra(s, t, "k").collect()) == [(1, "missing"), (3, "extra")]


def test_global_row_number_equals_window(spark):
    o = spark.read.parquet(f"{SF_MED}/orders.parquet").select("o_orderkey", "o_orderdate")
    fast = B.global_row_number(o, ["o_orderdate", "o_orderkey"], n_partitions=7)
    slow = o.withColumn("rn_ref", F.row_number().over(Window.orderBy("o_orderdate", "o_orderkey")))
    j = fast.join(slow, ["o_orderkey", "o_orderdate"])
    assert j.count() == o.count()
    assert j.filter(F.col("rn") != F.col("rn_ref")).count() == 0


def test_row_batches_ceil_no_empty_batch(spark):
    df = spark.range(0, 10).select(F.col("id").alias("k"), F.lit(dt.datetime(2024, 1, 1)).alias("ts"))
    r = B.row_batches(df, ["k"], 5, "ts", create_date=F.lit(None))
    sizes = sorted(tuple(x) for x in r.groupBy("batch_no").count().collect())
    assert sizes == [(1, 5), (2, 5)]


def test_range_bounds_all_kinds(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "x int")
    got = {b: df.filter(X.between_bounds("x", 1, 3, b)).count() for b in ("()", "(]", "[)", "[]")}
    assert got == {"()": 1, "(]": 2, "[)": 2, "[]": 3}
    with pytest.raises(ValueError):
        X.between_bounds("x", 1, 3, "<>")


def test_range_join_day_buckets_match_plain_condition(spark, no_broadcast):
    o = spark.read.parquet(f"{SF_MED}/orders.parquet").select("o_orderkey", "o_orderdate")
    led = B.time_window_ledger(o, "o_orderdate", "month")
    a = J.range_join(o, "o_orderdate", led, "batch_start", "batch_end", "[)")
    b = o.join(led, (F.col("o_orderdate") >= F.col("batch_start")) & (F.col("o_orderdate") < F.col("batch_end")))
    assert a.count() == b.count() == o.count()
    assert a.select("o_orderkey", "batch_id").exceptAll(b.select("o_orderkey", "batch_id")).count() == 0


def test_gap_fill_sums_to_unfilled(spark):
    e = spark.read.parquet(f"{SF_MED}/events.parquet")
    g = RP.gap_filled_series(e, "ts", "event_type", "2024-01-01", "2024-01-30", unit="day", known_systems=["ABC"])
    assert g.agg(F.sum("count")).first()[0] == e.count()
    assert g.filter(F.col("system_name") == "System ABC").agg(F.sum("count")).first()[0] == 0
    assert g.count() == 6 * 30
    with pytest.raises(ValueError):
        RP.report(e, "ts", "hourlyy")


def test_validate_rules(spark):
    schema = {
        "required": ["name"],
        "properties": {
            "state": {"bsonType": "string", "enum": ["open", "held", "closed"]},
            "age": {"bsonType": "int"},
            "family": {"bsonType": "object", "required": ["spouse"]},
            "kids": {"bsonType": "array", "items": {"bsonType": "string"}},
        },
    }
    rows = [
        ("a", "open", 1, ("s",), ["k"]),
        (None, "X", 1, (None,), ["k"]),
        ("c", None, None, None, None),
    ]
    df = spark.createDataFrame(rows, "name string, state string, age int, family struct<spouse:string>, kids array<string>")
    got = [sorted(r[0]) for r in V.validate(df, schema).select("violations").collect()]
    assert got == [[], ["enum:state", "required:family.spouse", "required:name"], []]


def test_validate_rejects_unknown_keywords(spark):
    df = spark.createDataFrame([("a",)], "name string")
    for schema in ({"properties": {"name": {"pattern": "^b"}}}, {"maxProperties": 1}):
        with pytest.raises(ValueError):
            V.validate(df, schema)


def test_id_range_batches_of_an_empty_table(spark):
    rows, table = B.id_range_batches(spark.createDataFrame([], "k long"), "k", 10)
    assert rows.count() == table.count() == 0


def test_except_all_both_counts_copies_and_nulls(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, None), (3, "z"), (3, "z")], "k int, v string")
    got = sorted(tuple(r) for r in J.except_all_both(a, b, ["k", "v"]).collect())
    assert got == [(1, "x", "source_only"), (3, "z", "target_only"), (3, "z", "target_only")]


def test_parse_with_errors_keeps_rows(spark):
    df = spark.createDataFrame([("2024-01-01",), ("bad",), (None,)], "d string")
    p = V.parse_with_errors(df, {"dd": ("d", F.try_to_timestamp("d", F.lit("yyyy-MM-dd")))})
    assert [r.error for r in p.collect()] == [None, "dd", None]


def test_upsert_sets_null_and_is_idempotent(spark):
    tgt = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, s string, p string")
    upd = spark.createDataFrame([(1, None), (3, "c")], "k int, s string")
    once = U.upsert(tgt, upd, "k")
    twice = U.upsert(once, upd, "k")
    want = [(1, None, "x"), (2, "b", "y"), (3, "c", None)]
    assert sorted(tuple(r) for r in once.collect()) == want
    assert sorted(tuple(r) for r in twice.collect()) == want


def test_upsert_duplicate_updates_latest_wins(spark):
    tgt = spark.createDataFrame([(1, "a")], "k int, s string")
    upd = spark.createDataFrame([(1, "old", 1), (1, "new", 2)], "k int, s string, seq int")
    assert [tuple(r) for r in U.upsert(tgt, upd, "k", order_col="seq").collect()] == [(1, "new")]


def test_parse_prefixed_uuid(spark):
    u = "123e4567-e89b-12d3-a456-426614174000"
    df = spark.createDataFrame([(f"DOC::{u}",), (f"XX::{u}",), ("DOC::nope",), (f"  DOC::{u.upper()} ",)], "q string")
    status, uid = X.parse_prefixed_uuid("q", "DOC::")
    got = [tuple(r) for r in df.select(status, uid).collect()]
    assert got == [("ok", u), ("bad_format", None), ("bad_uuid", None), ("ok", u)]


def test_extract_entities(spark):
    df = spark.createDataFrame(
        [("What is the diagnosis of patient John? His age is 42",), ("Patient named Mary was diagnosed with flu",), ("hello",)],
        "q string",
    )
    n, a, d = T.extract_entities("q")
    got = [tuple(r) for r in df.select(n, a, d).collect()]
    assert got == [("John", "42", "of"), ("Mary", None, "flu"), (None, None, None)]


def test_word_chunks_500_501(spark):
    df = spark.createDataFrame([(1, " ".join(["w"] * 500)), (2, " ".join(["w"] * 501)), (3, "")], "id int, t string")
    c = T.explode_chunks(df, "id", T.word_chunks("t", 500))
    got = sorted((r.id, r.chunk_no, len(r.chunk_text.split(" ")) if r.chunk_text else 0) for r in c.collect())
    assert got == [(1, 0, 500), (2, 0, 500), (2, 1, 1), (3, 0, 0)]


def test_paragraph_chunks(spark):
    df = spark.createDataFrame([(1, "a\n\nb\n\n\n\nc\n\n  ")], "id int, t string")
    c = T.explode_chunks(df, "id", T.line_chunks("t", "\n\n"))
    assert [r.chunk_text.strip() for r in c.orderBy("chunk_no").collect()] == ["a", "b", "c"]


def _brute_tfidf_topk(docs, queries, k, include_query=False):
    """Plain-Python reference: smooth idf, L2 norm, cosine, fit per query when including it."""
    import math
    import re
    from collections import Counter

    tok = lambda s: re.findall(r"[^\W]{2,}", s.lower())
    out = {}
    for qid, qt in queries:
        corpus = [(i, Counter(tok(t))) for i, t in docs]
        qc = Counter(tok(qt))
        fit = [c for _, c in corpus] + ([qc] if include_query else [])
        n = len(fit)
        df = Counter(t for c in fit for t in c)
        idf = {t: math.log((1 + n) / (1 + d)) + 1 for t, d in df.items()}

        def vec(c):
            v = {t: f * idf[t] for t, f in c.items() if t in idf}
            nn = math.sqrt(sum(x * x for x in v.values()))
            return {t: x / nn for t, x in v.items()} if nn else {}

        qv = vec(qc)
        scores = []
        for i, c in corpus:
            dv = vec(c)
            s = sum(qv[t] * dv[t] for t in qv if t in dv)
            if any(t in dv for t in qv):
                scores.append((-round(s, 9), i, s))
        scores.sort()
        out[qid] = [(i, round(s, 6)) for _, i, s in scores[:k]]
    return out


DOCS = [
    (0, "the cat sat on the mat"),
    (1, "the dog sat on the log"),
    (2, "cats and dogs"),
    (3, "the cat sat on the mat"),
    (4, "quantum physics of cats"),
    (5, "nothing shared here"),
]
QS = [(10, "cat on a mat"), (11, "dogs and cats"), (12, "zebra")]


def _search(spark, docs, queries, k, **kw):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    q = spark.createDataFrame(queries, "qid long, text string")
    top = T.tfidf_top_k(T.term_index(d, "doc_id", "text"), q, "qid", "text", k, **kw)
    got = {}
    for r in top.orderBy("qid", "rank").collect():
        got.setdefault(r.qid, []).append((r.id, round(r.score, 6)))
    return got


def _expected(docs, queries, k, include_query=False):
    return {q: v for q, v in _brute_tfidf_topk(docs, queries, k, include_query).items() if v}


@pytest.mark.parametrize("include_query", [False, True])
@pytest.mark.parametrize("block", [2, 8192])  # many small blocks give the same as one
def test_tfidf_topk_matches_brute_force(spark, monkeypatch, block, include_query):
    monkeypatch.setattr(T, "DOC_BLOCK", block)
    monkeypatch.setattr(T, "QUERY_BLOCK", block)
    assert _search(spark, DOCS, QS, 3, include_query=include_query) == _expected(DOCS, QS, 3, include_query)


def test_tfidf_topk_with_shuffled_vocabulary(spark, no_broadcast):
    assert _search(spark, DOCS, QS, 3) == _expected(DOCS, QS, 3)


def test_tfidf_topk_nulls_and_empty_tables(spark):
    docs = [*DOCS, (6, None), (7, ""), (8, " - ")]
    known = [(i, t or "") for i, t in docs]
    assert _search(spark, docs, [*QS, (13, None), (14, "")], 3) == _expected(known, QS, 3)
    assert _search(spark, [], QS, 3) == {}
    assert _search(spark, docs, [], 3) == {}


def test_tfidf_stop_words_do_not_count(spark):
    d = spark.createDataFrame(DOCS, "doc_id long, text string")
    terms = {r.term for r in T.postings(T.term_index(d, "doc_id", "text", T.english_stop_words())).collect()}
    assert "cat" in terms and not terms & {"the", "on", "and", "of"}


def test_best_chunk_is_the_earliest_of_equals(spark):
    texts = [(1, "alpha beta gamma delta alpha beta"), (2, "gamma delta gamma delta"), (3, "")]
    d = spark.createDataFrame(texts, "doc_id long, text string")
    index = T.term_index(d, "doc_id", "text", words_per_chunk=2)
    assert sorted((r.id, r.sub) for r in index.collect()) == [(1, 0), (1, 1), (1, 2), (2, 0), (2, 1), (3, 0)]
    q = spark.createDataFrame([(9, "alpha"), (10, "delta")], "qid long, text string")
    top = T.tfidf_top_k(index, q, "qid", "text", 5)
    got = sorted((r.qid, r.rank, r.id, r.sub) for r in top.collect())
    assert got == [(9, 1, 1, 0), (10, 1, 1, 1), (10, 2, 2, 0)]


def test_dedup_top_k_equals_plain(spark):
    docs = [(i + 10 * r, t) for r in range(4) for i, t in DOCS]  # every text four times or more
    d = spark.createDataFrame(docs, "doc_id long, text string")
    q = spark.createDataFrame(QS, "qid long, text string")
    plain = T.tfidf_top_k(T.term_index(d, "doc_id", "text"), q, "qid", "text", 5)
    dd = T.dedup_cosine_top_k(d, "doc_id", "text", q, "qid", "text", 5)
    a = sorted((r.qid, r.id, r.rank, round(r.score, 9)) for r in plain.collect())
    b = sorted((r.qid, r.id, r.rank, round(r.score, 9)) for r in dd.collect())
    assert a == b


def test_embedding_top_k_many_queries(spark):
    """More queries than one block holds: each finds itself first."""
    v = F.array(*[F.sin((F.col("id") + 1) * (j + 1)).cast("double") for j in range(4)])
    e = spark.range(0, 10_001).select("id", v.alias("v"))
    top = VE.embedding_top_k(e, "id", "v", e, "id", "v", 1)
    assert top.count() == 10_001
    # equal directions may tie; a vector's best cosine is 1
    assert top.where(F.abs(F.col("score") - 1) > 1e-9).count() == 0


def test_cosine_vectors(spark):
    df = spark.createDataFrame(
        [(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [-1.0, 0.0]), (4, [0.0, 0.0]), (5, [2.0, 0.0])], "id int, v array<float>"
    )
    q = spark.createDataFrame([("q", [1.0, 0.0])], "qid string, qv array<double>")
    top = VE.embedding_top_k(df, "id", "v", q, "qid", "qv", 5)
    got = [(r.id, round(r.score, 6)) for r in top.orderBy("rank").collect()]
    assert got == [(1, 1.0), (5, 1.0), (2, 0.0), (3, -1.0)]  # zero vector has no cosine


def test_linear_trend_exact_line(spark):
    from docflow.operators import predict as P

    rows = [(dt.date(2024, 1, 1) + dt.timedelta(days=i), 3.0 + 2.0 * i) for i in (0, 1, 2, 5)]
    daily = spark.createDataFrame(rows, "day date, total double")
    m = P.linear_trend(daily).first()
    assert round(m.slope, 9) == 2.0 and round(m.intercept, 9) == 3.0
    f = P.forecast(P.linear_trend(daily), 2).orderBy("day").collect()
    assert [round(r.predicted, 6) for r in f] == [15.0, 17.0]


def test_status_string_bounded_sample(spark):
    df = spark.range(0, 1000).select((F.col("id") % 2).alias("g"), F.col("id").alias("i"))
    s = R.sample_per_group(df, "g", F.col("i"), 3)
    assert sorted(tuple(r) for r in s.collect()) == [(0, 0), (0, 2), (0, 4), (1, 1), (1, 3), (1, 5)]
    st = R.status_string(s.withColumn("st", F.lit("SUCCESS")), "g", "i", "st")
    assert dict(st.collect())[0] == "0:SUCCESS,2:SUCCESS,4:SUCCESS"


def test_row_number_window_partition_offsets_ignore_partition_sizes(spark):
    df = spark.range(0, 50).select(((F.col("id") * 7919) % 50).alias("k"))
    got = [r.rn for r in B.global_row_number(df, ["k"], n_partitions=4).orderBy("k").collect()]
    assert got == list(range(1, 51))


def test_hot_key_third_of_rows(spark):
    """One key / system holding a third of all rows: results stay whole and exact."""
    n = 30_000
    df = spark.range(0, n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("s"), (F.col("id") % 7).cast("string"))).alias("sys"),
        (F.lit(dt.datetime(2024, 1, 1)) + F.make_interval(mins=(F.col("id") % 1440).cast("int"))).alias("ts"),
        F.lit("B1").alias("batch"),
    )
    # report: the hot system is counted, nothing dropped
    c = RP.bucket_counts(df, "ts", unit="6 hours", system="sys")
    assert c.agg(F.sum("n")).first()[0] == n
    assert c.filter(F.col("system") == "HOT").agg(F.sum("n")).first()[0] == n // 3
    # reconciliation: the hot key is a duplicate group -> counted once as a multiplicity
    tgt = df.filter(~((F.col("k") == 0) & (F.col("ts") < F.lit(dt.datetime(2024, 1, 1, 0, 3)))))
    r = R.reconcile_by_batch(df, tgt, "k", "batch", {"s": ("sys", "sys")}).first()
    assert r.source_count == n and r.target_count == tgt.count()
    assert r.mismatched == 1 and r.missing == 0 and r.extra == 0
    # profile: partial aggregation keeps the hot value whole
    from docflow.operators.profile import field_value_profile

    prof = dict((row.value, row.n) for row in field_value_profile([(df, "t", ["sys"])]).collect())
    assert prof["HOT"] == n // 3
