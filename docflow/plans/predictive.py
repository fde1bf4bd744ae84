"""Growth forecast and code recommendation queries; cross-source enrichment."""

from __future__ import annotations

from pyspark.sql import functions as F

from docflow.functions.exprs import compare
from docflow.operators import predict as P
from docflow.plans.batching import hash_bucket
from docflow.plans.registry import query
from docflow.sources.tables import Tables

_DAILY_SQL = """
  daily AS (SELECT CAST(ts AS DATE) AS day, sum(value) AS total FROM events GROUP BY 1),
  pts AS (SELECT day, day - (SELECT min(day) FROM daily) AS x, total AS y FROM daily),
  model AS (SELECT regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept, min(day) AS first_day,
                   max(day) AS last_day, count(*) AS n_days FROM pts)"""


def _model(spark, sf):
    return P.linear_trend(P.daily_totals(Tables(spark, sf).events, "ts", "value"))


@query(
    "daily_growth",
    f"""WITH {_DAILY_SQL} SELECT strftime(day, '%Y-%m-%d') AS day, round(total, 6) AS total,
                                round(total * 1e9 / (1024 * 1024 * 1024), 6) AS total_gb FROM daily""",
)
def daily_growth(spark, sf):
    d = P.daily_totals(Tables(spark, sf).events, "ts", "value")
    return d.select(
        F.date_format("day", "yyyy-MM-dd").alias("day"),
        F.round("total", 6).alias("total"),
        F.round(F.col("total") * 1e9 / (1024 * 1024 * 1024), 6).alias("total_gb"),
    )


@query(
    "growth_trend",
    f"""WITH {_DAILY_SQL} SELECT round(slope, 6) AS slope, round(intercept, 6) AS intercept, n_days FROM model""",
)
def growth_trend(spark, sf):
    m = _model(spark, sf)
    return m.select(F.round("slope", 6).alias("slope"), F.round("intercept", 6).alias("intercept"), "n_days")


@query(
    "growth_forecast",
    f"""WITH {_DAILY_SQL},
        f AS (SELECT unnest(generate_series(last_day + 1, last_day + 30, INTERVAL 1 DAY)) AS day, slope, intercept, first_day
              FROM model)
        SELECT strftime(day, '%Y-%m-%d') AS day, round(intercept + slope * (CAST(day AS DATE) - first_day), 6) AS predicted
        FROM f""",
)
def growth_forecast(spark, sf):
    f = P.forecast(_model(spark, sf), 30)
    return f.select(F.date_format("day", "yyyy-MM-dd").alias("day"), F.round("predicted", 6).alias("predicted"))


_FEAT = ["c_nationkey", "c_mktsegment"]


def _coded_orders(spark, sf):
    t = Tables(spark, sf)
    o = t.orders.select(
        "o_orderkey",
        "o_custkey",
        F.when(F.col("o_orderkey") % 101 == 0, F.lit(None).cast("string")).otherwise(F.col("o_orderpriority")).alias("code"),
    )
    return o.join(t.customer.select(F.col("c_custkey").alias("o_custkey"), *_FEAT), "o_custkey")


_CODED_SQL = """
  co AS (SELECT o.o_orderkey, c.c_nationkey, c.c_mktsegment,
                CASE WHEN o.o_orderkey % 101 = 0 THEN NULL ELSE o.o_orderpriority END AS code
         FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
  cnt AS (SELECT c_nationkey, c_mktsegment, code, count(*) AS n FROM co WHERE code IS NOT NULL GROUP BY ALL),
  fr AS (SELECT *, n / sum(n) OVER (PARTITION BY c_nationkey, c_mktsegment) AS probability,
                row_number() OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY n DESC, code) AS rank FROM cnt)"""


@query(
    "code_topn_by_frequency",
    f"""WITH {_CODED_SQL} SELECT c_nationkey, c_mktsegment, code, n, round(probability, 6) AS probability, rank
        FROM fr WHERE rank <= 3""",
)
def code_topn_by_frequency(spark, sf):
    fr = P.code_frequencies(_coded_orders(spark, sf), _FEAT, "code")
    return fr.where(F.col("rank") <= 3).select(*_FEAT, "code", "n", F.round("probability", 6).alias("probability"), F.col("rank").cast("bigint").alias("rank"))


@query(
    "autopopulate_codes",
    f"""WITH {_CODED_SQL}
        SELECT co.o_orderkey, coalesce(co.code, fr.code) AS code, co.code IS NULL AND fr.code IS NOT NULL AS filled
        FROM co LEFT JOIN fr ON co.c_nationkey = fr.c_nationkey AND co.c_mktsegment = fr.c_mktsegment AND fr.rank = 1""",
)
def autopopulate_codes(spark, sf):
    co = _coded_orders(spark, sf)
    fr = P.code_frequencies(co, _FEAT, "code")
    return P.autopopulate(co, _FEAT, "code", fr).select("o_orderkey", "code", "filled")


_FOREST_FEAT = ["nation", "segment", "status", "month"]


def _forest(spark, sf):
    """(model, codes by class, labelled test rows, rows without a code).

    Four categorical features. Rows are split by a hash of the key, so a run
    repeats. Some test rows have a segment that training never saw.
    """
    t = Tables(spark, sf)
    k = F.col("o_orderkey")
    o = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    test = hash_bucket("o_orderkey", 5) == 0
    segment = F.when(test & (k % 7 == 0), F.lit("NEVER SEEN")).otherwise(F.col("c_mktsegment"))
    rows = o.select(
        "o_orderkey",
        F.col("c_nationkey").cast("string").alias("nation"),
        segment.alias("segment"),
        F.col("o_orderstatus").alias("status"),
        F.month("o_orderdate").cast("string").alias("month"),
        F.when(k % 101 != 0, F.col("o_orderpriority")).alias("code"),
        test.alias("test"),
    ).fillna("", _FOREST_FEAT)
    coded = rows.where(F.col("code").isNotNull())
    model = P.forest_pipeline(_FOREST_FEAT, "code").fit(coded.where(~F.col("test")))
    return model, model.stages[-2].labels, coded.where("test"), rows.where(F.col("code").isNull())


@query(
    "code_classifier_accuracy",
    """SELECT count(*) AS n_test, count(*) FILTER (WHERE o_orderkey % 7 = 0) AS n_unseen, true AS accuracy_in_range
       FROM orders JOIN customer ON o_custkey = c_custkey
       WHERE o_orderkey % 101 <> 0 AND o_orderpriority IS NOT NULL
         AND CAST(('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8)) AS BIGINT) % 5 = 0""",
)
def code_classifier_accuracy(spark, sf):
    """Random forest from four features to a code: held-out accuracy, test rows
    (hash split) and test rows with a category that training never saw."""
    model, _, test, _ = _forest(spark, sf)
    hit = F.avg((F.col("prediction") == F.col("label")).cast("double"))
    return model.transform(test).agg(
        F.count(F.lit(1)).alias("n_test"),
        F.count_if(F.col("segment") == "NEVER SEEN").alias("n_unseen"),
        hit.between(0.0, 1.0).alias("accuracy_in_range"),
    )


def _learnable(spark, sf):
    """(model, labelled test rows, all rows): codes that follow from segment and status but for
    one row in twenty; every hundred-and-first row has none."""
    t = Tables(spark, sf)
    k = F.col("o_orderkey")
    o = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    rule = F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("F-"), F.substring("c_mktsegment", 1, 4))).otherwise(F.lit("GENERAL"))
    rows = o.select(
        "o_orderkey",
        F.col("c_nationkey").cast("string").alias("nation"),
        F.col("c_mktsegment").alias("segment"),
        F.col("o_orderstatus").alias("status"),
        F.month("o_orderdate").cast("string").alias("month"),
        rule.alias("rule"),
        F.when(k % 101 == 0, F.lit(None)).when(k % 20 == 7, F.lit("OTHER")).otherwise(rule).alias("code"),
        (hash_bucket("o_orderkey", 5) == 0).alias("test"),
    ).fillna("", _FOREST_FEAT)
    coded = rows.where(F.col("code").isNotNull())
    model = P.forest_pipeline(_FOREST_FEAT, "code").fit(coded.where(~F.col("test")))
    return model, coded.where("test"), rows


@query(
    "code_classifier_beats_majority",
    """SELECT count(*) AS n_test, true AS beats_majority FROM orders JOIN customer ON o_custkey = c_custkey
       WHERE o_orderkey % 101 <> 0
         AND CAST(('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8)) AS BIGINT) % 5 = 0""",
)
def code_classifier_beats_majority(spark, sf):
    """Held-out accuracy of the forest on codes that follow from two features: at least
    half of what always naming the most frequent code of the same rows gets wrong is right."""
    model, test, _ = _learnable(spark, sf)
    scored = model.transform(test).select("code", (F.col("prediction") == F.col("label")).alias("hit"))
    per_code = scored.groupBy("code").agg(F.count(F.lit(1)).alias("n"), F.count_if("hit").alias("hits"))
    n = F.sum("n")
    return per_code.agg(n.alias("n_test"), (F.sum("hits") >= (n + F.max("n")) / 2).alias("beats_majority"))


@query(
    "autopopulate_from_model",
    """SELECT count(*) AS n, count(*) FILTER (WHERE o_orderkey % 101 = 0) AS filled, true AS others_untouched, true AS mostly_right
       FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def autopopulate_from_model(spark, sf):
    """Missing codes filled with the model's likeliest code, given ones untouched; four of
    five filled codes are those that the rule behind the codes gives."""
    model, _, rows = _learnable(spark, sf)
    done = P.autopopulate_from_model(rows, "code", model)
    filled = F.col("filled")
    right = F.count_if(filled & (F.col("code") == F.col("rule")))
    given = F.when(F.col("o_orderkey") % 20 == 7, F.lit("OTHER")).otherwise(F.col("rule"))
    return done.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(filled).alias("filled"),
        (F.count_if(~filled & ~F.col("code").eqNullSafe(given)) == 0).alias("others_untouched"),
        (right >= 0.8 * F.count_if(filled)).alias("mostly_right"),
    )


def _forest_codes(spark, sf):
    model, codes, _, empty = _forest(spark, sf)
    # every row is scored, also those whose code the model cannot know
    scored = model.transform(empty.withColumn("code", F.lit(codes[0])))
    return P.top_n_classes(scored, "o_orderkey", codes, 3)


@query("code_topn_forest")
def code_topn_forest(spark, sf):
    """The three likeliest codes of every row without one (rows-only; invariants below)."""
    return _forest_codes(spark, sf)


@query(
    "code_forest_invariants",
    """WITH e AS (SELECT o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey
                  WHERE o_orderkey % 101 = 0 OR o_orderpriority IS NULL)
       SELECT o_orderkey, CAST(3 AS BIGINT) AS n_codes, true AS distinct_known_codes, true AS falling_probabilities FROM e""",
)
def code_forest_invariants(spark, sf):
    """Per filled row: three different codes of the code list, probabilities falling and at most 1 together."""
    top = _forest_codes(spark, sf)
    known = Tables(spark, sf).orders.select(F.col("o_orderpriority").alias("code")).distinct().withColumn("known", F.lit(True))
    j = top.join(known, "code", "left")
    p = F.transform(F.sort_array(F.collect_list(F.struct("rank", "probability"))), lambda x: x["probability"])
    falling = (p[0] >= p[1]) & (p[1] >= p[2]) & (p[2] >= 0) & (p[0] + p[1] + p[2] <= 1 + 1e-9)
    return j.groupBy("o_orderkey").agg(
        F.count(F.lit(1)).alias("n_codes"),
        ((F.count_distinct("code") == 3) & (F.count("known") == 3)).alias("distinct_known_codes"),
        falling.alias("falling_probabilities"),
    )


# ------------------------------------------------------- enrichment (J14)


def _reference(t):
    """Reference table: (APP_REF_NO, PROD_ACCT_NO, PROD_CD) from lineitem."""
    code = F.when(F.col("l_returnflag") == "R", "CC").when(F.col("l_returnflag") == "A", "SB").otherwise("OT")
    return t.lineitem.select(
        F.col("l_orderkey").alias("app_ref_no"),
        F.when(code == "CC", F.col("l_partkey")).otherwise(F.col("l_suppkey")).alias("prod_acct_no"),
        code.alias("prod_cd"),
    )


def enrichment(t, code: str):
    """driver ⋈ reference (semi: only driver keys) -> split by product code."""
    driver = t.orders.where(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").alias("app_ref_no"))
    ref = _reference(t).join(driver, "app_ref_no", "left_semi")
    return ref.where(F.col("prod_cd") == code)


@query(
    "enrichment_consumer",
    """WITH ref AS (SELECT l_orderkey AS app_ref_no, l_partkey AS prod_acct_no FROM lineitem WHERE l_returnflag = 'R'
                   AND l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'))
       SELECT ref.app_ref_no, ref.prod_acct_no, p.p_size AS detail_value FROM ref JOIN part p ON ref.prod_acct_no = p.p_partkey
       WHERE p.p_size > 40""",
)
def enrichment_consumer(spark, sf):
    """Consumer branch: reference rows with code CC joined to the consumer
    detail table (part as stand-in), filtered on the detail column."""
    t = Tables(spark, sf)
    cc = enrichment(t, "CC")
    det = t.part.select(F.col("p_partkey").alias("prod_acct_no"), F.col("p_size").alias("detail_value"))
    return cc.join(det, "prod_acct_no").where(F.col("detail_value") > 40).select("app_ref_no", "prod_acct_no", "detail_value")


@query(
    "enrichment_business",
    """WITH ref AS (SELECT l_orderkey AS app_ref_no, l_suppkey AS prod_acct_no FROM lineitem WHERE l_returnflag = 'A'
                   AND l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'))
       SELECT ref.app_ref_no, s.s_suppkey AS acct_id, s.s_acctbal AS cur_bl_am
       FROM ref JOIN supplier s ON ref.prod_acct_no = s.s_suppkey WHERE s.s_acctbal < 0""",
)
def enrichment_business(spark, sf):
    """Business branch: code SB joined on differently named keys
    (prod_acct_no = acct_id) and filtered by balance; the comparison operator
    is a parameter (the workflow keeps zero balances; here: negative)."""
    t = Tables(spark, sf)
    sb = enrichment(t, "SB")
    det = t.supplier.select(F.col("s_suppkey").alias("acct_id"), F.col("s_acctbal").alias("cur_bl_am"))
    j = sb.join(det, sb["prod_acct_no"] == det["acct_id"])
    return j.where(compare("cur_bl_am", "<", 0.0)).select("app_ref_no", "acct_id", "cur_bl_am")
