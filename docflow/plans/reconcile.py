"""Reconciliation queries: orders (source) vs mutated orders (target);
retrieval validation of documents against an object listing."""

from __future__ import annotations

from pyspark.sql import functions as F

from docflow.operators import batches as B
from docflow.operators import joins as J
from docflow.operators import recon as R
from docflow.operators import upsert as U
from docflow.operators.digests import digest_differences
from docflow.plans.batching import _LEDGER_SQL, monthly_ledger
from docflow.plans.bindings import LISTING_SQL, TARGET_SQL, object_listing, target_orders
from docflow.plans.registry import query
from docflow.sources.tables import Tables

FIELDS = {
    "status": ("o_orderstatus", "o_orderstatus"),
    "priority": ("o_orderpriority", "o_orderpriority"),
    "customer": ("o_custkey", "o_custkey"),
    "amount": ("o_totalprice", "o_totalprice"),
}


def _sides(spark, sf):
    t = Tables(spark, sf)
    return t.orders, target_orders(t)


@query(
    "recon_counts",
    f"""WITH {TARGET_SQL},
        s AS (SELECT o_orderstatus AS g, GROUPING(o_orderstatus) AS lvl, count(*) AS n FROM orders GROUP BY ROLLUP (o_orderstatus)),
        t AS (SELECT o_orderstatus AS g, GROUPING(o_orderstatus) AS lvl, count(*) AS n FROM tgt GROUP BY ROLLUP (o_orderstatus))
        SELECT CASE WHEN coalesce(s.lvl, t.lvl) = 1 THEN 'total' ELSE 'group' END AS level,
               coalesce(s.g, t.g) AS o_orderstatus, coalesce(s.n, 0) AS source_count, coalesce(t.n, 0) AS target_count,
               CASE WHEN coalesce(s.n, 0) = coalesce(t.n, 0) THEN 'matched' ELSE 'not matched' END AS status
        FROM s FULL OUTER JOIN t ON s.g IS NOT DISTINCT FROM t.g AND s.lvl = t.lvl""",
)
def recon_counts(spark, sf):
    s, t = _sides(spark, sf)
    return R.count_recon(s, t, "o_orderstatus")


_MISMATCH_SQL = f"""WITH {TARGET_SQL},
  m AS (SELECT s.o_orderkey, list_filter([
          CASE WHEN s.o_orderstatus IS DISTINCT FROM t.o_orderstatus THEN 'status' END,
          CASE WHEN s.o_orderpriority IS DISTINCT FROM t.o_orderpriority THEN 'priority' END,
          CASE WHEN s.o_custkey IS DISTINCT FROM t.o_custkey THEN 'customer' END,
          CASE WHEN s.o_totalprice IS DISTINCT FROM t.o_totalprice THEN 'amount' END], lambda x: x IS NOT NULL) AS mm
        FROM orders s JOIN tgt t ON s.o_orderkey = t.o_orderkey)"""


@query(
    "recon_field_mismatches",
    f"""{_MISMATCH_SQL} SELECT o_orderkey, array_to_string(mm, ',') AS mismatch_columns FROM m WHERE len(mm) > 0""",
)
def recon_field_mismatches(spark, sf):
    s, t = _sides(spark, sf)
    m = R.field_mismatches(s, t, "o_orderkey", FIELDS)
    return m.filter(F.size("mismatch_columns") > 0).select(
        "o_orderkey", F.array_join("mismatch_columns", ",").alias("mismatch_columns")
    )


@query(
    "recon_mismatch_by_field",
    f"""{_MISMATCH_SQL} SELECT unnest(mm) AS field, count(*) AS mismatch_count FROM m GROUP BY 1""",
)
def recon_mismatch_by_field(spark, sf):
    s, t = _sides(spark, sf)
    return R.mismatch_by_field(R.field_mismatches(s, t, "o_orderkey", FIELDS))


@query(
    "recon_missing_extra",
    f"""WITH {TARGET_SQL}
        SELECT DISTINCT o_orderkey, 'missing' AS side FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM tgt)
        UNION ALL SELECT DISTINCT o_orderkey, 'extra' FROM tgt WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders)""",
)
def recon_missing_extra(spark, sf):
    s, t = _sides(spark, sf)
    return R.missing_extra(s, t, "o_orderkey")


@query(
    "recon_digest_tree",
    f"""WITH {TARGET_SQL}
        SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey,
               CASE WHEN t.o_orderkey IS NULL THEN 'missing' WHEN s.o_orderkey IS NULL THEN 'extra' ELSE 'changed' END AS side,
               CASE WHEN s.o_orderkey IS NULL THEN 0 ELSE 1 END AS source_rows,
               CASE WHEN t.o_orderkey IS NULL THEN 0 ELSE 1 END AS target_rows
        FROM orders s FULL OUTER JOIN tgt t ON s.o_orderkey = t.o_orderkey
        WHERE t.o_orderkey IS NULL OR s.o_orderkey IS NULL
           OR s.o_orderstatus IS DISTINCT FROM t.o_orderstatus OR s.o_orderpriority IS DISTINCT FROM t.o_orderpriority
           OR s.o_custkey IS DISTINCT FROM t.o_custkey OR s.o_totalprice IS DISTINCT FROM t.o_totalprice""",
)
def recon_digest_tree(spark, sf):
    """Missing, extra and changed keys; only ranges whose digests differ are compared by row."""
    s, t = _sides(spark, sf)
    return digest_differences(s, t, "o_orderkey", FIELDS)


_KEY_COLS = ["o_custkey", "o_orderstatus", "o_orderpriority"]


@query(
    "recon_two_sided",
    f"""WITH {TARGET_SQL},
        s AS (SELECT o_custkey, o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL),
        t AS (SELECT o_custkey, o_orderstatus, o_orderpriority, count(*) AS n FROM tgt GROUP BY ALL)
        SELECT coalesce(s.o_custkey, t.o_custkey) AS o_custkey, coalesce(s.o_orderstatus, t.o_orderstatus) AS o_orderstatus,
               CASE WHEN s.n IS NULL THEN t.o_orderpriority ELSE s.o_orderpriority END AS o_orderpriority,
               coalesce(s.n, 0) AS source_count, coalesce(t.n, 0) AS target_count
        FROM s FULL OUTER JOIN t ON s.o_custkey IS NOT DISTINCT FROM t.o_custkey
             AND s.o_orderstatus IS NOT DISTINCT FROM t.o_orderstatus
             AND s.o_orderpriority IS NOT DISTINCT FROM t.o_orderpriority
        WHERE coalesce(s.n, 0) <> coalesce(t.n, 0)""",
)
def recon_two_sided(spark, sf):
    s, t = _sides(spark, sf)
    return R.two_sided_counts(s, t, _KEY_COLS)


_NESTED_KEYS = {
    "domain": ("c_mktsegment", "owner.domain"),
    "division": ("n_name", "owner.division"),
    "subdivision": ("o_orderstatus", "owner.subdivision"),
    "cust_ref_key": ("o_orderpriority", "customerRef.name"),
    "cust_ref_value": ("o_custkey", "customerRef.value"),
    "ext_ref_key": ("o_day", "externalRef.name"),
    "ext_ref_value": ("cents", "externalRef.value"),
}


@query(
    "recon_nested_keys",
    f"""WITH {TARGET_SQL},
        own AS (SELECT c_custkey, c_mktsegment, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey),
        s AS (SELECT c_mktsegment AS domain, n_name AS division, o_orderstatus AS subdivision, o_orderpriority AS cust_ref_key,
                     o_custkey AS cust_ref_value, strftime(o_orderdate, '%Y-%m-%d') AS ext_ref_key,
                     CAST(round(o_totalprice * 100) AS BIGINT) AS ext_ref_value, count(*) AS n
              FROM orders LEFT JOIN own ON o_custkey = c_custkey GROUP BY ALL),
        t AS (SELECT c_mktsegment AS domain, n_name AS division, o_orderstatus AS subdivision, o_orderpriority AS cust_ref_key,
                     o_custkey AS cust_ref_value, strftime(o_orderdate, '%Y-%m-%d') AS ext_ref_key,
                     CAST(round(o_totalprice * 100) AS BIGINT) AS ext_ref_value, count(*) AS n
              FROM tgt LEFT JOIN own ON o_custkey = c_custkey GROUP BY ALL),
        u AS (SELECT * EXCLUDE (n), n AS sn, 0 AS tn FROM s UNION ALL SELECT * EXCLUDE (n), 0, n FROM t)
        SELECT domain, division, subdivision, cust_ref_key, cust_ref_value, ext_ref_key, ext_ref_value,
               CAST(sum(sn) AS BIGINT) AS source_count, CAST(sum(tn) AS BIGINT) AS target_count
        FROM u GROUP BY ALL HAVING sum(sn) <> sum(tn)""",
)
def recon_nested_keys(spark, sf):
    """Seven key columns, flat on the source side and inside structs on the target side."""
    t = Tables(spark, sf)
    own = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").select("c_custkey", "c_mktsegment", "n_name")

    def flat(orders):
        return orders.join(own, F.col("o_custkey") == F.col("c_custkey"), "left").select(
            "c_mktsegment", "n_name", "o_orderstatus", "o_orderpriority", "o_custkey",
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_day"), F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"),
        )

    nested = flat(target_orders(t)).select(
        F.struct(F.col("c_mktsegment").alias("domain"), F.col("n_name").alias("division"), F.col("o_orderstatus").alias("subdivision")).alias("owner"),
        F.struct(F.col("o_orderpriority").alias("name"), F.col("o_custkey").alias("value")).alias("customerRef"),
        F.struct(F.col("o_day").alias("name"), F.col("cents").alias("value")).alias("externalRef"),
    )
    return R.two_sided_counts(flat(t.orders), nested, _NESTED_KEYS)


# ------------------------------------------------------------ per batch

_BATCH_SQL = f"""WITH {TARGET_SQL},
  s AS (SELECT strftime(o_orderdate, '%Y%m') AS batch_id, * FROM orders),
  t AS (SELECT strftime(o_orderdate, '%Y%m') AS batch_id, * FROM tgt),
  j AS (SELECT coalesce(s.batch_id, t.batch_id) AS batch_id, s.o_orderkey AS sk, t.o_orderkey AS tk,
               (s.o_orderstatus IS DISTINCT FROM t.o_orderstatus OR s.o_orderpriority IS DISTINCT FROM t.o_orderpriority
                OR s.o_custkey IS DISTINCT FROM t.o_custkey OR s.o_totalprice IS DISTINCT FROM t.o_totalprice) AS diff
        FROM s FULL OUTER JOIN t ON s.batch_id = t.batch_id AND s.o_orderkey = t.o_orderkey),
  per AS (SELECT batch_id, count(sk) AS source_count, count(tk) AS target_count,
                 CAST(sum(CASE WHEN sk IS NOT NULL AND tk IS NOT NULL AND diff THEN 1 ELSE 0 END) AS BIGINT) AS mismatched,
                 CAST(sum(CASE WHEN tk IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing,
                 CAST(sum(CASE WHEN sk IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS extra
          FROM j GROUP BY 1),
  dec AS (SELECT *, CASE WHEN source_count = 0 OR target_count = 0 THEN 'NOT MATCHED' WHEN mismatched = 0 THEN 'MATCHED'
                         ELSE 'MISMATCHED' END AS reconcile_check,
                    CASE WHEN source_count = target_count THEN 'MATCHED' ELSE 'NOT MATCHED' END AS count_status
          FROM per)"""


def _batched(spark, sf):
    s, t = _sides(spark, sf)
    bid = F.date_format("o_orderdate", "yyyyMM")
    return R.reconcile_by_batch(s.withColumn("batch_id", bid), t.withColumn("batch_id", bid), "o_orderkey", "batch_id", FIELDS)


@query("recon_batch_status", f"{_BATCH_SQL} SELECT * FROM dec")
def recon_batch_status(spark, sf):
    return _batched(spark, sf)


@query(
    "recon_summary",
    f"""{_BATCH_SQL}
        SELECT count(*) AS batches, CAST(sum(source_count) AS BIGINT) AS total_processed,
               round(avg(CASE WHEN reconcile_check = 'MATCHED' THEN 1.0 ELSE 0.0 END), 6) AS match_rate,
               round(avg(CASE WHEN reconcile_check = 'MISMATCHED' THEN 1.0 ELSE 0.0 END), 6) AS mismatch_rate,
               round(sum(source_count - mismatched - missing) / sum(source_count), 6) AS record_success_rate
        FROM dec""",
)
def recon_summary(spark, sf):
    b = _batched(spark, sf)
    return b.agg(
        F.count(F.lit(1)).alias("batches"),
        F.sum("source_count").alias("total_processed"),
        F.round(F.avg(F.when(F.col("reconcile_check") == "MATCHED", 1.0).otherwise(0.0)), 6).alias("match_rate"),
        F.round(F.avg(F.when(F.col("reconcile_check") == "MISMATCHED", 1.0).otherwise(0.0)), 6).alias("mismatch_rate"),
        F.round(
            F.sum(F.col("source_count") - F.col("mismatched") - F.col("missing")) / F.sum("source_count"), 6
        ).alias("record_success_rate"),
    )


@query(
    "recon_all_batches",
    f"""WITH {_LEDGER_SQL}, {TARGET_SQL},
        s AS (SELECT l.batch_id, o.* FROM orders o JOIN ledger l
              ON o.o_orderdate >= l.batch_start AND o.o_orderdate < l.batch_end WHERE l.reconcile_dttm IS NULL),
        t AS (SELECT l.batch_id, o.* FROM tgt o JOIN ledger l
              ON o.o_orderdate >= l.batch_start AND o.o_orderdate < l.batch_end WHERE l.reconcile_dttm IS NULL),
        j AS (SELECT coalesce(s.batch_id, t.batch_id) AS batch_id, s.o_orderkey AS sk, t.o_orderkey AS tk,
                     (s.o_orderstatus IS DISTINCT FROM t.o_orderstatus OR s.o_orderpriority IS DISTINCT FROM t.o_orderpriority
                      OR s.o_custkey IS DISTINCT FROM t.o_custkey OR s.o_totalprice IS DISTINCT FROM t.o_totalprice) AS diff
              FROM s FULL OUTER JOIN t ON s.batch_id = t.batch_id AND s.o_orderkey = t.o_orderkey),
        per AS (SELECT batch_id, count(sk) AS source_count, count(tk) AS target_count,
                       CAST(sum(CASE WHEN sk IS NOT NULL AND tk IS NOT NULL AND diff THEN 1 ELSE 0 END) AS BIGINT) AS mismatched,
                       CAST(sum(CASE WHEN tk IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing,
                       CAST(sum(CASE WHEN sk IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS extra FROM j GROUP BY 1)
        SELECT l.batch_id, coalesce(p.source_count, 0) AS source_count, coalesce(p.target_count, 0) AS target_count,
               coalesce(p.mismatched, 0) AS mismatched, coalesce(p.missing, 0) AS missing, coalesce(p.extra, 0) AS extra,
               CASE WHEN coalesce(p.source_count, 0) = 0 OR coalesce(p.target_count, 0) = 0 THEN 'NOT MATCHED'
                    WHEN coalesce(p.mismatched, 0) = 0 THEN 'MATCHED' ELSE 'MISMATCHED' END AS reconcile_check,
               CASE WHEN coalesce(p.source_count, 0) = 0 OR coalesce(p.target_count, 0) = 0 THEN 'FAILURE' END
                 AS retrieval_validation,
               strftime(l.batch_end, '%Y-%m-%d') AS reconcile_dttm
        FROM ledger l LEFT JOIN per p USING (batch_id) WHERE l.reconcile_dttm IS NULL""",
)
def recon_all_batches(spark, sf):
    """All pending batches reconciled in one plan: rows of both sides are
    range-joined to the pending windows, compared per batch, decided, and the
    ledger rows are produced for one upsert."""
    s, t = _sides(spark, sf)
    pending = B.pending_batches(monthly_ledger(spark, sf)).select("batch_id", "batch_start", "batch_end")
    sj = J.range_join(s, "o_orderdate", pending, "batch_start", "batch_end", bounds="[)")
    tj = J.range_join(t, "o_orderdate", pending, "batch_start", "batch_end", bounds="[)")
    per = R.reconcile_by_batch(sj, tj, "o_orderkey", "batch_id", FIELDS)
    out = pending.join(per, "batch_id", "left")
    check, validation = R.decide(F.col("source_count"), F.col("target_count"), F.col("mismatched"))
    return out.select(
        "batch_id",
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("source_count", "target_count", "mismatched", "missing", "extra")],
        check.alias("reconcile_check"),
        validation.alias("retrieval_validation"),
        F.date_format("batch_end", "yyyy-MM-dd").alias("reconcile_dttm"),
    )


# ----------------------------------------------------- retrieval validation

SAMPLE = 100  # ids checked per batch (the reference's retrieval sample size)

_SAMPLE_SQL = f"""WITH {LISTING_SQL},
  per AS (SELECT guid, max(length > 0) AS ok, sum(CASE WHEN length > 0 THEN 1 ELSE 0 END) AS servers_found,
                 count(*) AS servers_listed FROM listing GROUP BY 1),
  smp AS (SELECT doc_id, source FROM (
            SELECT doc_id, source, row_number() OVER (PARTITION BY source
                     ORDER BY CAST(('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8)) AS BIGINT), doc_id) AS rn
            FROM documents) WHERE rn <= {SAMPLE}),
  chk AS (SELECT smp.doc_id, smp.source, CASE WHEN coalesce(per.ok, false) THEN 'SUCCESS' ELSE 'FAILURE' END AS status
          FROM smp LEFT JOIN per ON smp.doc_id = per.guid)"""


def _sample_checked(spark, sf):
    t = Tables(spark, sf)
    ids = R.sample_per_group(
        t.documents.select("doc_id", "source"),
        "source",
        # doc_id breaks ties of the hash
        F.struct(F.conv(F.substring(F.md5(F.col("doc_id").cast("string")), 1, 8), 16, 10).cast("bigint").alias("h"), "doc_id"),
        SAMPLE,
    )
    return R.retrieval_validation(ids, object_listing(t), "doc_id")


@query("retrieval_validation", f"{_SAMPLE_SQL} SELECT doc_id, source, status FROM chk")
def retrieval_validation(spark, sf):
    return _sample_checked(spark, sf).select("doc_id", "source", "status")


@query(
    "status_string_agg",
    f"""{_SAMPLE_SQL} SELECT source, string_agg(CAST(doc_id AS VARCHAR) || ':' || status, ','
                                        ORDER BY CAST(doc_id AS VARCHAR) || ':' || status) AS validation_results
        FROM chk GROUP BY 1""",
)
def status_string_agg(spark, sf):
    return R.status_string(_sample_checked(spark, sf), "source", "doc_id", "status")


@query(
    "retrieval_by_replica",
    f"""WITH {LISTING_SQL},
        per AS (SELECT guid, max(length > 0) AS ok, CAST(sum(CASE WHEN length > 0 THEN 1 ELSE 0 END) AS BIGINT) AS servers_found,
                       count(*) AS servers_listed FROM listing GROUP BY 1)
        SELECT d.doc_id, CASE WHEN coalesce(per.ok, false) THEN 'SUCCESS' ELSE 'FAILURE' END AS status,
               coalesce(per.servers_found, 0) AS servers_found, coalesce(per.servers_listed, 0) AS servers_listed
        FROM documents d LEFT JOIN per ON d.doc_id = per.guid""",
)
def retrieval_by_replica(spark, sf):
    t = Tables(spark, sf)
    return R.retrieval_validation(t.documents.select("doc_id"), object_listing(t), "doc_id")


# -------------------------------------------- ledger write-back and report

# Objects of the orders: absent, empty or present by key arithmetic. A batch is
# finished one second after its end per source record.
_RESULTS_SQL = f"""WITH {_LEDGER_SQL}, {TARGET_SQL},
  s AS (SELECT strftime(o_orderdate, '%Y%m') AS batch_id, * FROM orders),
  t AS (SELECT strftime(o_orderdate, '%Y%m') AS batch_id, * FROM tgt),
  j AS (SELECT coalesce(s.batch_id, t.batch_id) AS batch_id, s.o_orderkey AS sk, t.o_orderkey AS tk,
               (s.o_orderstatus IS DISTINCT FROM t.o_orderstatus OR s.o_orderpriority IS DISTINCT FROM t.o_orderpriority
                OR s.o_custkey IS DISTINCT FROM t.o_custkey OR s.o_totalprice IS DISTINCT FROM t.o_totalprice) AS diff
        FROM s FULL OUTER JOIN t ON s.batch_id = t.batch_id AND s.o_orderkey = t.o_orderkey),
  per AS (SELECT batch_id, count(sk) AS source_count, count(tk) AS target_count,
                 count(*) FILTER (sk IS NOT NULL AND tk IS NOT NULL AND diff) AS mismatched, count(*) FILTER (tk IS NULL) AS missing
          FROM j GROUP BY 1),
  smp AS (SELECT batch_id, o_orderkey FROM (
            SELECT batch_id, o_orderkey, row_number() OVER (PARTITION BY batch_id
                     ORDER BY CAST(('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8)) AS BIGINT), o_orderkey) AS rn
            FROM t) WHERE rn <= {SAMPLE}),
  chk AS (SELECT smp.batch_id, smp.o_orderkey, o.o_orderkey IS NOT NULL AND o.o_orderkey % 13 <> 0 AND o.o_orderkey % 17 <> 0 AS ok
          FROM smp LEFT JOIN orders o ON smp.o_orderkey = o.o_orderkey),
  val AS (SELECT batch_id, count(*) AS sampled, count(*) FILTER (ok) AS retrieved,
                 string_agg(CAST(o_orderkey AS VARCHAR) || ':' || CASE WHEN ok THEN 'SUCCESS' ELSE 'FAILURE' END, ','
                            ORDER BY CAST(o_orderkey AS VARCHAR) || ':' || CASE WHEN ok THEN 'SUCCESS' ELSE 'FAILURE' END) AS txt
          FROM chk GROUP BY 1),
  res AS (SELECT l.batch_id, l.batch_end, coalesce(source_count, 0) AS source_count, coalesce(target_count, 0) AS target_count,
                 coalesce(mismatched, 0) AS mismatched, coalesce(missing, 0) AS missing,
                 coalesce(sampled, 0) AS sampled, coalesce(retrieved, 0) AS retrieved,
                 CASE WHEN coalesce(source_count, 0) = 0 OR coalesce(target_count, 0) = 0 THEN 'NOT MATCHED'
                      WHEN mismatched = 0 THEN 'MATCHED' ELSE 'MISMATCHED' END AS reconcile_check,
                 CASE WHEN coalesce(source_count, 0) = 0 OR coalesce(target_count, 0) = 0 THEN 'FAILURE' ELSE txt END AS retrieval_validation,
                 l.batch_end + to_seconds(coalesce(source_count, 0)) AS reconcile_dttm
          FROM ledger l LEFT JOIN per USING (batch_id) LEFT JOIN val USING (batch_id) WHERE l.reconcile_dttm IS NULL)"""


def _written_back(spark, sf):
    """The ledger after one upsert of the results of all pending batches."""
    t = Tables(spark, sf)
    ledger = monthly_ledger(spark, sf)
    pending = B.pending_batches(ledger)
    month = F.date_format("o_orderdate", "yyyyMM").alias("batch_id")
    todo = pending.select("batch_id")
    s, tg = (df.select("*", month).join(todo, "batch_id", "left_semi") for df in (t.orders, target_orders(t)))
    per = R.reconcile_by_batch(s, tg, "o_orderkey", "batch_id", FIELDS)
    order = F.struct(F.conv(F.substring(F.md5(F.col("id").cast("string")), 1, 8), 16, 10).cast("bigint").alias("h"), "id")
    sample = R.sample_per_group(tg.select("batch_id", F.col("o_orderkey").alias("id")), "batch_id", order, SAMPLE)
    k = F.col("o_orderkey")
    listing = t.orders.where(k % 13 != 0).select(k.alias("guid"), F.lit(0).alias("server"), F.when(k % 17 == 0, 0).otherwise(1).alias("length"))
    checked = R.retrieval_validation(sample, listing, "id")
    finished = F.timestamp_add("SECOND", F.coalesce("source_count", F.lit(0)), F.col("batch_end"))
    return U.upsert(ledger, R.batch_results(pending, per, checked, finished), "batch_id")


@query(
    "ledger_write_back",
    f"""{_RESULTS_SQL}
        SELECT l.batch_id, strftime(coalesce(r.reconcile_dttm, l.reconcile_dttm), '%Y-%m-%d %H:%M:%S') AS reconcile_dttm,
               CAST(r.source_count AS VARCHAR) AS source_count, CAST(r.target_count AS VARCHAR) AS target_count,
               r.reconcile_check, r.retrieval_validation
        FROM ledger l LEFT JOIN res r USING (batch_id)""",
)
def ledger_write_back(spark, sf):
    """Counts, decision, retrieval results and completion time of every pending batch in one upsert."""
    return _written_back(spark, sf).select(
        "batch_id",
        F.date_format("reconcile_dttm", "yyyy-MM-dd HH:mm:ss").alias("reconcile_dttm"),
        F.col("source_count").cast("string").alias("source_count"),
        F.col("target_count").cast("string").alias("target_count"),
        "reconcile_check",
        "retrieval_validation",
    )


@query(
    "recon_report",
    f"""{_RESULTS_SQL}
        SELECT count(*) AS batches, CAST(sum(greatest(source_count, target_count)) AS BIGINT) AS total_processed,
               round(avg(CASE WHEN reconcile_check = 'MATCHED' THEN 1.0 ELSE 0.0 END), 6) AS match_rate,
               round(avg(CASE WHEN reconcile_check = 'MISMATCHED' THEN 1.0 ELSE 0.0 END), 6) AS mismatch_rate,
               round(sum(retrieved) / sum(sampled), 6) AS validation_success_rate,
               round(avg(epoch_us(reconcile_dttm) - epoch_us(batch_end)) / 1000000, 3) AS avg_reconcile_seconds
        FROM res""",
)
def recon_report(spark, sf):
    """Key figures over the written-back ledger, validation rate and mean time included."""
    return R.reconciliation_report(_written_back(spark, sf), F.col("batch_end"))


@query(
    "lookup_by_uid",
    """WITH ids AS (SELECT doc_id AS uid FROM labels UNION ALL SELECT doc_id + 1000000000 FROM labels)
       SELECT ids.uid, d.doc_id IS NOT NULL AS found FROM ids LEFT JOIN documents d ON ids.uid = d.doc_id""",
)
def lookup_by_uid(spark, sf):
    """Batch of point lookups: ids table left-joined to the documents."""
    t = Tables(spark, sf)
    ids = t.labels.select(F.col("doc_id").alias("uid")).unionByName(
        t.labels.select((F.col("doc_id") + 1_000_000_000).alias("uid"))
    )
    docs = t.documents.select(F.col("doc_id").alias("uid"), F.lit(True).alias("found"))
    return ids.join(docs, "uid", "left").select("uid", F.coalesce("found", F.lit(False)).alias("found"))


@query(
    "job_log_metrics",
    """SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS batch_id,
              CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS migrated,
              CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS failed,
              count(*) AS source_count,
              (epoch_us(max(ts)) - epoch_us(min(ts))) // 1000000 AS duration_s,
              CASE WHEN sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) = 0 THEN 'PASS' ELSE 'FAIL' END AS outcome
       FROM events GROUP BY 1""",
)
def job_log_metrics(spark, sf):
    """Structured job-log metrics per batch (events read as a job log)."""
    e = Tables(spark, sf).events
    failed = F.sum(F.when(F.col("event_type") == "error", 1).otherwise(0))
    secs = F.unix_micros(F.col("ts").cast("timestamp"))
    return e.groupBy(F.date_format(F.date_trunc("day", "ts"), "yyyy-MM-dd").alias("batch_id")).agg(
        F.sum(F.when(F.col("event_type") == "purchase", 1).otherwise(0)).alias("migrated"),
        failed.alias("failed"),
        F.count(F.lit(1)).alias("source_count"),
        F.floor((F.max(secs) - F.min(secs)) / 1_000_000).cast("bigint").alias("duration_s"),
        F.when(failed == 0, "PASS").otherwise("FAIL").alias("outcome"),
    )

