"""Nested-document queries: predicates on nested paths, array fields,
document assembly, unwind, validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from docflow.functions.exprs import elem_match as elem_match_expr
from docflow.functions.exprs import ne_or_missing as ne_expr
from docflow.functions.exprs import ne_or_missing_array
from docflow.operators import nesting as N
from docflow.operators import profile as P
from docflow.operators import validate as V
from docflow.plans.bindings import DOCS_SQL, order_documents
from docflow.plans.registry import query
from docflow.sources.tables import Tables

W = f"WITH {DOCS_SQL}"


@query(
    "required_fields",
    f"""{W} SELECT doc_id FROM docs
        WHERE url IS NOT NULL AND NOT mh_null AND mig_batch IS NOT NULL AND prio IS NOT NULL
          AND created IS NOT NULL AND tkind = 'two' AND seg IS NOT NULL AND nat IS NOT NULL
          AND t1_div IS NOT NULL""",
)
def required_fields(spark, sf):
    d = order_documents(Tables(spark, sf))
    pred = N.required_fields(
        [
            "documentOS.documentOsGuid",
            "systemCreatedDateTime",
            "storage.documentStoreUrl",
            "adminDocument.originationSystemName",
            "migrationHistory.migrationBatchId",
        ],
        arrays={"bankDocument.tenants": ["domain", "division"]},
    )
    return d.filter(pred).select("doc_id")


@query(
    "elem_match",
    f"""{W} SELECT doc_id FROM docs
        WHERE tkind = 'two' AND ((seg = 'BUILDING' AND t1_div = 'NATION_3') OR (nat = 'BUILDING' AND seg = 'NATION_3'))""",
)
def elem_match(spark, sf):
    d = order_documents(Tables(spark, sf))
    return d.filter(elem_match_expr("bankDocument.tenants", domain="BUILDING", division="NATION_3")).select("doc_id")


@query(
    "ne_or_missing",
    f"""{W} SELECT doc_id,
               migrated_by IS DISTINCT FROM 'loader' AS migrated_by_ne,
               NOT (tkind = 'two' AND (seg = 'BUILDING' OR nat = 'BUILDING')) AS domain_ne
        FROM docs""",
)
def ne_or_missing(spark, sf):
    d = order_documents(Tables(spark, sf))
    return d.select(
        "doc_id",
        ne_expr("migrationHistory.migratedBy", "loader").alias("migrated_by_ne"),
        ne_or_missing_array(N.array_field("bankDocument.tenants", "domain"), "BUILDING").alias("domain_ne"),
    )


@query(
    "array_field",
    f"""{W} SELECT doc_id,
               CASE tkind WHEN 'null' THEN NULL WHEN 'empty' THEN '' ELSE concat_ws(',', seg, nat) END AS domains,
               CASE tkind WHEN 'two' THEN '2' WHEN 'empty' THEN '0' END AS n_tenants
        FROM docs""",
)
def array_field(spark, sf):
    d = order_documents(Tables(spark, sf))
    arr = N.array_field("bankDocument.tenants", "domain")
    tenants = F.col("bankDocument.tenants")
    # size of a NULL array is NULL here (not -1); rendered as text to keep NULL
    n = F.when(tenants.isNotNull(), F.size(tenants)).cast("string")
    return d.select("doc_id", F.array_join(arr, ",").alias("domains"), n.alias("n_tenants"))


@query(
    "array_first",
    f"""{W} SELECT doc_id, CASE WHEN tkind = 'two' THEN seg END AS first_domain,
               CASE WHEN tkind = 'two' THEN t1_code END AS first_record_code FROM docs""",
)
def array_first(spark, sf):
    d = order_documents(Tables(spark, sf))
    first = N.first_element("bankDocument.tenants")
    return d.select(
        "doc_id", first["domain"].alias("first_domain"), first["recordsManagement"]["recordCode"].alias("first_record_code")
    )


# Fixed rule set used by the document-validation queries.
DOC_SCHEMA = {
    "bsonType": "object",
    "required": ["documentOS", "systemCreatedDateTime", "contentSize"],
    "properties": {
        "documentOS": {"bsonType": "object", "required": ["documentOsGuid"]},
        "storage": {"bsonType": "object", "required": ["documentStoreUrl"]},
        "contentSize": {"bsonType": ["int", "long"]},
        "systemCreatedDateTime": {"bsonType": "date"},
        "businessDocumentStatus": {"bsonType": "string", "enum": ["F", "O", "P", "WIP"]},
        "migrationHistory": {"bsonType": "object", "required": ["migratedBy"]},
        "bankDocument": {
            "bsonType": "object",
            "required": ["tenants"],
            "properties": {
                "tenants": {
                    "bsonType": "array",
                    "minItems": 1,
                    "items": {"bsonType": "object", "required": ["domain", "division"]},
                }
            },
        },
    },
}

_VIOL_SQL = f"""{W}, v AS (
  SELECT doc_id, list_filter([
      CASE WHEN url IS NULL THEN 'required:storage.documentStoreUrl' END,
      CASE WHEN bstatus NOT IN ('F', 'O', 'P', 'WIP') THEN 'enum:businessDocumentStatus' END,
      CASE WHEN NOT mh_null AND migrated_by IS NULL THEN 'required:migrationHistory.migratedBy' END,
      CASE WHEN tkind = 'null' THEN 'required:bankDocument.tenants' END,
      CASE WHEN tkind = 'empty' THEN 'minItems:bankDocument.tenants' END,
      CASE WHEN tkind = 'two' AND (seg IS NULL OR nat IS NULL) THEN 'required:bankDocument.tenants[].domain' END,
      CASE WHEN tkind = 'two' AND (t1_div IS NULL OR seg IS NULL) THEN 'required:bankDocument.tenants[].division' END
    ], lambda x: x IS NOT NULL) AS viol
  FROM docs)"""


def _validated(spark, sf):
    return V.validate(order_documents(Tables(spark, sf)), DOC_SCHEMA)


@query(
    "validate_documents",
    f"""{_VIOL_SQL} SELECT doc_id, array_to_string(list_sort(viol), ',') AS violations, len(viol) AS n_violations FROM v""",
)
def validate_documents(spark, sf):
    v = _validated(spark, sf)
    return v.select(
        "doc_id",
        F.array_join(F.sort_array("violations"), ",").alias("violations"),
        F.size("violations").cast("bigint").alias("n_violations"),
    )


# Rule set of the JSON documents below (fixed values).
JSON_SCHEMA = {
    "bsonType": "object",
    "required": ["status", "owner"],
    "properties": {
        "status": {"bsonType": "string", "enum": ["F", "O"]},
        "amount": {"bsonType": ["int", "long"]},
        "owner": {"bsonType": "object", "required": ["ref"], "properties": {"ref": {"bsonType": "string"}}},
    },
}


@query(
    "validate_json_values",
    """WITH o AS (SELECT o_orderkey AS k, o_orderstatus AS s FROM orders)
       SELECT k AS doc_id, array_to_string(list_sort(list_filter(CASE WHEN k % 47 = 0 THEN ['required:$'] WHEN k % 43 = 0 THEN ['json:$'] ELSE [
           CASE WHEN k % 31 = 0 THEN 'type:status' WHEN s NOT IN ('F', 'O') THEN 'enum:status' END,
           CASE WHEN k % 29 = 0 THEN 'type:amount' END,
           CASE WHEN k % 37 = 0 THEN 'required:owner' WHEN k % 41 = 0 THEN 'required:owner.ref' WHEN k % 11 = 0 THEN 'type:owner.ref' END
         ] END, lambda x: x IS NOT NULL)), ',') AS violations
       FROM o""",
)
def validate_json_values(spark, sf):
    """Per-value type, enum and presence rules on documents held as JSON text, with
    malformed, missing and wrongly typed values by key arithmetic over all orders."""
    k = F.col("o_orderkey")
    status = F.when(k % 31 == 0, F.lit("7")).otherwise(F.concat(F.lit('"'), "o_orderstatus", F.lit('"')))
    amount = F.when(k % 29 == 0, F.lit('"n/a"')).otherwise(F.round(F.col("o_totalprice") * 100).cast("bigint").cast("string"))
    ref = F.when(k % 41 == 0, F.lit("null")).when(k % 11 == 0, F.col("o_custkey").cast("string")).otherwise(F.concat(F.lit('"c'), F.col("o_custkey").cast("string"), F.lit('"')))
    owner = F.when(k % 37 == 0, F.lit("")).otherwise(F.concat(F.lit(',"owner":{"ref":'), ref, F.lit("}")))
    body = F.concat(F.lit('{"status":'), status, F.lit(',"amount":'), amount, owner, F.lit("}"))
    body = F.when(k % 47 == 0, F.lit(None)).when(k % 43 == 0, F.lit('{"status": ')).otherwise(body)
    docs = Tables(spark, sf).orders.select(k.alias("doc_id"), body.alias("body"))
    v = V.validate_json(docs, "body", JSON_SCHEMA)
    return v.select("doc_id", F.array_join(F.sort_array("violations"), ",").alias("violations"))


# Rule set of the JSON documents with arrays below (fixed values).
JSON_ARRAY_SCHEMA = {
    "bsonType": "object",
    "properties": {
        "lines": {
            "bsonType": "array",
            "minItems": 1,
            "items": {
                "bsonType": "object",
                "required": ["qty"],
                "properties": {"qty": {"bsonType": ["int", "long"]}, "tags": {"bsonType": "array", "minItems": 1, "items": {"bsonType": "string"}}},
            },
        }
    },
}


@query(
    "validate_json_arrays",
    """SELECT o_orderkey AS doc_id, array_to_string(list_sort(list_filter(
         CASE WHEN o_orderkey % 41 = 0 THEN ['minItems:lines'] WHEN o_orderkey % 43 = 0 THEN ['type:lines'] ELSE [
           CASE WHEN o_orderkey % 47 = 0 THEN 'required:lines[0].qty' END,
           CASE WHEN o_orderkey % 29 = 0 THEN 'type:lines[1].qty' END,
           CASE WHEN o_orderkey % 31 = 0 THEN 'minItems:lines[1].tags' WHEN o_orderkey % 37 = 0 THEN 'type:lines[1].tags[1]' END
         ] END, lambda x: x IS NOT NULL)), ',') AS violations
       FROM orders""",
)
def validate_json_arrays(spark, sf):
    """Rules on array items, arrays in arrays and their lengths, each with its position;
    broken values by key arithmetic over all orders."""
    k = F.col("o_orderkey")
    qty0 = F.when(k % 47 == 0, F.lit("")).otherwise(F.concat(F.lit('"qty":'), k.cast("string"), F.lit(",")))
    qty1 = F.when(k % 29 == 0, F.lit('"five"')).otherwise(F.lit("5"))
    tags = F.when(k % 31 == 0, F.lit("[]")).when(k % 37 == 0, F.lit('["a",7]')).otherwise(F.lit('["c"]'))
    lines = F.concat(F.lit("[{"), qty0, F.lit('"tags":["a","b"]},{"qty":'), qty1, F.lit(',"tags":'), tags, F.lit("}]"))
    body = F.concat(F.lit('{"lines":'), F.when(k % 41 == 0, F.lit("[]")).when(k % 43 == 0, F.lit('"none"')).otherwise(lines), F.lit("}"))
    v = V.validate_json(Tables(spark, sf).orders.select(k.alias("doc_id"), body.alias("body")), "body", JSON_ARRAY_SCHEMA)
    return v.select("doc_id", F.array_join(F.sort_array("violations"), ",").alias("violations"))


@query(
    "validation_split",
    f"""{_VIOL_SQL} SELECT CASE WHEN len(viol) = 0 THEN 'accepted' ELSE 'rejected' END AS outcome, count(*) AS n
        FROM v GROUP BY 1""",
)
def validation_split(spark, sf):
    outcome = F.when(F.size("violations") == 0, "accepted").otherwise("rejected")  # one pass for both sides
    return _validated(spark, sf).groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


@query("violation_counts", f"""{_VIOL_SQL} SELECT unnest(viol) AS rule, count(*) AS n FROM v GROUP BY 1""")
def violation_counts(spark, sf):
    return V.violation_counts(_validated(spark, sf))


@query(
    "row_error_quarantine",
    """WITH s AS (
         SELECT o_orderkey,
                CASE WHEN o_orderkey % 41 = 0 THEN 'not-a-date' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS date_txt,
                CASE WHEN o_orderkey % 43 = 0 THEN 'n/a' ELSE CAST(o_custkey AS VARCHAR) END AS cust_txt
         FROM orders),
       p AS (SELECT o_orderkey, try_strptime(date_txt, '%Y-%m-%d') AS order_date, TRY_CAST(cust_txt AS BIGINT) AS cust
             FROM s)
       SELECT o_orderkey, strftime(order_date, '%Y-%m-%d') AS order_date, CAST(cust AS VARCHAR) AS cust,
              nullif(concat_ws(',', CASE WHEN order_date IS NULL THEN 'order_date' END,
                                    CASE WHEN cust IS NULL THEN 'cust' END), '') AS error
       FROM p""",
)
def row_error_quarantine(spark, sf):
    o = Tables(spark, sf).orders
    k = F.col("o_orderkey")
    s = o.select(
        "o_orderkey",
        F.when(k % 41 == 0, F.lit("not-a-date")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("date_txt"),
        F.when(k % 43 == 0, F.lit("n/a")).otherwise(F.col("o_custkey").cast("string")).alias("cust_txt"),
    )
    p = V.parse_with_errors(
        s,
        {
            "order_date": ("date_txt", F.try_to_timestamp("date_txt", F.lit("yyyy-MM-dd"))),
            "cust": ("cust_txt", F.col("cust_txt").try_cast("bigint")),
        },
    )
    return p.select(
        "o_orderkey", F.date_format("order_date", "yyyy-MM-dd").alias("order_date"), F.col("cust").cast("string").alias("cust"), "error"
    )


# -- document assembly from relational rows ---------------------------------

def _child_fields():
    return {"domain": F.lit("ORDERS"), "name": F.col("l_returnflag"), "value": F.col("l_partkey").cast("string")}


def _assembled(spark, sf, *fields: str):
    """Orders with their child arrays (all of them, or the named ones)."""
    t = Tables(spark, sf)
    children = {
        "customerReferenceKeys": (t.lineitem, "l_orderkey", _child_fields()),
        "externalReferenceKeys": (
            t.lineitem.filter(F.col("l_linestatus") == "F"),
            "l_orderkey",
            {"domain": F.lit("EXT"), "name": F.col("l_linestatus"), "value": F.col("l_suppkey").cast("string")},
        ),
    }
    return N.assemble_documents(
        t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority"),
        "o_orderkey",
        {k: v for k, v in children.items() if not fields or k in fields},
    )


def _refs_text(field: str):
    return F.array_join(F.transform(field, lambda x: F.concat_ws("/", x["domain"], x["name"], x["value"])), ",")


@query(
    "nested_value_profile",
    f"""{W}, p AS (
         SELECT unnest([{{'field': 'document.businessDocumentStatus', 'value': bstatus}},
                        {{'field': 'document.migrationHistory.migratedBy', 'value': CASE WHEN mh_null THEN NULL ELSE migrated_by END}},
                        {{'field': 'document.bankDocument.tenants.domain',
                          'value': CASE tkind WHEN 'null' THEN NULL WHEN 'empty' THEN '[]'
                                   ELSE CAST(to_json([seg, nat]) AS VARCHAR) END}}], recursive := true) FROM docs)
       SELECT field, value, count(*) AS n FROM p GROUP BY 1, 2""",
)
def nested_value_profile(spark, sf):
    """Value frequencies at dotted paths of the nested documents, also through an array."""
    d = order_documents(Tables(spark, sf))
    paths = ["businessDocumentStatus", "migrationHistory.migratedBy", "bankDocument.tenants.domain"]
    return P.field_value_profile([(d, "document", paths)]).select("field", "value", "n")


@query(
    "collect_children",
    """SELECT l_orderkey AS o_orderkey, count(*) AS n_children,
              string_agg(l_returnflag || '=' || CAST(l_partkey AS VARCHAR), ',' ORDER BY l_returnflag, CAST(l_partkey AS VARCHAR)) AS children
       FROM lineitem GROUP BY 1""",
)
def collect_children(spark, sf):
    li = Tables(spark, sf).lineitem
    c = N.collect_children(li, "l_orderkey", _child_fields(), "refs")
    return c.select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.size("refs").cast("bigint").alias("n_children"),
        F.array_join(F.transform("refs", lambda x: F.concat(x["name"], F.lit("="), x["value"])), ",").alias("children"),
    )


@query(
    "assemble_documents",
    """WITH c AS (SELECT l_orderkey, count(*) AS n, string_agg('ORDERS/' || l_returnflag || '/' || CAST(l_partkey AS VARCHAR), ','
                                                          ORDER BY l_returnflag, CAST(l_partkey AS VARCHAR)) AS refs
                  FROM lineitem GROUP BY 1),
            e AS (SELECT l_orderkey, count(*) AS n, string_agg('EXT/F/' || CAST(l_suppkey AS VARCHAR), ',' ORDER BY CAST(l_suppkey AS VARCHAR)) AS refs
                  FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1)
       SELECT o.o_orderkey, o.o_orderstatus, coalesce(c.n, 0) AS n_customer_refs, coalesce(e.n, 0) AS n_external_refs,
              coalesce(c.refs, '') AS customer_refs, coalesce(e.refs, '') AS external_refs
       FROM orders o LEFT JOIN c ON o.o_orderkey = c.l_orderkey LEFT JOIN e ON o.o_orderkey = e.l_orderkey""",
)
def assemble_documents(spark, sf):
    d = _assembled(spark, sf)
    return d.select(
        "o_orderkey",
        "o_orderstatus",
        F.size("customerReferenceKeys").cast("bigint").alias("n_customer_refs"),
        F.size("externalReferenceKeys").cast("bigint").alias("n_external_refs"),
        _refs_text("customerReferenceKeys").alias("customer_refs"),
        _refs_text("externalReferenceKeys").alias("external_refs"),
    )


@query(
    "left_join_chain",
    """WITH c AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1),
            e AS (SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1)
       SELECT CASE WHEN c.n IS NULL THEN 'no_children' WHEN e.n IS NULL THEN 'customer_only' ELSE 'both' END AS shape,
              count(*) AS n_documents
       FROM orders o LEFT JOIN c ON o.o_orderkey = c.l_orderkey LEFT JOIN e ON o.o_orderkey = e.l_orderkey
       GROUP BY 1""",
)
def left_join_chain(spark, sf):
    """main ⟕ ext ⟕ cust: parents without children survive both left joins."""
    t = Tables(spark, sf)
    flags = {"has_customer": (t.lineitem, "l_orderkey"), "has_external": (t.lineitem.filter(F.col("l_linestatus") == "F"), "l_orderkey")}
    d = N.flag_children(t.orders.select("o_orderkey"), "o_orderkey", flags)
    shape = F.when(~F.col("has_customer"), "no_children").when(~F.col("has_external"), "customer_only").otherwise("both")
    return d.groupBy(shape.alias("shape")).agg(F.count(F.lit(1)).alias("n_documents"))


@query(
    "unwind",
    """SELECT l_orderkey AS o_orderkey, l_returnflag AS name, l_partkey AS value FROM lineitem""",
)
def unwind(spark, sf):
    d = _assembled(spark, sf, "customerReferenceKeys")
    u = N.unwind(d.select("o_orderkey", "customerReferenceKeys"), "customerReferenceKeys", "ref")
    return u.select("o_orderkey", F.col("ref.name").alias("name"), F.col("ref.value").cast("bigint").alias("value"))


@query(
    "children_having_count",
    """SELECT l_orderkey AS o_orderkey, count(*) AS matching_children FROM lineitem
       WHERE l_returnflag = 'R' GROUP BY 1 HAVING count(*) = 3""",
)
def children_having_count(spark, sf):
    d = _assembled(spark, sf, "customerReferenceKeys")
    r = N.children_having_count(d, "customerReferenceKeys", lambda x: x["name"] == "R", 3)
    return r.select("o_orderkey", F.col("matching_children").cast("bigint").alias("matching_children"))


@query(
    "embed_child",
    """SELECT o_orderkey, c.c_name AS customer_name, c.c_mktsegment AS customer_segment
       FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey""",
)
def embed_child(spark, sf):
    t = Tables(spark, sf)
    parent = t.orders.select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    e = N.embed_child(parent, t.customer, "c_custkey", "customer", ["c_name", "c_mktsegment"])
    return e.select("o_orderkey", F.col("customer.c_name").alias("customer_name"), F.col("customer.c_mktsegment").alias("customer_segment"))


@query(
    "nest_subdocument",
    """SELECT o_orderkey AS orderId, c.c_name AS customer_name, c.c_mktsegment AS customer_segment,
              n.n_name AS customer_nation_name
       FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""",
)
def nest_subdocument(spark, sf):
    t = Tables(spark, sf)
    j = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left").join(
        t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left"
    )
    nested = N.nest_by_path(
        j,
        {
            "orderId": "o_orderkey",
            "customer.name": "c_name",
            "customer.segment": "c_mktsegment",
            "customer.nation.name": "n_name",
        },
    )
    return nested.select(
        "orderId",
        F.col("customer.name").alias("customer_name"),
        F.col("customer.segment").alias("customer_segment"),
        F.col("customer.nation.name").alias("customer_nation_name"),
    )


@query(
    "map_columns",
    """SELECT c_custkey AS customerId, c_name AS customerName, c_nationkey AS c_nationkey,
              c_acctbal AS c_acctbal, c_mktsegment AS "family.segment" FROM customer""",
)
def map_columns(spark, sf):
    c = Tables(spark, sf).customer
    return N.rename_by_mapping(
        c, {"C_CUSTKEY": "customerId", "C_NAME": "customerName", "C_MKTSEGMENT": "family.segment"}
    )


@query(
    "migrate_documents",
    f"""{_VIOL_SQL} SELECT CASE WHEN len(viol) = 0 THEN 'accepted' ELSE 'rejected' END AS outcome, count(*) AS n,
                           CAST(sum(len(viol)) AS BIGINT) AS n_violations
        FROM v GROUP BY 1""",
)
def migrate_documents(spark, sf):
    """Whole migration run: assemble + validate + one partitioned write; the
    written collection is read back per outcome (the run's ledger row is the
    same aggregate, see ``operators.migrate``)."""
    from docflow.operators.migrate import migrate_documents as run
    from docflow.session import scratch_path

    out = scratch_path(spark, "migration")
    run(spark, order_documents(Tables(spark, sf)), DOC_SCHEMA, out, "RUN-1")
    back = spark.read.parquet(out)
    return back.groupBy("outcome").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.size("violations")).cast("bigint").alias("n_violations")
    )
