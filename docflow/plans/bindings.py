"""Reference entities mapped onto the test tables (Spark side) and the same
derivations as SQL fragments for the DuckDB oracle.

* main document = orders (key o_orderkey), tenants from customer/nation;
  nulls, empty arrays and odd values are injected by key arithmetic on the
  WHOLE table (they simulate dirty data; they never select a subset).
* target side for reconciliation = orders with deterministic mutations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docflow.functions.exprs import uuid_from_key
from docflow.sources.tables import Tables

TENANTS_TYPE = (
    "array<struct<domain:string,division:string,subdivision:string,"
    "recordsManagement:struct<recordCode:string,jurisdiction:string>>>"
)


def order_documents(t: Tables) -> DataFrame:
    """Nested document per order."""
    K = F.col("o_orderkey")
    cn = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    o = t.orders.join(cn, F.col("o_custkey") == F.col("c_custkey"), "left")
    t1 = F.struct(
        F.col("c_mktsegment").alias("domain"),
        F.when(K % 19 == 0, F.lit(None).cast("string")).otherwise(F.col("n_name")).alias("division"),
        F.col("o_orderstatus").alias("subdivision"),
        F.struct(
            F.when(K % 23 == 0, F.lit(None).cast("string")).otherwise(F.col("o_orderpriority")).alias("recordCode"),
            F.col("n_name").alias("jurisdiction"),
        ).alias("recordsManagement"),
    )
    t2 = F.struct(
        F.col("n_name").alias("domain"),
        F.col("c_mktsegment").alias("division"),
        F.col("o_orderstatus").alias("subdivision"),
        F.struct(F.col("o_orderstatus").alias("recordCode"), F.col("n_name").alias("jurisdiction")).alias(
            "recordsManagement"
        ),
    )
    two = F.array(t1, t2)
    tenants = F.when(K % 13 == 0, F.array().cast(TENANTS_TYPE)).when(K % 17 == 0, F.lit(None)).otherwise(two)
    return o.select(
        K.alias("doc_id"),
        F.struct(uuid_from_key(K).alias("documentOsGuid"), F.concat(F.lit("doc-"), K.cast("string")).alias("documentOsName")).alias("documentOS"),
        F.struct(F.concat(F.lit("T"), K.cast("string")).alias("TUPLEID")).alias("tuple"),
        F.struct(
            F.lit("archive").alias("documentStoreType"),
            F.when(K % 29 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("store://"), K.cast("string"))).alias(
                "documentStoreUrl"
            ),
        ).alias("storage"),
        F.struct(tenants.alias("tenants")).alias("bankDocument"),
        F.struct(F.col("o_orderpriority").alias("originationSystemName")).alias("adminDocument"),
        F.when(K % 11 == 0, F.lit(None)).otherwise(
            F.struct(
                F.when(K % 7 == 0, F.lit("loader")).when(K % 5 == 0, F.lit(None).cast("string")).otherwise(F.lit("docflow")).alias("migratedBy"),
                F.concat(F.lit("B"), F.floor(K / 5000).cast("string")).alias("migrationBatchId"),
            )
        ).alias("migrationHistory"),
        F.col("o_orderdate").alias("systemCreatedDateTime"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("contentSize"),
        F.when(K % 31 == 0, F.lit("WIP")).when(K % 37 == 0, F.lit("X")).otherwise(F.col("o_orderstatus")).alias(
            "businessDocumentStatus"
        ),
    )


# Same derivation, flattened, for the oracle.
DOCS_SQL = """
docs AS (
  SELECT o.o_orderkey AS doc_id, o.o_orderkey AS k, c.c_mktsegment AS seg, n.n_name AS nat,
         o.o_orderstatus AS status, o.o_orderpriority AS prio, o.o_orderdate AS created,
         CASE WHEN o.o_orderkey % 13 = 0 THEN 'empty' WHEN o.o_orderkey % 17 = 0 THEN 'null' ELSE 'two' END AS tkind,
         CASE WHEN o.o_orderkey % 19 = 0 THEN NULL ELSE n.n_name END AS t1_div,
         CASE WHEN o.o_orderkey % 23 = 0 THEN NULL ELSE o.o_orderpriority END AS t1_code,
         CASE WHEN o.o_orderkey % 29 = 0 THEN NULL ELSE 'store://' || CAST(o.o_orderkey AS VARCHAR) END AS url,
         o.o_orderkey % 11 = 0 AS mh_null,
         CASE WHEN o.o_orderkey % 11 = 0 THEN NULL WHEN o.o_orderkey % 7 = 0 THEN 'loader'
              WHEN o.o_orderkey % 5 = 0 THEN NULL ELSE 'docflow' END AS migrated_by,
         CASE WHEN o.o_orderkey % 11 = 0 THEN NULL ELSE 'B' || CAST(floor(o.o_orderkey / 5000) AS BIGINT) END AS mig_batch,
         CAST(round(o.o_totalprice * 100) AS BIGINT) AS content_size,
         CASE WHEN o.o_orderkey % 31 = 0 THEN 'WIP' WHEN o.o_orderkey % 37 = 0 THEN 'X' ELSE o.o_orderstatus END AS bstatus
  FROM orders o LEFT JOIN (customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey) ON o.o_custkey = c.c_custkey
)"""


def target_orders(t: Tables) -> DataFrame:
    """Target copy of orders: k%97 dropped, status 'X' if k%89, priority NULL if
    k%101, extra rows k+1e6 for k%211."""
    K = F.col("o_orderkey")
    o = t.orders
    base = o.filter(K % 97 != 0).select(
        "o_orderkey",
        "o_custkey",
        F.when(K % 89 == 0, F.lit("X")).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        "o_totalprice",
        "o_orderdate",
        F.when(K % 101 == 0, F.lit(None).cast("string")).otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
    )
    extra = o.filter(K % 211 == 0).select(
        (-K - 1).alias("o_orderkey"), "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"
    )
    return base.unionByName(extra)


TARGET_SQL = """
tgt AS (
  SELECT o_orderkey, o_custkey,
         CASE WHEN o_orderkey % 89 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
         o_totalprice, o_orderdate,
         CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority
  FROM orders WHERE o_orderkey % 97 <> 0
  UNION ALL
  SELECT -o_orderkey - 1, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderkey % 211 = 0
)"""


def object_listing(t: Tables) -> DataFrame:
    """Object store listing derived from documents: (guid, server, length).

    Absent for doc_id%13==0, zero length for doc_id%17==0, a second replica
    on another server for doc_id%5==0.
    """
    d = t.documents.filter(F.col("doc_id") % 13 != 0)
    length = F.when(F.col("doc_id") % 17 == 0, F.lit(0)).otherwise(F.col("n_chars")).cast("bigint")
    first = d.select(F.col("doc_id").alias("guid"), (F.col("doc_id") % 3).alias("server"), length.alias("length"))
    second = d.filter(F.col("doc_id") % 5 == 0).select(
        F.col("doc_id").alias("guid"), ((F.col("doc_id") + 1) % 3).alias("server"), F.col("n_chars").alias("length")
    )
    return first.unionByName(second)


LISTING_SQL = """
listing AS (
  SELECT doc_id AS guid, doc_id % 3 AS server,
         CAST(CASE WHEN doc_id % 17 = 0 THEN 0 ELSE n_chars END AS BIGINT) AS length
  FROM documents WHERE doc_id % 13 <> 0
  UNION ALL
  SELECT doc_id, (doc_id + 1) % 3, n_chars FROM documents WHERE doc_id % 13 <> 0 AND doc_id % 5 = 0
)"""
