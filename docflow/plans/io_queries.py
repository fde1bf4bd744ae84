"""Source / sink round trips through the shared scratch folder, keyed upsert,
window scans and the pandas decode hook."""

from __future__ import annotations

from pyspark.sql import functions as F

from docflow.functions.udf import decode_column, utf8_decode
from docflow.operators import discover as D
from docflow.operators import upsert as U
from docflow.plans.bindings import DOCS_SQL, order_documents
from docflow.plans.registry import query
from docflow.session import scratch_path
from docflow.sources import io as IO
from docflow.sources.tables import Tables

TEXTS_PER_FILE = 200

_FLAT_DOC_SQL = f"""WITH {DOCS_SQL}
  SELECT doc_id, regexp_replace(md5(CAST(doc_id AS VARCHAR)), '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})$', '\\1-\\2-\\3-\\4-\\5') AS guid,
         url, migrated_by, CASE tkind WHEN 'two' THEN '2' WHEN 'empty' THEN '0' END AS n_tenants, bstatus AS status,
         strftime(created, '%Y-%m-%d') AS created
  FROM docs"""


def _flatten(d):
    return d.select(
        "doc_id",
        F.col("documentOS.documentOsGuid").alias("guid"),
        F.col("storage.documentStoreUrl").alias("url"),
        F.col("migrationHistory.migratedBy").alias("migrated_by"),
        F.when(F.col("bankDocument.tenants").isNotNull(), F.size("bankDocument.tenants")).cast("string").alias("n_tenants"),
        F.col("businessDocumentStatus").alias("status"),
        F.date_format("systemCreatedDateTime", "yyyy-MM-dd").alias("created"),
    )


@query("scan_documents", _FLAT_DOC_SQL)
def scan_documents(spark, sf):
    """Nested documents written as a JSON collection, scanned back with the
    nested schema (NULL fields are absent in the files)."""
    docs = order_documents(Tables(spark, sf))
    spec = IO.DocumentSpec("json", scratch_path(spark, "docs-json"))
    IO.write_documents(docs, spec, mode="errorifexists")
    return _flatten(IO.read_documents(spark, spec, docs.schema))


@query(
    "sink_documents_roundtrip",
    f"""WITH {DOCS_SQL} SELECT bstatus AS status, count(*) AS n, CAST(sum(content_size) AS BIGINT) AS total_size FROM docs GROUP BY 1""",
)
def sink_documents_roundtrip(spark, sf):
    """Append to a parquet collection partitioned by status; read back with
    partition pruning available on the status column."""
    docs = order_documents(Tables(spark, sf))
    spec = IO.DocumentSpec("parquet", scratch_path(spark, "docs-parquet"))
    docs = IO.cluster_for_partitioned_write(docs, ["businessDocumentStatus"])
    IO.write_documents(docs, spec, mode="append", partition_by=["businessDocumentStatus"])
    back = IO.read_documents(spark, spec)
    return back.groupBy(F.col("businessDocumentStatus").alias("status")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("contentSize").alias("total_size")
    )


@query(
    "text_folder_scan",
    "SELECT source, CAST(sum(length(text) + 1) AS BIGINT) AS total_chars FROM documents GROUP BY 1",
)
def text_folder_scan(spark, sf):
    """Corpus written as a folder of text files (one folder per source, a bounded
    number of texts per file), read back one row per file with its path;
    characters summed per source."""
    path = scratch_path(spark, "text-folder")
    docs = IO.cluster_for_partitioned_write(Tables(spark, sf).documents, ["source"])
    docs.select("source", "text").write.option("maxRecordsPerFile", str(TEXTS_PER_FILE)).partitionBy("source").text(path)
    files = IO.read_text_folder(spark, path, glob="*.txt")
    return files.groupBy("source").agg(F.sum(F.length("text")).cast("bigint").alias("total_chars"))


@query("sink_csv_roundtrip", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def sink_csv_roundtrip(spark, sf):
    path = scratch_path(spark, "csv")
    IO.write_csv(Tables(spark, sf).nation, path)
    return IO.read_csv(spark, path, "n_nationkey int, n_name string, n_regionkey int")


@query(
    "sink_pipe_csv_roundtrip",
    "SELECT s_suppkey, s_name, s_acctbal, CAST(s_suppkey // 25 AS INTEGER) AS batch_no FROM supplier",
)
def sink_pipe_csv_roundtrip(spark, sf):
    """Pipe-delimited CSV with header, appended per batch — all batches in ONE
    write with the batch id as partition column."""
    path = scratch_path(spark, "pipe-csv")
    s = Tables(spark, sf).supplier.select(
        "s_suppkey", "s_name", "s_acctbal", F.floor(F.col("s_suppkey") / 25).cast("int").alias("batch_no")
    )
    s = IO.cluster_for_partitioned_write(s, ["batch_no"])
    IO.write_csv(s, path, sep="|", mode="append", partition_by=["batch_no"])
    back = IO.read_csv(spark, path, "s_suppkey bigint, s_name string, s_acctbal double, batch_no int", sep="|")
    return back.select("s_suppkey", "s_name", "s_acctbal", "batch_no")


@query(
    "to_json_records",
    """SELECT s_suppkey, CASE WHEN s_nationkey % 2 = 0
              THEN to_json({'s_suppkey': s_suppkey, 's_name': s_name, 's_nationkey': s_nationkey, 'note': 'even'})
              ELSE to_json({'s_suppkey': s_suppkey, 's_name': s_name, 's_nationkey': s_nationkey}) END AS json
       FROM supplier""",
)
def to_json_records(spark, sf):
    s = Tables(spark, sf).supplier
    note = F.when(F.col("s_nationkey") % 2 == 0, F.lit("even")).alias("note")
    return IO.to_json_records(s, ["s_suppkey", "s_name", "s_nationkey", note], keep=["s_suppkey"])


@query(
    "from_json_records",
    """SELECT s_suppkey, s_name, s_nationkey, CASE WHEN s_nationkey % 2 = 0 THEN 'even' END AS note,
              CAST(s_nationkey AS VARCHAR) AS nation_text FROM supplier""",
)
def from_json_records(spark, sf):
    """JSON objects read back with a schema (absent fields are NULL) and by path."""
    j = to_json_records(spark, sf)
    r = F.from_json("json", "s_name string, s_nationkey bigint, note string")
    return j.select("s_suppkey", r.alias("r"), F.get_json_object("json", "$.s_nationkey").alias("nation_text")).select(
        "s_suppkey", "r.s_name", "r.s_nationkey", "r.note", "nation_text"
    )


@query(
    "keyed_upsert",
    """WITH u AS (SELECT o_orderkey, 'X' AS o_orderstatus,
                         CASE WHEN o_orderkey % 178 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority
                  FROM orders WHERE o_orderkey % 89 = 0
                  UNION ALL SELECT -o_orderkey - 1, 'N', '9-NEW' FROM orders WHERE o_orderkey % 211 = 0)
       SELECT coalesce(t.o_orderkey, u.o_orderkey) AS o_orderkey,
              CASE WHEN u.o_orderkey IS NOT NULL THEN u.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
              CASE WHEN u.o_orderkey IS NOT NULL THEN u.o_orderpriority ELSE t.o_orderpriority END AS o_orderpriority,
              t.o_totalprice
       FROM orders t FULL OUTER JOIN u ON t.o_orderkey = u.o_orderkey""",
)
def keyed_upsert(spark, sf):
    """Keyed update + insert written as a new table version (write-new-then-swap)."""
    o = Tables(spark, sf).orders.select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    base = scratch_path(spark, "upsert")
    o.write.parquet(f"{base}/v0")
    k = F.col("o_orderkey")
    upd = o.filter(k % 89 == 0).select(
        "o_orderkey", F.lit("X").alias("o_orderstatus"),
        F.when(k % 178 == 0, F.lit(None).cast("string")).otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
    ).unionByName(
        o.filter(k % 211 == 0).select((-k - 1).alias("o_orderkey"), F.lit("N").alias("o_orderstatus"),
                                      F.lit("9-NEW").alias("o_orderpriority"))
    )
    new = U.write_upsert(spark, f"{base}/v0", upd, "o_orderkey", f"{base}/v1")
    return spark.read.parquet(new)


KEY_RANGES = 32  # partitions of the table that is updated in place


@query(
    "keyed_upsert_touched",
    """WITH m AS (SELECT max(o_orderkey) AS hi FROM orders),
            u AS (SELECT o_orderkey, 'X' AS o_orderstatus FROM orders, m WHERE o_orderkey > hi - hi // 10 AND o_orderkey % 3 = 0
                  UNION ALL SELECT o_orderkey + hi, 'N' FROM orders, m WHERE o_orderkey <= hi // 50)
       SELECT coalesce(t.o_orderkey, u.o_orderkey) AS o_orderkey, coalesce(u.o_orderstatus, t.o_orderstatus) AS o_orderstatus, t.o_totalprice
       FROM orders t FULL OUTER JOIN u ON t.o_orderkey = u.o_orderkey""",
)
def keyed_upsert_touched(spark, sf):
    """Updates of the newest keys and inserts after them; only their key ranges are rewritten."""
    o = Tables(spark, sf).orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    lo, hi = o.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    part = U.key_range_part("o_orderkey", lo or 0, max(1, ((hi or 0) - (lo or 0)) // KEY_RANGES))
    path = scratch_path(spark, "upsert-ranges")
    o.withColumn("part", part).hint("rebalance", "part").write.partitionBy("part").parquet(path)
    k, hi = F.col("o_orderkey"), hi or 0
    upd = o.where((k > hi - hi // 10) & (k % 3 == 0)).select("o_orderkey", F.lit("X").alias("o_orderstatus"))
    new = o.where(k <= hi // 50).select((k + hi).alias("o_orderkey"), F.lit("N").alias("o_orderstatus"))
    U.write_upsert_touched(spark, path, upd.unionByName(new), "o_orderkey", part)
    return spark.read.schema("o_orderkey long, o_orderstatus string, o_totalprice double, part int").parquet(path).drop("part")


@query(
    "scan_time_window",
    """SELECT o_orderkey, o_orderstatus FROM orders
       WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'""",
)
def scan_time_window(spark, sf):
    o = Tables(spark, sf).orders
    return IO.read_window(o, "o_orderdate", "1997-01-01", "1998-01-01", "[)").select("o_orderkey", "o_orderstatus")


@query(
    "pandas_decode",
    """SELECT c_custkey, CASE WHEN c_custkey % 7 <> 0 THEN c_name END AS decoded,
              CASE WHEN c_custkey % 7 = 0 THEN 'UnicodeDecodeError' END AS error FROM customer""",
)
def pandas_decode(spark, sf):
    """Binary column decoded by a user-supplied Python function in Arrow batches;
    every seventh value is cut within a character and is reported as an error."""
    blob = F.encode("c_name", "UTF-8")
    broken = F.concat(blob, F.unhex(F.lit("E2")))
    c = Tables(spark, sf).customer.select("c_custkey", F.when(F.col("c_custkey") % 7 == 0, broken).otherwise(blob).alias("blob"))
    d = c.select("c_custkey", decode_column("blob", utf8_decode).alias("d"))
    return d.select("c_custkey", F.col("d.value").alias("decoded"), F.col("d.error").alias("error"))


# Orders as a collection whose writers changed over time: prices as texts in some
# documents, a late sub-document, items of mixed kinds.
_DRIFT_SQL = """d AS (SELECT o_orderkey AS id, o_orderstatus AS st, CAST(o_totalprice AS DECIMAL(15, 2)) AS price, o_orderkey % 7 = 0 AS as_text,
                             o_orderkey % 5 <> 0 AS late, o_orderkey % 11 = 0 AS mixed, left(o_orderpriority, 1) AS code FROM orders)"""


def _drifting_documents(t):
    k = F.col("o_orderkey")
    price = F.col("o_totalprice").cast("decimal(15, 2)").cast("string")
    fields = F.concat_ws(
        ", ",
        F.concat(F.lit('"id": '), k.cast("string")),
        F.concat(F.lit('"price": '), F.when(k % 7 == 0, F.concat(F.lit('"'), price, F.lit('"'))).otherwise(price)),
        F.concat(F.lit('"tags": ["'), "o_orderstatus", F.when(k % 11 == 0, F.lit('", 1]')).otherwise(F.lit('"]'))),
        F.when(k % 5 != 0, F.concat(F.lit('"priority": {"code": '), F.left("o_orderpriority", F.lit(1)), F.lit("}"))),
    )
    return t.orders.select(F.concat(F.lit("{"), fields, F.lit("}")).alias("body"))


@query(
    "discover_value_kinds",
    f"""WITH {_DRIFT_SQL},
            v AS (SELECT unnest([{{'path': '$', 'kind': 'OBJECT'}}, {{'path': 'id', 'kind': 'BIGINT'}},
                                 {{'path': 'price', 'kind': CASE WHEN as_text THEN 'STRING' ELSE 'DECIMAL' END}},
                                 {{'path': 'tags', 'kind': 'ARRAY'}}, {{'path': 'tags[]', 'kind': 'STRING'}}]
                                || CASE WHEN mixed THEN [{{'path': 'tags[]', 'kind': 'BIGINT'}}] ELSE [] END
                                || CASE WHEN late THEN [{{'path': 'priority', 'kind': 'OBJECT'}}, {{'path': 'priority.code', 'kind': 'BIGINT'}}] ELSE [] END)
                  AS x FROM d)
       SELECT x.path AS path, x.kind AS kind, count(*) AS n FROM v GROUP BY 1, 2""",
)
def discover_value_kinds(spark, sf):
    """Kinds of value at every path of a drifting collection, with their counts."""
    return D.value_kinds(_drifting_documents(Tables(spark, sf)), "body")


@query(
    "discover_conflicts",
    f"""WITH {_DRIFT_SQL},
            p AS (SELECT count(*) FILTER (as_text) AS s, count(*) FILTER (NOT as_text) AS r, count(*) AS n, count(*) FILTER (mixed) AS m FROM d)
       SELECT 'price' AS path, 'NUMBER,STRING' AS kinds, n, least(s, r) AS n_minority FROM p WHERE s > 0 AND r > 0
       UNION ALL SELECT 'tags[]', 'NUMBER,STRING', n + m, least(n, m) FROM p WHERE m > 0""",
)
def discover_conflicts(spark, sf):
    """Paths whose values no one type holds, with the number of values to mend."""
    kinds = D.value_kinds(_drifting_documents(Tables(spark, sf)), "body")
    return D.kind_conflicts(kinds).withColumn("kinds", F.array_join("kinds", ","))


@query(
    "scan_discovered_types",
    f"""WITH {_DRIFT_SQL}
       SELECT st AS status, count(*) AS n, CAST(sum(id) AS BIGINT) AS ids, CAST(sum(price) AS DOUBLE) AS price,
              count(*) FILTER (as_text) AS text_prices, CAST(coalesce(sum(CAST(code AS BIGINT)) FILTER (late), 0) AS BIGINT) AS codes,
              CAST(sum(CASE WHEN mixed THEN 2 ELSE 1 END) AS BIGINT) AS tags FROM d GROUP BY 1""",
)
def scan_discovered_types(spark, sf):
    """The drifting collection written as text files and read without a given schema:
    typed fields as they are, the conflicting price through its variant."""
    path = scratch_path(spark, "drifting-json")
    _drifting_documents(Tables(spark, sf)).withColumnRenamed("body", "value").write.text(path)
    doc = D.read_discovered(spark.read.text(path), "value").select("doc.*")
    return doc.groupBy(F.variant_get(F.col("tags")[0], "$", "string").alias("status")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("id").alias("ids"),
        F.sum(F.variant_get("price", "$", "decimal(15, 2)")).cast("double").alias("price"),
        F.count_if(F.schema_of_variant("price") == "STRING").alias("text_prices"),
        F.coalesce(F.sum("priority.code"), F.lit(0)).alias("codes"),
        F.sum(F.size("tags")).alias("tags"),
    )
