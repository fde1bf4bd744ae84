"""Projections, filters, joins, aggregates, set operations, ordering."""

from __future__ import annotations

from pyspark.sql import functions as F

from docflow.functions import exprs as X
from docflow.operators import bucketed as BU
from docflow.operators import joins as J
from docflow.operators import profile as P
from docflow.plans.bindings import TARGET_SQL, target_orders
from docflow.plans.registry import query
from docflow.sources.tables import TABLES, Tables


# ---------------------------------------------------------------- projections


@query(
    "select_alias",
    """SELECT o_orderkey AS source_id, o_orderstatus AS source_status, o_orderpriority AS source_priority FROM orders""",
)
def select_alias(spark, sf):
    o = Tables(spark, sf).orders
    return o.select(
        F.col("o_orderkey").alias("source_id"),
        F.col("o_orderstatus").alias("source_status"),
        F.col("o_orderpriority").alias("source_priority"),
    )


@query(
    "constant_column",
    """SELECT c_custkey, 'docflow' AS migrated_by, 'RUN-1' AS migration_batch_id FROM customer""",
)
def constant_column(spark, sf):
    c = Tables(spark, sf).customer
    return c.select("c_custkey", F.lit("docflow").alias("migrated_by"), F.lit("RUN-1").alias("migration_batch_id"))


@query(
    "status_case",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 'isCurrent' ELSE 'notCurrent' END AS status_label
       FROM orders""",
)
def status_case(spark, sf):
    o = Tables(spark, sf).orders
    return o.select("o_orderkey", F.when(F.col("o_orderstatus") == "O", "isCurrent").otherwise("notCurrent").alias("status_label"))


@query(
    "derive_chain",
    """WITH a AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 'isCurrent' ELSE 'notCurrent' END AS status_label,
                        CAST(round(o_totalprice * 100) AS BIGINT) AS content_size FROM orders),
            b AS (SELECT *, status_label = 'isCurrent' AND content_size > 10000000 AS large_current FROM a)
       SELECT o_orderkey, status_label, content_size, large_current,
              CASE WHEN large_current THEN 'review' ELSE 'pass' END AS action FROM b""",
)
def derive_chain(spark, sf):
    """Each derived column sees the previous ones (chained withColumns)."""
    o = Tables(spark, sf).orders
    d = o.select("o_orderkey", "o_orderstatus", "o_totalprice")
    d = d.withColumn("status_label", F.when(F.col("o_orderstatus") == "O", "isCurrent").otherwise("notCurrent"))
    d = d.withColumn("content_size", F.round(F.col("o_totalprice") * 100).cast("bigint"))
    d = d.withColumn("large_current", (F.col("status_label") == "isCurrent") & (F.col("content_size") > 10_000_000))
    d = d.withColumn("action", F.when(F.col("large_current"), "review").otherwise("pass"))
    return d.select("o_orderkey", "status_label", "content_size", "large_current", "action")


_EVENT_ALIASES = {"click": "Click stream", "view": "Page view"}


@query(
    "alias_lookup",
    """SELECT event_type AS system, CASE event_type WHEN 'click' THEN 'Click stream' WHEN 'view' THEN 'Page view'
              ELSE event_type END AS system_name, count(*) AS n FROM events GROUP BY 1, 2""",
)
def alias_lookup(spark, sf):
    e = Tables(spark, sf).events
    return e.groupBy(F.col("event_type").alias("system"), X.lookup(_EVENT_ALIASES, "event_type", keep_unknown=True).alias("system_name")).agg(
        F.count(F.lit(1)).alias("n")
    )


_REPLACE = {"o_orderpriority": {"1-URGENT": "URGENT", "2-HIGH": "HIGH"}, "o_orderstatus": {"F": "FINAL"}}


@query(
    "value_replacement",
    """SELECT o_orderkey,
              CASE o_orderpriority WHEN '1-URGENT' THEN 'URGENT' WHEN '2-HIGH' THEN 'HIGH' ELSE o_orderpriority END
                AS o_orderpriority,
              CASE o_orderstatus WHEN 'F' THEN 'FINAL' ELSE o_orderstatus END AS o_orderstatus
       FROM orders""",
)
def value_replacement(spark, sf):
    o = Tables(spark, sf).orders
    return o.select(
        "o_orderkey", *[X.lookup(rule, c, keep_unknown=True).alias(c) for c, rule in _REPLACE.items()]
    )


@query(
    "deterministic_uuid",
    r"""SELECT o_orderkey, regexp_replace(md5(CAST(o_orderkey AS VARCHAR)),
              '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\1-\2-\3-\4-\5') AS doc_uuid FROM orders""",
)
def deterministic_uuid(spark, sf):
    o = Tables(spark, sf).orders
    return o.select("o_orderkey", X.uuid_from_key("o_orderkey").alias("doc_uuid"))


@query(
    "short_batch_id",
    """SELECT CAST(floor(o_orderkey / 5000) AS BIGINT) AS batch_no,
              substr(md5('RUN-1|' || CAST(CAST(floor(o_orderkey / 5000) AS BIGINT) AS VARCHAR)), 1, 8) AS batch_id,
              count(*) AS n FROM orders GROUP BY 1, 2""",
)
def short_batch_id(spark, sf):
    K = F.col("o_orderkey")
    o = Tables(spark, sf).orders
    b = F.floor(K / 5000).cast("bigint")
    return o.groupBy(b.alias("batch_no"), X.short_id(F.lit("RUN-1"), b).alias("batch_id")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "row_uuid",
)
def row_uuid(spark, sf):
    """Random per-row id (not reproducible -> rows-only check)."""
    o = Tables(spark, sf).orders
    return o.select("o_orderkey", F.uuid().alias("_id"))


@query(
    "row_uuid_invariants",
    "SELECT count(*) AS n_rows, count(*) AS n_ids, count(*) AS n_well_formed FROM orders",
)
def row_uuid_invariants(spark, sf):
    """Every row has an id of its own, of the canonical form."""
    form = "^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$"
    return row_uuid(spark, sf).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("_id").alias("n_ids"), F.count_if(F.col("_id").rlike(form)).alias("n_well_formed")
    )


_TITLE_SQL = """
  p AS (SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host,
               regexp_extract(url, '/([^/?#]*)([?#].*)?$', 1) AS seg,
               CASE page_id % 5 WHEN 0 THEN 'text/plain' WHEN 1 THEN 'application/pdf' WHEN 2 THEN 'image/jpeg'
                    WHEN 3 THEN 'application/vnd.ms-powerpoint' ELSE 'application/zip' END AS mime
        FROM pages)"""


def _pages(spark, sf):
    pg = Tables(spark, sf).pages
    mime = (
        F.when(F.col("page_id") % 5 == 0, "text/plain")
        .when(F.col("page_id") % 5 == 1, "application/pdf")
        .when(F.col("page_id") % 5 == 2, "image/jpeg")
        .when(F.col("page_id") % 5 == 3, "application/vnd.ms-powerpoint")
        .otherwise("application/zip")
    )
    return pg.select(
        "page_id",
        F.regexp_extract("url", r"^[a-z]+://([^/?#]+)", 1).alias("host"),
        F.regexp_extract("url", r"/([^/?#]*)([?#].*)?$", 1).alias("seg"),
        mime.alias("mime"),
    )


_MIME_CASE = (
    "CASE {m} WHEN 'text/plain' THEN 'txt' WHEN 'application/pdf' THEN 'pdf' WHEN 'image/jpeg' THEN 'jpg' "
    "WHEN 'application/vnd.ms-powerpoint' THEN 'pptx' END"
)


@query(
    "split_title",
    f"""WITH {_TITLE_SQL}
        SELECT page_id,
               CASE WHEN strpos(host, '.') > 0 THEN regexp_extract(host, '^(.*)\\.[^.]*$', 1) ELSE host END AS host_base,
               CASE WHEN strpos(host, '.') > 0 THEN regexp_extract(host, '\\.([^.]*)$', 1) ELSE {_MIME_CASE.format(m='mime')} END
                 AS host_ext,
               CASE WHEN strpos(seg, '.') > 0 THEN regexp_extract(seg, '^(.*)\\.[^.]*$', 1) ELSE seg END AS seg_base,
               CASE WHEN strpos(seg, '.') > 0 THEN regexp_extract(seg, '\\.([^.]*)$', 1) ELSE {_MIME_CASE.format(m='mime')} END
                 AS seg_ext
        FROM p""",
)
def split_title(spark, sf):
    p = _pages(spark, sf)
    hb, he = X.split_title("host", "mime")
    sb, se = X.split_title("seg", "mime")
    return p.select("page_id", hb.alias("host_base"), he.alias("host_ext"), sb.alias("seg_base"), se.alias("seg_ext"))


@query(
    "mime_extension",
    f"""WITH {_TITLE_SQL} SELECT mime, {_MIME_CASE.format(m='mime')} AS extension, count(*) AS n FROM p GROUP BY 1, 2""",
)
def mime_extension(spark, sf):
    p = _pages(spark, sf)
    return p.groupBy("mime", X.lookup(X.MIME_EXTENSIONS, "mime").alias("extension")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "split_list",
    """SELECT p_partkey, array_to_string(list_filter(list_transform(string_split(coalesce(p_name, ''), ' '), lambda x: trim(x)),
                                              lambda x: x <> ''), '|') AS name_parts,
              len(list_filter(string_split(coalesce(p_name, ''), ' '), lambda x: trim(x) <> '')) AS n_parts
       FROM part""",
)
def split_list(spark, sf):
    p = Tables(spark, sf).part
    arr = X.split_list("p_name", " ")
    return p.select("p_partkey", F.array_join(arr, "|").alias("name_parts"), F.size(arr).cast("bigint").alias("n_parts"))


@query(
    "wide_to_array",
    """WITH w AS (SELECT c_custkey, c_name AS kid1,
                         CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_mktsegment END AS kid2,
                         CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE CAST(c_nationkey AS VARCHAR) END AS kid3 FROM customer)
       SELECT c_custkey, concat_ws('|', nullif(kid1, ''), nullif(kid2, ''), nullif(kid3, '')) AS kids,
              (CASE WHEN coalesce(kid1, '') <> '' THEN 1 ELSE 0 END + CASE WHEN coalesce(kid2, '') <> '' THEN 1 ELSE 0 END
               + CASE WHEN coalesce(kid3, '') <> '' THEN 1 ELSE 0 END) AS n_kids
       FROM w""",
)
def wide_to_array(spark, sf):
    c = Tables(spark, sf).customer
    w = c.select(
        "c_custkey",
        F.col("c_name").alias("kid1"),
        F.when(F.col("c_custkey") % 3 == 0, F.lit("")).otherwise(F.col("c_mktsegment")).alias("kid2"),
        F.when(F.col("c_custkey") % 5 == 0, F.lit(None).cast("string")).otherwise(F.col("c_nationkey").cast("string")).alias("kid3"),
    )
    arr = X.wide_to_array("kid1", "kid2", "kid3")
    return w.select("c_custkey", F.array_join(arr, "|").alias("kids"), F.size(arr).alias("n_kids"))


@query(
    "conditional_expiry",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN strftime(CAST(o_orderdate AS DATE) + INTERVAL 540 DAY, '%Y-%m-%d') END
              AS wip_expiration_date FROM orders""",
)
def conditional_expiry(spark, sf):
    """Field present only when status matches; the as-of date is the row date."""
    o = Tables(spark, sf).orders
    exp = F.when(F.col("o_orderstatus") == "P", F.date_add(F.to_date("o_orderdate"), 540))
    return o.select("o_orderkey", F.date_format(exp, "yyyy-MM-dd").alias("wip_expiration_date"))


_IDS_SQL = """
  ids AS (SELECT o_orderkey,
                 regexp_replace(md5(CAST(o_orderkey AS VARCHAR)), '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\\1-\\2-\\3-\\4-\\5') AS u
          FROM orders),
  raw AS (SELECT o_orderkey, u,
                 CASE WHEN o_orderkey % 7 = 0 THEN 'XYZ::' || u
                      WHEN o_orderkey % 11 = 0 THEN 'DOC::' || substr(u, 1, 30)
                      WHEN o_orderkey % 3 = 0 THEN ' DOC::' || upper(u) || ' '
                      ELSE 'DOC::' || u END AS q
          FROM ids)"""


def _raw_ids(spark, sf):
    K = F.col("o_orderkey")
    o = Tables(spark, sf).orders
    u = X.uuid_from_key("o_orderkey")
    q = (
        F.when(K % 7 == 0, F.concat(F.lit("XYZ::"), u))
        .when(K % 11 == 0, F.concat(F.lit("DOC::"), F.substring(u, 1, 30)))
        .when(K % 3 == 0, F.concat(F.lit(" DOC::"), F.upper(u), F.lit(" ")))
        .otherwise(F.concat(F.lit("DOC::"), u))
    )
    return o.select("o_orderkey", u.alias("u"), q.alias("q"))


@query(
    "normalise_id",
    f"""WITH {_IDS_SQL} SELECT o_orderkey, lower(trim(q)) AS normalised FROM raw""",
)
def normalise_id(spark, sf):
    r = _raw_ids(spark, sf)
    return r.select("o_orderkey", X.normalise_id("q").alias("normalised"))


@query(
    "parse_prefixed_uuid",
    f"""WITH {_IDS_SQL},
        p AS (SELECT o_orderkey, trim(q) AS t FROM raw)
        SELECT o_orderkey,
               CASE WHEN NOT starts_with(t, 'DOC::') THEN 'bad_format'
                    WHEN NOT regexp_matches(substr(t, 6), '^[0-9a-fA-F]{{8}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{12}}$')
                      THEN 'bad_uuid'
                    ELSE 'ok' END AS parse_status,
               CASE WHEN starts_with(t, 'DOC::') AND regexp_matches(substr(t, 6), '^[0-9a-fA-F]{{8}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{12}}$')
                    THEN lower(substr(t, 6)) END AS uuid
        FROM p""",
)
def parse_prefixed_uuid(spark, sf):
    r = _raw_ids(spark, sf)
    status, uuid = X.parse_prefixed_uuid("q", "DOC::")
    return r.select("o_orderkey", status.alias("parse_status"), uuid.alias("uuid"))


@query(
    "decode_binary",
    """SELECT c_custkey, decode(encode(c_name)) AS decoded, octet_length(encode(c_name)) AS n_bytes FROM customer""",
)
def decode_binary(spark, sf):
    c = Tables(spark, sf).customer
    b = c.select("c_custkey", F.encode("c_name", "UTF-8").alias("blob"))
    return b.select("c_custkey", F.decode("blob", "UTF-8").alias("decoded"), F.length("blob").cast("bigint").alias("n_bytes"))


# -------------------------------------------------------------------- filters


@query(
    "split_by_code",
    """SELECT CASE l_returnflag WHEN 'R' THEN 'CC' ELSE 'SB' END AS branch, count(*) AS n,
              count(DISTINCT l_orderkey) AS n_orders
       FROM lineitem WHERE l_returnflag IN ('R', 'A') GROUP BY 1""",
)
def split_by_code(spark, sf):
    li = Tables(spark, sf).lineitem.select("l_orderkey", "l_returnflag").where(F.col("l_returnflag").isin("R", "A"))
    branch = F.when(F.col("l_returnflag") == "R", "CC").otherwise("SB")  # one scan for both branches
    return li.groupBy(branch.alias("branch")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("l_orderkey").alias("n_orders"))


@query(
    "balance_filter",
    """SELECT s_suppkey, s_name, s_acctbal FROM supplier WHERE s_acctbal < 0""",
)
def balance_filter(spark, sf):
    s = Tables(spark, sf).supplier
    return s.filter(X.compare("s_acctbal", "<", 0.0)).select("s_suppkey", "s_name", "s_acctbal")


@query(
    "date_after",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate FROM orders
       WHERE o_orderdate > TIMESTAMP '2000-01-01'""",
)
def date_after(spark, sf):
    o = Tables(spark, sf).orders
    r = o.filter(F.col("o_orderdate") > F.lit("2000-01-01").cast("timestamp_ntz"))
    return r.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"))


@query(
    "range_bounds",
    """SELECT b.bounds, count(o.o_orderkey) AS n FROM (VALUES ('()'), ('(]'), ('[)'), ('[]')) b(bounds)
       LEFT JOIN orders o ON
         (CASE WHEN b.bounds LIKE '[%' THEN o.o_orderdate >= TIMESTAMP '1996-01-01' ELSE o.o_orderdate > TIMESTAMP '1996-01-01' END)
         AND (CASE WHEN b.bounds LIKE '%]' THEN o.o_orderdate <= TIMESTAMP '1997-01-01' ELSE o.o_orderdate < TIMESTAMP '1997-01-01' END)
       GROUP BY 1""",
)
def range_bounds(spark, sf):
    """All four bound conventions over the same range in one pass."""
    o = Tables(spark, sf).orders
    lo, hi = F.lit("1996-01-01").cast("timestamp_ntz"), F.lit("1997-01-01").cast("timestamp_ntz")
    aggs = [
        F.sum(F.when(X.between_bounds("o_orderdate", lo, hi, b), 1).otherwise(0)).cast("bigint").alias(b)
        for b in ("()", "(]", "[)", "[]")
    ]
    wide = o.agg(*aggs)
    return wide.select(
        F.inline(F.array(*[F.struct(F.lit(b).alias("bounds"), F.col(f"`{b}`").alias("n")) for b in ("()", "(]", "[)", "[]")]))
    )


@query(
    "inclusive_end_date",
    """SELECT event_type, count(*) AS n FROM events
       WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-13' GROUP BY 1""",
)
def inclusive_end_date(spark, sf):
    e = Tables(spark, sf).events
    return e.filter(X.inclusive_end_date("ts", "2024-01-10", "2024-01-12")).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query(
    "in_list_filter",
    """SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')""",
)
def in_list_filter(spark, sf):
    o = Tables(spark, sf).orders
    return o.filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select("o_orderkey", "o_orderpriority")


@query(
    "optional_filter",
    """SELECT 'ALL' AS requested, count(*) AS n FROM events
       UNION ALL SELECT 'purchase', count(*) FROM events WHERE event_type = 'purchase'""",
)
def optional_filter(spark, sf):
    """'ALL' disables the predicate; a concrete value filters."""
    e = Tables(spark, sf).events
    asked = ("ALL", "purchase")
    counts = e.agg(*[F.count_if(X.optional_filter({"event_type": a})).alias(a) for a in asked])  # one scan
    return counts.select(F.explode(F.array(*[F.struct(F.lit(a).alias("requested"), F.col(a).alias("n")) for a in asked])).alias("r")).select("r.*")


@query(
    "drop_null_label",
    """SELECT d.doc_id, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
       WHERE l.quality IS NOT NULL AND trim(d.text) <> ''""",
)
def drop_null_label(spark, sf):
    t = Tables(spark, sf)
    j = t.documents.select("doc_id", "text").join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    return j.dropna(subset=["quality"]).filter(F.trim("text") != "").select("doc_id", "quality")


# ---------------------------------------------------------------------- joins


@query(
    "inner_join",
    """SELECT o.o_orderkey, l.l_linenumber, o.o_orderstatus, l.l_returnflag
       FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey""",
)
def inner_join(spark, sf):
    t = Tables(spark, sf)
    li = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_returnflag")
    return t.orders.select("o_orderkey", "o_orderstatus").join(li, "o_orderkey", "inner")


@query(
    "inner_join_diff_keys",
    """SELECT s.s_nationkey, count(*) AS n_lines, round(sum(l.l_extendedprice), 2) AS revenue
       FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey GROUP BY 1""",
)
def inner_join_diff_keys(spark, sf):
    t = Tables(spark, sf)
    j = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"), "inner")
    return j.groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("n_lines"), F.round(F.sum("l_extendedprice"), 2).alias("revenue"))


@query(
    "broadcast_join",
    """SELECT c.c_custkey, n.n_name FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""",
)
def broadcast_join(spark, sf):
    """Small dimension: broadcast by Spark while under its byte threshold."""
    t = Tables(spark, sf)
    nation = t.nation.select("n_nationkey", "n_name")
    return t.customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name")


@query(
    "semi_join",
    """SELECT o_orderkey, o_orderstatus FROM orders
       WHERE o_orderkey IN (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""",
)
def semi_join(spark, sf):
    t = Tables(spark, sf)
    keys = t.lineitem.filter(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("o_orderkey"))
    return J.semi_join(t.orders.select("o_orderkey", "o_orderstatus"), keys, "o_orderkey")


@query(
    "anti_join_missing",
    """SELECT o_orderkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)""",
)
def anti_join_missing(spark, sf):
    t = Tables(spark, sf)
    keys = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"))
    return J.semi_join(t.orders.select("o_orderkey"), keys, "o_orderkey", negate=True)


@query(
    "copartitioned_join",
    """WITH l AS (SELECT l_orderkey, count(*) AS n_lines, sum(l_quantity) AS qty FROM lineitem GROUP BY 1)
       SELECT o.o_orderkey, l.n_lines, l.qty, o.o_orderpriority FROM orders o JOIN l ON o.o_orderkey = l.l_orderkey""",
)
def copartitioned_join(spark, sf):
    t = Tables(spark, sf)
    li = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_quantity")
    # the aggregate reuses the key partitioning: one exchange per side
    j = J.copartitioned_join(t.orders.select("o_orderkey", "o_orderpriority"), li, "o_orderkey")
    return j.groupBy("o_orderkey", "o_orderpriority").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("qty")
    )


@query(
    "bucketed_join",
    """WITH l AS (SELECT l_orderkey, count(*) AS n_lines, sum(l_quantity) AS qty FROM lineitem GROUP BY 1)
       SELECT o.o_orderkey, l.n_lines, l.qty, o.o_orderpriority FROM orders o JOIN l ON o.o_orderkey = l.l_orderkey""",
)
def bucketed_join(spark, sf):
    """Both sides stored in buckets once; joins and aggregates on the key then shuffle neither."""
    t = Tables(spark, sf)
    li = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_quantity")
    with_lines = BU.store_pair(li, t.orders.select("o_orderkey", "o_orderpriority"), "o_orderkey").join()
    return with_lines.groupBy("o_orderkey", "o_orderpriority").agg(F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("qty"))


@query(
    "full_outer_merge",
    f"""WITH {TARGET_SQL}
        SELECT coalesce(o.o_orderkey, t.o_orderkey) AS o_orderkey, o.o_orderstatus, o.o_orderpriority,
               t.o_orderstatus AS o_orderstatus_right, t.o_orderpriority AS o_orderpriority_right
        FROM orders o FULL OUTER JOIN tgt t ON o.o_orderkey = t.o_orderkey""",
)
def full_outer_merge(spark, sf):
    t = Tables(spark, sf)
    left = t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority")
    right = target_orders(t).select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return J.full_outer_merge(left, right, "o_orderkey")


@query(
    "full_outer_diff",
    f"""WITH {TARGET_SQL}
        SELECT coalesce(o.o_orderkey, t.o_orderkey) AS o_orderkey,
               CASE WHEN o.o_orderkey IS NULL THEN 'right_only' ELSE 'left_only' END AS side
        FROM (SELECT DISTINCT o_orderkey FROM orders) o FULL OUTER JOIN (SELECT DISTINCT o_orderkey FROM tgt) t
          ON o.o_orderkey = t.o_orderkey
        WHERE o.o_orderkey IS NULL OR t.o_orderkey IS NULL""",
)
def full_outer_diff(spark, sf):
    t = Tables(spark, sf)
    return J.full_outer_diff(t.orders, target_orders(t), "o_orderkey")


_CMP = ["o_orderkey", "o_orderstatus", "o_orderpriority"]


@query(
    "except_all_both",
    f"""WITH {TARGET_SQL}
        SELECT *, 'source_only' AS side FROM (SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
                                               EXCEPT ALL SELECT o_orderkey, o_orderstatus, o_orderpriority FROM tgt)
        UNION ALL
        SELECT *, 'target_only' FROM (SELECT o_orderkey, o_orderstatus, o_orderpriority FROM tgt
                                      EXCEPT ALL SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders)""",
)
def except_all_both(spark, sf):
    t = Tables(spark, sf)
    return J.except_all_both(t.orders, target_orders(t), _CMP)


# ----------------------------------------------------------------- aggregates


@query("row_count", "SELECT count(*) AS n FROM lineitem")
def row_count(spark, sf):
    return Tables(spark, sf).lineitem.agg(F.count(F.lit(1)).alias("n"))


@query("group_count", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def group_count(spark, sf):
    return Tables(spark, sf).orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("distinct_keys", "SELECT DISTINCT l_suppkey FROM lineitem")
def distinct_keys(spark, sf):
    return Tables(spark, sf).lineitem.select("l_suppkey").distinct()


@query(
    "min_max_range",
    """SELECT min(o_orderkey) AS min_key, max(o_orderkey) AS max_key,
              strftime(min(o_orderdate), '%Y-%m-%d') AS min_date, strftime(max(o_orderdate), '%Y-%m-%d') AS max_date FROM orders""",
)
def min_max_range(spark, sf):
    o = Tables(spark, sf).orders
    return o.agg(
        F.min("o_orderkey").alias("min_key"),
        F.max("o_orderkey").alias("max_key"),
        F.date_format(F.min("o_orderdate"), "yyyy-MM-dd").alias("min_date"),
        F.date_format(F.max("o_orderdate"), "yyyy-MM-dd").alias("max_date"),
    )


@query(
    "before_after_counts",
    f"""WITH {TARGET_SQL}, loaded AS (SELECT * FROM tgt UNION ALL SELECT o_orderkey + 2000000, o_custkey, o_orderstatus,
                                             o_totalprice, o_orderdate, o_orderpriority FROM orders WHERE o_orderstatus = 'P')
        SELECT (SELECT count(*) FROM tgt) AS before_count, (SELECT count(*) FROM loaded) AS after_count,
               (SELECT count(*) FROM loaded) - (SELECT count(*) FROM tgt) AS inserted""",
)
def before_after_counts(spark, sf):
    """Target count before and after a load in ONE aggregate over a tagged union."""
    t = Tables(spark, sf)
    before = target_orders(t)
    load = t.orders.filter(F.col("o_orderstatus") == "P").withColumn("o_orderkey", F.col("o_orderkey") + 2_000_000)
    tagged = before.select(F.lit(1).alias("b")).unionByName(load.select(F.lit(0).alias("b")))
    return tagged.agg(
        F.sum("b").cast("bigint").alias("before_count"),
        F.count(F.lit(1)).alias("after_count"),
        (F.count(F.lit(1)) - F.sum("b")).cast("bigint").alias("inserted"),
    )


@query(
    "field_value_profile",
    """SELECT field, value, count(*) AS n FROM (
         SELECT 'customer.c_mktsegment' AS field, c_mktsegment AS value FROM customer
         UNION ALL SELECT 'orders.o_orderstatus', o_orderstatus FROM orders
         UNION ALL SELECT 'orders.o_orderpriority', o_orderpriority FROM orders
         UNION ALL SELECT 'lineitem.l_returnflag', l_returnflag FROM lineitem
         UNION ALL SELECT 'lineitem.l_linestatus', l_linestatus FROM lineitem) GROUP BY 1, 2""",
)
def field_value_profile(spark, sf):
    t = Tables(spark, sf)
    return P.field_value_profile(
        [
            (t.customer, "customer", ["c_mktsegment"]),
            (t.orders, "orders", ["o_orderstatus", "o_orderpriority"]),
            (t.lineitem, "lineitem", ["l_returnflag", "l_linestatus"]),
        ]
    ).select("field", "value", "n")


_WIDE_FIELDS = ("l_orderkey", "l_partkey", "l_suppkey", "l_quantity")


@query(
    "heavy_field_values",
    "WITH c AS ("
    + " UNION ALL ".join(f"SELECT '{f}' AS field, CAST({f} AS VARCHAR) AS value, count(*) AS n FROM lineitem GROUP BY 2" for f in _WIDE_FIELDS)
    + """)
       SELECT field, value, n, row_number() OVER (PARTITION BY field ORDER BY n DESC, value NULLS FIRST) AS rank
       FROM c QUALIFY rank <= 20""",
)
def heavy_field_values(spark, sf):
    """The 20 most frequent values of fields with many values, counted exactly."""
    return P.heavy_values(Tables(spark, sf).lineitem, _WIDE_FIELDS, 20)


@query(
    "collection_counts",
    "SELECT * FROM (VALUES "
    + ", ".join(
        f"('{n}', (SELECT count(*) FROM {n}))"
        for n in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
    )
    + ") v(collection, n)",
)
def collection_counts(spark, sf):
    t = Tables(spark, sf)
    return P.collection_counts({n: getattr(t, n) for n in TABLES})


@query(
    "named_query_totals",
    """SELECT 'orders_by_status' AS name, o_orderstatus AS grp, count(*) AS total FROM orders GROUP BY 2
       UNION ALL SELECT 'lines_by_flag', l_returnflag, count(*) FROM lineitem GROUP BY 2
       UNION ALL SELECT 'customers_by_segment', c_mktsegment, count(*) FROM customer GROUP BY 2""",
)
def named_query_totals(spark, sf):
    """Named SQL catalogue run over temp views; results tagged and unioned."""
    t = Tables(spark, sf)
    views = {"orders": t.orders, "lineitem": t.lineitem, "customer": t.customer}
    catalog = {
        "orders_by_status": "SELECT o_orderstatus AS grp, count(*) AS total FROM orders GROUP BY 1",
        "lines_by_flag": "SELECT l_returnflag AS grp, count(*) AS total FROM lineitem GROUP BY 1",
        "customers_by_segment": "SELECT c_mktsegment AS grp, count(*) AS total FROM customer GROUP BY 1",
    }
    return P.run_named_queries(spark, views, catalog)
