"""Embedding search and question answering queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from docflow.operators import text as T
from docflow.operators import vector_cells as VC
from docflow.operators import vectors as V
from docflow.plans.registry import query
from docflow.sources.tables import Tables

TOPK = 5

_EMB_SQL = """
  e AS (SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
  en AS (SELECT vec_id, sqrt(sum(x * x)) AS n FROM e GROUP BY 1)"""


def _emb_topk_sql(group_expr: str) -> str:
    return f"""WITH {_EMB_SQL},
      c AS (SELECT {group_expr} AS qid, i, avg(x) AS q FROM e GROUP BY 1, 2),
      cn AS (SELECT qid, sqrt(sum(q * q)) AS n FROM c GROUP BY 1),
      d AS (SELECT c.qid, e.vec_id, sum(e.x * c.q) AS dot FROM e JOIN c ON e.i = c.i GROUP BY 1, 2),
      s AS (SELECT d.qid, d.vec_id, d.dot / (en.n * cn.n) AS score FROM d JOIN en USING (vec_id) JOIN cn USING (qid)
            WHERE en.n * cn.n > 0),
      r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(score, 9) DESC, vec_id) AS rank FROM s)
    SELECT qid, vec_id, rank, round(score, 6) AS score FROM r WHERE rank <= {TOPK}"""


def _emb_topk(spark, sf, group):
    e = Tables(spark, sf).embeddings
    q = V.centroids(e, group, "embedding").select(F.col("grp").cast("string").alias("qid"), "centroid")
    top = V.embedding_top_k(e, "vec_id", "embedding", q, "qid", "centroid", TOPK)
    return top.select("qid", F.col("id").alias("vec_id"), F.col("rank").cast("bigint").alias("rank"), F.round("score", 6).alias("score"))


@query("embedding_topk", _emb_topk_sql("'all'"))
def embedding_topk(spark, sf):
    """Nearest stored vectors to the corpus centroid."""
    return _emb_topk(spark, sf, None)


@query("embedding_topk_multi", _emb_topk_sql("CAST(label AS VARCHAR)"))
def embedding_topk_multi(spark, sf):
    """Many queries at once: one centroid query per label, top 5 each."""
    return _emb_topk(spark, sf, "label")


_NEAR_SQL = """WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE embedding IS NOT NULL),
  s AS (SELECT a.vec_id AS qid, b.vec_id, list_cosine_similarity(a.v, b.v) AS score FROM e a, e b
        WHERE a.vec_id % 50 = 0),
  r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(score, 9) DESC, vec_id) AS rank FROM s)
SELECT CAST(qid AS VARCHAR) AS qid, vec_id, rank, round(score, 6) AS score FROM r WHERE rank <= 5"""


@query("embedding_topk_cells", _NEAR_SQL)
def embedding_topk_cells(spark, sf):
    """Nearest stored vectors of every 50th vector among all, exact, cells opened by their bound."""
    e = Tables(spark, sf).embeddings
    q = e.where(F.col("vec_id") % 50 == 0).select(F.col("vec_id").cast("string").alias("qid"), F.col("embedding").alias("q"))
    top = VC.cell_top_k(e, "vec_id", "embedding", q, "qid", "q", TOPK)
    return top.select("qid", F.col("id").alias("vec_id"), F.col("rank").cast("bigint").alias("rank"), F.round("score", 6).alias("score"))


# ------------------------------------------------------------- questions

_QUESTIONS_SQL = """
  pat AS (SELECT c.c_custkey AS pid, 'Cust' || CAST(c.c_custkey AS VARCHAR) AS name, c.c_nationkey + 20 AS age,
                 c.c_mktsegment AS diagnosis, 'Dr. ' || n.n_name AS doctor, n.n_name || ' General' AS hospital,
                 lower(c.c_mktsegment) || ' ' || lower(n.n_name) || ' patient record' AS description
          FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey),
  qs AS (SELECT c_custkey AS question_id,
                CASE c_custkey % 4
                  WHEN 0 THEN 'What is the diagnosis of patient Cust' || CAST(CASE WHEN c_custkey % 7 = 0 THEN c_custkey + 1000000 ELSE c_custkey END AS VARCHAR) || '? Age is ' || CAST(c_nationkey + 20 AS VARCHAR) || '.'
                  WHEN 1 THEN 'Patient named Cust' || CAST(CASE WHEN c_custkey % 7 = 0 THEN c_custkey + 1000000 ELSE c_custkey END AS VARCHAR) || ' was diagnosed with ' || c_mktsegment
                  WHEN 2 THEN 'Tell me about the ' || lower(c_mktsegment) || ' cases'
                  ELSE 'My name is cust' || CAST(CASE WHEN c_custkey % 7 = 0 THEN c_custkey + 1000000 ELSE c_custkey END AS VARCHAR) || ', my age is ' || CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR)
                END AS question
         FROM customer),
  ent AS (SELECT question_id, question,
                 nullif(regexp_extract(question, '(?i)\\b(name|patient)\\s*(?:is|named)?\\s*(\\w+)', 2), '') AS name,
                 nullif(regexp_extract(question, '(?i)\\b(age|old)\\s*is\\s*(\\d+)', 2), '') AS age,
                 nullif(regexp_extract(question, '(?i)\\b(diagnosis|diagnosed)\\s*(with)?\\s*(\\w+)', 3), '') AS diagnosis
          FROM qs)"""


def _patients(spark, sf):
    t = Tables(spark, sf)
    j = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return j.select(
        F.col("c_custkey").alias("pid"),
        F.concat(F.lit("Cust"), F.col("c_custkey").cast("string")).alias("name"),
        (F.col("c_nationkey") + 20).alias("age"),
        F.col("c_mktsegment").alias("diagnosis"),
        F.concat(F.lit("Dr. "), F.col("n_name")).alias("doctor"),
        F.concat(F.col("n_name"), F.lit(" General")).alias("hospital"),
        F.concat_ws(" ", F.lower("c_mktsegment"), F.lower("n_name"), F.lit("patient record")).alias("description"),
    )


def _questions(spark, sf):
    c = Tables(spark, sf).customer
    k = F.col("c_custkey")
    shown = F.when(k % 7 == 0, k + 1_000_000).otherwise(k).cast("string")
    q = (
        F.when(k % 4 == 0, F.concat(F.lit("What is the diagnosis of patient Cust"), shown, F.lit("? Age is "),
                                   (F.col("c_nationkey") + 20).cast("string"), F.lit(".")))
        .when(k % 4 == 1, F.concat(F.lit("Patient named Cust"), shown, F.lit(" was diagnosed with "), F.col("c_mktsegment")))
        .when(k % 4 == 2, F.concat(F.lit("Tell me about the "), F.lower("c_mktsegment"), F.lit(" cases")))
        .otherwise(F.concat(F.lit("My name is cust"), shown, F.lit(", my age is "), F.floor("c_acctbal").cast("bigint").cast("string")))
    )
    return c.select(k.alias("question_id"), q.alias("question"))


def _entities(spark, sf):
    q = _questions(spark, sf)
    name, age, diag = T.extract_entities("question")
    return q.select("question_id", "question", name.alias("name"), age.alias("age"), diag.alias("diagnosis"))


@query("extract_entities", f"WITH {_QUESTIONS_SQL} SELECT question_id, name, age, diagnosis FROM ent")
def extract_entities(spark, sf):
    return _entities(spark, sf).select("question_id", "name", "age", "diagnosis")


# Answer sentences of the question-answering cascade.
ANSWER_TEMPLATE = "Patient %s is %d years old, diagnosed with %s, treated by %s at %s."
MATCHES_PREFIX = "Here are the closest matches: "
NOTHING = "No relevant patient information found."


def format_answer_col(name="name", age="age", diagnosis="diagnosis", doctor="doctor", hospital="hospital"):
    return F.format_string(ANSWER_TEMPLATE, F.col(name), F.col(age), F.col(diagnosis), F.col(doctor), F.col(hospital))


@query(
    "format_answer",
    f"""WITH {_QUESTIONS_SQL}
        SELECT pid, printf('Patient %s is %d years old, diagnosed with %s, treated by %s at %s.', name, age, diagnosis, doctor, hospital)
                 AS answer FROM pat""",
)
def format_answer(spark, sf):
    p = _patients(spark, sf)
    return p.select("pid", format_answer_col().alias("answer"))


_TOK = r"'[\p{L}\p{N}_]{2,}'"
_SW = ", ".join("'" + w.replace("'", "''") + "'" for w in T.english_stop_words())


@query(
    "answer_cascade",
    f"""WITH {_QUESTIONS_SQL},
      exact AS (SELECT ent.question_id, 'exact' AS kind,
                       printf('Patient %s is %d years old, diagnosed with %s, treated by %s at %s.',
                              pat.name, pat.age, pat.diagnosis, pat.doctor, pat.hospital) AS answer
                FROM ent JOIN pat ON lower(ent.name) = lower(pat.name)),
      rest AS (SELECT question_id, question FROM ent WHERE question_id NOT IN (SELECT question_id FROM exact)),
      tok AS (SELECT pid AS id, unnest(regexp_extract_all(lower(description), {_TOK})) AS term FROM pat),
      tf AS (SELECT id, term, count(*) AS tf FROM tok WHERE term NOT IN ({_SW}) GROUP BY 1, 2),
      nd AS (SELECT count(*) AS n FROM pat),
      voc AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
      idf AS (SELECT term, ln((1.0 + (SELECT n FROM nd)) / (1.0 + df)) + 1 AS idf FROM voc),
      raw AS (SELECT tf.id, tf.term, tf.tf * idf.idf AS raw FROM tf JOIN idf USING (term)),
      wt AS (SELECT id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY id)) AS weight FROM raw),
      qtok AS (SELECT question_id AS qid, unnest(regexp_extract_all(lower(question), {_TOK})) AS term FROM rest),
      qtf AS (SELECT qid, term, count(*) AS tf FROM qtok WHERE term NOT IN ({_SW}) GROUP BY 1, 2),
      qraw AS (SELECT qid, term, tf * idf AS raw FROM qtf JOIN idf USING (term)),
      qw AS (SELECT qid, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY qid)) AS qweight FROM qraw),
      sc AS (SELECT qid, id, sum(weight * qweight) AS score FROM wt JOIN qw USING (term) GROUP BY 1, 2),
      rk AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(score, 9) DESC, id) AS rank FROM sc),
      sim AS (SELECT qid AS question_id, 'similar' AS kind,
                     '{MATCHES_PREFIX}' || string_agg(pat.description, ' | ' ORDER BY rank) AS answer
              FROM rk JOIN pat ON rk.id = pat.pid WHERE rank <= 3 GROUP BY 1)
    SELECT * FROM exact UNION ALL SELECT * FROM sim
    UNION ALL SELECT question_id, 'none', '{NOTHING}' FROM rest WHERE question_id NOT IN (SELECT question_id FROM sim)""",
)
def answer_cascade(spark, sf):
    """Exact (case-insensitive) name match first; otherwise the descriptions
    of the 3 most similar records (TF-IDF cosine); otherwise the fixed
    'no relevant information' answer when no term is shared."""
    ent = _entities(spark, sf)
    pat = _patients(spark, sf)
    p = pat.select(
        F.lower("name").alias("__name"),
        format_answer_col().alias("answer"),
    )
    exact = ent.join(p, F.lower(ent["name"]) == p["__name"]).select("question_id", F.lit("exact").alias("kind"), "answer")
    rest = ent.join(exact.select("question_id"), "question_id", "left_anti").select("question_id", "question")
    # many records share a description: identical texts are scored once
    top = T.dedup_cosine_top_k(pat, "pid", "description", rest, "question_id", "question", 3, T.english_stop_words())
    described = top.join(pat.select(F.col("pid").alias("id"), "description"), "id")
    sim = described.groupBy(F.col("qid").alias("question_id")).agg(
        F.array_join(
            F.transform(F.sort_array(F.collect_list(F.struct("rank", "description"))), lambda x: x["description"]), " | "
        ).alias("matches")
    ).select("question_id", F.lit("similar").alias("kind"), F.concat(F.lit(MATCHES_PREFIX), "matches").alias("answer"))
    none = rest.join(sim.select("question_id"), "question_id", "left_anti").select(
        "question_id", F.lit("none").alias("kind"), F.lit(NOTHING).alias("answer")
    )
    return exact.unionByName(sim).unionByName(none)
