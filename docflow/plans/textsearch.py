"""Text queries over ``documents`` (corpus) and ``benchmark`` (questions)."""

from __future__ import annotations

from pyspark.sql import functions as F

from docflow.operators import text as T
from docflow.plans.registry import query
from docflow.session import written
from docflow.sources.tables import Tables

CHUNK = 500
TOPK = 5
_TOK = r"'[\p{L}\p{N}_]{2,}'"
STOP = T.english_stop_words()
_SW = ", ".join("'" + w.replace("'", "''") + "'" for w in STOP)


@query(
    "chunk_words",
    f"""WITH w AS (SELECT doc_id, string_split_regex(trim(text), '\\s+') AS words FROM documents),
             c AS (SELECT doc_id, words, unnest(range(0, greatest(CAST(ceil(len(words) / {CHUNK}) AS BIGINT), 1))) AS i FROM w)
        SELECT doc_id, CAST(i AS INTEGER) AS chunk_no,
               md5(array_to_string(words[i * {CHUNK} + 1 : (i + 1) * {CHUNK}], ' ')) AS chunk_md5,
               len(words[i * {CHUNK} + 1 : (i + 1) * {CHUNK}]) AS n_words
        FROM c""",
)
def chunk_words(spark, sf):
    d = Tables(spark, sf).documents
    c = T.explode_word_chunks(d, "doc_id", "text", CHUNK)
    return c.select(
        "doc_id", "chunk_no", F.md5("chunk_text").alias("chunk_md5"),
        F.size(F.split("chunk_text", " ")).cast("bigint").alias("n_words"),
    )


@query(
    "chunk_chars",
    f"""WITH c AS (SELECT doc_id, text, unnest(range(0, greatest(CAST(ceil(length(text) / {CHUNK}) AS BIGINT), 1))) AS i
                   FROM documents)
        SELECT doc_id, CAST(i AS INTEGER) AS chunk_no, md5(substring(text, i * {CHUNK} + 1, {CHUNK})) AS chunk_md5,
               length(substring(text, i * {CHUNK} + 1, {CHUNK})) AS n_chars
        FROM c""",
)
def chunk_chars(spark, sf):
    d = Tables(spark, sf).documents
    c = T.explode_chunks(d, "doc_id", T.char_chunks("text", CHUNK))
    return c.select("doc_id", "chunk_no", F.md5("chunk_text").alias("chunk_md5"), F.length("chunk_text").cast("bigint").alias("n_chars"))


@query(
    "chunk_lines",
    """WITH l AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '') AS ls FROM documents)
       SELECT doc_id, CAST(generate_subscripts(ls, 1) - 1 AS INTEGER) AS chunk_no, md5(unnest(ls)) AS chunk_md5 FROM l""",
)
def chunk_lines(spark, sf):
    d = Tables(spark, sf).documents
    c = T.explode_chunks(d, "doc_id", T.line_chunks("text", "\n"))
    return c.select("doc_id", "chunk_no", F.md5("chunk_text").alias("chunk_md5"))


_BASIC_SQL = """
  tb AS (SELECT unnest(list_filter(string_split_regex(lower(regexp_replace(text, '[^a-zA-Z\\s]', '', 'g')), '\\s+'),
                                   lambda x: x <> '')) AS token FROM documents)"""


@query("tokenise_basic", f"WITH {_BASIC_SQL} SELECT token, count(*) AS n FROM tb GROUP BY 1")
def tokenise_basic(spark, sf):
    d = Tables(spark, sf).documents
    return d.select(F.explode(T.tokens_basic("text")).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))


@query(
    "tokens_no_stopwords",
    f"WITH {_BASIC_SQL} SELECT token, count(*) AS n FROM tb WHERE token NOT IN ({_SW}) GROUP BY 1",
)
def tokens_no_stopwords(spark, sf):
    d = Tables(spark, sf).documents
    toks = d.select(F.explode(T.tokens_basic("text")).alias("token")).where(T.not_stop_word("token"))
    return toks.groupBy("token").agg(F.count(F.lit(1)).alias("n"))


_TFIDF_SQL = f"""
  tok AS (SELECT doc_id AS id, unnest(regexp_extract_all(lower(text), {_TOK})) AS term FROM documents),
  tf AS (SELECT id, term, count(*) AS tf FROM tok WHERE term NOT IN ({_SW}) GROUP BY 1, 2),
  nd AS (SELECT count(*) AS n FROM documents),
  voc AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
  idf AS (SELECT term, df, ln((1.0 + (SELECT n FROM nd)) / (1.0 + df)) + 1 AS idf FROM voc),
  raw AS (SELECT tf.id, tf.term, tf.tf * idf.idf AS raw FROM tf JOIN idf USING (term)),
  wt AS (SELECT id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY id)) AS weight FROM raw)"""

_QUERY_SQL = f"""
  qtok AS (SELECT item_id AS qid, unnest(regexp_extract_all(lower(text), {_TOK})) AS term FROM benchmark),
  qtf AS (SELECT qid, term, count(*) AS tf FROM qtok WHERE term NOT IN ({_SW}) GROUP BY 1, 2),
  qraw AS (SELECT qid, term, tf * idf AS raw FROM qtf JOIN idf USING (term)),
  qw AS (SELECT qid, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY qid)) AS qweight FROM qraw)"""


@query("tfidf_weights", f"WITH {_TFIDF_SQL} SELECT id AS doc_id, term, round(weight, 6) AS weight FROM wt")
def tfidf_weights(spark, sf):
    w = T.tfidf(Tables(spark, sf).documents, "doc_id", "text", STOP)
    return w.select(F.col("id").alias("doc_id"), "term", F.round("weight", 6).alias("weight"))


@query(
    "tfidf_topk",
    f"""WITH {_TFIDF_SQL}, {_QUERY_SQL},
        sc AS (SELECT qid, id, sum(weight * qweight) AS score FROM wt JOIN qw USING (term) GROUP BY 1, 2),
        rk AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(score, 9) DESC, id) AS rank FROM sc)
        SELECT qid AS item_id, id AS doc_id, rank, round(score, 6) AS score FROM rk WHERE rank <= {TOPK}""",
)
def tfidf_topk(spark, sf):
    return _top(spark, sf)


def _top(spark, sf, include_query=False):
    t = Tables(spark, sf)
    index = written(T.term_index(t.documents, "doc_id", "text", STOP), "term-index")
    top = T.tfidf_top_k(index, t.benchmark, "item_id", "text", TOPK, STOP, include_query)
    return top.select(F.col("qid").alias("item_id"), F.col("id").alias("doc_id"), F.col("rank").cast("bigint").alias("rank"), F.round("score", 6).alias("score"))


@query(
    "tfidf_topk_with_query",
    f"""WITH
      tok AS (SELECT doc_id AS id, unnest(regexp_extract_all(lower(text), {_TOK})) AS term FROM documents),
      tf AS (SELECT id, term, count(*) AS tf FROM tok WHERE term NOT IN ({_SW}) GROUP BY 1, 2),
      nd AS (SELECT count(*) + 1 AS n FROM documents),
      voc AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
      qtok AS (SELECT item_id AS qid, unnest(regexp_extract_all(lower(text), {_TOK})) AS term FROM benchmark),
      qtf AS (SELECT qid, term, count(*) AS tf FROM qtok WHERE term NOT IN ({_SW}) GROUP BY 1, 2),
      -- per query q: idf_q(t) = ln((1+N+1)/(1+df(t)+[t in q])) + 1, documents re-weighted
      pairs AS (SELECT DISTINCT q.qid, tf.id FROM qtf q JOIN tf USING (term)),
      dv AS (SELECT p.qid, tf.id, tf.term, tf.tf * (ln((1.0 + (SELECT n FROM nd)) /
                      (1.0 + v.df + CASE WHEN q.term IS NOT NULL THEN 1 ELSE 0 END)) + 1) AS raw
             FROM pairs p JOIN tf ON p.id = tf.id JOIN voc v ON tf.term = v.term
             LEFT JOIN qtf q ON q.qid = p.qid AND q.term = tf.term),
      dn AS (SELECT qid, id, sqrt(sum(raw * raw)) AS norm FROM dv GROUP BY 1, 2),
      qv AS (SELECT q.qid, q.term, q.tf * (ln((1.0 + (SELECT n FROM nd)) / (1.0 + coalesce(v.df, 0) + 1)) + 1) AS raw
             FROM qtf q LEFT JOIN voc v USING (term)),
      qn AS (SELECT qid, sqrt(sum(raw * raw)) AS norm FROM qv GROUP BY 1),
      sc AS (SELECT dv.qid, dv.id, sum(dv.raw * qv.raw) / (min(dn.norm) * min(qn.norm)) AS score
             FROM dv JOIN qv ON dv.qid = qv.qid AND dv.term = qv.term
             JOIN dn ON dn.qid = dv.qid AND dn.id = dv.id JOIN qn ON qn.qid = dv.qid GROUP BY 1, 2),
      rk AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(score, 9) DESC, id) AS rank FROM sc)
    SELECT qid AS item_id, id AS doc_id, rank, round(score, 6) AS score FROM rk WHERE rank <= {TOPK}""",
)
def tfidf_topk_with_query(spark, sf):
    """Each question is fitted together with the corpus (N + 1 documents)."""
    return _top(spark, sf, include_query=True)


@query(
    "best_chunk_per_doc",
    f"""WITH
      w AS (SELECT doc_id, string_split_regex(trim(text), '\\s+') AS words FROM documents),
      c AS (SELECT doc_id, words, unnest(range(0, greatest(CAST(ceil(len(words) / {CHUNK}) AS BIGINT), 1))) AS i FROM w),
      chunks AS (SELECT {{'d': doc_id, 'c': CAST(i AS BIGINT)}} AS cid,
                        array_to_string(words[i * {CHUNK} + 1 : (i + 1) * {CHUNK}], ' ') AS text FROM c),
      tok AS (SELECT cid AS id, unnest(regexp_extract_all(lower(text), {_TOK})) AS term FROM chunks),
      tf AS (SELECT id, term, count(*) AS tf FROM tok WHERE term NOT IN ({_SW}) GROUP BY 1, 2),
      nd AS (SELECT count(*) AS n FROM chunks),
      voc AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
      idf AS (SELECT term, df, ln((1.0 + (SELECT n FROM nd)) / (1.0 + df)) + 1 AS idf FROM voc),
      raw AS (SELECT tf.id, tf.term, tf.tf * idf.idf AS raw FROM tf JOIN idf USING (term)),
      wt AS (SELECT id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY id)) AS weight FROM raw),
      {_QUERY_SQL},
      sc AS (SELECT qid, id, sum(weight * qweight) AS score FROM wt JOIN qw USING (term) GROUP BY 1, 2),
      bc AS (SELECT qid, id.d AS doc_id, id.c AS chunk_no, score,
                    row_number() OVER (PARTITION BY qid, id.d ORDER BY round(score, 9) DESC, id.c) AS r FROM sc),
      rk AS (SELECT qid, doc_id, chunk_no, score, row_number() OVER (PARTITION BY qid ORDER BY round(score, 9) DESC, doc_id) AS rank
             FROM bc WHERE r = 1)
    SELECT qid AS item_id, doc_id, chunk_no AS best_chunk, rank, round(score, 6) AS score FROM rk WHERE rank <= {TOPK}""",
)
def best_chunk_per_doc(spark, sf):
    """Chunk-level TF-IDF search; each document is represented by its best
    chunk (highest score, earliest chunk on ties); top documents by that score."""
    t = Tables(spark, sf)
    index = written(T.term_index(t.documents, "doc_id", "text", STOP, words_per_chunk=CHUNK), "chunk-index")
    top = T.tfidf_top_k(index, t.benchmark, "item_id", "text", TOPK, STOP)
    return top.select(
        F.col("qid").alias("item_id"), F.col("id").alias("doc_id"), F.col("sub").cast("bigint").alias("best_chunk"),
        F.col("rank").cast("bigint").alias("rank"), F.round("score", 6).alias("score"),
    )
