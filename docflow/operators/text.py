"""Text retrieval: chunking, tokenising, TF-IDF weights and cosine top-k
through an inverted-index join.

TF-IDF follows the common smooth-idf definition: raw term counts,
``idf = ln((1 + N) / (1 + df)) + 1``, L2-normalised document vectors.
(MLlib's ``IDF`` omits the ``+ 1`` and is therefore not used.)

Scale notes: terms are counted inside the row, document frequencies with
partial aggregates; a search scores blocks of texts against blocks of queries
and keeps k rows per query and block, never a row per (query, text). Spark
picks the joins from its own size estimates.
"""

from __future__ import annotations

import os
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docflow.functions.exprs import col_
from docflow.session import written

TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"
WORD_SPLIT = r"\s+"


@lru_cache(maxsize=1)
def english_stop_words() -> tuple[str, ...]:
    """Spark's default English stop-word list (as shipped with StopWordsRemover)."""
    path = os.path.join(os.path.dirname(__file__), "..", "functions", "stopwords_english.txt")
    with open(path, encoding="utf-8") as fh:
        return tuple(w.strip() for w in fh if w.strip())


# ------------------------------------------------------------------ chunking


def word_chunks(text: str | Column, size: int = 500) -> Column:
    """Array of chunks of ``size`` whitespace-separated words joined by one space.

    Built inside the row, then exploded once per chunk. Pass a column that
    already holds the text; use ``explode_word_chunks`` on a frame so the
    word split is evaluated once per row (not once per chunk).
    """
    return _chunks_of_words(F.split(F.trim(col_(text)), WORD_SPLIT), size)


def _chunks_of_words(words: Column, size: int) -> Column:
    n = F.size(words)
    starts = F.sequence(F.lit(0), F.greatest(F.ceil(n / F.lit(size)).cast("int") - 1, F.lit(0)))
    return F.transform(starts, lambda i: F.array_join(F.slice(words, i * size + 1, size), " "))


def explode_word_chunks(df: DataFrame, id_col: str, text_col: str, size: int = 500) -> DataFrame:
    """(id, chunk_no, chunk_text) with the words split once per text."""
    w = df.select(F.col(id_col), F.split(F.trim(F.col(text_col)), WORD_SPLIT).alias("__words"))
    return w.select(F.col(id_col), F.posexplode(_chunks_of_words(F.col("__words"), size)).alias("chunk_no", "chunk_text"))


def char_chunks(text: str | Column, size: int = 500) -> Column:
    """Array of consecutive ``size``-character pieces."""
    n = F.length(col_(text))
    starts = F.sequence(F.lit(0), F.greatest(F.ceil(n / F.lit(size)).cast("int") - 1, F.lit(0)))
    return F.transform(starts, lambda i: F.substring(col_(text), i * size + 1, size))


def line_chunks(text: str | Column, sep: str = "\n") -> Column:
    """Pieces split on ``sep`` ('\\n' lines, '\\n\\n' paragraphs); blank pieces dropped."""
    return F.filter(F.split(col_(text), rf"\Q{sep}\E"), lambda x: F.trim(x) != F.lit(""))


def explode_chunks(df: DataFrame, id_col: str, chunks: Column) -> DataFrame:
    """(id, chunk_no starting at 0, chunk_text)."""
    return df.select(F.col(id_col), F.posexplode(chunks).alias("chunk_no", "chunk_text"))


# ---------------------------------------------------------------- tokenising


def tokens_basic(text: str | Column) -> Column:
    """Strip non-letters, lower-case, whitespace split (empty tokens dropped)."""
    cleaned = F.lower(F.regexp_replace(col_(text), r"[^a-zA-Z\s]", ""))
    return F.filter(F.split(cleaned, WORD_SPLIT), lambda x: x != F.lit(""))


def remove_stop_words(tokens: Column, stop_words=None) -> Column:
    """Array form (per-row filter). On exploded tokens prefer ``not_stop_word``
    (a hash-set lookup instead of a scan of the list per token)."""
    words = list(stop_words if stop_words is not None else english_stop_words())
    lit_arr = F.array(*[F.lit(w) for w in words])
    return F.filter(tokens, lambda x: ~F.array_contains(lit_arr, x))


def not_stop_word(token: str | Column, stop_words=None) -> Column:
    """Predicate on one token; ``isin`` over a long list is planned as InSet (hash lookup)."""
    words = list(stop_words if stop_words is not None else english_stop_words())
    return ~col_(token).isin(*words)


def tokens_unicode(text: str | Column) -> Column:
    """Lower-cased word tokens of two or more letters / digits / underscores."""
    return F.regexp_extract_all(F.lower(col_(text)), F.lit(TOKEN_PATTERN), 0)


# -------------------------------------------------------------------- TF-IDF

DOC_BLOCK, QUERY_BLOCK = 8192, 256  # texts and queries scored together in one group
_TOKEN = re.compile(r"\w{2,}")
_SPACE = re.compile(r"[ \t\n\x0b\f\r]+")
_INDEX_SLICE = 256  # index rows per output batch


def term_index(
    df: DataFrame, id_col: str, text_col: str, stop_words=None, words_per_chunk: int | None = None, mult_col: str | None = None
) -> DataFrame:
    """(id, sub, mult, terms, tfs): the distinct terms of every text and their counts.

    Counted inside the row (no shuffle of texts or tokens). With
    ``words_per_chunk`` there is a row per chunk of so many words, numbered by
    ``sub``; otherwise ``sub`` is 0. ``mult`` is the number of documents that a
    row stands for. Texts without terms (also null ones) keep a row.
    """
    id_type = df.schema[id_col].dataType
    stop = frozenset(stop_words or ())

    def pieces(text: str) -> Iterator[str]:
        if words_per_chunk is None:
            yield text
            return
        words = _SPACE.split(text.strip(" "))
        for at in range(0, len(words), words_per_chunk):
            yield " ".join(words[at : at + words_per_chunk])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, subs, terms, tfs = [], [], [], []

            def flush(b=b):
                take = pa.array(at, pa.int64())
                cols = [b.column(0).take(take), pa.array(subs, pa.int32()), b.column(1).take(take)]
                cols += [pa.array(terms, pa.list_(pa.string())), pa.array(tfs, pa.list_(pa.int32()))]
                out = pa.RecordBatch.from_arrays(cols, names=["id", "sub", "mult", "terms", "tfs"])
                for x in (at, subs, terms, tfs):
                    x.clear()
                return out

            for row, text in enumerate(b.column(2)):
                for sub, piece in enumerate(pieces(text.as_py() or "")):
                    counts = Counter(_TOKEN.findall(piece))
                    kept = [t for t in counts if t not in stop]
                    at.append(row)
                    subs.append(sub)
                    terms.append(kept)
                    tfs.append([counts[t] for t in kept])
                    if len(at) >= _INDEX_SLICE:
                        yield flush()
            if at:
                yield flush()

    mult = F.lit(1) if mult_col is None else F.col(mult_col)
    src = df.select(F.col(id_col).alias("id"), mult.cast("bigint").alias("mult"), F.lower(text_col).alias("text"))
    return src.mapInArrow(run, f"id {id_type.simpleString()}, sub int, mult bigint, terms array<string>, tfs array<int>")


def postings(index: DataFrame) -> DataFrame:
    """(id, sub, term, tf) of an index."""
    pairs = index.select("id", "sub", F.explode(F.arrays_zip("terms", "tfs")).alias("p"))
    return pairs.select("id", "sub", F.col("p.terms").alias("term"), F.col("p.tfs").alias("tf"))


def smooth_idf(n_docs, df) -> Column:
    return F.log((F.lit(1.0) + F.lit(n_docs)) / (F.lit(1.0) + df)) + 1.0


def vocabulary(index: DataFrame) -> tuple[DataFrame, int, int]:
    """((term, df), number of documents, number of index rows)."""
    total = index.agg(F.coalesce(F.sum("mult"), F.lit(0)).alias("docs"), F.count(F.lit(1)).alias("rows")).first()
    df = index.select("mult", F.explode("terms").alias("term")).groupBy("term").agg(F.sum("mult").alias("df"))
    return df, total["docs"], total["rows"]


def tfidf(df: DataFrame, id_col: str, text_col: str, stop_words=None) -> DataFrame:
    """(id, term, tf, idf, weight): smooth idf, vectors of length one."""
    index = written(term_index(df, id_col, text_col, stop_words), "term-index")
    vocab, n_docs, _ = vocabulary(index)
    w = postings(index).join(vocab.select("term", smooth_idf(n_docs, F.col("df")).alias("idf")), "term")
    w = w.withColumn("raw", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy("id")))
    return w.select("id", "term", "tf", "idf", (F.col("raw") / norm).alias("weight"))


def top_k_per_group(df: DataFrame, group: str, score: str, tie: str, k: int) -> DataFrame:
    """Best ``k`` rows per group by score desc, tie-broken by ``tie`` asc.

    ``row_number() <= k`` is planned with a map-side group limit, so at most
    k rows per group and task are shuffled. Scores are compared at 1e-9 so
    that exact duplicates (equal up to float summation order) tie on ``tie``.
    """
    w = Window.partitionBy(group).orderBy(F.desc(F.round(F.col(score), 9)), F.asc(tie))
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def query_terms(queries: DataFrame, qid: str, text_col: str, vocab: DataFrame, n_docs: int, stop_words, include_query: bool) -> DataFrame:
    """(qid, term, x, y): what a posting of the term with count tf adds to a
    query's score, tf * x, and to the squared norm of its text, tf * tf * y."""
    qtf = postings(term_index(queries, qid, text_col, stop_words)).select(F.col("id").alias("qid"), "term", "tf")
    n = n_docs + 1 if include_query else n_docs
    idf = smooth_idf(n, F.coalesce("df", F.lit(0)) + (1 if include_query else 0))
    q = qtf.join(vocab, "term", "left" if include_query else "inner").withColumn("idf", idf)
    norm = F.sqrt(F.sum(F.pow(F.col("tf") * F.col("idf"), 2)).over(Window.partitionBy("qid")))
    x = F.col("tf") * F.col("idf") * F.col("idf") / norm
    y = F.pow("idf", 2) - F.pow(smooth_idf(n, F.col("df")), 2) if include_query else F.lit(0.0)
    return q.select("qid", "term", x.alias("x"), F.coalesce(y, F.lit(0.0)).alias("y"))


def tfidf_top_k(index: DataFrame, queries: DataFrame, qid: str, qtext: str, k: int, stop_words=None, include_query: bool = False) -> DataFrame:
    """(qid, id, sub, score, rank): best ``k`` ids per query by TF-IDF cosine, of
    each id its best row (the smallest ``sub`` on ties).

    With ``include_query`` the idf is that of the corpus and the ONE query being
    asked (N + 1 documents, df + 1 for its terms). Every text's squared norm is
    computed once; for a query only its shared terms change, so the norm is
    corrected on them.

    The postings meet the vocabulary once, for the norms; only those of query
    terms go on to the scoring. Texts and queries are cut into
    blocks by a hash of their ids; a group scores one block of texts against one
    block of queries and returns ``k`` rows per query, so no row per (query,
    text) ever exists. Rows of one id share a block. Only texts that share a
    term with the query are scored.
    """
    vocab, n_docs, n_rows = vocabulary(index)
    q = written(query_terms(queries, qid, qtext, vocab, n_docs, stop_words, include_query), "query-terms")
    n_q = q.agg(F.count_distinct("qid")).first()[0]
    d_blocks, q_blocks = max(1, -(-n_rows // DOC_BLOCK)), max(1, -(-n_q // QUERY_BLOCK))

    asked = q.select("term").distinct().withColumn("asked", F.lit(True))
    idf = smooth_idf(n_docs + 1 if include_query else n_docs, F.col("df"))
    terms = vocab.join(asked, "term", "left").select("term", idf.alias("idf"), "asked")
    hit = F.col("asked").isNotNull()
    texts = (
        postings(index)
        .join(terms, "term")
        .groupBy("id", "sub")
        .agg(
            F.sum(F.pow(F.col("tf") * F.col("idf"), 2)).alias("s0"),
            F.collect_list(F.when(hit, F.struct("term", "tf"))).alias("hits"),
        )
        .where(F.size("hits") > 0)
    )
    texts = texts.select("id", "sub", "s0", F.col("hits.term").alias("terms"), F.col("hits.tf").alias("tfs"))
    texts = texts.withColumn("__d", F.pmod(F.xxhash64("id"), F.lit(d_blocks))).withColumn("__q", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))))
    asks = q.withColumn("__q", F.pmod(F.xxhash64("qid"), F.lit(q_blocks)).cast("int")).withColumn("__d", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(d_blocks - 1).cast("bigint"))))

    types = f"qid {q.schema['qid'].dataType.simpleString()}, id {index.schema['id'].dataType.simpleString()}"

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        return score_block(left, right, k)

    local = texts.groupBy("__d", "__q").cogroup(asks.groupBy("__d", "__q")).applyInArrow(score, f"{types}, sub int, score double")
    return top_k_per_group(local, "qid", "score", "id", k)


def score_block(texts: pa.Table, asks: pa.Table, k: int) -> pa.Table:
    """Best ``k`` ids of one block of texts for every query of one block."""
    id_type, qid_type = texts.schema.field("id").type, asks.schema.field("qid").type
    out_q, out_row, out_score = [], [], []
    if texts.num_rows and asks.num_rows:
        ids = pc.rank(texts.column("id"), tiebreaker="dense").to_numpy().astype(np.int64)  # order of ids of any type
        subs, s0 = texts.column("sub").to_numpy(), texts.column("s0").to_numpy()
        lists = texts.column("terms").combine_chunks()
        rows = np.repeat(np.arange(texts.num_rows), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        tf = texts.column("tfs").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        known = pc.unique(asks.column("term"))
        codes = pc.fill_null(pc.index_in(lists.flatten(), value_set=known), -1).to_numpy(zero_copy_only=False)
        order = np.argsort(codes, kind="stable")
        codes, rows, tf = codes[order], rows[order], tf[order]
        starts = np.searchsorted(codes, np.arange(len(known) + 1))
        qids = asks.column("qid").combine_chunks().dictionary_encode()
        qno = qids.indices.to_numpy(zero_copy_only=False)
        qterm = pc.index_in(asks.column("term"), value_set=known).to_numpy()
        x, y = asks.column("x").to_numpy(), asks.column("y").to_numpy()
        by_query = np.lexsort((qterm, qno))
        for part in np.split(by_query, np.flatnonzero(np.diff(qno[by_query])) + 1):
            dot, norm, shared = np.zeros(len(ids)), s0.copy(), np.zeros(len(ids), dtype=bool)
            for j in part:
                at = slice(starts[qterm[j]], starts[qterm[j] + 1])
                dot[rows[at]] += tf[at] * x[j]
                norm[rows[at]] += tf[at] * tf[at] * y[j]
                shared[rows[at]] = True
            found = np.flatnonzero(shared)
            cosine = dot[found] / np.sqrt(norm[found])
            level = np.round(cosine, 9)
            best = np.lexsort((subs[found], ids[found], -level))
            _, first = np.unique(ids[found][best], return_index=True)  # the best row of every id
            best = best[np.sort(first)][:k]
            out_q += [qno[part[0]]] * len(best)
            out_row += found[best].tolist()
            out_score += cosine[best].tolist()
        qid_col = qids.dictionary.take(pa.array(out_q, pa.int64()))
        picked = texts.take(pa.array(out_row, pa.int64()))
        return pa.table({"qid": qid_col, "id": picked.column("id"), "sub": picked.column("sub"), "score": pa.array(out_score, pa.float64())})
    empty = {"qid": pa.array([], qid_type), "id": pa.array([], id_type), "sub": pa.array([], pa.int32()), "score": pa.array([], pa.float64())}
    return pa.table(empty)


# ----------------------------------------------------------------- entities

# Question patterns (case-insensitive) and the captured group.
NAME_PATTERN = r"(?i)\b(name|patient)\s*(?:is|named)?\s*(\w+)"
AGE_PATTERN = r"(?i)\b(age|old)\s*is\s*(\d+)"
DIAGNOSIS_PATTERN = r"(?i)\b(diagnosis|diagnosed)\s*(with)?\s*(\w+)"


def extract_entities(text: str | Column) -> tuple[Column, Column, Column]:
    """(name, age, diagnosis) from a question; NULL when a pattern does not match."""
    t = col_(text)
    name = F.nullif(F.regexp_extract(t, NAME_PATTERN, 2), F.lit(""))
    age = F.nullif(F.regexp_extract(t, AGE_PATTERN, 2), F.lit(""))
    diag = F.nullif(F.regexp_extract(t, DIAGNOSIS_PATTERN, 3), F.lit(""))
    return name, age, diag


# ------------------------------------------------- duplicate-aware search


def group_duplicates(df: DataFrame, id_col: str, text_col: str, k: int) -> tuple[DataFrame, DataFrame]:
    """Collapse identical texts: (unique: id = smallest member id, text, mult)
    and (members: rep -> first ``k`` member ids, ascending).

    Multiplicities come from a hash aggregate on the text digest; the first
    ``k`` members (and the representative's text) from a windowed limit that
    runs map-side first, so a text repeated in a third of all rows never
    lands in one task as a whole and texts are never sorted as a group.
    """
    sig = F.sha2(F.col(text_col), 256)
    keyed = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), sig.alias("sig"))
    mult = keyed.groupBy("sig").agg(F.count(F.lit(1)).alias("mult"))
    w = Window.partitionBy("sig").orderBy("id")
    firsts = keyed.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= k)
    unique = firsts.where(F.col("__r") == 1).join(mult, "sig").select("id", "text", "mult")
    members = firsts.groupBy("sig").agg(F.min("id").alias("rep"), F.sort_array(F.collect_list("id")).alias("ids"))
    return unique, members.drop("sig")


def dedup_cosine_top_k(
    df: DataFrame, id_col: str, text_col: str, queries: DataFrame, qid: str, qtext: str, k: int, stop_words=None
) -> DataFrame:
    """Exact top-``k`` documents per query where identical documents are
    scored once: the best k groups per query are expanded to their first k
    member ids and re-ranked by (score desc, id asc). Any document of the
    true top k lies in one of the best k groups among its first k members."""
    unique, members = group_duplicates(df, id_col, text_col, k)
    index = written(term_index(unique, "id", "text", stop_words, mult_col="mult"), "term-index")
    top_groups = tfidf_top_k(index, queries, qid, qtext, k, stop_words).select("qid", F.col("id").alias("rep"), "score")
    expanded = top_groups.join(members, "rep").select("qid", "score", F.explode("ids").alias("id"))
    return top_k_per_group(expanded, "qid", "score", "id", k)
