"""Exact deduplication over content-defined chunk recipes (DataFrame functions only).

A text is cut where its own content says so (after the white space that follows
a sentence mark, or after a line feed), with a least and a greatest chunk
length, so every character belongs to exactly one chunk. Chunks become verified
identifiers: a 64-bit hash plus an ordinal that tells apart different chunks
(by SHA-256) of one hash. A document is then its ordered list of identifiers;
documents are equal when their lists are. Only digests and identifiers are
shuffled, never texts.

Defined results: a null text counts as empty; all empty texts are one group.
Rows that repeat an id *and* text are one document: each counts in
``group_size`` and they are kept or dropped together. A null id is never larger
than another id. Further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docflow.llm.common import docs_of, query, written

MIN_CHUNK = 1024  # characters
MAX_CHUNK = 8192
_CUT = rf"(?s).{{{MIN_CHUNK},{MAX_CHUNK - 1}}}?(?:(?<=[.!?;:\n]\s)|(?<=\n)|\z)|.{{1,{MAX_CHUNK}}}"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only; null becomes empty. For pure ASCII this is ``lower``."""
    t = F.coalesce(text, F.lit(""))
    return F.when(F.length(t) == F.octet_length(t), F.lower(t)).otherwise(F.translate(t, _UPPER, _UPPER.lower()))


def chunk_occurrences(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text_sha, pos, h, s): one row per chunk of a document; an empty text
    has one row without a chunk (pos null)."""
    norm = docs.select(F.col(id_col).alias("id"), lower_ascii(F.col(text_col)).alias("t"))
    chunks = F.transform(
        F.regexp_extract_all("t", F.lit(_CUT), F.lit(0)),
        lambda c: F.struct(F.xxhash64(c).alias("h"), F.unhex(F.sha2(c, 256)).alias("s")),
    )
    return norm.select("id", F.unhex(F.sha2("t", 256)).alias("text_sha"), F.posexplode_outer(chunks).alias("pos", "c")).select(
        "id", "text_sha", "pos", "c.h", "c.s"
    )


def verified_identifiers(occurrences: DataFrame) -> DataFrame:
    """(h, s, k): each distinct chunk's identifier (h, k); k > 0 only where
    different chunks share the 64-bit hash."""
    distinct = occurrences.where(F.col("h").isNotNull()).select("h", "s").distinct()
    return distinct.withColumn("k", F.row_number().over(Window.partitionBy("h").orderBy("s")) - 1)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, keep_id (largest id among equal texts),
    group_size, kept, text_sha256 of the normalised text."""
    occ = written(chunk_occurrences(docs, id_col, text_col), "chunk-occurrences")
    listed = occ.join(verified_identifiers(occ), ["h", "s"], "left")
    recipes = listed.groupBy("id", "text_sha").agg(
        F.transform(
            F.array_sort(F.collect_set(F.when(F.col("pos").isNotNull(), F.struct("pos", "h", "k")))),
            lambda c: F.struct(c["h"].alias("h"), c["k"].alias("k")),
        ).alias("recipe"),
        F.count(F.when(F.coalesce(F.col("pos"), F.lit(0)) == 0, F.lit(1))).alias("times"),
    )
    groups = recipes.groupBy("recipe").agg(F.max("id").alias("keep_id"), F.sum("times").alias("group_size"))
    return (
        recipes.join(groups, "recipe")
        .select(
            F.col("id").alias(id_col),
            "keep_id",
            "group_size",
            F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
            F.lower(F.hex("text_sha")).alias("text_sha256"),
            F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))).alias("__copy"),
        )
        .drop("__copy")
    )


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text is the one of its group that stays; rows
    without an id can't be told apart and stay."""
    dropped = exact_groups(docs).where(~F.col("kept")).select(F.col("doc_id").alias("__drop")).distinct()
    return docs.join(dropped, docs["doc_id"] == dropped["__drop"], "left_anti")


@query(
    "op3_exact_dedup",
    """
    WITH t AS (
      SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
      FROM documents)
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           doc_id = max(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
    FROM t WINDOW w AS (PARTITION BY norm)
    """,
)
def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract columns for every row of documents."""
    return exact_groups(docs_of(spark, sf_dir, "doc_id", "text"))
