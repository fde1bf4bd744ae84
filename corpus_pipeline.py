"""Corpus pipeline: toxicity, exact copies, near copies, leaked benchmark items,
then the token ids of what is left.

Each stage takes (spark, docs, sf_dir), is written as Parquet and read again as
the next one's ``docs``. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.llm.bpe_codec import round_trip
from docflow.llm.common import docs_of, query, written
from docflow.llm.decontam import drop_contaminated
from docflow.llm.exact import drop_exact_copies
from docflow.llm.minhash import drop_near_copies
from docflow.llm.toxicity import drop_toxic
from docflow.sources.tables import table

VOCABULARY = "word_bpe_49k.json"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
ORACLE_SQL = None  # the toxicity and tokeniser stages have no SQL equivalent


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    return drop_toxic(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (but for the case of A-Z), the one with the largest id."""
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest id, of each group of 0.8 similar 5-word shingle sets."""
    return drop_near_copies(docs, width=5)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which no benchmark item leaked."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, the ids (little-endian unsigned 32-bit) and the hash of the decoded text."""
    both = round_trip(docs, public_tokenizers.path(VOCABULARY))
    return both.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("encoding", encoding),
]


@query("pipeline", ORACLE_SQL)
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = docs_of(spark, sf_dir, *COLUMNS)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
