"""Toxicity scores from the nearest labelled examples.

Fit, on a bounded sample of labelled rows: which terms carry label evidence
(lower Wilson bound of the toxic rate over one half, from ``MAX_SAMPLE`` rows),
and an inverted index of ``MAX_EXAMPLES`` of them over all their terms.
Document frequencies are counted over all documents.

Score: TF-IDF cosine (1 + log tf, smoothed idf, ``LIFT`` times as much for
terms with label evidence) to the ``K`` nearest examples, exactly, by block-max
pruning: postings are grouped in blocks of examples, each block's term maxima
bound its cosines, blocks are opened from the largest bound down until no bound
exceeds the K-th cosine. Every example can be a neighbour, and every term of the
examples counts. The votes are weighted by cosine and smoothed with the toxic
rate of examples without evidence, which is also the score of a text that shares
no term with an example. The nearest ids and terms are the evidence.

Defined results: null or empty text has the base score. Rows are scored
independently; ids may be null (then never held out, as crc32 of null is null)
or repeated. Labels that are null, or of unknown documents, are not used.
Without labels every score is the neutral prior ``PRIOR``.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.llm.common import docs_of, query, written
from docflow.sources.tables import table

MAX_SAMPLE = 20_000  # labelled rows that evidence is learned from
MAX_EXAMPLES = 4_000  # labelled rows in the index
MIN_EXAMPLES = 5  # labelled examples that a term needs
LIFT = 16.0  # weight of a term with label evidence
COMMON = 1 / 8  # terms of a larger share of the examples are kept as whole rows
WILSON_Z = 2.58
K, BLOCK, SMOOTH, PRIOR = 25, 64, 1.0, 0.1
FOLDS = 5
_TERMS = re.compile(r"[^\W_]+")


def held_out(id_col):
    """Is the row in the fold that is never learned from?"""
    return F.coalesce(F.pmod(F.crc32(F.encode(id_col.cast("string"), "UTF-8")), F.lit(FOLDS)) == 0, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, most: int = MAX_SAMPLE) -> DataFrame:
    """(id, toxic, terms): about ``most`` labelled texts outside the held-out fold,
    chosen by a hash of the id (a sample of that rate, so ``most`` is its mean)."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    rate = min(1.0, most / max(1, known.count()))
    chosen = known.where(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 30)) < int(rate * (1 << 30)))
    texts = docs.select(F.col("doc_id").alias("id"), "text").where(~held_out(F.col("id")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            terms = [sorted(set(_TERMS.findall((t.as_py() or "").lower()))) for t in b.column(1)]
            counts = [Counter(_TERMS.findall((t.as_py() or "").lower())) for t in b.column(1)]
            tf = [[c[x] for x in ts] for ts, c in zip(terms, counts, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(terms, pa.list_(pa.string())), pa.array(tf, pa.list_(pa.int32()))], names=["id", "toxic", "terms", "tf"])

    picked = texts.join(chosen, texts["id"] == chosen["doc_id"]).select("id", "text", "toxic")
    return picked.mapInArrow(run, "id long, toxic int, terms array<string>, tf array<int>")


def example_terms(sample: DataFrame) -> DataFrame:
    """(term, evidence): every term of the sample, and whether its examples are
    toxic more often than not, beyond chance."""
    n, p = F.col("n"), F.col("toxic") / F.col("n")
    z2 = WILSON_Z * WILSON_Z
    low = (p + z2 / (2 * n) - WILSON_Z * F.sqrt(p * (1 - p) / n + z2 / (4 * n * n))) / (1 + z2 / n)
    counted = (
        sample.select(F.explode("terms").alias("term"), F.col("toxic").alias("y"), "indexed")
        .groupBy("term")
        .agg(F.count("*").alias("n"), F.sum("y").alias("toxic"), F.max("indexed").alias("indexed"))
        .withColumn("evidence", (n >= MIN_EXAMPLES) & (low > 0.5))
    )
    return counted.where("indexed OR evidence").select("term", "evidence")


def term_counts(docs: DataFrame, terms: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, terms, tf): numbers and frequencies of the given terms in every text."""
    number = docs.sparkSession.sparkContext.broadcast({t: k for k, t in enumerate(terms)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = number.value
        for b in batches:
            counted = [Counter(map(known.__getitem__, filter(known.__contains__, _TERMS.findall((t.as_py() or "").lower())))) for t in b.column(1)]
            keys = [sorted(c) for c in counted]
            tf = [[c[k] for k in ks] for c, ks in zip(counted, keys, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(keys, pa.list_(pa.int32())), pa.array(tf, pa.list_(pa.int32()))], names=["id", "terms", "tf"])

    return docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(run, "id long, terms array<int>, tf array<int>")


def numbered(sample: DataFrame, terms: list[str]) -> DataFrame:
    """(id, toxic, terms, tf) of the sample with the numbers of the given terms."""
    number = sample.sparkSession.sparkContext.broadcast({t: k for k, t in enumerate(terms)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = number.value
        for b in batches:
            kept = [sorted((known[t], f) for t, f in zip(ts, tf, strict=True) if t in known) for ts, tf in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)]
            cols = [pa.array([[x[k] for x in z] for z in kept], pa.list_(pa.int32())) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *cols], names=["id", "toxic", "terms", "tf"])

    return sample.select("id", "toxic", "terms", "tf").mapInArrow(run, "id long, toxic int, terms array<int>, tf array<int>")


def unit_weights(terms: np.ndarray, tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF weights of one text, of length one."""
    w = (1 + np.log(tf)) * idf[terms]
    return w / np.sqrt((w * w).sum())


def _ranges(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions, lengths): the positions of all ranges, one after the other."""
    n = hi - lo
    return np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum())), n


@dataclass
class BlockMaxIndex:
    """Postings of the examples by term and block, with the largest weight of each;
    the weights of common terms as rows over all examples."""

    idf: np.ndarray
    ids: np.ndarray
    toxic: np.ndarray
    base: float
    row: np.ndarray  # by term: its row of ``common``, or -1
    common: np.ndarray
    starts: np.ndarray  # by term: where its entries start
    blocks: np.ndarray  # by entry: block, largest weight, where its postings start
    most: np.ndarray
    posts: np.ndarray
    examples: np.ndarray  # by posting: example, weight
    weights: np.ndarray

    @classmethod
    def build(cls, examples: list[tuple[int, int, list[int], list[int]]], idf: np.ndarray, base: float) -> BlockMaxIndex:
        """``examples``: (id, toxic, terms, tf) of the examples that have terms."""
        rows = [(i, y, np.asarray(ts, dtype=np.int32), unit_weights(np.asarray(ts, dtype=np.int32), np.asarray(tf), idf)) for i, y, ts, tf in examples]
        # examples of the same strongest terms share blocks, which makes bounds tight
        rows.sort(key=lambda r: (*r[2][np.argsort(-r[3], kind="stable")][:3].tolist(), r[0]))
        none = np.zeros(0)
        example = np.repeat(np.arange(len(rows), dtype=np.int32), [len(r[2]) for r in rows])
        term = np.concatenate([r[2] for r in rows] or [none]).astype(np.int32)
        weight = np.concatenate([r[3] for r in rows] or [none])
        row, often = np.full(len(idf), -1), np.flatnonzero(np.bincount(term, minlength=len(idf)) > COMMON * len(rows))
        row[often] = np.arange(len(often))
        is_common = row[term] >= 0
        common = np.zeros((len(often), len(rows)))
        common[row[term[is_common]], example[is_common]] = weight[is_common]
        example, term, weight = example[~is_common], term[~is_common], weight[~is_common]
        order = np.lexsort((example, term))
        example, term, weight = example[order], term[order], weight[order]
        block = example // BLOCK
        first = np.flatnonzero(np.concatenate([[True], (term[1:] != term[:-1]) | (block[1:] != block[:-1])]) if len(term) else none)
        return cls(
            idf, np.array([r[0] for r in rows], dtype=np.int64), np.array([r[1] for r in rows], dtype=np.int64), base, row, common,
            np.searchsorted(term[first], np.arange(len(idf) + 1)), block[first].astype(np.int32),
            np.maximum.reduceat(weight, first) if len(first) else none, np.append(first, len(term)), example.astype(np.int32), weight,
        )

    def nearest(self, terms: np.ndarray, tf: np.ndarray, k: int = K) -> tuple[np.ndarray, np.ndarray]:
        """(example numbers, cosines) of the k nearest, exactly; of equal cosines
        those of the lower example number among the opened blocks come first."""
        if not len(self.ids) or not len(terms):
            return np.zeros(0, dtype=np.int64), np.zeros(0)
        q, row = unit_weights(terms, tf, self.idf), self.row[terms]
        known = np.zeros(len(self.common))
        known[row[row >= 0]] = q[row >= 0]
        scores = known @ self.common
        rest, q = terms[row < 0], q[row < 0]
        entries, n = _ranges(self.starts[rest], self.starts[rest + 1])
        share, of_block = np.repeat(q, n), self.blocks[entries]
        # the cosine over common terms is known, the rest is bounded; a margin for the rounding of sums in another order
        bounds = np.maximum.reduceat(scores, np.arange(0, len(scores), BLOCK)) + 1e-12
        bounds += np.bincount(of_block, share * self.most[entries], len(bounds))
        order = np.argsort(-bounds, kind="stable")
        opened, exact = order[:4], scores
        while len(opened):
            if 2 * len(opened) > len(order):  # most blocks: the terms' postings as they lie
                posts, m = _ranges(self.posts[self.starts[rest]], self.posts[self.starts[rest + 1]])
                values = np.repeat(q, m)
                scores = exact
            else:
                chosen = np.zeros(len(order), dtype=bool)
                chosen[opened] = True
                here = chosen[of_block]
                posts, m = _ranges(self.posts[entries[here]], self.posts[entries[here] + 1])
                values = np.repeat(share[here], m)
            scores = scores + np.bincount(self.examples[posts], values * self.weights[posts], len(scores))
            bounds[opened] = 0.0
            kth = np.partition(scores, -k)[-k] if len(scores) >= k else 0.0
            opened = np.flatnonzero(bounds > max(kth, 1e-12)) if 2 * len(opened) <= len(order) else opened[:0]
        near = np.argsort(-scores, kind="stable")[:k] if len(scores) <= 4 * k else self._largest(scores, k)
        near = near[scores[near] > 0]
        return near, scores[near]

    @staticmethod
    def _largest(scores: np.ndarray, k: int) -> np.ndarray:
        """Numbers of the k largest scores, the lower number first among equal ones."""
        some = np.flatnonzero(scores >= np.partition(scores, -k)[-k])
        return some[np.argsort(-scores[some], kind="stable")][:k]

    def score(self, terms: np.ndarray, tf: np.ndarray) -> tuple[float, list[int]]:
        """Smoothed distance-weighted vote, and the ids of the nearest examples."""
        near, cosine = self.nearest(terms, tf)
        vote = (float((cosine * self.toxic[near]).sum()) + SMOOTH * self.base) / (float(cosine.sum()) + SMOOTH)
        return min(1.0, max(0.0, vote)), self.ids[near][:5].tolist()


def fit(docs: DataFrame, labels: DataFrame) -> tuple[BlockMaxIndex, list[str], np.ndarray, DataFrame]:
    """(index, terms, has evidence by term, counted terms of every text)."""
    sample = training_sample(docs, labels)
    sample = written(sample.withColumn("__h", F.xxhash64("id", F.lit(11))), "toxicity-sample")
    rate = min(1.0, MAX_EXAMPLES / max(1, sample.count()))
    sample = sample.withColumn("indexed", F.pmod("__h", F.lit(1 << 30)) < int(rate * (1 << 30)))
    # the terms of a bounded sample of rows, as columns: rows of Python values take many times the memory
    found = example_terms(sample).toArrow()
    terms, evidence = found.column(0).to_pylist(), found.column(1).to_numpy().astype(bool)
    order = sorted(range(len(terms)), key=terms.__getitem__)
    terms, evidence = [terms[k] for k in order], evidence[order]
    del found, order
    counted = written(term_counts(docs, terms), "toxicity-terms")
    n = counted.count()

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(terms), dtype=np.int64)
        for b in batches:
            total += np.bincount(b.column(0).flatten().to_numpy(), minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], names=["t", "n"])

    df = np.zeros(len(terms))
    # a number per term of the sample
    for t, c in counted.select("terms").mapInArrow(present, "t int, n long").groupBy("t").agg(F.sum("n")).collect():
        df[t] = c
    weight = (np.log((n + 1) / (df + 1)) + 1) * np.where(evidence, LIFT, 1.0)
    rows = numbered(sample.where("indexed"), terms).collect()
    bare = [r["toxic"] for r in rows if not evidence[r["terms"]].any()]
    base = (sum(bare) + 1) / (len(bare) + 1 / PRIOR)
    examples = sorted((r["id"], r["toxic"], r["terms"], r["tf"]) for r in rows if r["terms"])
    return BlockMaxIndex.build(examples, weight, base), terms, evidence, counted


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, neighbours (ids), evidence (terms)."""
    spark = docs.sparkSession
    fitted, terms, has_evidence, counted = fit(docs, labels)
    index = spark.sparkContext.broadcast(fitted)
    words = spark.sparkContext.broadcast({int(k): terms[k] for k in np.flatnonzero(has_evidence)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[bytes, bytes], tuple[float, list[int], list[str]]] = {}
        evidence = np.zeros(len(index.value.idf), dtype=bool)
        evidence[list(words.value)] = True
        for b in batches:
            out = []
            ends = b.column(1).offsets.to_numpy()
            all_terms, all_tf = b.column(1).values.to_numpy(), b.column(2).values.to_numpy()
            tf_ends = b.column(2).offsets.to_numpy()
            for i in range(b.num_rows):
                ts, tf = all_terms[ends[i] : ends[i + 1]], all_tf[tf_ends[i] : tf_ends[i + 1]]
                key = (ts.tobytes(), tf.tobytes())
                if key not in seen:
                    if len(seen) > 5_000:
                        seen.clear()
                    seen[key] = (*index.value.score(ts, tf), [words.value[t] for t in ts[evidence[ts]].tolist()])
                out.append(seen[key])
            cols = [pa.array([o[k] for o in out], t) for k, t in enumerate((pa.float64(), pa.list_(pa.int64()), pa.list_(pa.string())))]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], names=["doc_id", "score", "neighbours", "evidence"])

    scored = counted.mapInArrow(run, "doc_id long, score double, neighbours array<long>, evidence array<string>")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "neighbours", "evidence")


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic; rows without an id stay."""
    bad = score_documents(docs, labels).where("predicted = 1").select(F.col("doc_id").alias("__drop")).distinct()
    return docs.join(bad, docs["doc_id"] == bad["__drop"], "left_anti")


@query("op5_toxicity")
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract columns (and evidence) for every row of documents."""
    return score_documents(docs_of(spark, sf_dir, "doc_id", "text"), table(spark, sf_dir, "labels").select("doc_id", "toxic"))
