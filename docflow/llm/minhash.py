"""Near-duplicate groups by MinHash.

1. Each document's set of word shingles is hashed to 64 bits; a digest of the
   sorted set makes classes of equal sets, and one document stands for a class.
2. ``HASHES`` universal hash minima (multiply-add modulo 2^64) give a signature;
   ``BANDS`` bands of it are bucket keys. At similarity 0.8 two sets share no
   bucket with probability (1 - 0.8^4)^32 = 5e-8.
3. Star links: in every bucket each member meets the smallest one. Pairs whose
   signatures agree in fewer than ``SKETCH`` of the places are dropped (0.8 lies
   more than five standard errors above), the rest is confirmed on the full sets.
4. In buckets that still hold several components the star is repeated: each
   member outside the bucket's largest component meets ``PIVOTS`` members of other
   components, anew as long as a round halves the components that are left. What then stays apart is compared whole,
   in blocks of bounded size that give only links between components; the members
   of a bucket's largest component are not compared with one another. No list of
   all pairs is made, and no bucket is cut.
5. Components by alternating large-star and small-star.

Defined results: a document without words (or null) has no shingles, is linked
with nothing and stands alone. Fewer words than a shingle: the whole sequence is
one shingle. Rows that repeat an id and text are one document, returned once per
row. A null id is its own component (null) and kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest, xxh3_128_digest

from docflow.llm.common import bitmap_of, docs_of, in_bitmap, odd_keys, query, window_hashes, written
from docflow.llm.components import connected_components

HASHES, BANDS = 128, 32
ROWS = HASHES // BANDS
SKETCH = 0.6
PIVOTS = 8
BLOCK_DOCS, BLOCK_SHINGLES = 4096, 4_000_000
_MULTIPLY, _ADD = odd_keys(HASHES, 11), odd_keys(HASHES, 12)


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of the ``width``-word shingles: A-Z lower-cased,
    words between ASCII white space."""
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    tokens = np.fromiter(map(xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    return np.unique(window_hashes(tokens, min(width, len(words)), seed=7))


def signature(shingles: np.ndarray) -> np.ndarray:
    """Minima of the universal hashes, upper 32 bits, in slices that fit a cache."""
    out = np.full(HASHES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for lo in range(0, len(shingles), 1024):
        part = _MULTIPLY[:, None] * shingles[None, lo : lo + 1024]
        part += _ADD[:, None]
        np.minimum(out, part.min(axis=1), out=out)
    return (out >> np.uint64(32)).astype(np.uint32)


def features(docs: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """id, n (set size), digest of the set, sig (null for an empty set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, digest, sig = [], [], []
            for t in b.column(1):
                s = shingle_set(t.as_py(), width)
                n.append(len(s))
                digest.append(xxh3_128_digest(s.tobytes()))
                sig.append(signature(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(sig, pa.binary())], names=["id", "n", "digest", "sig"])

    return docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(run, "id long, n long, digest binary, sig binary")


def candidate_sets(docs: DataFrame, wanted: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """(rep, n, set) of the class representatives in ``wanted`` (rep, digest). A
    bitmap of fixed size keeps most other texts out before the exact join."""
    bitmap = docs.sparkSession.sparkContext.broadcast(bitmap_of(wanted, "rep"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = np.flatnonzero(in_bitmap(bitmap.value, b.column(0).fill_null(0).to_numpy(zero_copy_only=False)))
            for lo in range(0, len(keep), 64):
                some = b.take(pa.array(keep[lo : lo + 64]))
                sets = [shingle_set(t.as_py(), width) for t in some.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array([xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))],
                    names=["rep", "digest", "set"],
                )

    sets = docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(run, "rep long, digest binary, set array<long>")
    return sets.join(wanted.select("rep", "digest"), ["rep", "digest"]).select("rep", F.size("set").cast("long").alias("n"), "set")


def _agreeing(pairs: DataFrame) -> DataFrame:
    """The pairs (a, b, sig_a, sig_b) whose signatures agree often enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x, y = (np.frombuffer(b"".join(b.column(k).to_pylist()), dtype=np.uint32).reshape(-1, HASHES) for k in (2, 3))
                yield b.select([0, 1]).filter(pa.array((x == y).mean(axis=1) >= SKETCH))

    return pairs.mapInArrow(run, "a long, b long")


def _similar(inter, n_a, n_b):
    """Jaccard similarity of 0.8 or more, in integers."""
    return 100 * inter >= 80 * (n_a + n_b - inter)


def _block_links(rows: pd.DataFrame) -> pd.DataFrame:
    """Links that join components within one block pair (i, j) of a bucket. A pair
    is looked at only in the first band it shares."""
    band, i, j = (int(rows[c].iloc[0]) for c in ("band", "i", "j"))
    sig = np.frombuffer(b"".join(rows["sig"]), dtype=np.uint32).reshape(-1, HASHES)
    sets = [np.asarray(s, dtype=np.int64).view(np.uint64) for s in rows["set"]]
    n, rep, label, part = (rows[c].to_numpy().copy() for c in ("n", "rep", "component", "part"))
    found = []
    for x in range(len(rows)):
        ok = label != label[x]
        ok &= (np.arange(len(rows)) > x) if i == j else (part != part[x])
        if i != j and part[x] != i:
            continue
        ok &= 100 * np.minimum(n, n[x]) >= 80 * np.maximum(n, n[x])
        idx = np.flatnonzero(ok)
        if not len(idx):
            continue
        same = sig[idx] == sig[x]
        share = same.mean(axis=1)
        first = same.reshape(len(idx), BANDS, ROWS).all(axis=2).argmax(axis=1) == band
        good = np.flatnonzero(first & (share >= SKETCH))
        for k in good[np.argsort(-share[good], kind="stable")]:
            y = idx[k]
            if label[y] == label[x]:
                continue
            at = np.searchsorted(sets[y], sets[x])
            inter = int((sets[y][np.minimum(at, len(sets[y]) - 1)] == sets[x]).sum())
            if _similar(inter, n[x], n[y]):
                found.append((rep[x], rep[y]))
                label[label == label[y]] = label[x]
    return pd.DataFrame(found, columns=["a", "b"], dtype="int64")


def _confirmed(pairs: DataFrame, sigs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that are similar on their full sets."""
    pairs = pairs.join(sigs.toDF("a", "sig_a"), "a").join(sigs.toDF("b", "sig_b"), "b").select("a", "b", "sig_a", "sig_b")
    inter = F.size(F.array_intersect("set_a", "set_b"))
    return (
        _agreeing(pairs)
        .join(sets.toDF("a", "n_a", "set_a"), "a")
        .join(sets.toDF("b", "n_b", "set_b"), "b")
        .where(_similar(inter, F.col("n_a"), F.col("n_b")))
        .select("a", "b")
    )


def _open_members(placed: DataFrame, found: DataFrame) -> DataFrame:
    """(band, key, rep, n, component, members, weight of the component, big) of
    the buckets that hold several components; ``big`` marks the largest of each."""
    labelled = placed.join(found, placed["rep"] == found["node"], "left").select("band", "key", "rep", "n", F.coalesce("component", "rep").alias("component"))
    held = labelled.groupBy("band", "key", "component").agg(F.count("*").alias("members"), F.sum("n").alias("weight"))
    largest = held.groupBy("band", "key").agg(F.max_by("component", F.struct("members", "component")).alias("largest"), F.count("*").alias("kinds")).where("kinds > 1")
    held = held.join(largest, ["band", "key"]).select("band", "key", "component", "members", "weight", (F.col("component") == F.col("largest")).alias("big"))
    return labelled.join(held, ["band", "key", "component"]).select("band", "key", "rep", "n", "component", "members", "weight", "big")


def _pivot_pairs(rest: DataFrame, turn: int) -> DataFrame:
    """(a, b): every member outside the largest component of its bucket beside up to
    ``PIVOTS`` members of other components there, other ones each turn. One pivot a
    slice of the components."""
    drawn = F.xxhash64("rep", F.lit(turn))
    slices = rest.groupBy("band", "key", F.pmod(F.xxhash64("component", F.lit(turn)), F.lit(PIVOTS)).alias("slice")).agg(
        F.min_by(F.struct(F.col("rep").alias("pivot"), F.col("component").alias("of")), F.struct(drawn, "rep")).alias("p")
    )
    pivots = slices.groupBy("band", "key").agg(F.collect_list("p").alias("pivots"))  # PIVOTS at most
    met = rest.where(~F.col("big")).join(pivots, ["band", "key"]).select("rep", "component", F.inline("pivots")).where("component <> of")
    return met.select(F.least("rep", "pivot").alias("a"), F.greatest("rep", "pivot").alias("b")).distinct()


def _blocks(rest: DataFrame) -> DataFrame:
    """Members by block pair (i, j) of their bucket: the largest component in the
    first blocks, all others in the last; the former meet the latter only."""
    parts = F.greatest(F.ceil(F.col("m") / BLOCK_DOCS), F.ceil(F.col("w") / BLOCK_SHINGLES)).cast("int")
    sides = rest.groupBy("band", "key", "big", "component").agg(F.first("members").alias("m"), F.first("weight").alias("w"))
    sides = sides.groupBy("band", "key", "big").agg(F.sum("m").alias("m"), F.sum("w").alias("w")).withColumn("parts", parts)
    sides = sides.groupBy("band", "key").agg(F.max(F.when(F.col("big"), F.col("parts"))).alias("first"), F.max(F.when(~F.col("big"), F.col("parts"))).alias("last"))
    part = F.when(F.col("big"), F.pmod(F.xxhash64("rep"), F.col("first"))).otherwise(F.col("first") + F.pmod(F.xxhash64("rep"), F.col("last")))
    start = F.when(F.col("big"), F.col("first")).otherwise(F.lit(0))
    return (
        rest.join(sides, ["band", "key"])
        .withColumn("part", part.cast("int"))
        .withColumn("other", F.explode(F.sequence(start, F.col("first") + F.col("last") - 1)))
        .select("band", "key", "rep", "component", "part", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"))
    )


def near_groups(docs: DataFrame, width: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_shingles, component_id (smallest id reachable), kept; one row per row."""
    feats = written(features(docs, width, id_col, text_col), "minhash-features")
    classes = written(
        feats.where("n > 0 and id is not null").groupBy("digest", "n").agg(F.min("id").alias("rep"), F.first("sig").alias("sig")),
        "minhash-classes",
    )
    bands = classes.select(
        "rep", "n",
        F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda k: F.xxhash64(k, F.substring(F.col("sig"), k * (4 * ROWS) + 1, F.lit(4 * ROWS))))).alias("band", "key"),
    )
    buckets = (
        bands.groupBy("band", "key")
        .agg(F.count("*").alias("size"), F.sum("n").alias("weight"), F.min("rep").alias("center"), F.max("rep").alias("top"), F.bit_xor(F.xxhash64("rep")).alias("members"))
        .where("size > 1")
    )
    # buckets of the same members count once, in their first band
    buckets = buckets.groupBy("size", "weight", "center", "top", "members").agg(F.min(F.struct("band", "key")).alias("k")).select("center", "k.band", "k.key")
    placed = written(bands.select("band", "key", "rep", "n").join(buckets, ["band", "key"]), "minhash-buckets")

    wanted = placed.select("rep").distinct().join(classes, "rep")
    sets = written(candidate_sets(docs, wanted, width, id_col, text_col), "minhash-sets")
    sigs = classes.select("rep", "sig")

    stars = placed.where("rep <> center").select(F.col("center").alias("a"), F.col("rep").alias("b")).distinct()
    links = written(_confirmed(stars, sigs, sets), "minhash-links")
    linked = connected_components(links)
    left, turn = None, 0
    while True:
        rest = written(_open_members(placed, linked), "minhash-open")
        before, left = left, rest.select("component").distinct().count()
        if not left or (before is not None and 2 * left > before):
            break
        turn += 1
        more = written(_confirmed(_pivot_pairs(rest, turn), sigs, sets), "minhash-pivot-links")
        linked = connected_components(linked.toDF("a", "b").unionByName(more))
    if left:
        more = _blocks(rest).join(sigs, "rep").join(sets, "rep").groupBy("band", "key", "i", "j").applyInPandas(_block_links, "a long, b long")
        linked = connected_components(linked.toDF("a", "b").unionByName(written(more, "minhash-more-links")))

    member = feats.select("id", "n", "digest").join(classes.select("digest", "rep"), "digest", "left")
    component = F.when(F.col("n") > 0, F.coalesce("component", "rep")).otherwise(F.col("id"))
    return (
        member.join(linked, member["rep"] == linked["node"], "left")
        .withColumn("component_id", F.when(F.col("id").isNotNull(), component))
        .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
    )


def drop_near_copies(docs: DataFrame, width: int = 5) -> DataFrame:
    """The rows of ``docs`` that stand for their group of near-duplicates."""
    dropped = near_groups(docs, width).where(~F.col("kept")).select(F.col("doc_id").alias("__drop")).distinct()
    return docs.join(dropped, docs["doc_id"] == dropped["__drop"], "left_anti")


@query("op1_minhash_dedup")
def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract columns for every row of documents, 4-word shingles."""
    return near_groups(docs_of(spark, sf_dir, "doc_id", "text"), width=4)
