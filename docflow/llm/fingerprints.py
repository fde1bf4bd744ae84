"""Document fingerprints by consistent weighted sampling (DataFrame functions only).

A document is a weighted set: its words (lower-cased, between ASCII white space), each
with the number of times it occurs. For each of ``SAMPLES`` samples and each word,
hashes of the word and the sample's number give r and c, both gamma(2, 1), and b,
uniform. With t = floor(ln w / r + b) and y = exp(r * (t - b)), the word of the
least c / (y * exp(r)) is the sample, together with its t. Two documents draw the
same sample with a probability equal to their generalised Jaccard similarity
(sum of the smaller weights over sum of the larger ones), so the share of equal
samples estimates it with a standard error of at most 0.5 / sqrt(SAMPLES). A sample
is kept as 28 bits; two different ones agree by chance once in 2^28.

The order of a sample and its 28 bits are packed into one long, so a document's samples
are plain minima over its words: words are counted and sampled where their text
lies, and only the samples leave the task.

Edited texts need the next document by descending id. Ids are ranged, numbered in their
range and written; a range's last document meets the first of the next range that
has any (one row per range). A text is shuffled once, and the part of it that its
neighbour needs a second time.

Defined results: a null text is empty. Documents without words have the empty
fingerprint; its likeness is 1 to itself and 0 to others. A null id comes after all
others. Rows of one id are ordered by a hash of their texts; rows that repeat an id and
text are one document (one neighbour), returned once per row. A single document is its
own next one. Further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docflow.llm.common import docs_of, query, written

SAMPLES = 32
BITS = 28
_MASK = (1 << BITS) - 1
_STEP = float(1 << 27)  # order of a sample: (ln a + 128) in steps of 2^-27
_KEY = ["i", "h"]


def _uniform(bits: Column, width: int) -> Column:
    """A number inside (0, 1) from the low ``width`` bits."""
    return (bits.bitwiseAND(F.lit((1 << width) - 1)) + F.lit(0.5)) / F.lit(float(1 << width))


def sample(term: Column, log_weight: Column, k: int) -> Column:
    """Order and identity of a word's draw for sample ``k``, as one non-negative long."""
    h1, h2, h3 = (F.xxhash64(term, F.lit(3 * k + j)) for j in range(3))
    r = -F.log(_uniform(h1, 32) * _uniform(F.shiftrightunsigned(h1, 32), 32))
    c = -F.log(_uniform(h2, 32) * _uniform(F.shiftrightunsigned(h2, 32), 32))
    b = _uniform(F.shiftrightunsigned(h3, BITS), 36)
    t = F.floor(log_weight / r + b)
    order = F.floor((F.log(c) - r * (t - b) - r + F.lit(128.0)) * F.lit(_STEP))
    order = F.least(F.greatest(order, F.lit(0).cast("long")), F.lit((1 << 35) - 1))
    name = h3.bitwiseXOR(t * F.lit(40503)).bitwiseAND(F.lit(_MASK))
    return F.shiftleft(order, BITS).bitwiseOR(name)


def words_of(text: Column) -> Column:
    """The words of a text; an empty string at either end stands for no word."""
    return F.split(F.lower(text), r"[\x20\x09-\x0D]+")


def fingerprint_pairs(texts: DataFrame, keys: list[str], first: str, second: str) -> DataFrame:
    """(keys, first, second): the fingerprints of two texts of each row as arrays of ints,
    null without words. ``keys`` tell the rows apart; no shuffle if ``texts`` lies by some of
    them. A word with the same count in both texts is drawn once for both."""
    side = F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col(first).alias("t")), F.struct(F.lit(1).alias("side"), F.col(second).alias("t"))))
    words = texts.select(*keys, side.alias("e")).select(*keys, "e.side", F.explode(words_of(F.col("e.t"))).alias("word"))
    term = F.when(F.col("word") != "", F.xxhash64("word")).alias("term")
    counts = words.select(*keys, "side", term).groupBy(*keys, "term").agg(F.sum(1 - F.col("side")).alias("w0"), F.sum("side").alias("w1"))
    # side 2: both texts hold the word equally often
    apart = F.filter(F.array(F.struct(F.lit(0).alias("side"), F.col("w0").alias("w")), F.struct(F.lit(1).alias("side"), F.col("w1").alias("w"))), lambda e: e["w"] > 0)
    both = F.array(F.struct(F.lit(2).alias("side"), F.col("w0").alias("w")))
    draws = counts.select(*keys, "term", F.explode(F.when(F.col("w0") == F.col("w1"), both).otherwise(apart)).alias("e"))
    draws = draws.select(*keys, "e.side", "term", F.log(F.col("e.w").cast("double")).alias("lw"))
    drawn = draws.groupBy(*keys, "side").agg(*[F.min(F.when(F.col("term").isNotNull(), sample(F.col("term"), F.col("lw"), k))).alias(f"s{k}") for k in range(SAMPLES)])
    least = F.array(*[F.col(f"s{k}") for k in range(SAMPLES)])
    sides = drawn.groupBy(*keys).agg(*[F.max(F.when(F.col("side") == k, F.when(F.col("s0").isNotNull(), least))).alias(f"a{k}") for k in range(3)])

    def merged(a: Column, b: Column) -> Column:
        pair = F.zip_with(a, b, lambda x, y: F.least(x, y).bitwiseAND(F.lit(_MASK)).cast("int"))
        alone = F.transform(F.coalesce(a, b), lambda x: x.bitwiseAND(F.lit(_MASK)).cast("int"))
        return F.when(a.isNotNull() & b.isNotNull(), pair).otherwise(alone)

    return sides.select(*keys, merged(F.col("a0"), F.col("a2")).alias("first"), merged(F.col("a1"), F.col("a2")).alias("second"))


def as_text(samples: Column) -> Column:
    """Seven hexadecimal digits per sample; empty without words."""
    each = F.transform(samples, lambda x: F.lpad(F.lower(F.hex(x)), 7, "0"))
    return F.coalesce(F.array_join(each, ""), F.lit(""))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal samples, the estimate of the generalised Jaccard similarity."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda e: e))
    return F.when(a.isNull() | b.isNull(), (a.isNull() & b.isNull()).cast("double")).otherwise(same / F.lit(float(SAMPLES)))


def neighbours(documents: DataFrame) -> DataFrame:
    """(i, h, n, ni, nh): each document (key i, h; n characters) with the key of the next
    by descending i, of the first for the last."""
    order = [F.desc("missing_last"), F.desc("i"), F.desc("h")]
    ranged = written(documents.withColumn("missing_last", F.col("i") != F.lit(-(1 << 63))).repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "fingerprint-order")
    inside = Window.partitionBy("part").orderBy(*order)
    near = ranged.withColumn("next", F.lead(F.struct("i", "h")).over(inside)).withColumn("rn", F.row_number().over(inside))
    first = near.where("rn = 1").select("part", F.struct("i", "h").alias("head"))  # one row per range
    around = Window.orderBy("part")
    whole = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = first.select("part", F.coalesce(F.lead("head").over(around), F.first("head").over(whole)).alias("after"))
    return near.join(heads, "part").select("i", "h", "n", F.coalesce("next", "after").alias("next")).select("i", "h", "n", F.col("next.i").alias("ni"), F.col("next.h").alias("nh"))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next): one row per row of ``docs``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    src = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"))
    src = src.select("id", F.coalesce("id", F.lit(-(1 << 63))).alias("i"), F.xxhash64(F.col("id").isNull(), "text").alias("h"), "text")
    documents = written(src.groupBy("id", *_KEY, F.length("text").cast("long").alias("n")).agg(F.count("*").alias("copies")), "fingerprint-documents")
    links = written(neighbours(documents.select(*_KEY, "n")), "fingerprint-links")

    texts = src.groupBy(*_KEY).agg(F.first("text").alias("text"))
    asked = links.select(F.col("ni").alias("i"), F.col("nh").alias("h"), F.col("i").alias("pi"), F.col("h").alias("ph"), F.floor(F.col("n") / 2).cast("int").alias("need"))
    heads = texts.join(asked, _KEY).select(F.col("pi").alias("i"), F.col("ph").alias("h"), "need", F.substring(F.col("text"), F.lit(1), F.col("need")).alias("head"))
    both = texts.join(heads, _KEY)
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.length("text") - F.col("need")), F.col("head"))
    pairs = both.select(*_KEY, "text", edited.alias("edited")).withColumn("sha", F.unhex(F.sha2("edited", 256)))
    prints = written(fingerprint_pairs(pairs, [*_KEY, "sha"], "text", "edited"), "fingerprint-samples")

    own = prints.select(*_KEY, "sha", F.col("first").alias("own"), F.col("second").alias("changed"))
    following = prints.select(F.col("i").alias("ni"), F.col("h").alias("nh"), F.col("first").alias("following"))
    return (
        documents.join(links.select(*_KEY, "ni", "nh"), _KEY)
        .join(own, _KEY)
        .join(following, ["ni", "nh"])
        .select(
            F.col("id").alias(id_col),
            F.col("n").alias("n_chars"),
            F.lower(F.hex("sha")).alias("edited_sha256"),
            as_text(F.col("own")).alias("fingerprint"),
            as_text(F.col("changed")).alias("edited_fingerprint"),
            likeness(F.col("own"), F.col("changed")).alias("near_edited"),
            likeness(F.col("own"), F.col("following")).alias("near_next"),
            F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("__copy"),
        )
        .drop("__copy")
    )


@query("op13_document_fingerprints")
def op13_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract columns for every row of documents."""
    return edited_fingerprints(docs_of(spark, sf_dir, "doc_id", "text"))
