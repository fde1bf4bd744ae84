"""Phrase collocations by best-first branch-and-bound growth.

Texts are cut into pieces and words and stored once, as blocks of words of one
language: a block holds its own vocabulary (words and their 64-bit hashes) and the
word numbers, 0 between pieces. Everything after that reads blocks, not texts.

* A phrase grows word by word. Nodes are phrases of 2 to 4 words found at least
  ``MIN_COUNT`` times. For a node q with first word w1, every phrase that starts with
  q has at most f(q) occurrences, so its first cut scores at most
  floor(2000000 * f(q) / (f(w1) + f(q))): the bound of the node, from prefix counts.
* Best first: all words are opened (their pairs counted), then, round by round, the
  nodes whose bound reaches their language's frontier score. Opening a node
  counts all phrases of one word more that start or end with it, which gives both
  its children and the phrases that may contain it: if a longer candidate holds
  at least 80 % of a phrase's occurrences, one with a single word more does, too.
* A score whose parts are not all counted yet stands at its upper bound, and the pair
  in the phrase's middle is opened, which counts them.
* The frontier score is that of the language's 2000th phrase not known to be
  dropped; a round opens the nodes down to the 4000th, the next to the 8000th and so on,
  and the search ends when no unopened node reaches the 2000th, ties included. Then
  every phrase from there up is counted, scored exactly and known to survive.

Nodes to open reach the tasks as bitmaps of a fixed size; a false hit only counts
a phrase too many, always with its full count. Counts are summed in the blocks, then
by Spark, per (language, words). Two words of a language with one 64-bit hash are
detected, and the texts are then hashed anew with another seed.

Defined results: a null text is empty; a null language is ``und``, together with texts
that say ``und``. Rows that repeat count every time. Further columns are ignored.
Languages with fewer phrases return those they have.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from xxhash import xxh3_64_intdigest

from docflow.llm.common import bitmap_of, docs_of, in_bitmap, mix64, query, written
from docflow.session import scratch_path

MIN_COUNT = 30
TOP = 2000
CONTAINED = 80  # percent of a phrase's occurrences inside a longer candidate
BLOCK_WORDS = 1 << 18
SLICE_BYTES = 1 << 20
SEEDS = 8
PARTS_OF_A_LANGUAGE = 64
_END = b"\xff"  # no byte of UTF-8
_TABLE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz" + _END * 10)
_PARTS = ["w1", "w2", "w3", "w4"]


class _Numbers(dict):
    """Numbers words in the order in which they come."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def slices(text: bytes) -> Iterator[bytes]:
    """The text with A-Z lower-cased and piece ends marked, in slices that end with a piece."""
    t = text.translate(_TABLE)
    lo = 0
    while lo < len(t):
        hi = len(t)
        if hi - lo > SLICE_BYTES:
            hi = t.rfind(_END, lo, lo + SLICE_BYTES) + 1 or t.find(_END, lo + SLICE_BYTES) + 1 or len(t)
        yield t[lo:hi]
        lo = hi


class _Block:
    """Words of one language, not yet written."""

    def __init__(self) -> None:
        self.numbers, self.runs, self.size = _Numbers({_END: 0}), [], 0

    def add(self, piece: bytes) -> None:
        words = piece.replace(_END, b" " + _END + b" ").split()
        words.append(_END)
        self.runs.append(np.fromiter(map(self.numbers.__getitem__, words), dtype=np.int32, count=len(words)))
        self.size += len(words)

    def row(self, lang: str, seed: int, mask: int) -> dict:
        ranks = np.concatenate(self.runs)
        words = list(self.numbers)[1:]
        hashes = np.array([xxh3_64_intdigest(w, seed) & mask for w in words], dtype=np.uint64)
        counts = np.bincount(ranks, minlength=len(words) + 1)[1:]
        return {"lang": lang, "words": words, "hashes": hashes.view(np.int64), "counts": counts, "ranks": ranks.tobytes()}


def word_blocks(docs: DataFrame, lang_col: str, text_col: str, seed: int, bits: int) -> DataFrame:
    """(lang, words, hashes, counts, ranks): blocks of about ``BLOCK_WORDS`` words."""
    mask = (1 << bits) - 1
    types = {"lang": pa.string(), "words": pa.list_(pa.binary()), "hashes": pa.list_(pa.int64()), "counts": pa.list_(pa.int64()), "ranks": pa.binary()}

    def out(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in types.items()], names=list(types))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[str, _Block] = {}
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                for piece in slices(text.as_py() or b""):
                    block = blocks.setdefault(lang, _Block())
                    block.add(piece)
                    if block.size >= BLOCK_WORDS:
                        yield out([blocks.pop(lang).row(lang, seed, mask)])
            while sum(x.size for x in blocks.values()) > 4 * BLOCK_WORDS:  # many languages
                lang = max(blocks, key=lambda k: blocks[k].size)
                yield out([blocks.pop(lang).row(lang, seed, mask)])
        for lang, block in blocks.items():
            yield out([block.row(lang, seed, mask)])

    src = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("binary").alias("text"))
    blocks = src.mapInArrow(run, "lang string, words array<binary>, hashes array<long>, counts array<long>, ranks binary")
    path = scratch_path(docs.sparkSession, "phrase-blocks")
    # small row groups: a task never holds many blocks
    blocks.write.option("compression", "zstd").option("parquet.block.size", str(8 << 20)).option("parquet.block.size.row.check.min", "4").parquet(path)
    return docs.sparkSession.read.schema(blocks.schema).parquet(path)


def word_counts(blocks: DataFrame) -> DataFrame:
    """(lang, w, f, one): count of each word by hash; ``one`` says that the hash stands for one word."""
    each = blocks.select("lang", F.explode(F.arrays_zip("hashes", "counts", "words")).alias("e"))
    check = F.xxhash64("e.words")
    return each.groupBy("lang", F.col("e.hashes").alias("w")).agg(F.sum("e.counts").alias("f"), (F.min(check) == F.max(check)).alias("one"))


def _keys(lang: str, *words: np.ndarray) -> np.ndarray:
    """64-bit keys of phrases given as columns of word hashes."""
    h = np.full(len(words[0]), xxh3_64_intdigest(lang.encode("utf-8"), len(words)), dtype=np.uint64)
    for w in words:
        h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + w.view(np.uint64))
    return h


def phrase_bitmap(phrases: DataFrame, size: int) -> np.ndarray:
    """Bitmap of fixed size over phrases of ``size`` words (lang, w1, ...)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            langs = pd.Categorical(b.column(0).to_pylist())
            words = [b.column(k + 1).to_numpy() for k in range(size)]
            out = np.zeros(b.num_rows, dtype=np.uint64)
            for code, lang in enumerate(langs.categories):
                at = np.flatnonzero(langs.codes == code)
                out[at] = _keys(lang, *(w[at] for w in words))
            yield pa.RecordBatch.from_arrays([pa.array(out.view(np.int64))], names=["key"])

    return bitmap_of(phrases.select("lang", *_PARTS[:size]).mapInArrow(run, "key long"), "key")


class _Windows:
    """Windows of one block: exact numbers for its pairs and triples of words."""

    def __init__(self, lang: str, hashes: np.ndarray, ranks: np.ndarray, words: np.ndarray):
        self.lang, self.r = lang, ranks.astype(np.int64)
        self.h = np.concatenate([np.zeros(1, dtype=np.int64), hashes])
        self.known = np.concatenate([[False], in_bitmap(words, _keys(lang, hashes))])[ranks]

    def number(self, left: np.ndarray, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of (left number, word at the window's end) for windows starting ``at``,
        and for each number the place of a window that has it."""
        key = left * len(self.h) + self.r[at + width - 1]
        codes, _ = pd.factorize(key)
        first = np.zeros(int(codes.max()) + 1 if len(codes) else 0, dtype=np.int64)
        first[codes[::-1]] = at[::-1]
        return codes.astype(np.int64), first

    def words(self, first: np.ndarray, width: int) -> list[np.ndarray]:
        return [self.h[self.r[first + k]] for k in range(width)]

    def member(self, bitmap: np.ndarray, first: np.ndarray, width: int) -> np.ndarray:
        return in_bitmap(bitmap, _keys(self.lang, *self.words(first, width)))

    def counted(self, codes: np.ndarray, first: np.ndarray, width: int) -> pa.RecordBatch:
        n = np.bincount(codes, minlength=len(first))
        some = n > 0
        cols = [w[some] for w in self.words(first, width)]
        arrays = [pa.array([self.lang] * int(some.sum()), pa.string()), *(pa.array(c) for c in cols)]
        arrays += [pa.nulls(int(some.sum()), pa.int64())] * (4 - width) + [pa.array(n[some])]
        return pa.RecordBatch.from_arrays(arrays, names=["lang", *_PARTS, "f"])


def _next(mask: np.ndarray, k: int) -> np.ndarray:
    """mask shifted: place i holds mask[i + k]."""
    return np.concatenate([mask[k:], np.zeros(min(k, len(mask)), dtype=bool)])


def counted_windows(blocks: DataFrame, words: np.ndarray, pairs: np.ndarray | None = None, open2: np.ndarray | None = None, open3: np.ndarray | None = None) -> DataFrame:
    """(lang, w1..w4, f) of phrases found at least ``MIN_COUNT`` times, with full counts:
    all pairs of frequent words, or, given ``pairs`` (frequent pairs), the triples that
    start or end with a pair in ``open2`` and the fours that do with a triple in ``open3``."""
    bitmaps = blocks.sparkSession.sparkContext.broadcast((words, pairs, open2, open3))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, pairs, open2, open3 = bitmaps.value
        for b in batches:
            for lang, hashes, ranks in zip(b.column(0).to_pylist(), b.column(1), b.column(2), strict=True):
                w = _Windows(lang, hashes.values.to_numpy(), np.frombuffer(ranks.as_py(), dtype=np.int32), words)
                at = np.flatnonzero(w.known & _next(w.known, 1))
                codes, first = w.number(w.r[at], at, 2)
                if pairs is None:
                    yield w.counted(codes, first, 2)
                    continue
                good = w.member(pairs, first, 2)
                two, opened = np.zeros(len(w.r), dtype=bool), np.zeros(len(w.r), dtype=bool)
                pair = np.zeros(len(w.r), dtype=np.int64)
                two[at], pair[at] = good[codes], codes
                opened[at] = (good & w.member(open2, first, 2))[codes]
                three = two & _next(two, 1)
                at = np.flatnonzero(three)
                if not len(at):
                    continue
                codes, first = w.number(pair[at], at, 3)
                wanted = (opened | _next(opened, 1))[at]
                yield w.counted(codes[wanted], first, 3)
                triple, opened3 = np.zeros(len(w.r), dtype=np.int64), np.zeros(len(w.r), dtype=bool)
                triple[at], opened3[at] = codes, w.member(open3, first, 3)[codes]
                at = np.flatnonzero(three & _next(two, 2) & (opened3 | _next(opened3, 1)))
                if len(at):
                    codes, first = w.number(triple[at], at, 4)
                    yield w.counted(codes, first, 4)

    rows = blocks.select("lang", "hashes", "ranks").mapInArrow(run, "lang string, w1 long, w2 long, w3 long, w4 long, f long")
    return rows.groupBy("lang", *_PARTS).agg(F.sum("f").alias("f")).where(F.col("f") >= MIN_COUNT)


def _score(a: Column, parts: Column) -> Column:
    """floor(2000000 * a / parts), exact."""
    return F.call_function("div", a.cast("decimal(25,0)") * F.lit(2_000_000).cast("decimal(7,0)"), parts.cast("decimal(20,0)"))


def _least_cut(*cuts: tuple[Column, Column]) -> Column:
    """(s, k, l, r) of the lowest-scoring cut, the first of equal ones."""
    each = [F.struct(_score(F.col("f"), left + right).alias("s"), F.lit(k + 1).alias("k"), left.alias("l"), right.alias("r")) for k, (left, right) in enumerate(cuts)]
    return F.least(*each) if len(each) > 1 else each[0]


def scored(words: DataFrame, g2: DataFrame, g3: DataFrame, g4: DataFrame) -> DataFrame:
    """(lang, w1..w4, size, f, f1, cut, unsure, bound): every known phrase with its least
    cut; parts not counted yet (``unsure``) stand at their lower bound, f, which only
    raises the score."""

    def word(k: str, name: str) -> DataFrame:
        return words.select("lang", F.col("w").alias(k), F.col("f").alias(name))

    def gram(df: DataFrame, ks: list[str], name: str) -> DataFrame:
        return df.select("lang", *[F.col(p).alias(k) for p, k in zip(_PARTS, ks, strict=False)], F.col("f").alias(name))

    f = F.col
    cols = ["lang", *_PARTS]
    two = g2.join(word("w1", "f1"), ["lang", "w1"]).join(word("w2", "f2"), ["lang", "w2"])
    two = two.withColumn("cut", _least_cut((f("f1"), f("f2")))).withColumn("unsure", F.lit(False))
    three = (
        g3.join(word("w1", "f1"), ["lang", "w1"]).join(word("w3", "f3"), ["lang", "w3"])
        .join(gram(g2, ["w1", "w2"], "f12"), ["lang", "w1", "w2"]).join(gram(g2, ["w2", "w3"], "f23"), ["lang", "w2", "w3"])
        .withColumn("cut", _least_cut((f("f1"), f("f23")), (f("f12"), f("f3")))).withColumn("unsure", F.lit(False))
    )
    four = (
        g4.join(word("w1", "f1"), ["lang", "w1"]).join(word("w4", "f4"), ["lang", "w4"])
        .join(gram(g2, ["w1", "w2"], "f12"), ["lang", "w1", "w2"]).join(gram(g2, ["w3", "w4"], "f34"), ["lang", "w3", "w4"])
        .join(gram(g3, ["w1", "w2", "w3"], "f123"), ["lang", "w1", "w2", "w3"], "left").join(gram(g3, ["w2", "w3", "w4"], "f234"), ["lang", "w2", "w3", "w4"], "left")
        .withColumn("cut", _least_cut((f("f1"), F.coalesce("f234", "f")), (f("f12"), f("f34")), (F.coalesce("f123", "f"), f("f4"))))
        .withColumn("unsure", f("f123").isNull() | f("f234").isNull())
    )
    tables = [d.select(*cols, F.lit(n).alias("size"), "f", "f1", "cut", "unsure") for n, d in ((2, two), (3, three), (4, four))]
    return tables[0].unionByName(tables[1]).unionByName(tables[2]).withColumn("bound", _score(f("f"), f("f1") + f("f")))


def without_contained(items: DataFrame, g2: DataFrame, g3: DataFrame, g4: DataFrame) -> DataFrame:
    """The items that no known phrase of one word more holds to ``CONTAINED`` percent."""
    holders = None
    for short, long in ((2, g3), (3, g4)):
        for lo in (0, 1):
            part = long.select("lang", *[F.col(_PARTS[lo + k]).alias(f"x{k + 1}") if k < short else F.lit(None).cast("long").alias(f"x{k + 1}") for k in range(4)], F.col("f").alias("fx"))
            holders = part if holders is None else holders.unionByName(part)
    most = holders.groupBy("lang", "x1", "x2", "x3", "x4").agg(F.max("fx").alias("fx")).withColumnRenamed("lang", "xl")
    f = F.col
    same = (f("lang") == f("xl")) & (f("w1") == f("x1")) & (f("w2") == f("x2")) & f("w3").eqNullSafe(f("x3")) & f("w4").eqNullSafe(f("x4"))
    held = f("fx").cast("decimal(20,0)") * 100 >= f("f").cast("decimal(20,0)") * CONTAINED
    return items.join(most, same & held, "left_anti")


def _frontier(alive: DataFrame, k: int) -> DataFrame:
    """(lang, least): the score of each language's ``k``-th phrase, null where there are
    fewer. Scores are counted first, so a language has at most 1,000,001 rows here."""
    by = Window.partitionBy("lang").orderBy(F.desc("s")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    scores = alive.groupBy("lang", F.col("cut.s").alias("s")).agg(F.count("*").alias("times")).withColumn("sofar", F.sum("times").over(by))
    return scores.groupBy("lang").agg(F.max(F.when(F.col("sofar") >= k, F.col("s"))).alias("least"))


def _first(df: DataFrame, k: int, key: Column, order: list[Column], ties: bool = False) -> DataFrame:
    """Each language's first ``k`` rows, found in ``PARTS_OF_A_LANGUAGE`` parts before
    they meet; with ``ties`` all rows of a part that equal its last one stay."""
    rank = F.rank() if ties else F.row_number()
    part = Window.partitionBy("lang", F.pmod(F.xxhash64(key), F.lit(PARTS_OF_A_LANGUAGE))).orderBy(*order)
    return df.withColumn("__in_part", rank.over(part)).where(F.col("__in_part") <= k).drop("__in_part")


def _to_open(items: DataFrame, least: DataFrame, opened: DataFrame) -> DataFrame:
    """Unopened pairs and triples whose bound reaches the frontier, and the middle
    pairs of phrases of four that reach it with parts not counted yet."""
    near = items.join(least, "lang", "left").where(F.col("bound") >= F.coalesce("least", F.lit(0)))
    middle = near.where((F.col("size") == 4) & F.col("unsure") & (F.col("cut.s") >= F.coalesce("least", F.lit(0)))).select(
        "lang", F.col("w2").alias("w1"), F.col("w3").alias("w2"), F.lit(None).cast("long").alias("w3")
    )
    nodes = near.where("size < 4").select("lang", "w1", "w2", "w3").unionByName(middle).distinct()
    o = opened.select(F.col("lang").alias("ol"), F.col("w1").alias("o1"), F.col("w2").alias("o2"), F.col("w3").alias("o3"))
    same = (F.col("lang") == F.col("ol")) & (F.col("w1") == F.col("o1")) & (F.col("w2") == F.col("o2")) & F.col("w3").eqNullSafe(F.col("o3"))
    return nodes.join(o, same, "left_anti")


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", top: int = TOP, bits: int = 64) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases. ``bits`` of
    the word hashes are used (fewer only to test the detection of equal hashes)."""
    for seed in range(SEEDS):
        blocks = word_blocks(docs, lang_col, text_col, seed, bits)
        counts = written(word_counts(blocks), "phrase-words")
        if counts.where(~F.col("one")).isEmpty():
            break
    else:
        raise RuntimeError("two words share a hash under every seed")
    spark = docs.sparkSession
    total = counts.groupBy("lang").agg(F.sum("f").alias("n"))
    words = written(counts.where(F.col("f") >= MIN_COUNT).select("lang", "w", "f"), "phrase-frequent-words")
    word_map = phrase_bitmap(words.withColumnRenamed("w", "w1"), 1)
    g2 = written(counted_windows(blocks, word_map), "phrase-pairs")
    pair_map = phrase_bitmap(g2, 2)
    g3 = g4 = spark.createDataFrame([], g2.schema)
    opened = spark.createDataFrame([], "lang string, w1 long, w2 long, w3 long")
    width = 2 * top
    while True:
        items = written(scored(words, g2, g3, g4), "phrase-nodes")
        alive = written(without_contained(items, g2, g3, g4), "phrase-alive")
        if _to_open(items, _frontier(alive, top), opened).isEmpty():
            break
        nodes = written(_to_open(items, _frontier(alive, width), opened), "phrase-open")
        found = counted_windows(blocks, word_map, pair_map, phrase_bitmap(nodes.where("w3 is null"), 2), phrase_bitmap(nodes.where("w3 is not null"), 3))
        found = written(found, "phrase-found")
        # a phrase counted in two rounds has the same full count in both
        g3 = written(g3.unionByName(found.where("w4 is null")).distinct(), "phrase-triples")
        g4 = written(g4.unionByName(found.where("w4 is not null")).distinct(), "phrase-fours")
        opened = written(opened.unionByName(nodes), "phrase-opened")
        width *= 2

    best = alive.join(_frontier(alive, top), "lang", "left").where(F.col("cut.s") >= F.coalesce("least", F.lit(0)))
    best = best.drop("least").withColumn("id", F.struct("lang", *_PARTS))
    best = written(_first(best, top, F.col("id"), [F.desc("cut.s"), F.desc("f")], ties=True), "phrase-best")
    each = best.select("id", "lang", F.posexplode(F.array_compact(F.array(*_PARTS))).alias("pos", "w"))
    wanted = each.select("lang", "w").distinct()
    spelled = (
        blocks.select("lang", F.explode(F.arrays_zip("hashes", "words")).alias("e")).select("lang", F.col("e.hashes").alias("w"), F.col("e.words").cast("string").alias("word"))
        .join(wanted, ["lang", "w"], "left_semi").distinct()
    )
    text = each.join(spelled, ["lang", "w"]).groupBy("id").agg(F.array_sort(F.collect_list(F.struct("pos", "word"))).alias("p"))
    named = best.join(text, "id").select("lang", F.array_join(F.col("p.word"), " ").alias("phrase"), F.col("f").alias("a"), "cut")
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    few = _first(named.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.s").alias("score")), top, F.col("phrase"), order)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


_ORACLE = r"""
    WITH pieces AS (
      SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
      FROM documents),
    w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
    grams AS (
      SELECT lang, k, unnest(list_transform(generate_series(1, len(ws) - k + 1), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase
      FROM w, (VALUES (1), (2), (3), (4)) AS s(k) WHERE len(ws) >= k),
    f AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL),
    total AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY 1),
    c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k >= 2 AND f >= 30),
    held AS (
      SELECT DISTINCT c.lang, c.phrase FROM c
      JOIN (SELECT lang, a, unnest([array_to_string(ws[:k - 1], ' '), array_to_string(ws[2:], ' ')]) AS part FROM c) x
        ON x.lang = c.lang AND x.part = c.phrase AND 100 * x.a >= 80 * c.a),
    cuts AS (SELECT lang, phrase, k, a, ws, unnest(generate_series(1, k - 1)) AS cut FROM c),
    scored AS (
      SELECT u.lang, u.phrase, u.a, u.cut, p.f AS l, q.f AS r,
             ((2000000::HUGEINT * u.a) // (p.f + q.f))::BIGINT AS score
      FROM cuts u
      JOIN f p ON p.lang = u.lang AND p.phrase = array_to_string(u.ws[:u.cut], ' ')
      JOIN f q ON q.lang = u.lang AND q.phrase = array_to_string(u.ws[u.cut + 1:], ' ')),
    least_cut AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
    ranked AS (
      SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank
      FROM least_cut s ANTI JOIN held h ON h.lang = s.lang AND h.phrase = s.phrase)
    SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""


@query("op12_phrase_collocations", _ORACLE)
def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract columns over all documents."""
    return collocations(docs_of(spark, sf_dir, "lang", "text"))
