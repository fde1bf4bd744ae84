"""Benchmark decontamination by template canonicalisation.

Texts become templates: numbers, units after a number and names (capitalised
words inside a sentence) turn into typed placeholders, other words are
lower-cased. Windows of ``WIDTH`` template tokens are hash-joined with the
windows of the benchmark items. An item counts as leaked into a document when
``COVER`` of its windows occur there, or ``RUN`` windows at one alignment, and
the slots agree: on an alignment each value of the item stands for one value of
the document; the best alignment that agrees counts. So re-parameterised questions are found, and texts that
only share a pattern of placeholders are not.

Two more forms of the windows are matched beside the template, each by the same
rules: capitalised words as names at the start of a sentence too (a changed name
there), and lower-cased words with numbers as the only slots (copies in capitals
or title case).

A window with fewer than ``ANCHORS`` ordinary words keeps its raw values.
Documents are filtered by a bitmap of fixed size before the join.

Defined results: null or empty texts match nothing; an item of fewer than
``WIDTH`` tokens is one window of its own width; an item without tokens is left
out. Rows that repeat an id are one document. Null ids are left out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from docflow.llm.common import bitmap_of, docs_of, in_bitmap, mix64, query, window_hashes, written
from docflow.sources.tables import table

WIDTH, ANCHORS = 5, 2
COVER, RUN = 0.8, 9
FORMS = ("template", "names", "caseless")
CACHE_WORDS = 300_000
_TOKENS = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)*|\d+(?:[.,:/]\d+)*|[.!?:\n]")
_UNITS = set(
    "mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers kilometre kilometres "
    "mg g kg lb lbs oz ton tons gram grams kilogram kilograms pound pounds ounce ounces ml l liter liters litre litres gallon gallons cup cups "
    "s sec secs second seconds min mins minute minutes h hr hrs hour hours day days week weeks month months year years "
    "dollar dollars cent cents euro euros percent degrees degree mph kmh kw kwh w v a hz".split()
)
_WORD, _STOP, _NUMBER, _CAPITAL, _UNIT = range(5)
_SLOTS = {k: np.uint64(xxh3_64_intdigest(f"<{name}>") & ~7) for k, name in ((_NUMBER, "num"), (_UNIT, "unit"), (_CAPITAL, "name"))}

_SLOT_OF = np.array([_SLOTS.get(k, np.uint64(0)) for k in range(5)], dtype=np.uint64)


class _Tokens(dict):
    """token -> 61 bits of its hash and 3 bits of its kind."""

    def __missing__(self, token: str) -> int:
        low = token.lower()
        kind = _WORD
        if token in ".!?:\n":
            kind = _STOP
        elif token[0].isdigit():
            kind = _NUMBER
        elif token != low:
            kind = _CAPITAL
        elif low in _UNITS:
            kind = _UNIT
        packed = (xxh3_64_intdigest(low) & ~7) | kind
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[token] = packed
        return packed


_KNOWN = _Tokens()


class Tokens:
    """The words of several texts in one row of arrays: kind, hash, whether a
    capitalised word starts a sentence, and where each text starts and ends."""

    def __init__(self, texts: list[str | None]):
        found = [_TOKENS.findall(t or "") for t in texts]
        ends = np.cumsum([len(f) for f in found], dtype=np.int64)
        packed = np.fromiter(map(_KNOWN.__getitem__, chain.from_iterable(found)), dtype=np.uint64, count=int(ends[-1]) if len(ends) else 0)
        kind = (packed & np.uint64(7)).astype(np.int8)
        before = np.empty_like(kind)
        before[1:] = kind[:-1]
        begins = np.concatenate([[0], ends[:-1]])
        before[begins[begins < len(kind)]] = _STOP  # each text's own start
        first = (kind == _CAPITAL) & (before == _STOP)
        kind[(kind == _UNIT) & (before != _NUMBER)] = _WORD
        words = kind != _STOP
        kept = np.concatenate([[0], np.cumsum(words)])
        self.kind, self.raw, self.first = kind[words], (packed & ~np.uint64(7))[words], first[words]
        self.starts, self.ends = kept[begins], kept[ends]
        # the words left in a word's text, from it on
        self.left = np.repeat(self.ends, self.ends - self.starts) - np.arange(len(self.kind))


def template(words: Tokens, form: str) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of template tokens, which are slots). In form "names" capitalised words
    are names at the start of a sentence too, in form "caseless" only numbers are slots."""
    if form == "caseless":
        slot = words.kind == _NUMBER
        return np.where(slot, _SLOTS[_NUMBER], words.raw), slot
    slot = words.kind != _WORD
    if form == "template":
        slot &= ~words.first
    return np.where(slot, _SLOT_OF[words.kind], words.raw), slot


def windows(words: Tokens, widths: list[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each form and width (width, window hashes, slot values of the tokens (0:
    no slot), places of the windows that lie in one text); the last two bits of a
    hash are the form's number."""
    plain_hashes: dict[int, np.ndarray] = {}
    for f, form in enumerate(FORMS):
        typed, slot = template(words, form)
        values = np.where(slot, words.raw, np.uint64(0)).view(np.int64)
        ordinary = np.concatenate([[0], np.cumsum(~slot)])
        for width in widths:
            if len(typed) < width:
                continue
            hashes = window_hashes(typed, width)
            plain = np.flatnonzero(ordinary[width:] - ordinary[:-width] < min(ANCHORS, width))
            if len(plain):
                if width not in plain_hashes:
                    plain_hashes[width] = mix64(window_hashes(words.raw, width))
                hashes[plain] = plain_hashes[width][plain]
            places = np.flatnonzero(words.left[: len(hashes)] >= width)
            yield width, mix64(hashes ^ np.uint64(width)) & ~np.uint64(3) | np.uint64(f), values, places


def _slices(b: pa.RecordBatch, chars: int = 1_000_000) -> Iterator[tuple[np.ndarray, list[str | None]]]:
    """(ids, texts) of a batch, in parts of about ``chars`` characters; longer texts alone."""
    ids = b.column(0).to_numpy(zero_copy_only=False)
    lo, texts, size = 0, [], 0
    for k, t in enumerate(b.column(1)):
        texts.append(t.as_py())
        size += len(texts[-1] or "")
        if size >= chars:
            yield ids[lo : k + 1], texts
            lo, texts, size = k + 1, [], 0
    if texts:
        yield ids[lo:], texts


_SCHEMA = "id long, pos int, windows int, h long, slots array<long>"


def _rows(batches: Iterator[pa.RecordBatch], cut) -> Iterator[pa.RecordBatch]:
    """A row per window that ``cut(words)`` gives as (width, hashes, values, places)."""
    names = ["id", "pos", "windows", "h", "slots"]
    _KNOWN.clear()  # a worker keeps the words of one task
    for b in batches:
        for ids, texts in _slices(b):
            words = Tokens(texts)
            text_of = np.repeat(np.arange(len(texts)), words.ends - words.starts)
            for width, hashes, values, places in cut(words):
                for lo in range(0, len(places), 50_000):
                    at = places[lo : lo + 50_000]
                    whose = text_of[at]
                    slots = values[at[:, None] + np.arange(width)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(ids[whose], pa.int64()),
                            pa.array(at - words.starts[whose], pa.int32()),
                            pa.array((words.ends - words.starts)[whose] - width + 1, pa.int32()),
                            pa.array(hashes[at].view(np.int64)),
                            pa.ListArray.from_arrays(np.arange(len(at) + 1, dtype=np.int32) * width, slots.ravel()),
                        ],
                        names=names,
                    )
    _KNOWN.clear()


def _joined(batches: Iterator[pa.RecordBatch], rows: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Fewer, larger batches."""
    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b.num_rows
        if size >= rows:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def item_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Windows of the benchmark items: id, pos, windows (their number), h, slots."""

    def cut(words):
        # an item's own width: WIDTH, or all its words if it has fewer
        own = np.minimum(WIDTH, words.ends - words.starts)
        own = np.repeat(own, words.ends - words.starts)
        for width, hashes, values, places in windows(words, sorted(set(own.tolist()))):
            yield width, hashes, values, places[own[places] == width]

    rows = items.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long"), text_col)
    return rows.mapInArrow(lambda it: _joined(_rows(it, cut)), _SCHEMA)


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", item_col: str = "item_id") -> DataFrame:
    """One row per leaked item of a document: id, item id, n_windows, n_matched,
    longest_run (windows at the best alignment), n_slots, n_changed."""
    known = written(item_windows(items, item_col), "item-windows")
    bitmap = docs.sparkSession.sparkContext.broadcast(bitmap_of(known, "h"))
    # at most WIDTH widths: those of items that are shorter, and WIDTH
    widths = sorted(r[0] for r in known.select(F.size("slots")).distinct().collect())

    def cut(words):
        for width, hashes, values, places in windows(words, widths):
            yield width, hashes, values, places[in_bitmap(bitmap.value, hashes[places])]

    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long"), "text")
    hits = rows.mapInArrow(lambda it: _joined(_rows(it, cut)), _SCHEMA).select("id", F.col("pos").alias("doc_pos"), "h", F.col("slots").alias("doc_slots"))
    pairs = F.filter(
        F.transform(F.arrays_zip(F.col("slots").alias("a"), F.col("doc_slots").alias("b")), lambda s: F.struct(s["a"].alias("a"), s["b"].alias("b"))),
        lambda s: s["a"] != 0,
    )
    lined = (
        hits.join(known.withColumnRenamed("id", "item"), "h")
        .groupBy("id", "item", "windows", F.col("h").bitwiseAND(3).alias("form"), (F.col("doc_pos") - F.col("pos")).alias("shift"))
        .agg(F.collect_set("pos").alias("places"), F.array_distinct(F.flatten(F.collect_set(pairs))).alias("pairs"))
    )
    # the slot test is each alignment's own: a look-alike elsewhere hides no leak
    agrees = F.size("pairs") == F.size(F.array_distinct(F.transform("pairs", lambda s: s["a"])))
    size, shift = F.size("places"), -F.col("shift")
    places = F.collect_list("places"), F.collect_list(F.when(F.col("agrees"), F.col("places")))
    matched = [F.size(F.array_distinct(F.flatten(p))) for p in places]
    per_item = (
        lined.withColumn("agrees", agrees)
        .groupBy("id", "item", "windows", "form")
        .agg(
            F.max_by(F.struct("places", "pairs", "agrees"), F.struct("agrees", size, shift)).alias("best"),
            # all alignments cover the item if the largest agrees, else those that do
            F.when(F.max_by("agrees", F.struct(size, shift)), matched[0]).otherwise(matched[1]).alias("n_matched"),
            F.max(size).alias("largest"),
        )
    )
    slots, run = F.col("best.pairs"), F.size("best.places")
    leaked = F.col("best.agrees") & ((F.col("n_matched") >= COVER * F.col("windows")) | (run >= RUN))
    names = ["n_windows", "n_matched", "longest_run", "n_slots", "n_changed"]
    changed = F.size(F.filter(slots, lambda s: s["a"] != s["b"]))
    columns = (F.col("windows"), F.col("n_matched"), run, F.size(slots), changed)
    leak = F.struct(-F.col("form"), *(c.alias(n) for c, n in zip(columns, names, strict=True)))  # the first form that finds the item
    caseless = F.col("form") == FORMS.index("caseless")
    forms = per_item.groupBy(F.col("id").alias(id_col), F.col("item").alias(item_col)).agg(
        F.max(F.when(leaked & ~caseless, leak)).alias("typed"),
        F.max(F.when(leaked & caseless, leak)).alias("caseless"),
        F.coalesce(F.max(F.when(~caseless, F.col("largest"))), F.lit(0)).alias("largest"),
    )
    # names are no slots without case: where the other forms see more, they decide
    found = F.coalesce("typed", F.when(F.col("caseless.longest_run") >= F.col("largest"), F.col("caseless")))
    return forms.select(id_col, item_col, found.alias("leak")).where("leak is not null").select(id_col, item_col, *(F.col(f"leak.{n}") for n in names))


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` into which no item leaked."""
    bad = contaminated(docs, items).select(F.col("doc_id").alias("__drop")).distinct()
    return docs.join(bad, docs["doc_id"] == bad["__drop"], "left_anti")


@query("op7_decontamination")
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaked items of all documents against the whole benchmark."""
    return contaminated(docs_of(spark, sf_dir, "doc_id", "text"), table(spark, sf_dir, "benchmark").select("item_id", "text"))
