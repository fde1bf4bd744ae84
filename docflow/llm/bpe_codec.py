"""Byte-pair encoding and decoding of whole texts.

Encoding: an Aho-Corasick automaton over the vocabulary finds, for every place
of a word, the longest token that starts there. A backtracking walk takes the
longest token that is compatible with the token before it, else a shorter
prefix token, else steps back; places from which no walk ends are marked, so a
place is tried once. Two neighbours are compatible when merging their joined
string gives exactly these two tokens, which the merge ranks along the right
edge of one and the left edge of the other decide; decisions are kept in a
table. A sequence whose neighbours are all compatible is the merge result.

Decoding: one blob of all token strings with an offset table; the bytes of a
text are gathered in one indexed copy.

Defined results: null counts as empty; empty text has no ids and decodes to the
empty text. Rows are independent, further columns of the input are dropped.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from collections.abc import Iterator
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from docflow.llm.common import bounded_batches, docs_of, query

CACHE_WORDS = 300_000  # encoded words kept by a worker
PAIRS = 1_000_000  # pair decisions kept by a worker
FLUSH_BYTES = 4 << 20  # size of an output batch
_END = 0xE000  # a word's last byte b is the symbol chr(_END + b)
_BIG = 1 << 60
# fixed values: the pre-tokenizer pattern of the vocabulary file; {L}, {N} and
# {S} are Unicode's letters, numbers and white space
_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[{L}]+|[{N}]|[^{S}{L}{N}]+"
_PLAIN = re.compile("[\x00-\u024f\u2010-\u2027]*")


def latin_pattern(pattern: str) -> re.Pattern:
    """``pattern`` for texts of the Latin blocks (``_PLAIN``), whose classes are the
    same in every Unicode version; other texts go through the library's own steps."""

    def members(kind: str) -> str:
        return "".join(f"\\x{c:02x}" if c < 256 else f"\\u{c:04x}" for c in range(0x250) if unicodedata.category(chr(c))[0] == kind)

    return re.compile(pattern.format(L=members("L"), N=members("N"), S="\t-\r \x85\xa0"))


def plain(text: str) -> bool:
    """Does ``text`` keep to the Latin blocks and general punctuation?"""
    return _PLAIN.fullmatch(text) is not None


_WORDS = latin_pattern(_PATTERN)


def byte_symbols() -> dict[int, str]:
    """The printable character that byte-level vocabularies use for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class WordCodec(dict):
    """Tables of one vocabulary file with an end-of-word suffix; as a dict, the
    encoded words seen so far."""

    def __init__(self, path: str):
        super().__init__()
        with open(path, encoding="utf-8") as fh:
            spec = json.load(fh)
        model, self.suffix = spec["model"], spec["model"]["end_of_word_suffix"]
        self.byte_of = {c: b for b, c in byte_symbols().items()}
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_re = re.compile("(" + "|".join(re.escape(s) for s in self.specials) + ")")
        # the library's steps before its model, whose tables stay out of memory
        self.library = Tokenizer.from_str(json.dumps(spec | {"added_tokens": [], "model": model | {"vocab": {}, "merges": []}}))
        symbols = {tok: self._symbols(tok) for tok in model["vocab"]}
        self.id_of = {symbols[tok]: i for tok, i in model["vocab"].items()}
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        ids = model["vocab"]
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.rank[ids[left], ids[right]] = rank
            self.parts.setdefault(ids[left + right], (rank, ids[left], ids[right]))
        self.size = [0] * (max(self.id_of.values()) + 1)
        for s, i in self.id_of.items():
            self.size[i] = len(s)
        self.table: dict[tuple[int, int], bool] = {}
        # tokens that merging can reach
        self.whole = {s: i for s, i in self.id_of.items() if i not in self.parts or self.compatible(*self.parts[i][1:], self.parts[i][0])}
        self.shorter = [-1] * len(self.size)
        self.automaton = ahocorasick.Automaton()
        for s, i in self.whole.items():
            self.shorter[i] = self._shorter(s)
            self.automaton.add_word(s, (i, len(s)))
        self.automaton.make_automaton()

    def _symbols(self, token: str) -> str:
        if token.endswith(self.suffix) and len(token) > len(self.suffix):
            body = token[: -len(self.suffix)]
            return body[:-1] + chr(_END + self.byte_of[body[-1]])
        return token

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """(token, rank of the merge that ends its life) along one edge of ``token``."""
        out, until = [(token, _BIG)], _BIG
        while token in self.parts:
            until, token = self.parts[token][0], self.parts[token][side]
            out.append((token, until))
        return out

    def compatible(self, left: int, right: int, before: int = _BIG) -> bool:
        """No merge of rank under ``before`` joins the two tokens across their border."""
        rights = self._edge(right, 1)
        for a, a_until in self._edge(left, 2):
            for b, b_until in rights:
                rank = self.rank.get((a, b))
                # of equal ranks the leftmost pair merges first
                if rank is not None and rank < before and rank < a_until and rank <= b_until:
                    return False
        return True

    def _shorter(self, s: str) -> int:
        """The longest token that starts ``s`` and is shorter, or -1."""
        for n in range(len(s) - 1, 0, -1):
            if s[:n] in self.whole:
                return self.whole[s[:n]]
        return -1

    def word_ids(self, symbols: str) -> list[int]:
        """Ids of one word, given as symbols."""
        if symbols in self.whole:
            return [self.whole[symbols]]
        n = len(symbols)
        longest = [-1] * (n + 1)
        for end, (token, size) in self.automaton.iter(symbols):
            longest[end + 1 - size] = token  # a later end is a longer match
        out: list[int] = []
        sizes, shorter, table = self.size, self.shorter, self.table
        dead = bytearray(n + 1)
        pos, token = 0, longest[0]
        while pos < n:
            while token >= 0:
                if not dead[pos + sizes[token]]:
                    if not out:
                        break
                    pair = (out[-1], token)
                    ok = table.get(pair)
                    if ok is None:
                        if len(table) >= PAIRS:
                            table.clear()
                        ok = table[pair] = self.compatible(*pair)
                    if ok:
                        break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                pos += sizes[token]
                token = longest[pos]
            else:
                if not out:
                    raise ValueError("a word has no encoding in this vocabulary")
                dead[pos] = 1
                token = out.pop()
                pos -= sizes[token]
        return out

    def __missing__(self, word: str) -> bytes:
        """Ids of a word that isn't in the table of words, as bytes."""
        if word.isascii() and word.isprintable():
            raw = word[:-1] + chr(_END + ord(word[-1]))
        else:
            b = word.encode("utf-8")
            raw = b[:-1].decode("latin-1").translate(_BYTES) + chr(_END + b[-1])
        got = array("I", self.word_ids(raw)).tobytes()
        if len(word) <= 64:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = got
        return got

    def words(self, text: str) -> list[str]:
        """Normalised words of a text without special strings."""
        if plain(text):
            return _WORDS.findall(text.lower())
        pieces = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return [bytes(self.byte_of[c] for c in w).decode("utf-8") for w, _ in pieces]

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids of a text."""
        out = []
        for part in self.special_re.split(text) if "<|" in text else (text,):
            if part in self.specials:
                out.append(np.uint32(self.specials[part]).astype("<u4").tobytes())
            elif part:
                out.extend(map(self.__getitem__, self.words(part)))
        return b"".join(out)


class OffsetTable:
    """All token strings of a vocabulary file in one blob, each followed by a
    space, and where they start."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as fh:
            spec = json.load(fh)
        ids = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec["added_tokens"]}
        parts = [b""] * (max(ids.values()) + 1)
        for token, i in ids.items():
            parts[i] = token.encode("utf-8") + b" "
        self.offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
        self.blob = np.frombuffer(b"".join(parts), dtype=np.uint8)

    def decode(self, ids: bytes) -> bytes:
        """Token strings joined by a space, as UTF-8."""
        i = np.frombuffer(ids, dtype="<u4").astype(np.int64)
        if not len(i):
            return b""
        start, size = self.offsets[i], self.offsets[i + 1] - self.offsets[i]
        shift = np.repeat(start - (np.cumsum(size) - size), size)
        return self.blob[shift + np.arange(len(shift))].tobytes()[:-1]


_BYTES = byte_symbols()


@cache
def codec(path: str) -> WordCodec:
    """The worker's encoder for a vocabulary file."""
    return WordCodec(path)


@cache
def offset_table(path: str) -> OffsetTable:
    """The worker's decoder for a vocabulary file."""
    return OffsetTable(path)


def _batched(rows: Iterator[tuple], names: list[str], types: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    """Record batches of about FLUSH_BYTES from rows whose second value is long."""
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += len(row[1]) + 32
        if size >= FLUSH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types, strict=True)], names=names)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types, strict=True)], names=names)


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and ``ids``: the text's ids as little-endian unsigned 32-bit integers."""
    pairs = docs.select(F.col(id_col).cast("long"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        rows = ((i.as_py(), c.encode(t.as_py())) for b in batches for i, t in zip(b.column(0), b.column(1), strict=True))
        yield from _batched(rows, [id_col, "ids"], [pa.int64(), pa.binary()])

    return pairs.mapInArrow(run, f"`{id_col}` long, ids binary")


def decode_documents(encoded: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """id, ``decoded`` (the text of ``ids``) and ``ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = offset_table(path)
        raws = ((i.as_py(), ids.as_py() or b"") for b in batches for i, ids in zip(b.column(0), b.column(1), strict=True))
        rows = ((i, c.decode(raw).decode("utf-8"), raw) for i, raw in raws)
        yield from _batched(rows, [id_col, "decoded", "ids"], [pa.int64(), pa.string(), pa.binary()])

    return encoded.select(id_col, "ids").mapInArrow(run, f"`{id_col}` long, decoded string, ids binary")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encoding and decoding in one pass: id, ``decoded`` and ``ids``."""
    pairs = docs.select(F.col(id_col).cast("long"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = codec(path), offset_table(path)
        raws = ((i.as_py(), encoder.encode(t.as_py())) for b in batches for i, t in zip(b.column(0), b.column(1), strict=True))
        rows = ((i, decoder.decode(raw).decode("utf-8"), raw) for i, raw in raws)
        yield from _batched(rows, [id_col, "decoded", "ids"], [pa.int64(), pa.string(), pa.binary()])

    return pairs.mapInArrow(run, f"`{id_col}` long, decoded string, ids binary")


@query("op4_bpe_codec")
def op4_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract columns for every row of documents."""
    both = round_trip(docs_of(spark, sf_dir, "doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))
    return both.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
