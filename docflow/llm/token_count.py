"""Token counts by byte-pair merging, without building identifiers.

Each word's bytes form a linked list; a heap holds the adjacent pairs that can
merge. The pair of lowest rank (leftmost of equals) merges again and again; the
count is the number of bytes less the number of merges. Counts of words are
kept in a bounded table per worker.

Defined results: null counts as empty (0 tokens). Special strings inside a text
are one token each, as the library does by default. Rows are independent.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator

import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from docflow.llm.bpe_codec import byte_symbols, latin_pattern, plain
from docflow.llm.common import docs_of, query

CACHE_WORDS = 800_000  # counted words kept by a worker
LIMIT = 512
# fixed values: the byte-level pre-tokenizer's pattern
_WORDS = latin_pattern("'s|'t|'re|'ve|'m|'ll|'d| ?[{L}]+| ?[{N}]+| ?[^{S}{L}{N}]+|[{S}]+(?![^{S}])|[{S}]+")


class Counter(dict):
    """word -> number of tokens; unknown words are merged on first use."""

    def __init__(self, path: str):
        super().__init__()
        with open(path, encoding="utf-8") as fh:
            spec = json.load(fh)
        self.specials = [t["content"] for t in spec["added_tokens"]]
        self.special_re = re.compile("|".join(re.escape(s) for s in self.specials))
        self.library = Tokenizer.from_file(path)
        vocab = spec["model"]["vocab"]
        self.first = {b: vocab[c] for b, c in byte_symbols().items()}
        self.from_symbol = {c: b for b, c in byte_symbols().items()}
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merge[vocab[left], vocab[right]] = (rank, vocab[left + right])

    def __missing__(self, word: str) -> int:
        n = self.merged(word.encode("utf-8"))
        if len(word) <= 64:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = n
        return n

    def merged(self, raw: bytes) -> int:
        """Symbols left of ``raw`` when no pair can merge any more."""
        n = len(raw)
        merge, token = self.merge, [self.first[b] for b in raw]
        nxt, prev = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []  # rank and place of a pair as one integer
        for i in range(n - 1):
            m = merge.get((token[i], token[i + 1]))
            if m:
                heap.append(m[0] << 32 | i)
        heapq.heapify(heap)
        left = n
        while heap:
            top = heapq.heappop(heap)
            i = top & 0xFFFFFFFF
            j = nxt[i]
            if j >= n:
                continue
            m = merge.get((token[i], token[j]))
            if m is None or m[0] != top >> 32:
                continue  # one of the two has merged elsewhere
            left -= 1
            made = token[i] = m[1]
            token[j] = -1
            k = nxt[i] = nxt[j]
            if k < n:
                prev[k] = i
                m = merge.get((made, token[k]))
                if m:
                    heapq.heappush(heap, m[0] << 32 | i)
            p = prev[i]
            if p >= 0:
                m = merge.get((token[p], made))
                if m:
                    heapq.heappush(heap, m[0] << 32 | p)
        return left

    def words(self, text: str) -> list[str]:
        if plain(text):
            return _WORDS.findall(text)
        pieces = self.library.pre_tokenizer.pre_tokenize_str(text)
        return [bytes(self.from_symbol[c] for c in w).decode("utf-8") for w, _ in pieces]

    def tokens(self, text: str) -> int:
        parts = self.special_re.split(text) if "<|" in text else (text,)
        return len(parts) - 1 + sum(sum(map(self.__getitem__, self.words(p))) for p in parts if p)


_COUNTERS: dict[str, Counter] = {}


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes (UTF-8) and n_tokens of every text."""
    pairs = docs.select(F.col(id_col).cast("long"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _COUNTERS:
            _COUNTERS[path] = Counter(path)
        counter = _COUNTERS[path]
        for b in batches:
            tokens, sizes = [], []
            for t in b.column(1):
                text = t.as_py()
                tokens.append(counter.tokens(text))
                sizes.append(len(text.encode("utf-8")))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64())], names=[id_col, "n_bytes", "n_tokens"])

    return pairs.mapInArrow(run, f"`{id_col}` long, n_bytes long, n_tokens long")


@query("op8_token_count")
def op8_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract columns for every row of documents."""
    counted = count_tokens(docs_of(spark, sf_dir, "doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > LIMIT)
