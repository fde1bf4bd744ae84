"""Near-duplicate passages by compact windows.

The tokens are 5-word shingles. For each of ``HASHES`` hash functions the
Cartesian tree over a document's token hashes gives its compact windows: a node
(l, c, r) stands for every stretch of [l, r) that holds c, all of which have the
minimum at c; nodes narrower than a passage are not built, so there are about
two per passage length. Windows with the same function, minimum and words next
to it form a group. Each member is joined with the group's smallest document
where both windows leave room for a passage (an interval join on the distances
to c), never with all the others; the hits of one document pair are merged over
all functions. A group of more than two, a member of which has no room or no
verified passage with its head, is divided by the stretches of ``LEVELS`` shingles
around the minimum: members with the same 50 words meet in a smaller group all of
whose members have them, whatever shorter documents quote. The texts of such pairs are then compared word by word: equal
runs along the hit alignments, and those that go on from their ends on another
one where words were inserted or left out, are chained over short gaps, and a chain of
``MIN_WORDS`` or more words whose shingles are 0.8 similar is reported; of a
chain that is less similar, the longest parts that are.

Words are the stretches between ASCII white space, A-Z lower-cased.

Defined results: null, empty and short texts have no passages. Repeats inside
one document are not reported. Rows that repeat an id are one document. Null ids are left out.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from docflow.llm.common import bitmap_of, docs_of, in_bitmap, mix64, odd_keys, query, window_hashes, without_shuffles, written

WIDTH = 5
MIN_WORDS = 50
SPAN = MIN_WORDS - WIDTH + 1  # shingles of a passage
HASHES = 4
NEXT_TO = 4  # shingles on either side of a minimum that must agree too
GAP = 12  # words that a chain may skip
# Shingles of the stretches by which a group is divided whose head is not in all
# of its members' passages: a whole passage; and what a passage of 0.8 with
# replaced words always has on one side of them
LEVELS = (SPAN, 20)
_SEEDS = odd_keys(HASHES, 21)


def shingles(text: str | None) -> np.ndarray:
    words = (text or "").encode("utf-8").lower().split()
    tokens = np.fromiter(map(xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    return window_hashes(tokens, WIDTH, seed=9)


def compact_windows(hashes: np.ndarray, span: int) -> np.ndarray:
    """Rows (l, c, r) of the Cartesian tree's nodes of ``span`` or more tokens."""
    out, todo = [], [(0, len(hashes))] if len(hashes) >= span else []
    while todo:
        lo, hi = todo.pop()
        c = lo + int(hashes[lo:hi].argmin())
        out.append((lo, c, hi))
        if c - lo >= span:
            todo.append((lo, c))
        if hi - c > span:
            todo.append((c + 1, hi))
    return np.array(out, dtype=np.int64).reshape(-1, 3)


_WINDOW = "key long, doc long, n int, c int, before int, after int"


def capped_windows(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(c, c - l, r - c), both up to ``span``, of the compact windows of each stretch
    [start, end) of ``hashes``: c is the first minimum of all runs of ``span`` tokens
    that begin between two places, which give its window."""
    n = len(hashes)
    bits = np.uint64(n.bit_length())
    low = np.arange(n, dtype=np.uint64)
    ranked = hashes >> bits << bits | low  # of equal hashes the first is the least
    least, width = ranked, 1
    while 2 * width <= span:
        least, width = np.minimum(least[:-width], least[width:]), 2 * width
    least = np.minimum(least[: n - span + 1], least[span - width :][: n - span + 1])
    first = np.concatenate([[0], np.cumsum(np.maximum(ends - starts - span + 1, 0))])
    begins = np.arange(first[-1]) + np.repeat(starts - first[:-1], np.diff(first))
    if not len(begins):
        return (np.zeros(0, dtype=np.int64),) * 3
    at = (least[begins] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    edge = np.flatnonzero(at[1:] != at[:-1])
    c, i, j = at[np.concatenate([edge, [len(at) - 1]])], begins[np.concatenate([[0], edge + 1])], begins[np.concatenate([edge, [len(at) - 1]])]
    before = c - i
    further = np.flatnonzero(before == span - 1)
    start = starts[np.searchsorted(starts, c[further], side="right") - 1]
    more = (c[further] - span >= start) & (ranked[np.maximum(c[further] - span, 0)] > ranked[c[further]])
    before[further[more]] = span
    return c, before, j + span - c


def _windows_of(docs: list[int], held: list[np.ndarray]) -> list[np.ndarray]:
    """Columns of ``_WINDOW`` for all hash functions of several documents' shingles."""
    sizes = np.array([len(s) for s in held], dtype=np.int64)
    gap = np.zeros(NEXT_TO, dtype=np.uint64)
    s = np.concatenate([gap, *(x for h in held for x in (h, gap))])
    ends = np.cumsum(sizes + NEXT_TO)
    starts = ends - sizes
    around = window_hashes(s, 2 * NEXT_TO + 1, seed=23)
    parts = []
    for k in range(HASHES):
        c, before, after = capped_windows(mix64(s * _SEEDS[k]), starts, ends, SPAN)
        parts.append((around[c - NEXT_TO] ^ _SEEDS[k], c, before, after))
    key, c, before, after = (np.concatenate(x) for x in zip(*parts, strict=True))
    whose = np.searchsorted(starts, c, side="right") - 1
    return [key.view(np.int64), np.array(docs, dtype=np.int64)[whose], *(x.astype(np.int32) for x in (sizes[whose], c - starts[whose], before, after))]


def window_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Compact windows: key, doc, n (its shingles), c, tokens before c, tokens from
    c on (both up to the length of a passage, which is all that matters)."""
    names = [x.split()[0] for x in _WINDOW.split(", ")]
    types = [pa.int64(), pa.int64(), *[pa.int32()] * 4]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, held, size = [], [], 0
            for i, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                s = shingles(t.as_py())
                if len(s) >= SPAN:
                    ids.append(i)
                    held.append(s)
                    size += len(s)
                if size > 20_000:  # whole arrays that stay in the processor's cache
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(_windows_of(ids, held), types, strict=True)], names=names)
                    ids, held, size = [], [], 0
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(_windows_of(ids, held), types, strict=True)], names=names)

    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long"), text_col)
    return rows.mapInArrow(run, _WINDOW)


def shared_windows(windows: DataFrame, name: str) -> DataFrame:
    """Members of the groups of two or more windows, with their number ``size``."""
    shared = written(windows.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), f"shared-{name}")
    bitmap = windows.sparkSession.sparkContext.broadcast(bitmap_of(shared, "key"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(in_bitmap(bitmap.value, b.column(0).to_numpy())))

    return written(windows.mapInArrow(run, _WINDOW).join(shared, "key"), f"{name}-members")


def _room() -> Column:
    """Whether a member's window and its head's leave room for a passage."""
    return F.least("before", "head.before") + F.least("after", "head.after") >= SPAN


def with_heads(members: DataFrame) -> DataFrame:
    """Members with the head of their group, its shortest document (then the
    smallest id), without those of that document."""
    heads = members.groupBy("key").agg(F.min(F.struct("n", "doc", "c", "before", "after")).alias("head"))
    return members.join(heads, "key").where(F.col("doc") != F.col("head.doc"))


def document_pairs(headed: DataFrame) -> DataFrame:
    """(doc, other, shifts, hits): documents and heads of their groups; shifts are
    the distinct differences of their places, hits the distinct (c, c of other, key)
    in groups of more than two."""
    hit = F.when(F.col("size") > 2, F.struct("c", F.col("head.c").alias("oc"), "key"))
    near = headed.where(_room()).select("doc", F.col("head.doc").alias("other"), (F.col("head.c") - F.col("c")).alias("shift"), hit.alias("hit"))
    return near.groupBy("doc", "other").agg(F.sort_array(F.collect_set("shift")).alias("shifts"), F.collect_set("hit").alias("hits"))


def stretch_pairs(parts: DataFrame, pairs: DataFrame, members: DataFrame | None = None) -> DataFrame:
    """(doc, other, shifts, no hits) of the divided groups; those that ``pairs`` has
    with the same shifts are left out. ``members`` are all windows of the ``part``s
    whose stretches are in ``parts``; if none are given, those in ``parts``."""
    heads = parts.groupBy("key").agg(F.min(F.struct("n", "doc", "c", "before", "after")).alias("head"))
    near = parts.join(heads, "key").where(_room()).select("part", F.col("head.doc").alias("other"), F.col("head.c").alias("oc")).distinct()
    near = near.join((members or parts).select("part", "doc", "c").distinct(), "part").where("doc <> other")
    found = near.groupBy("doc", "other").agg(F.sort_array(F.collect_set(F.col("oc") - F.col("c"))).alias("shifts"))
    found = found.join(pairs, ["doc", "other", "shifts"], "left_anti")
    return found.withColumn("hits", F.array().cast(pairs.schema["hits"].dataType))


def _stretches(s: np.ndarray, key: np.ndarray, c: np.ndarray, before: np.ndarray, after: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(key, row): a key for each stretch of ``LEVELS`` shingles that holds the
    minimum of window ``row``, made of the window's key, the stretch and its place."""
    for level in LEVELS:
        hashes = window_hashes(s, level, seed=31)
        k = np.arange(level)
        at = c[:, None] - k
        row, k = np.nonzero((k <= before[:, None]) & (level - k <= after[:, None]) & (at >= 0) & (at < len(hashes)))
        yield mix64(key[row] ^ mix64(hashes[c[row] - k] + (level * SPAN + k).astype(np.uint64))), row


_PART = f"{_WINDOW}, part long"


def _parts_of(s: np.ndarray, key: np.ndarray, c: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """A number for each window, the same for windows of a group that hold the same
    shingles, and so have the same stretches."""
    ends = zip((c - before).tolist(), (c + after).tolist(), strict=True)
    held = np.fromiter((xxh3_64_intdigest(s[lo:hi].tobytes()) for lo, hi in ends), dtype=np.uint64, count=len(c))
    return mix64(key ^ mix64(held + (before * (SPAN + 1) + after).astype(np.uint64)))


def _per_document(members: DataFrame, texts: DataFrame, rows: Callable[..., Iterator[tuple]]) -> DataFrame:
    """Rows of ``_PART``: for the windows of each document what ``rows`` makes of its
    shingles and the windows' columns, (key, row, part) arrays."""
    names = [x.split()[0] for x in _PART.split(", ")]
    types = [pa.int64(), pa.int64(), *[pa.int32()] * 4, pa.int64()]
    per_doc = members.groupBy("doc", "n").agg(F.collect_set(F.struct("key", "c", "before", "after")).alias("w"))
    both = per_doc.join(texts.toDF("doc", "text"), "doc").select("doc", "n", "w", "text")

    def batch(held: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), t) for x, t in zip(zip(*held), types, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            for doc, n, w, text in zip(*b.columns, strict=True):
                s = shingles(text.as_py())
                if len(s) != n.as_py():
                    continue
                key, c, before, after = (w.values.field(f).to_numpy() for f in ("key", "c", "before", "after"))
                # so many windows at a time that long documents take no more memory
                for lo in range(0, len(key), 1000):
                    part = [x[lo : lo + 1000] for x in (key.view(np.uint64), c, before, after)]
                    for sub, at, number in rows(s, *part):
                        held.append((sub.view(np.int64), np.full(len(at), doc.as_py()), np.full(len(at), len(s), np.int32), *(x[at] for x in part[1:]), number.view(np.int64)))
                        size += len(at)
                    if size >= 100_000:
                        yield batch(held)
                        held, size = [], 0
        if held:
            yield batch(held)

    return both.mapInArrow(run, _PART)


def part_table(members: DataFrame, texts: DataFrame) -> DataFrame:
    """The windows with their ``part``: windows of a group that hold the same shingles."""
    return _per_document(members, texts, lambda s, *w: [(w[0], np.arange(len(w[0])), _parts_of(s, *w))])


def part_heads(members: DataFrame) -> DataFrame:
    """One window of each part, that of the shortest document (then the smallest id)."""
    heads = members.groupBy("part").agg(F.min(F.struct("n", "doc", "c", "key", "before", "after")).alias("w"))
    return heads.select(*(f"w.{x.split()[0]}" for x in _WINDOW.split(", ")))


def stretch_table(members: DataFrame, texts: DataFrame) -> DataFrame:
    """Windows of smaller groups, one for each stretch of a member."""

    def rows(s: np.ndarray, *w: np.ndarray) -> Iterator[tuple]:
        number = _parts_of(s, *w)
        return ((sub, at, number[at]) for sub, at in _stretches(s, *w))

    return _per_document(members, texts, rows)


def _parts(sizes: np.ndarray, most: int) -> Iterator[slice]:
    """Slices of rows whose sizes come to about ``most``, one row at least."""
    ends, lo = np.cumsum(sizes), 0
    while lo < len(ends):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + most, side="right")))
        yield slice(lo, hi)
        lo = hi


class _Pairs:
    """Pairs of documents that are compared together. ``held`` are their shingles
    one after the other, pair k has those of [a, a_end) and [b, b_end)."""

    def __init__(self, docs: list[np.ndarray], pairs: list[tuple[int, int]]):
        ends = np.cumsum([len(d) for d in docs], dtype=np.int64)
        starts = np.concatenate([[0], ends])
        # equal shingles have equal numbers
        self.held = pa.array(np.concatenate([*docs, np.zeros(1, dtype=np.uint64)])).dictionary_encode().indices.to_numpy()
        self._last = np.zeros(len(self.held), dtype=np.int32)
        left, right = np.array(pairs, dtype=np.int64).reshape(-1, 2).T
        self.a, self.a_end, self.b, self.b_end = starts[left], ends[left], starts[right], ends[right]

    def similarity(self, i: int, i_end: int, j: int, j_end: int) -> float:
        """Jaccard similarity of the shingles [i, i_end) and [j, j_end)."""
        x, y, last = self.held[i:i_end], self.held[j:j_end], self._last
        place = np.arange(1, max(len(x), len(y)) + 1, dtype=np.int32)
        last[x] = place[: len(x)]
        once = x[last[x] == place[: len(x)]]
        last[x] = 0
        last[y] = place[: len(y)]
        held = last[y]
        inter, others = np.count_nonzero(last[once]), np.count_nonzero(held == place[: len(y)])
        last[y] = 0
        return inter / max(1, len(once) + others - inter)

    def common(self, i: np.ndarray, j: np.ndarray, most: np.ndarray, step: int) -> np.ndarray:
        """How many shingles are equal from each (i, j) on, ``most`` at most."""
        n, todo = np.zeros(len(i), dtype=np.int64), np.flatnonzero(most)
        width = 16
        while len(todo):
            width = max(16, min(2 * width, 500_000 // len(todo)))
            at = n[todo][:, None] + np.arange(width)
            within = at < most[todo][:, None]
            at[~within] = 0
            at *= step
            same = (self.held[i[todo][:, None] + at] == self.held[j[todo][:, None] + at]) & within
            k = same.argmin(axis=1)
            k[same[np.arange(len(todo)), k]] = width
            n[todo] += k
            todo = todo[k == width]
        return n

    def aligned(self, pair: np.ndarray, shift: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """(pair, i, j, n): the maximal equal runs on the alignments ``shift``."""
        lo = np.maximum(0, -shift)
        size = np.maximum(0, np.minimum(self.a_end[pair] - self.a[pair], self.b_end[pair] - self.b[pair] - shift) - lo) + 1
        i, j = self.a[pair] + lo, self.b[pair] + lo + shift
        for part in _parts(size, 500_000):
            end = np.cumsum(size[part])
            start = end - size[part]
            at = np.arange(end[-1])
            x, y = (at + np.repeat(k[part] - start, size[part]) for k in (i, j))
            x[end - 1] = y[end - 1] = 0  # a place between two alignments
            same = np.zeros(len(at) + 1, dtype=bool)
            np.equal(self.held[x], self.held[y], out=same[1:])
            same[end] = False
            edges = np.flatnonzero(same[1:] != same[:-1])
            s, e = edges[::2], edges[1::2]
            row = np.searchsorted(start, s, side="right") - 1
            yield pair[part][row], i[part][row] + s - start[row], j[part][row] + s - start[row], e - s

    def beside(self, pair: np.ndarray, i: np.ndarray, j: np.ndarray, step: int) -> tuple[np.ndarray, ...]:
        """(pair, i, j, n): the longest run on any alignment that begins at most
        ``GAP`` behind each (i, j), or for step -1 ends at most ``GAP`` before it;
        of equally long ones the nearest in the first document."""
        if step > 0:
            left, right = self.a_end[pair] - i, self.b_end[pair] - j
        else:
            left, right = i - self.a[pair] + 1, j - self.b[pair] + 1
        far = np.arange(GAP + 1)
        out = [(np.zeros(0, dtype=np.int64),) * 4]
        for lo in range(0, len(i), 4096):
            part = slice(lo, lo + 4096)
            in_x, in_y = far < left[part][:, None], far < right[part][:, None]
            x = self.held[np.where(in_x, i[part][:, None] + step * far, 0)]
            y = self.held[np.where(in_y, j[part][:, None] + step * far, 0)]
            k, p, q = np.nonzero((x[:, :, None] == y[:, None, :]) & in_x[:, :, None] & in_y[:, None, :])
            first = np.sort(np.unique(k * (2 * GAP + 1) + q - p + GAP, return_index=True)[1])  # on each alignment
            k, p, q = k[first] + lo, p[first], q[first]
            n = self.common(i[k] + step * p, j[k] + step * q, np.minimum(left[k] - p, right[k] - q), step)
            order = np.lexsort((-n, k))
            best = order[np.concatenate([[True], k[order][1:] != k[order][:-1]])[: len(order)]]
            k, p, q, n = k[best], p[best], q[best], n[best]
            back = 0 if step > 0 else n - 1
            out.append((pair[k], i[k] + step * p - back, j[k] + step * q - back, n))
        return tuple(np.concatenate(c) for c in zip(*out, strict=True))

    def runs(self, pair: np.ndarray, shift: np.ndarray) -> np.ndarray:
        """Rows (pair, i, j, n) in order: the equal runs on the alignments ``shift``,
        and those that go on from a run's ends within ``GAP`` on other alignments (a
        word inserted or left out)."""
        found = [np.stack(part, axis=1) for part in self.aligned(pair, shift)]
        new = np.unique(np.concatenate([np.zeros((0, 4), dtype=np.int64), *found]), axis=0)
        seen = set(map(tuple, new.tolist()))
        out = [new]
        while len(new):
            k, i, j, n = new.T
            both = zip(self.beside(k, i + n, j + n, 1), self.beside(k, i - 1, j - 1, -1), strict=True)
            more = set(zip(*(np.concatenate(c).tolist() for c in both), strict=True)) - seen
            seen |= more
            new = np.array(sorted(more), dtype=np.int64).reshape(-1, 4)
            out.append(new)
        runs = np.concatenate(out)
        return runs[np.lexsort(runs.T[::-1])]

    def links(self, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(run, run before it) of one pair where at most ``GAP`` shingles are
        skipped in either document, in order."""
        pair, x, y, n = runs.T
        room = len(self.held) + GAP + 1
        ends = pair * room + x + n
        by_end = np.argsort(ends, kind="stable")
        lo = np.searchsorted(ends[by_end], pair * room + x - GAP)
        size = np.searchsorted(ends[by_end], pair * room + x, side="right") - lo
        out = [(np.zeros(0, dtype=np.int64),) * 2]
        for part in _parts(size, 500_000):
            k = np.repeat(np.arange(part.start, part.stop), size[part])
            first = np.cumsum(size[part]) - size[part]
            before = by_end[np.arange(len(k)) + np.repeat(lo[part] - first, size[part])]
            gap = y[k] - y[before] - n[before]
            near = (gap >= 0) & (gap <= GAP)
            out.append((k[near], before[near]))
        k, before = (np.concatenate(c) for c in zip(*out, strict=True))
        order = np.lexsort((before, k))
        return k[order], before[order]

    def passages(self, a: int, b: int, chains: list[list[tuple[int, int, int]]]) -> list[tuple[int, int, int, int, float]]:
        """The passages of the chains of the documents that begin at ``a`` and ``b``. A chain that is not similar enough is cut into
        its longest similar parts, so that every run of ``SPAN`` shingles is in one."""
        found, todo = [], chains
        while todo:
            part = todo.pop()
            s, os_ = part[0][0], part[0][1]
            e, oe = part[-1][0] + part[-1][2], part[-1][1] + part[-1][2]
            if min(e - s, oe - os_) < SPAN:
                continue
            if len(part) == 1:
                found.append((s, e + WIDTH - 1, os_, oe + WIDTH - 1, 1.0))
                continue
            similarity = self.similarity(a + s, a + e, b + os_, b + oe)
            if similarity >= 0.8:
                found.append((s, e + WIDTH - 1, os_, oe + WIDTH - 1, similarity))
                continue
            i, j = _longest(part)
            if (i, j) == (0, len(part)):  # similar but for repeated shingles: cut at the widest gap
                j = 1 + max(range(len(part) - 1), key=lambda k: part[k + 1][0] + part[k + 1][1] - part[k][0] - part[k][1] - 2 * part[k][2])
            todo += [p for p in (part[:i], part[i:j], part[j:]) if p]
        found.sort(key=lambda f: (f[0], -f[1], f[2], -f[3]))
        if len(found) < 2:
            return found
        _, e, os_, oe, _ = np.array(found).T
        out = []
        for k, f in enumerate(found):
            if not ((e[:k] >= f[1]) & (os_[:k] <= f[2]) & (oe[:k] >= f[3])).any():  # not inside another
                out.append(f)
        return out


def _chains(runs: list[tuple[int, int, int]], links: list[tuple[int, int]]) -> list[list[tuple[int, int, int]]]:
    """Each run in one chain: behind the run of ``links`` (run, run before it) that
    brings most equal shingles for what is skipped, whatever its alignment. Where
    chains part, the one with most equal shingles goes on."""
    equal, behind, best = [n for _, _, n in runs], [None] * len(runs), [0] * len(runs)
    for k, j in links:
        (x, y, n), (i, o, m) = runs[k], runs[j]
        worth = equal[j] - (x - i - m) - (y - o - m)
        if behind[k] is None or worth > best[k]:
            best[k], behind[k], equal[k] = worth, j, n + equal[j]
    out, used = [], set()
    for k in sorted(set(range(len(runs))) - set(behind), key=lambda k: -equal[k]):
        chain = []
        while k is not None and k not in used:
            used.add(k)
            chain.append(runs[k])
            k = behind[k]
        out.append(chain[::-1])
    return out


def _longest(chain: list[tuple[int, int, int]]) -> tuple[int, int]:
    """The runs [i, j) of a chain that are 0.8 similar by their aligned shingles and
    span most. Equal / (all of both - equal) >= 0.8 is a sum over runs and gaps: a
    run adds 0.2 of its length, a gap takes 0.8 of its shingles on both sides."""
    start, at = [0], chain[0]  # in fifths
    for run in chain[1:]:
        start.append(start[-1] + at[2] - 4 * (run[0] + run[1] - at[0] - at[1] - 2 * at[2]))
        at = run
    # the highest end from each run on, last run first
    most = list(accumulate((x + run[2] for x, run in zip(reversed(start), reversed(chain), strict=True)), max))
    last = [len(chain) - 1 - bisect_left(most, x) for x in start]
    i = max(range(len(chain)), key=lambda k: chain[last[k]][0] + chain[last[k]][2] - chain[k][0])
    return i, last[i] + 1


def passages(a: np.ndarray, b: np.ndarray, hits: np.ndarray) -> list[tuple[int, int, int, int, float]]:
    """(start, end, other start, other end, similarity) of the near-equal passages,
    in words, from the shingles of two documents and hits (c, c of the other)."""
    return aligned_passages(a, b, np.unique(hits[:, 1] - hits[:, 0]).tolist())


def aligned_passages(a: np.ndarray, b: np.ndarray, shifts: list[int]) -> list[tuple[int, int, int, int, float]]:
    """``passages`` on the alignments ``shifts``."""
    return passages_of([a, b], [(0, 1)], [np.array(shifts, dtype=np.int64)])[0]


def passages_of(docs: list[np.ndarray], pairs: list[tuple[int, int]], shifts: list[np.ndarray]) -> list[list[tuple[int, int, int, int, float]]]:
    """``aligned_passages`` of many pairs of ``docs``."""
    both = _Pairs(docs, pairs)
    runs = both.runs(np.repeat(np.arange(len(pairs)), [len(x) for x in shifts]), np.concatenate([np.zeros(0, dtype=np.int64), *shifts]))
    ks, befores = both.links(runs)
    # without a run that reaches SPAN, and without links, a pair has no passage
    linked = np.zeros(len(pairs), dtype=bool)
    linked[runs[ks, 0]] = True
    own = np.flatnonzero(linked[runs[:, 0]] | (runs[:, 3] >= SPAN))
    out: list[list[tuple[int, int, int, int, float]]] = [[] for _ in pairs]
    for part in np.split(own, np.flatnonzero(np.diff(runs[own, 0])) + 1) if len(own) else []:
        k = int(runs[part[0], 0])
        at = [(i, j, n) for i, j, n in (runs[part, 1:] - (both.a[k], both.b[k], 0)).tolist()]
        if linked[k]:
            lo, hi = np.searchsorted(ks, (part[0], part[-1] + 1))
            chains = _chains(at, list(zip((ks[lo:hi] - part[0]).tolist(), (befores[lo:hi] - part[0]).tolist(), strict=True)))
        else:
            chains = [[run] for run in at]
        out[k] = both.passages(int(both.a[k]), int(both.b[k]), chains)
    return out


_PASSAGE = "doc_id long, start_word int, end_word int, other_id long, other_start int, other_end int, similarity double"


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Verified pairs of passages: doc_id, its words [start_word, end_word), the
    document with the same passage, its words, and the shingles' similarity."""
    with without_shuffles(docs.sparkSession):
        return _repeated_passages(docs, id_col, text_col)


def _repeated_passages(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    members = shared_windows(written(window_table(docs, id_col, text_col), "compact-windows"), "window")
    headed = written(with_heads(members), "window-heads")
    pairs = written(document_pairs(headed), "passage-pairs")
    # members of larger groups whose head leaves no room for a passage
    apart = written(headed.where(~_room() & (F.col("size") > 2)).select("key").distinct(), "groups-without-room")
    ids = pairs.select(F.col("doc").alias("id")).unionByName(pairs.select(F.col("other").alias("id")))
    ids = ids.unionByName(members.join(apart, "key", "left_semi").select(F.col("doc").alias("id"))).distinct()
    bitmap = docs.sparkSession.sparkContext.broadcast(bitmap_of(ids, "id"))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(in_bitmap(bitmap.value, b.column(0).to_numpy())))

    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    texts = written(rows.mapInArrow(pick, "id long, text string"), "passage-texts")
    first = written(verified(pairs, texts), "verified-passages")
    open_keys = first.where(F.col("open_key").isNotNull()).select(F.col("open_key").alias("key")).unionByName(apart).distinct()
    open_members = written(part_table(members.join(open_keys, "key", "left_semi"), texts), "window-parts")
    parts = written(stretch_table(part_heads(open_members), texts), "stretches")
    second = written(verified(written(stretch_pairs(parts, pairs, open_members), "stretch-pairs"), texts), "verified-stretches")
    return first.unionByName(second).where(F.col("open_key").isNull()).drop("open_key").distinct()


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Passages of the pairs, and rows with the key of each larger group that has a
    member whose hit is in none of them (``open_key``)."""
    # both columns renamed both times: then Spark deals the texts out once for the two joins
    both = pairs.join(texts.toDF("doc", "doc_text"), "doc").join(texts.toDF("other", "other_text"), "other").select("doc", "other", "shifts", "hits", "doc_text", "other_text")
    names = [*(x.split()[0] for x in _PASSAGE.split(", ")), "open_key"]
    types = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.int64()]

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, opened = [], set()
            hits, ends = b.column(3).values, b.column(3).offsets.to_numpy()
            places = [hits.field(f).to_numpy() for f in ("c", "oc", "key")]
            shifts, cuts = b.column(2).values.to_numpy().astype(np.int64), b.column(2).offsets.to_numpy()
            texts = pa.concat_arrays([b.column(4), b.column(5)]).dictionary_encode()
            pairs = list(zip(*texts.indices.to_numpy().reshape(2, -1).tolist(), strict=True))
            all_found = passages_of([shingles(t) for t in texts.dictionary.to_pylist()], pairs, [shifts[lo:hi] for lo, hi in zip(cuts[:-1], cuts[1:], strict=True)])
            for k, (doc, other, found) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), all_found, strict=True)):
                out += [(doc, s, e, other, os_, oe, x, None) for s, e, os_, oe, x in found]
                c, oc, key = (x[ends[k] : ends[k + 1]] for x in places)
                inside = np.zeros(len(c), dtype=bool)
                for s, e, os_, oe, _ in found if len(c) else []:
                    inside |= (s <= c) & (c <= e - WIDTH) & (os_ <= oc) & (oc <= oe - WIDTH)
                opened.update(key[~inside].tolist())
            out += [(*[None] * 7, k) for k in opened]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types, strict=True)], names=names)

    return both.mapInArrow(verify, f"{_PASSAGE}, open_key long")


@query("op9_substring_dedup")
def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated passages of 50 or more words across all documents."""
    return repeated_passages(docs_of(spark, sf_dir, "doc_id", "text"))
