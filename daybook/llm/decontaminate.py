"""Benchmark decontamination by SimHash windows of each item's own size.

Words are runs of letters and digits, lower-cased; shingles are five words
(a shorter item is one shingle of all its words and is matched likewise).

1. Windows. A document is read in windows that hold as many shingles as the
   item, one at every start. Every word position of every text is looked up
   among each item's rarest shingles, one of which any similar window holds. For
   the pairs of text and item found so, a
   running count over the positions of shared shingles (each counts as often as
   the item holds it) tells how much of an item the window at each start holds.
   Windows that hold too little for MIN_SIMILARITY are not read further.
2. Candidates. Window and item fingerprints (64-bit SimHash over the window's
   shingles) are matched through a multi-index: the fingerprint is cut into
   BLOCKS blocks, and fingerprints within RADIUS bits differ by at most
   RADIUS // BLOCKS bits in one block, so looking up every block value within
   that many bits finds all of them.
3. Check. The weighted Jaccard similarity of the two shingle multisets
   (sum of minima over sum of maxima of the counts) must be at least MIN_SIMILARITY.

Items reach the tasks in blocks of ITEM_BYTES of text, one pass over the
documents for each block, so the broadcast stays bounded for any benchmark.
Null or wordless texts and items match nothing. Copies of an item each match.
Null ids are kept as they are. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words
from .common import fresh, saved, text_key

SHINGLE_WORDS = 5
MIN_SIMILARITY = 0.8
RADIUS = 19
BLOCKS = 8
#: Bytes of benchmark text broadcast at a time.
ITEM_BYTES = 8 << 20
#: Pairs, or positions of shared shingles, held at a time.
ENTRIES = 1 << 20
_SUMMARY = "doc_id long, text_key long, item_id long, similarity double, first_word long, n_words long"


def _text_shingles(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, shingle hashes, their rows, number of words by row, first word by row) per slice."""
    data, offsets = words.buffers(pc.utf8_lower(pc.fill_null(column.cast(pa.large_string()), "")))
    for a, b in words.slices(data, offsets):
        part, cuts = data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
        starts, ends, rows = words.spans(part, cuts, "alnum")
        hashes = words.word_hashes(part, starts, ends)
        h, first = words.shingles(hashes, rows, SHINGLE_WORDS)
        n = np.bincount(rows, minlength=b - a)
        yield a, h, rows[first], n, np.r_[0, np.cumsum(n)], hashes


def fingerprint(shingles: np.ndarray) -> np.uint64:
    """SimHash of a multiset of shingle hashes: a bit is set if it is in over half of them."""
    bits = np.unpackbits(shingles.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(2 * bits.sum(0, dtype=np.int64) > len(shingles), bitorder="little").view("<u8")[0]


class MultiIndex:
    """Finds all fingerprints within ``radius`` bits by equal or near blocks."""

    def __init__(self, fps: np.ndarray, radius: int = RADIUS, blocks: int = BLOCKS):
        self.fps, self.radius, self.blocks = fps, radius, blocks
        width = 64 // blocks
        self.mask = np.uint64((1 << width) - 1)
        self.shifts = [np.uint64(k * width) for k in range(blocks)]
        near = range(radius // blocks + 1)
        self.flips = np.array([sum(1 << i for i in at) for w in near for at in combinations(range(width), w)], np.int64)
        self.tables = []
        for shift in self.shifts:
            key = ((fps >> shift) & self.mask).astype(np.int64)
            order = np.argsort(key, kind="stable")
            self.tables.append((order, np.searchsorted(key[order], np.arange((1 << width) + 1))))

    def within(self, fp: np.uint64) -> np.ndarray:
        """Positions of all fingerprints within the radius of fp."""
        found = np.zeros(len(self.fps), bool)
        for shift, (order, cuts) in zip(self.shifts, self.tables, strict=True):
            for key in (int((fp >> shift) & self.mask) ^ self.flips).tolist():
                found[order[cuts[key]:cuts[key + 1]]] = True
        at = np.flatnonzero(found)
        return at[np.bitwise_count(self.fps[at] ^ fp) <= self.radius]


class Items:
    """Distinct items of one block that have a whole shingle, with their shingles and fingerprints.

    A window of similarity MIN_SIMILARITY or more holds at least that share of
    the item's shingles, so it holds one of those left when the most frequent
    ones (over the block's items) that make up less than the share are put
    aside. Only these rarest shingles are looked up in every text; all shingles
    are counted for the pairs of text and item that they find.
    """

    def __init__(self, rows: list[tuple[int, str]], min_words: int = 1):
        known: dict[bytes, int] = {}
        self.ids, self.shingles = [], []
        for a, h, owner, n, _, _ in _text_shingles(pa.array([t for _, t in rows], pa.string())):
            cuts = np.searchsorted(owner, np.arange(len(n) + 1))
            for k in np.flatnonzero(n >= max(SHINGLE_WORDS, min_words)).tolist():
                own = h[cuts[k]:cuts[k + 1]]
                at = known.setdefault(own.tobytes(), len(self.ids))
                if at == len(self.ids):
                    self.ids.append([])
                    self.shingles.append(own)
                self.ids[at].append(rows[a + k][0])
        self.sizes = np.array([len(s) for s in self.shingles], np.int64)
        self.index = MultiIndex(np.array([fingerprint(s) for s in self.shingles], np.uint64))
        self.parts = [np.unique(s, return_counts=True) for s in self.shingles]
        every, inverse, held = np.unique(np.concatenate([k for k, _ in self.parts]) if self.parts else np.zeros(0, np.uint64),
                                         return_inverse=True, return_counts=True)
        held, at = held[inverse], 0
        rare = []
        for size, (keys, times) in zip(self.sizes.tolist(), self.parts, strict=True):
            order = np.lexsort((keys, held[at:at + len(keys)]))
            least = size - int(np.ceil(MIN_SIMILARITY * size - 1e-9)) + 1
            rare.append(keys[order[:int(np.searchsorted(np.cumsum(times[order]), least)) + 1]])
            at += len(keys)
        flat = np.concatenate(rare) if rare else np.zeros(0, np.uint64)
        item = np.repeat(np.arange(len(rare)), [len(k) for k in rare])
        order = np.argsort(flat, kind="stable")
        self.keys, self.item = flat[order], item[order]
        self.bitmap = np.zeros(1 << 22, bool)
        self.bitmap[self.keys >> np.uint64(42)] = True

    def matches(self, h: np.ndarray, rows: np.ndarray):
        """{(row, item): (similarity, first shingle)} of the verified windows, the best of each."""
        best: dict[tuple[int, int], tuple[float, int]] = {}
        for row, items in self._pairs(h, rows):
            low, high = np.searchsorted(rows, [row, row + 1])
            todo = [items]
            while todo:
                part = todo.pop()
                place, item, times = self._shared(h[low:high], part)
                if place is None:  # too many at once
                    todo += [part[:len(part) // 2], part[len(part) // 2:]]
                    continue
                for own, s, e in self._windows(h[low:high], place, item, times):
                    if (row, own) not in best and own in self.index.within(fingerprint(h[low + s:low + e])):
                        sim = similarity(h[low + s:low + e], self.shingles[own])
                        if sim >= MIN_SIMILARITY:
                            best[row, own] = (sim, int(low + s))
        return best

    def _pairs(self, h: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(row, items) with a rare shingle in common, for about ENTRIES pairs at a time."""
        near = np.flatnonzero(self.bitmap[h >> np.uint64(42)])
        order = near[np.lexsort((h[near], rows[near]))]
        row, key = rows[order], h[order]
        new = np.r_[True, (row[1:] != row[:-1]) | (key[1:] != key[:-1])][:len(row)]
        row, key = row[new], key[new]
        low, high = np.searchsorted(self.keys, key, "left"), np.searchsorted(self.keys, key, "right")
        row, low, n = row[high > low], low[high > low], (high - low)[high > low]
        total = np.cumsum(n)
        a = 0
        while a < len(row):
            b = int(np.searchsorted(total, total[a] - n[a] + ENTRIES, "right"))
            if b < len(row):  # whole rows; one row has no more pairs than the block has rare shingles
                b = int(max(np.searchsorted(row, row[b], "left"), np.searchsorted(row, row[a], "right")))
            of, count = row[a:b], n[a:b]
            at = np.repeat(low[a:b], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            pair = np.unique(np.repeat(of, count) * len(self.ids) + self.item[at])
            of, items = pair // len(self.ids), pair % len(self.ids)
            cuts = np.flatnonzero(np.r_[True, of[1:] != of[:-1], True])
            for c, e in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                yield int(of[c]), items[c:e]
            a = b

    def _shared(self, h: np.ndarray, items: np.ndarray):
        """(place, item, times the item holds it) of the shingles that a row shares with items; Nones if over ENTRIES."""
        sizes = [len(self.parts[k][0]) for k in items.tolist()]
        if len(items) > 1 and sum(sizes) > ENTRIES:
            return None, None, None
        keys = np.concatenate([self.parts[k][0] for k in items.tolist()])
        order = np.argsort(keys, kind="stable")
        times = np.concatenate([self.parts[k][1] for k in items.tolist()])[order]
        keys, item = keys[order], np.repeat(items, sizes)[order]
        low, high = np.searchsorted(keys, h, "left"), np.searchsorted(keys, h, "right")
        n = high - low
        if len(items) > 1 and n.sum() > ENTRIES:
            return None, None, None
        at = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return np.repeat(np.arange(len(h)), n), item[at], times[at]

    def _windows(self, h, place, item, times) -> Iterator[tuple[int, int, int]]:
        """(item, start, end) of all windows of a row that hold enough of an item, those that hold most of it first.

        place, item, times: the positions of shared shingles, once for each item, and how often the item holds it.
        """
        if not len(place):
            return
        size = self.sizes[item]
        last = np.maximum(0, len(h) - size)
        # |a & b| >= s |a | b| for windows of this size
        need = np.ceil(MIN_SIMILARITY * (size + np.minimum(size, len(h))) / (1 + MIN_SIMILARITY) - 1e-9)
        enough = np.bincount(item)[item] >= need
        place, item, times, size, last, need = (x[enough] for x in (place, item, times, size, last, need))
        if not len(place):
            return
        # a position adds one to the windows that hold it without the item's whole number of the shingle before it
        order = np.lexsort((place, h[place], item))
        place, item, times, size, last, need = (x[order] for x in (place, item, times, size, last, need))
        before = np.arange(len(place)) - times
        same = (before >= 0) & (item[before] == item) & (h[place[before]] == h[place])
        low = np.maximum(np.maximum(place - size + 1, 0), np.where(same, place[before] + 1, 0))
        high = np.minimum(place, last)
        live = np.flatnonzero(low <= high)
        step = np.repeat([1, -1], len(live))
        start, owner = np.r_[low[live], high[live] + 1], np.r_[live, live]
        order = np.lexsort((start, item[owner]))
        start, owner, held = start[order], owner[order], np.cumsum(step[order])
        stays = np.r_[(np.diff(start) != 0) | (np.diff(item[owner]) != 0), True]
        start, owner, held = start[stays], owner[stays], held[stays]
        good = np.flatnonzero(held >= need[owner])
        for k in good[np.lexsort((start[good], -held[good], item[owner[good]]))].tolist():
            o = owner[k]
            for s in range(int(start[k]), int(start[k + 1])):
                yield int(item[o]), s, int(min(s + size[o], len(h)))


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two shingle multisets."""
    keys, at = np.unique(np.r_[a, b], return_inverse=True)
    x, y = np.bincount(at[:len(a)], minlength=len(keys)), np.bincount(at[len(a):], minlength=len(keys))
    return float(np.minimum(x, y).sum() / np.maximum(x, y).sum())


class ShortItems:
    """Items of fewer words than a shingle: matched as runs of their own number of words."""

    def __init__(self, rows: list[tuple[int, str]], min_words: int = 1):
        self.by_size: dict[int, dict[int, list[int]]] = {}
        for a, _, _, n, first, hashes in _text_shingles(pa.array([t for _, t in rows], pa.string())):
            for k in np.flatnonzero((n >= max(1, min_words)) & (n < SHINGLE_WORDS)).tolist():
                own = hashes[first[k]:first[k + 1]]
                h, _ = words.shingles(own, np.zeros(len(own), np.int64), len(own))
                self.by_size.setdefault(len(own), {}).setdefault(int(h[0]), []).append(rows[a + k][0])

    def matches(self, hashes: np.ndarray, rows: np.ndarray):
        for size, known in self.by_size.items():
            h, first = words.shingles(hashes, rows, size)
            keys = np.array(sorted(known), np.uint64)
            at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
            for k in np.flatnonzero(keys[at] == h).tolist():
                for item in known[int(h[k])]:
                    yield int(rows[first[k]]), item, int(first[k]), size


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    items = saved(benchmark.select(F.col("item_id").cast("long"), "text").filter("text IS NOT NULL"), "items")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // ITEM_BYTES) or 1
    for k in range(n):
        yield [tuple(r) for r in items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect()]


def contamination(docs: DataFrame, benchmark: DataFrame, min_item_words: int = 1) -> DataFrame:
    """doc_id, text_key, item_id, similarity, first_word, n_words: the best window of each document and item.

    Items of fewer than min_item_words words match nothing.
    """
    sc = docs.sparkSession.sparkContext
    passes = []
    for rows in _blocks(benchmark):
        shared = sc.broadcast(rows)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            long_items, short = None, None
            for batch in batches:
                if long_items is None:
                    long_items, short = Items(shared.value, min_item_words), ShortItems(shared.value, min_item_words)
                out = []
                for a, h, rows, _, first, hashes in _text_shingles(batch.column(2)):
                    whole = np.repeat(np.arange(len(first) - 1), np.diff(first))
                    per_row = np.searchsorted(rows, rows, "left")
                    for (row, k), (sim, s) in long_items.matches(h, rows).items():
                        found = sim, int(s - per_row[s]), int(long_items.sizes[k]) + SHINGLE_WORDS - 1
                        out.extend((a + row, item, *found) for item in long_items.ids[k])
                    seen = set()
                    for row, item, at, size in short.matches(hashes, whole):
                        if (row, item) not in seen:
                            seen.add((row, item))
                            out.append((a + row, item, 1.0, at - int(first[row]), size))
                if out:
                    cols = list(zip(*out, strict=True))
                    at = pa.array(cols[0], pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(at), batch.column(1).take(at), pa.array(cols[1], pa.int64()),
                         pa.array(cols[2], pa.float64()), pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int64())],
                        ["doc_id", "text_key", "item_id", "similarity", "first_word", "n_words"])

        passes.append(docs.select(F.col("doc_id").cast("long"), text_key().alias("text_key"), "text")
                      .mapInArrow(run, _SUMMARY))
    return reduce(DataFrame.union, passes)


def without_benchmark(docs: DataFrame, benchmark: DataFrame, min_item_words: int = 1) -> DataFrame:
    """docs without the rows that hold a benchmark item; same columns, whatever their names."""
    hits = saved(contamination(docs, benchmark, min_item_words).select("doc_id", "text_key").distinct()
                 .withColumnsRenamed({"doc_id": "_hit_id", "text_key": "_hit_key"}), "hits")
    key = fresh(docs, "_own_key")
    keyed = docs.withColumn(key, text_key())
    clean = keyed.join(hits, keyed["doc_id"].cast("long").eqNullSafe(hits["_hit_id"])
                       & (keyed[key] == hits["_hit_key"]), "left_anti")
    return clean.select(*[F.col(f"`{c}`") for c in docs.columns])
