"""Hard negatives by a secondary-sort shuffle of packed pair scores.

Every anchor is scored against all rows. A pair's score travels as one packed
key (anchor, descending score, kind, id): 25 bytes whose byte order is the sort
order. ``repartitionAndSortWithinPartitions`` deals the keys out by anchor and
sorts them on the way, and one iterator walks each partition: a positive opens
its window of scores, the negatives that follow fall into the open windows, and
a window closes when it is full or the scores have left it. The iterator holds
an anchor's open windows (``n_positives`` at most), never an anchor's rows.

Two such passes are made for each block of anchors: the first finds the
positives (no window is known before them), the second the negatives. Before
the shuffle each task reduces what it read to what may still be wanted: the
first ``n_positives`` rows of an anchor's label, the first ``n_negatives`` rows
of each window. The first of all rows are among the first of the tasks, so
nothing is lost, and an anchor's keys number (rows / TASK_ROWS) x 20 at most,
whatever its label's or its copies' share of the table.

Anchors are a query set that grows with the table. They are dealt into blocks
of about BLOCK_BYTES by a hash of vec_id, one block after another is broadcast,
and its results are written to the shared folder, so what the driver and a task
hold does not grow.

Scores are exact: components become floor(scale x), inner products are taken in
double precision where that is exact (norms' product below 2^53) and in 64-bit
integers elsewhere.

Defined results:
- Rows with a null id, label or vector, a null or non-finite component, or a
  scaled vector whose squared norm reaches 2^62 (its scores might not fit a
  long) take no part. Vectors of different lengths have no score together; two
  empty vectors have score 0.
- An anchor's other rows are those with other ids. Rows that repeat an id and
  their score with the anchor count once. Anchors that repeat in full are one
  anchor; anchors that share an id and differ are mined apart.
- Equal scores: smaller id first. A positive score below 0 has no window, as its
  bounds cross; a score of 0 takes negatives of score 0.
- An empty table, or one without anchors, gives no rows. Other columns of the
  table are not read, whatever their names.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.rdd import portable_hash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved

SCALE = 256
#: Bytes of anchors (8 a component) that are broadcast at a time.
BLOCK_BYTES = 8 << 20
#: Rows that a task reads at least, so that tasks, and keys per anchor, do not depend on how the table is cut.
TASK_ROWS = 4096
#: Scores held at a time.
_CELLS = 1 << 20
#: The first slice of a task's rows; later ones meet the thresholds it set.
_FIRST_ROWS = 32
_POSITIVE, _NEGATIVE = 0, 1
_KEY = np.dtype([("anchor", ">u8"), ("score", ">u8"), ("kind", "u1"), ("id", ">u8")])
_UNPACK = struct.Struct(">QQBQ").unpack
_SIGN = 1 << 63
_LEAST = np.iinfo(np.int64).min

_OUT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


@dataclass(frozen=True)
class Mining:
    """``low`` <= 100 x negative score / positive score <= ``high``; firsts kept of each kind."""

    n_positives: int = 5
    n_negatives: int = 3
    low: int = 50
    high: int = 95

    def window(self, positive: int) -> tuple[int, int]:
        """Least and greatest negative score of a positive score, both included."""
        return -(-self.low * positive // 100), self.high * positive // 100


def packed(anchor: np.ndarray, score: np.ndarray, kind: int, ids: np.ndarray) -> np.ndarray:
    """Keys in byte order of anchor, descending score, kind (positives first) and id."""
    out = np.empty(len(score), _KEY)
    out["anchor"] = anchor
    out["score"] = ~(score.astype(np.int64).view(np.uint64) ^ np.uint64(_SIGN))
    out["kind"] = kind
    out["id"] = ids.astype(np.int64).view(np.uint64) ^ np.uint64(_SIGN)
    return out


def unpacked(key: bytes) -> tuple[int, int, int, int]:
    """anchor, score, kind and id of a key."""
    anchor, score, kind, row = _UNPACK(key)
    return anchor, (~score & (2 * _SIGN - 1)) - _SIGN, kind, row - _SIGN


def vectors(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """ids, labels and scaled vectors (float64, whole numbers) of a batch's usable rows, by vector length."""
    ids, labels, lists = batch.column(0), batch.column(1), batch.column(2)
    usable = ~(np.asarray(ids.is_null()) | np.asarray(labels.is_null()) | np.asarray(lists.is_null()))
    n = np.asarray(lists.value_lengths().fill_null(0))
    flat = lists.flatten().cast(pa.float64())
    x = np.floor(SCALE * flat.fill_null(np.nan).to_numpy(zero_copy_only=False))
    ends = np.cumsum(n)
    ids, labels = (c.fill_null(0).to_numpy(zero_copy_only=False) for c in (ids, labels))
    for d in np.unique(n[usable]):
        rows = np.flatnonzero(usable & (n == d))
        part = x[(ends[rows] - d)[:, None] + np.arange(d)]
        with np.errstate(over="ignore", invalid="ignore"):
            fits = np.isfinite(part).all(1) & ((part * part).sum(1) < 2.0 ** 62)
        if fits.any():
            yield ids[rows[fits]], labels[rows[fits]], part[fits]


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole-number vectors whose squared norms are below 2^62."""
    norms = (np.sqrt((m * m).sum(1).max(initial=0.0)) for m in (a, b))
    if np.prod([*norms]) < 2.0 ** 52:
        return (a @ b.T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


class Firsts:
    """The first k (score descending, id ascending) of each slot, over slices of rows that come one after another."""

    def __init__(self, slots: int, k: int):
        self.slots, self.k = slots, k
        self.slot = np.zeros(0, np.int64)
        self.score = np.zeros(0, np.int64)
        self.id = np.zeros(0, np.int64)
        self.last_score = np.full(slots, _LEAST)
        self.last_id = np.full(slots, np.iinfo(np.int64).max)

    def offer(self, slots: np.ndarray, score: np.ndarray, ids: np.ndarray, allowed: np.ndarray) -> None:
        """A matrix of scores, one line per slot in ``slots``, one column per row id."""
        last = self.last_score[slots][:, None]
        better = (score > last) | ((score == last) & (ids[None, :] < self.last_id[slots][:, None]))
        line, column = np.nonzero(better & allowed)
        if not len(line):
            return
        slot = np.concatenate([self.slot, slots[line]])
        value = np.concatenate([self.score, score[line, column]])
        row = np.concatenate([self.id, ids[column]])
        order = np.lexsort((row, ~value, slot))
        slot, value, row = slot[order], value[order], row[order]
        new = np.r_[True, (slot[1:] != slot[:-1]) | (value[1:] != value[:-1]) | (row[1:] != row[:-1])]
        slot, value, row = slot[new], value[new], row[new]
        begin = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]])
        place = np.arange(len(slot)) - np.repeat(begin, np.diff(np.r_[begin, len(slot)]))
        full = place == self.k - 1
        self.last_score[slot[full]], self.last_id[slot[full]] = value[full], row[full]
        first = place < self.k
        self.slot, self.score, self.id = slot[first], value[first], row[first]


@dataclass
class Anchors:
    """A block's anchors of one vector length; ``no`` are their numbers in the block."""

    no: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    x: np.ndarray


def _scored(batches: Iterator[pa.RecordBatch], block: dict[int, Anchors]) -> Iterator[tuple]:
    """Anchors, scores and rows of slices of the batches, _CELLS scores or so at a time."""
    seen: set[int] = set()
    for batch in batches:
        for ids, labels, x in vectors(batch):
            anchors = block.get(x.shape[1])
            if anchors is None:
                continue
            low, step = 0, max(1, _CELLS // len(anchors.ids))
            while low < len(ids):
                size = step if x.shape[1] in seen else min(step, _FIRST_ROWS)
                seen.add(x.shape[1])
                part = slice(low, low + size)
                yield anchors, products(anchors.x, x[part]), ids[part], labels[part]
                low += size


def _keys(anchor: np.ndarray, score: np.ndarray, kind: int, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
    keys = np.unique(packed(anchor, score, kind, ids))
    values = pa.Array.from_buffers(pa.binary(_KEY.itemsize), len(keys), [None, pa.py_buffer(keys.tobytes())])
    yield pa.RecordBatch.from_arrays([values.cast(pa.binary())], ["key"])


def _positives(rows: DataFrame, block, n_anchors: int, rule: Mining) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Firsts(n_anchors, rule.n_positives)
        for a, score, ids, labels in _scored(batches, block.value):
            found.offer(a.no, score, ids, (a.labels[:, None] == labels) & (a.ids[:, None] != ids))
        yield from _keys(found.slot, found.score, _POSITIVE, found.id)

    return rows.mapInArrow(run, "key binary")


def _negatives(rows: DataFrame, block, positives, n_anchors: int, rule: Mining) -> DataFrame:
    """Keys of each task's first negatives of each window; ``positives``: anchor, rank, least and greatest score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, rank, least, greatest = positives.value
        found = Firsts(n_anchors * rule.n_positives, rule.n_negatives)
        low = np.full(n_anchors * rule.n_positives, np.iinfo(np.int64).max)
        high = np.full(n_anchors * rule.n_positives, _LEAST)
        low[anchor * rule.n_positives + rank], high[anchor * rule.n_positives + rank] = least, greatest
        for a, score, ids, labels in _scored(batches, block.value):
            other = (a.labels[:, None] != labels) & (a.ids[:, None] != ids)
            for k in range(rule.n_positives):
                slots = a.no * rule.n_positives + k
                found.offer(slots, score, ids,
                            other & (score >= low[slots][:, None]) & (score <= high[slots][:, None]))
        yield from _keys(found.slot // rule.n_positives, found.score, _NEGATIVE, found.id)

    return rows.mapInArrow(run, "key binary")


def secondary_sorted(keys: DataFrame, walk: Callable[[Iterator[bytes]], Iterator[tuple]], schema: str) -> DataFrame:
    """``walk`` over the packed keys in order, all keys of an anchor in one partition."""
    spark = keys.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = keys.rdd.map(lambda r: (bytes(r[0]), None)).repartitionAndSortWithinPartitions(
        n, lambda key: portable_hash(key[:8]))
    return spark.createDataFrame(dealt.mapPartitions(lambda pairs: walk(k for k, _ in pairs)), schema, verifySchema=False)


def first_positives(keys: Iterator[bytes], rule: Mining) -> Iterator[tuple[int, int, int, int]]:
    """anchor, rank from 0, positive id and score of each anchor's first positives."""
    before, anchor, taken = None, None, 0
    for key in keys:
        if key == before:
            continue
        before, (owner, score, _, row) = key, unpacked(key)
        if owner != anchor:
            anchor, taken = owner, 0
        if taken < rule.n_positives:
            yield anchor, taken, row, score
            taken += 1


def opened_windows(keys: Iterator[bytes], rule: Mining) -> Iterator[tuple[int, int, int, int, int, int]]:
    """anchor, positive id, rank, negative id and both scores; positives open windows, negatives fill them."""
    before, anchor = None, None
    windows: list[list[int]] = []  # positive id and score, least and greatest score, taken
    for key in keys:
        if key == before:
            continue
        before, (owner, score, kind, row) = key, unpacked(key)
        if owner != anchor:
            anchor, windows = owner, []
        if kind == _POSITIVE:
            least, greatest = rule.window(score)
            if least <= greatest:
                windows.append([row, score, least, greatest, 0])
            continue
        windows = [w for w in windows if w[2] <= score and w[4] < rule.n_negatives]
        for w in windows:
            if score <= w[3]:
                w[4] += 1
                yield anchor, w[0], w[4], row, w[1], score


def _block(anchors: DataFrame) -> tuple[dict[int, Anchors], np.ndarray]:
    """Anchors by vector length, numbered, and the vec_id of each number."""
    table = anchors.toArrow()
    found, ids, n = {}, [], 0
    for batch in table.combine_chunks().to_batches():
        for vec, labels, x in vectors(batch):
            order = np.lexsort((*x.T, labels, vec))
            vec, labels, x = vec[order], labels[order], x[order]
            new = np.r_[True, (vec[1:] != vec[:-1]) | (labels[1:] != labels[:-1]) | (x[1:] != x[:-1]).any(1)]
            vec, labels, x = vec[new], labels[new], x[new]
            found[x.shape[1]] = Anchors(np.arange(n, n + len(vec)), vec, labels, x)
            ids.append(vec)
            n += len(vec)
    return found, np.concatenate(ids) if ids else np.zeros(0, np.int64)


def mined(rows: DataFrame, is_anchor, rule: Mining = Mining(), block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Hard negatives of every anchor and positive.

    ``rows`` has vec_id, label and embedding; ``is_anchor`` is a condition on
    them. Returns anchor_id, positive_id, rank (from 1), negative_id,
    positive_score and negative_score.
    """
    spark = rows.sparkSession
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                       F.col("embedding").cast("array<double>").alias("embedding"))
    anchors = rows.filter(is_anchor & F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull())
    size, n_rows = anchors.agg(F.sum(8 * F.size("embedding") + 16)).first()[0] or 0, rows.count()
    blocks = -(-size // block_bytes)
    rows = rows.coalesce(max(1, n_rows // TASK_ROWS))
    done = []
    for b in range(blocks):
        block, ids = _block(anchors.filter(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b))
        if not len(ids):
            continue
        held = spark.sparkContext.broadcast(block)
        positives = saved(secondary_sorted(
            _positives(rows, held, len(ids), rule), lambda keys: first_positives(keys, rule),
            "anchor long, rank int, positive_id long, score long"), "positives")
        table = positives.toArrow()
        anchor, rank, row, score = (table.column(k).to_numpy() for k in range(4))
        bounds = np.array([rule.window(int(s)) for s in score], np.int64).reshape(-1, 2)
        known = spark.sparkContext.broadcast((anchor, rank, bounds[:, 0], bounds[:, 1]))

        def opening(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield from _keys(batch.column(0).to_numpy(), batch.column(2).to_numpy(), _POSITIVE, batch.column(1).to_numpy())

        keys = _negatives(rows, held, known, len(ids), rule).union(
            positives.select("anchor", "positive_id", "score").mapInArrow(opening, "key binary"))
        names = spark.sparkContext.broadcast(ids)

        def walk(found: Iterator[bytes], names=names) -> Iterator[tuple]:
            for anchor, *rest in opened_windows(found, rule):
                yield int(names.value[anchor]), *rest

        done.append(saved(secondary_sorted(keys, walk, _OUT), "negatives"))
        for b_ in (held, known, names):
            b_.unpersist()
    return reduce(DataFrame.unionAll, done) if done else spark.createDataFrame([], _OUT)
