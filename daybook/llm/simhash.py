"""SimHash near-duplicate groups by anchor-point covering.

Fingerprints that differ in at most ``distance`` bits are linked. The 64 bits
are cut into blocks, each with its own block distance; the block distances add
up to distance + 1 - blocks, so two linked fingerprints are within the block
distance in at least one block (if each block differed by one bit more, the
total would exceed the distance).

In each block a linear covering code gives the anchors: the code words of a
Hamming code on the block's first bits, all other bits free. Every block value
is within the covering radius R (1, or 0 without a code) of its home anchor.
A value within t bits of it is within R + t bits of that anchor, so when each
fingerprint is sent to all anchors within R + t, it meets every partner at
the partner's home anchor. Pairs are compared per anchor on all 64 bits, each
from its smaller home side. Nothing is capped.

Inputs: null text and texts without words have fingerprint zero and are linked
like others. Equal fingerprints are one vertex, so copies are never paired up.
A group's id is its smallest doc_id; null doc_ids come last.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words
from .common import fresh, saved, text_key
from .components import components

SHINGLE_WORDS = 4
MAX_DISTANCE = 4
SEED = 42

#: (bits, block distance) of the blocks, by the number of fingerprints they serve.
SMALL_PLAN = ((22, 1), (22, 1), (20, 0))
LARGE_PLAN = ((28, 1), (36, 2))
#: Above this many fingerprints the plan with more anchors is used; both plans find the same pairs.
LARGE_FROM = 1 << 22


def _fingerprints(data: np.ndarray, offsets: np.ndarray, size: int) -> np.ndarray:
    """Fingerprint of each text. Bits of a very long text are counted in pieces."""
    n = len(offsets) - 1
    data = words.lower_ascii(data)
    starts, ends, rows = words.spans(data, offsets, "space")
    out = np.zeros(n, np.uint64)
    if not len(starts):
        return out
    lengths = ends - starts
    at = np.r_[0, np.cumsum(lengths + 1)]  # each word with one space behind it
    joined = np.full(at[-1], 0x20, np.uint8)
    inside = np.repeat(starts - at[:-1], lengths) + (np.arange(lengths.sum()) + np.repeat(np.arange(len(starts)), lengths))
    joined[np.arange(lengths.sum()) + np.repeat(np.arange(len(starts)), lengths)] = data[inside]
    per_row = np.bincount(rows, minlength=n)
    row_first = np.r_[0, np.cumsum(per_row)]
    runs = np.where(per_row > 0, np.maximum(per_row - size + 1, 1), 0)
    first = np.arange(runs.sum()) + np.repeat(row_first[:-1] - np.r_[0, np.cumsum(runs)[:-1]], runs)
    last = np.minimum(first + size, np.repeat(row_first[1:], runs)) - 1
    low, high = at[first].tolist(), (at[last] + lengths[last]).tolist()
    view, digest = memoryview(joined.tobytes()), xxhash.xxh64_intdigest
    owner = np.repeat(np.arange(n), runs)
    ones = np.zeros((n, 64), np.int64)
    step = 1 << 16
    for k in range(0, len(low), step):
        h = np.fromiter((digest(view[a:b], SEED) for a, b in zip(low[k:k + step], high[k:k + step], strict=True)),
                        np.uint64)
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        own = owner[k:k + step]
        cut = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        ones[own[cut]] += np.add.reduceat(bits, cut, axis=0, dtype=np.int32)
    major = 2 * ones > runs[:, None]
    return np.packbits(major, axis=1, bitorder="little").view("<u8").ravel().astype(np.uint64)


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, text_key and fp (the fingerprint's 64 bits as a long) of each row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = words.buffers(batch.column(2))
            fp = np.zeros(batch.num_rows, np.uint64)
            for a, b in words.slices(data, offsets):
                fp[a:b] = _fingerprints(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], shingle_words)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), batch.column(1), pa.array(fp.view(np.int64))],
                ["doc_id", "text_key", "fp"])

    return docs.select(F.col("doc_id").cast("long"), text_key().alias("text_key"), "text").mapInArrow(
        run, "doc_id long, text_key long, fp long")


def code_tables(bits: int, distance: int) -> tuple[list[int], list[int], list[list[int]]]:
    """Parity masks, home error per syndrome, and all errors to anchors per syndrome.

    The code constrains the first 15 bits (Hamming code, radius 1); distance 0
    uses no code. value ^ home[syndrome] is the home anchor; value ^ e for e in
    errors[syndrome] are all anchors within radius + distance.
    """
    if not distance:
        return [], [0], [[0]]
    masks = [sum(1 << (j - 1) for j in range(1, 16) if j >> k & 1) for k in range(4)]

    def syndrome(e: int) -> int:
        return sum(((e & m).bit_count() & 1) << k for k, m in enumerate(masks))

    errors: list[list[int]] = [[] for _ in range(16)]
    for weight in range(distance + 2):
        for at in combinations(range(bits), weight):
            e = sum(1 << i for i in at)
            errors[syndrome(e)].append(e)
    home = [0] + [1 << (s - 1) for s in range(1, 16)]
    return masks, home, errors


def _literal(values: list[int]) -> str:
    return "array(" + ",".join(f"{v}L" for v in values) + ")"


def _block_rows(fps: DataFrame, plan) -> tuple[DataFrame, DataFrame]:
    """Rows (block, anchor, fp) of the homes and of all anchors reached."""
    homes, probes, shift = [], [], 0
    for k, (bits, distance) in enumerate(plan):
        masks, home, errors = code_tables(bits, distance)
        value = f"(shiftrightunsigned(fp, {shift}) & {(1 << bits) - 1}L)"
        syndrome = " + ".join(f"((bit_count({value} & {m}L) & 1) * {1 << i})" for i, m in enumerate(masks)) or "0"
        part = fps.selectExpr("fp", f"{value} AS val", f"{syndrome} AS syn")
        homes.append(part.selectExpr(f"{k} AS block", f"val ^ element_at({_literal(home)}, syn + 1) AS anchor", "fp"))
        table = "array(" + ",".join(_literal(e) for e in errors) + ")"
        probes.append(part.selectExpr("val", "fp", f"explode(element_at({table}, syn + 1)) AS e")
                      .selectExpr(f"{k} AS block", "val ^ e AS anchor", "fp"))
        shift += bits
    out = []
    for parts in (homes, probes):
        rows = parts[0]
        for p in parts[1:]:
            rows = rows.union(p)
        out.append(rows)
    return out[0], out[1]


def links(fps: DataFrame, distance: int = MAX_DISTANCE, plan=None) -> DataFrame:
    """(a, b), a < b: all pairs of different fingerprints within ``distance`` bits."""
    plan = plan or SMALL_PLAN
    if sum(b for b, _ in plan) != 64 or sum(t for _, t in plan) < distance + 1 - len(plan):
        raise ValueError("blocks must hold 64 bits and their distances add up to distance + 1 - blocks")
    homes, probes = _block_rows(fps, plan)
    # the planner's size estimate of a side does not know of the explode: never broadcast one
    return (homes.alias("h").join(probes.alias("p").hint("merge"), ["block", "anchor"])
            .filter(f"h.fp < p.fp AND bit_count(h.fp ^ p.fp) <= {int(distance)}")
            .select(F.col("h.fp").alias("a"), F.col("p.fp").alias("b")).distinct())


def simhash_groups(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, distance: int = MAX_DISTANCE,
                   plan=None) -> DataFrame:
    """doc_id, text_key, fingerprint (hex), fp, component_id of each row of docs.

    docs needs doc_id and text; other columns are not read. component_id is the
    smallest doc_id reachable by links (null only if the group has none).
    """
    rows = saved(fingerprints(docs, shingle_words), "fps")
    least = saved(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fp-ids")
    if plan is None:
        plan = LARGE_PLAN if distance == MAX_DISTANCE and least.count() > LARGE_FROM else SMALL_PLAN
    groups = components(links(least.select("fp"), distance, plan))
    named = least.join(groups.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first_id", F.coalesce("component", "fp").alias("component"))
    named = saved(named, "fp-groups")
    ids = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    by_fp = named.join(ids, "component").select("fp", "component_id")
    return rows.join(by_fp, "fp").select(
        "doc_id", "text_key", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "fp", "component_id")


def keep_one(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, distance: int = MAX_DISTANCE) -> DataFrame:
    """docs with one row of each group: that of the group's smallest doc_id.

    Rows repeated under that doc_id stay once. A group without any doc_id keeps
    one row as well. All columns of docs are kept.
    """
    groups = simhash_groups(docs, shingle_words, distance)
    keep = (groups.withColumn("own", F.coalesce("doc_id", F.lit((1 << 63) - 1)))
            .groupBy("component_id", F.when(F.col("component_id").isNull(), F.col("fp")).alias("alone"))
            .agg(F.min(F.struct("own", "doc_id", "text_key")).alias("k"))
            .select(F.col("k.doc_id").alias("keep_id"), F.col("k.text_key").alias("keep_key")).distinct())
    key = fresh(docs, "_key")
    keyed = docs.withColumn(key, text_key())
    kept = keyed.join(keep, keyed["doc_id"].cast("long").eqNullSafe(keep["keep_id"])
                      & (keyed[key] == keep["keep_key"]), "left_semi")
    return kept.dropDuplicates(["doc_id", key]).select(*[F.col(f"`{c}`") for c in docs.columns])
