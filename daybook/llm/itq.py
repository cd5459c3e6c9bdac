"""Embedding near-duplicates by iterative quantisation and multi-index tables.

1. Equal vectors are one vertex, so copies are never compared with each other.
2. Iterative quantisation, learned on at most SAMPLE vectors (a documented
   bound; the vectors with the smallest hashes): centred vectors are turned to
   their principal axes, then a rotation is learned that brings them close to
   the corners of the cube, so bits are balanced. Several rotations from
   different starts give CODE_BITS bits each.
3. Every code is cut into blocks, each a table. A vector is stored under its
   block value and looked up under all values within one bit. Bits over all
   codes must agree well enough for the threshold (six standard deviations of
   slack), which leaves few false candidates. Taking off the mean widens the
   angle of a pair when the vectors have a common direction, so the number of
   codes and the slack are measured (``fitted``) on pairs made from the sample
   that stand exactly at the threshold.
4. Candidates are ranked again with the original vectors in double precision;
   pairs with cosine >= the threshold are links.

Retrieval is approximate: ``fitted`` adds codes, then halves the blocks, until
RECALL of the pairs exactly at the threshold are found; closer pairs are found
more surely; tests measure the recall against all pairs. No bucket is capped.
The block width follows the number of vectors by one rule (``plan``), so that
a block value stands for about one vector at any size; the recall does not.

Vectors that are null, empty, zero or hold null or non-finite components link
with nothing. Vectors of different lengths never link. Null ids are kept; rows
repeated in full are rows of their own; an empty table gives an empty result;
columns other than vec_id and embedding play no part, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved
from .components import components

THRESHOLD = 0.9
SAMPLE = 20_000
CODE_BITS = 64
ROUNDS = 30
#: Share of the pairs at the threshold that the tables must find, measured on PAIRS of each kind.
RECALL = 0.95
PAIRS = 2_000
#: Codes are learned up to LEARNED_CODES times the least number, and added up to MORE_CODES times.
LEARNED_CODES, MORE_CODES = 16, 80


def plan(n: int, threshold: float = THRESHOLD) -> tuple[int, int]:
    """(bits of a block, least number of codes) for n vectors: about as many block values as vectors, 2**16 at least."""
    width = min(CODE_BITS // 2, max(16, n.bit_length() - 1))
    return width, _least_codes(width, threshold)


def _least_codes(width: int, threshold: float) -> int:
    p = math.acos(min(1.0, threshold)) / math.pi
    hit = (1 - p) ** width + width * p * (1 - p) ** (width - 1)
    tables = math.ceil(math.log(0.06) / math.log(max(1e-12, 1 - hit))) if hit < 1 else 1
    return max(1, -(-tables // (CODE_BITS // width)))


def rotations(sample: np.ndarray, seed: int = 6) -> Iterator[np.ndarray]:
    """Projections (dims, CODE_BITS) of one code after another, learned on centred vectors (``next``; ``send(0)``: unlearned)."""
    dims = sample.shape[1]
    rng = np.random.default_rng(seed)
    _, axes = np.linalg.eigh(sample.T @ sample + 1e-9 * np.eye(dims))
    k = min(dims, CODE_BITS)
    axes = axes[:, ::-1][:, :k]
    v = sample @ axes
    rounds = None
    while True:
        out = np.zeros((dims, CODE_BITS))
        for low in range(0, CODE_BITS, k):
            r, _ = np.linalg.qr(rng.standard_normal((k, k)))
            for _ in range(ROUNDS if rounds is None else rounds):
                left, _, right = np.linalg.svd(np.where(v @ r >= 0, 1.0, -1.0).T @ v)
                r = (left @ right).T
            out[:, low:low + k] = (axes @ r)[:, :CODE_BITS - low]
        rounds = yield out


def learn(sample: np.ndarray, codes: int, seed: int = 6) -> tuple[np.ndarray, np.ndarray]:
    """Mean and projections (codes, dims, CODE_BITS) by iterative quantisation of unit vectors."""
    mean = sample.mean(0) if len(sample) else np.zeros(sample.shape[1])
    return mean, np.stack([w for w, _ in zip(rotations(sample - mean, seed), range(codes))])


def threshold_pairs(sample: np.ndarray, threshold: float, seed: int = 7) -> list[tuple[np.ndarray, np.ndarray]]:
    """Unit vectors of the sample and others at the threshold's cosine to them.

    Two kinds: away in any direction, and along the differences between sample vectors.
    """
    rng = np.random.default_rng(seed)
    a = sample[rng.integers(0, len(sample), PAIRS)]
    others = sample[rng.integers(0, len(sample), PAIRS)] - sample[rng.integers(0, len(sample), PAIRS)]
    out = []
    for g in (rng.standard_normal(a.shape), others):
        g = g - (g * a).sum(1, keepdims=True) * a
        norm = np.linalg.norm(g, axis=1)
        x, g = a[norm > 1e-6], g[norm > 1e-6] / norm[norm > 1e-6, None]
        out.append((x, threshold * x + math.sqrt(max(0.0, 1 - threshold * threshold)) * g))
    return [pair for pair in out if len(pair[0])]


def disagreement(pair: tuple[np.ndarray, np.ndarray], mean: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Whether each bit of one code differs: (pairs, CODE_BITS)."""
    a, b = ((x - mean) @ axes >= 0 for x in pair)
    return a != b


def hits(differ: np.ndarray, width: int) -> np.ndarray:
    """Whether each pair meets in a table of the code: some block with at most one differing bit."""
    n = CODE_BITS // width
    return (differ[:, :n * width].reshape(len(differ), n, width).sum(2) <= 1).any(1)


def fitted(sample: np.ndarray, width: int, threshold: float = THRESHOLD) -> tuple[int, np.ndarray, np.ndarray, int]:
    """Bits of a block, mean, projections of as many codes as find RECALL of the threshold pairs, and bits of slack.

    The pairs are of every fifth sample vector, from which nothing is learned:
    bits fit the vectors they are learned from better than others.
    Rotations learned from few dimensions may be alike, and then more of them
    find nothing more; unlearned ones, which differ, follow them. If MORE_CODES
    times the least number of codes do not find enough, blocks are halved; a
    block of one bit holds every pair, so RECALL is reached in any case.
    """
    apart = np.arange(len(sample)) % 5 == 4 if len(sample) >= 50 else np.zeros(len(sample), bool)
    pairs = threshold_pairs(sample[apart] if apart.any() else sample, threshold) if len(sample) else []
    sample = sample[~apart]
    mean = sample.mean(0) if len(sample) else np.zeros(sample.shape[1])
    while True:
        least = _least_codes(width, threshold)
        found, total = [np.zeros(len(x), bool) for x, _ in pairs], [np.zeros(len(x), np.int64) for x, _ in pairs]
        more, axes = rotations(sample - mean), []
        recall = 0.0
        while len(axes) < least or recall < RECALL and len(axes) < MORE_CODES * least:
            axes.append(more.send(0) if len(axes) >= LEARNED_CODES * least else next(more))
            for k, pair in enumerate(pairs):
                differ = disagreement(pair, mean, axes[-1])
                found[k] |= hits(differ, width)
                total[k] += differ.sum(1)
            recall = min((f.mean() for f in found), default=1.0)
        if recall >= RECALL or width == 1:
            break
        width //= 2
    slack = max((max(int(t.max()), math.ceil(t.mean() + 6 * t.std())) for t in total), default=CODE_BITS * len(axes))
    return width, mean, np.stack(axes), min(slack, CODE_BITS * len(axes))


def _vectors(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of a list column without nulls as unit vectors."""
    flat = np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, dims)
    return flat / np.linalg.norm(flat, axis=1, keepdims=True)


def _valid() -> F.Column:
    return F.coalesce((F.size("embedding") > 0)
                      & ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
                      & F.exists("embedding", lambda x: x != 0), F.lit(False))


def _links(reps: DataFrame, dims: int, threshold: float) -> DataFrame:
    """(a, b) for linked reps of one length."""
    spark = reps.sparkSession
    n = reps.count()
    width, _ = plan(n, threshold)
    bound = max(256, min(SAMPLE, (16 << 20) // dims))
    share = min(1.0, bound / max(1, n))
    rows = reps.filter(F.pmod(F.xxhash64("embedding", F.lit(6)), F.lit(1 << 30)) <= int(share * (1 << 30))).select(
        "embedding").toArrow().column(0).combine_chunks()
    width, mean, axes, slack = fitted(_vectors(rows, dims), width, threshold)
    codes = len(axes)
    shared = spark.sparkContext.broadcast((mean, axes))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean, axes = shared.value
        for batch in batches:
            x = _vectors(batch.column(1), dims) - mean
            words = [np.packbits(x @ w >= 0, axis=1, bitorder="little").view("<i8").ravel() for w in axes]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.FixedSizeListArray.from_arrays(
                    pa.array(np.stack(words, 1).ravel()), len(words)).cast(pa.list_(pa.int64()))], ["rep", "code"])

    coded = saved(reps.select("rep", "embedding").mapInArrow(encode, "rep long, code array<long>"), "itq-codes")
    value = F.explode(F.expr(
        f"flatten(transform(code, (c, i) -> transform(sequence(0, {CODE_BITS // width - 1}), "
        f"j -> named_struct('t', i * {CODE_BITS // width} + j, "
        f"'key', shiftrightunsigned(c, j * {width}) & {(1 << width) - 1}L))))"))
    homes = coded.select("rep", "code", value.alias("v")).select("rep", "code", "v.t", "v.key")
    flips = "array(" + ",".join(["0L", *(f"{1 << k}L" for k in range(width))]) + ")"
    probes = homes.select("rep", "code", "t", "key", F.explode(F.expr(flips)).alias("flip")).select(
        "rep", "code", "t", F.expr("key ^ flip").alias("key"))
    differ = " + ".join(f"bit_count(h.code[{c}] ^ p.code[{c}])" for c in range(codes))
    # the planner's size estimate of a side does not know of the explode: never broadcast one
    near = homes.alias("h").join(probes.alias("p").hint("merge"), ["t", "key"]).filter(
        f"h.rep < p.rep AND {differ} <= {slack}").select(F.col("h.rep").alias("a"), F.col("p.rep").alias("b")).distinct()
    left, right = (reps.select(F.col("rep").alias(c), F.col("embedding").alias(e)) for c, e in (("a", "x"), ("b", "y")))
    pairs = near.join(left, "a").join(right, "b").select("a", "b", "x", "y")

    def rerank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cosine = (_vectors(batch.column(2), dims) * _vectors(batch.column(3), dims)).sum(1)
            yield batch.select(["a", "b"]).filter(pa.array(cosine >= threshold))

    return pairs.mapInArrow(rerank, "a long, b long")


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id and kept of each row of (vec_id, embedding).

    Rows of one vec_id are rows of their own; component_id is the smallest
    vec_id reachable, null only if none in the component has an id.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding"))
    good = rows.filter(_valid()).withColumn("h", F.xxhash64("embedding"))
    reps = saved(good.groupBy("h", "embedding").agg(F.count("*").alias("n"), F.min("vec_id").alias("first_id"))
                 .withColumn("rep", F.monotonically_increasing_id()), "itq-reps")
    dims = [r[0] for r in reps.groupBy(F.size("embedding").alias("d")).count().collect()]  # a row per vector length
    found = [_links(reps.filter(F.size("embedding") == d), d, threshold) for d in sorted(dims)]
    links = saved(reduce(DataFrame.union, found), "itq-links") if found else vectors.sparkSession.createDataFrame(
        [], "a long, b long")
    both = links.union(links.select("b", "a"))
    counts = both.join(reps.select(F.col("rep").alias("b"), "n"), "b").groupBy("a").agg(F.sum("n").alias("others"))
    groups = components(links)
    named = reps.join(groups.withColumnRenamed("node", "rep"), "rep", "left").join(
        counts.withColumnRenamed("a", "rep"), "rep", "left").select(
        "h", "embedding", "first_id", F.coalesce("component", "rep").alias("component"),
        (F.col("n") - 1 + F.coalesce("others", F.lit(0))).cast("long").alias("n_links"))
    named = saved(named, "itq-groups")
    ids = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    linked = good.join(named.join(ids, "component").select("h", "embedding", "n_links", "component_id"),
                       ["h", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = rows.filter(~_valid()).select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                          F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
