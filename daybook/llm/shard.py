"""Reproducible shuffle and sharding by a Feistel permutation of global row numbers.

Rows get global numbers 0..N-1 in an order that only their contents decide:
hash buckets of (doc_id, text CRC-32), inside a bucket by doc_id, CRC-32 and
size. A bucket's offset comes from the row counts of the buckets before it;
there are at most MAX_BUCKETS of them, so the broadcast offsets stay under a
few MB whatever N is.

The permutation acts on the grid a x b >= N with a = ceil(sqrt N): each round
adds a keyed function of one coordinate to the other (a Feistel network with
addition). Numbers that land at N or above walk on along their cycle until
they are below N. Permuted number p goes to shard p mod n at slot p div n, so
shard sizes differ by one row at most, slots have no gaps, and
``original_number`` computes the row number back from (shard, slot).

Null text has no bytes; null doc_ids come first; rows repeated in full are
interchangeable. An empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh

ROUNDS = 8
_PRIME = (1 << 31) - 1
BUCKET_ROWS = 256
MAX_BUCKETS = 1 << 16


def _keys(seed: int) -> list[int]:
    state, out = seed % _PRIME + 1, []
    for _ in range(ROUNDS):
        state = state * 48271 % _PRIME
        out.append(state)
    return out


def _round(v: np.ndarray, key: int) -> np.ndarray:
    t = (v % _PRIME + key) % _PRIME
    t = (t * t + 40692 * (key % 52774) + t) % _PRIME
    return t * 48271 % _PRIME


def _grid(n: int) -> tuple[int, int]:
    a = math.isqrt(max(n - 1, 0)) + 1
    return a, -(-max(n, 1) // a)


def _once(x: np.ndarray, n: int, seed: int, back: bool) -> np.ndarray:
    a, b = _grid(n)
    left, right = x // b, x % b
    steps = list(enumerate(_keys(seed)))
    sign = -1 if back else 1
    for k, key in reversed(steps) if back else steps:
        if k % 2:
            right = (right + sign * _round(left, key)) % b
        else:
            left = (left + sign * _round(right, key)) % a
    return left * b + right


def permute(x: np.ndarray, n: int, seed: int, back: bool = False) -> np.ndarray:
    """Image (or, with back, origin) of each x in 0..n-1 under the seed's permutation."""
    x = _once(np.asarray(x, np.int64), n, seed, back)
    while (out := x >= n).any():
        x[out] = _once(x[out], n, seed, back)
    return x


def original_number(shard: np.ndarray, slot: np.ndarray, n: int, n_shards: int, seed: int) -> np.ndarray:
    return permute(np.asarray(slot, np.int64) * n_shards + np.asarray(shard), n, seed, back=True)


def _numbered(docs: DataFrame) -> tuple[DataFrame, int]:
    """Columns row, doc_id, size, text_crc32, number; and the number of rows."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"))
    n = docs.count()
    buckets = max(1, min(MAX_BUCKETS, -(-n // BUCKET_ROWS)))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(buckets)).cast("int"))
    ahead = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("bucket").agg(F.count("*").alias("c")).select(
        "bucket", F.coalesce(F.sum("c").over(ahead), F.lit(0)).alias("before"))
    within = Window.partitionBy("bucket").orderBy("doc_id", "text_crc32", "size")
    return rows.withColumn("at", F.row_number().over(within) - 1).join(F.broadcast(offsets), "bucket").select(
        "row", "doc_id", "size", "text_crc32", (F.col("before") + F.col("at")).alias("number")), n


def shard_rows(docs: DataFrame, n_shards: int = 8, seed: int = 20) -> DataFrame:
    """row (struct of all columns of docs), doc_id, size, text_crc32, number, shard and slot."""
    rows, n = _numbered(docs)

    @F.pandas_udf("long")
    def image(number: pd.Series) -> pd.Series:
        return pd.Series(permute(number.to_numpy(), n, seed))

    return rows.withColumn("image", image("number")).select(
        "row", "doc_id", "size", "text_crc32", "number", (F.col("image") % n_shards).cast("int").alias("shard"),
        F.expr(f"image div {int(n_shards)}").alias("slot"))


def sharded(docs: DataFrame, n_shards: int = 8, seed: int = 20) -> DataFrame:
    """docs with shard and slot; columns of docs that have such names keep theirs."""
    out = shard_rows(docs, n_shards, seed)
    return out.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns],
                      F.col("shard").alias(fresh(docs, "shard")), F.col("slot").alias(fresh(docs, "slot")))
