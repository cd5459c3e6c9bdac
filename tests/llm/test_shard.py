"""The permutation is one, and the shards are even, whole and reproducible."""

import zlib
from collections import Counter

import numpy as np
import pytest

from daybook.llm import shard


@pytest.mark.parametrize("n", [0, 1, 2, 3, 5, 10, 17, 64, 101, 1000, 4097])
def test_permutation_and_inverse(n):
    x = np.arange(n)
    for seed in (0, 7):
        y = shard.permute(x.copy(), n, seed)
        assert sorted(y.tolist()) == x.tolist()
        assert shard.permute(y, n, seed, back=True).tolist() == x.tolist()
    big = 10**15 + np.arange(50)
    assert (shard.permute(shard.permute(big, 3 * 10**15, 1), 3 * 10**15, 1, back=True) == big).all()


def test_shuffle_spreads():
    y = shard.permute(np.arange(20000), 20000, 20)
    assert abs(np.corrcoef(np.arange(20000), y)[0, 1]) < 0.03


def test_shards(spark):
    data = [(i, f"té {i % 40}", i) for i in range(1003)] + [(5, "té 5", 5)] * 3 + [(None, None, 0), (None, "", 1)]
    df = spark.createDataFrame(data, "doc_id long, text string, slot int")
    got = shard.shard_rows(df.repartition(7)).collect()
    assert len(got) == len(data)
    for r in got:
        raw = (r.row.text or "").encode()
        assert r.size == len(raw) + 1 and r.text_crc32 == zlib.crc32(raw)
        assert shard.original_number([r.shard], [r.slot], len(data), 8, 20)[0] == r.number
    counts = Counter(r.shard for r in got)
    assert set(counts) == set(range(8)) and max(counts.values()) - min(counts.values()) <= 1
    for s in range(8):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(counts[s]))
    again = shard.shard_rows(df.repartition(2)).collect()
    key = lambda rows: Counter((r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in rows)
    assert key(got) == key(again)
    out = shard.sharded(df)
    assert out.columns == ["doc_id", "text", "slot", "shard", "slot_"]


def test_empty(spark):
    assert shard.shard_rows(spark.createDataFrame([], "doc_id long, text string")).count() == 0
