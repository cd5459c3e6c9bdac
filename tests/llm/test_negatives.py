"""Mined negatives against a plain loop over all pairs; packed keys; odd rows."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from daybook.llm import negatives
from daybook.llm.negatives import Mining, packed, unpacked


def plain(rows, anchors, rule=Mining()):
    """rows: (id, label, whole-number vector), ids without repeats."""
    out = []
    for a, label, x in rows:
        if not anchors(a):
            continue
        scored = sorted((-sum(p * q for p, q in zip(x, y, strict=True)), k, m) for k, m, y in rows if k != a and len(x) == len(y))
        for ps, pos, _ in [s for s in scored if s[2] == label][:rule.n_positives]:
            fits = [(-ns, k) for ns, k, m in scored if m != label and rule.low * -ps <= 100 * -ns <= rule.high * -ps]
            out += [(a, pos, r, k, -ps, ns) for r, (ns, k) in enumerate(fits[:rule.n_negatives], 1)]
    return Counter(out)


def data(n=400, dims=8, seed=1, hot=False):
    r = np.random.default_rng(seed)
    x = r.standard_normal((n, dims)) * 0.4 + 0.3
    if hot:
        x[: n // 3] = x[0]
        x[n // 3: n // 2] = x[1]
    return [(k, int(r.integers(0, 3)), np.asarray(v, np.float32).astype(float).tolist()) for k, v in enumerate(x)]


def whole(rows):
    return [(k, m, [int(np.floor(256 * c)) for c in v]) for k, m, v in rows]


SCHEMA = "vec_id long, label int, embedding array<float>, anchor int, score string"


def frame(spark, rows, parts=5):
    return spark.createDataFrame([(*r, 3, "x") for r in rows], SCHEMA).repartition(parts)


@pytest.mark.parametrize("hot", [False, True])
@pytest.mark.parametrize("block", [negatives.BLOCK_BYTES, 300])
def test_against_all_pairs(spark, monkeypatch, hot, block):
    monkeypatch.setattr(negatives, "TASK_ROWS", 64)
    rows = data(hot=hot)
    got = negatives.mined(frame(spark, rows), F.col("vec_id") % 25 == 0, block_bytes=block)
    want = plain(whole(rows), lambda k: k % 25 == 0)
    assert Counter(map(tuple, got.collect())) == want and len(want) > 60
    assert got.schema.simpleString() == ("struct<anchor_id:bigint,positive_id:bigint,rank:int,negative_id:bigint,"
                                         "positive_score:bigint,negative_score:bigint>")


def test_window_rules(spark):
    """Bounds included, fewer than asked for, a score of 0, scores below 0."""
    one = [(0, 1, [100.0, 0.0, 0.0]), (1, 1, [100.0, 1.0, 0.0]), (2, 1, [0.0, 5.0, 5.0]), (3, 1, [-1.0, 0.0, 0.0])]
    rows = [(k, m, [c / 256 for c in v]) for k, m, v in [
        *one, (10, 2, [95.0, 0, 0]), (11, 2, [50.0, 0, 0]), (12, 2, [96.0, 0, 0]), (13, 2, [49.0, 0, 0]), (14, 2, [0.0, 7.0, 0]),
        (15, 3, [-1.0, 0, 0]), (16, 3, [95.0, 1.0, 0])]]
    got = Counter(map(tuple, negatives.mined(frame(spark, rows), F.col("vec_id") == 0).collect()))
    assert got == plain(whole(rows), lambda k: k == 0) == Counter([
        (0, 1, 1, 10, 10000, 9500), (0, 1, 2, 16, 10000, 9500), (0, 1, 3, 11, 10000, 5000), (0, 2, 1, 14, 0, 0)])


def test_odd_rows(spark):
    good = data(60, dims=3)
    odd = [(None, 1, [1.0, 1.0, 1.0]), (50, None, [1.0, 1.0, 1.0]), (100, 1, None), (150, 1, [1.0, None, 1.0]),
           (200, 1, [1.0, float("nan"), 1.0]), (250, 1, [1.0, float("inf"), 1.0]), (300, 1, [3e38, 1.0, 1.0]),
           (350, 1, []), (400, 2, []), (450, 1, []), (500, 1, [1.0, 2.0]), (None, None, None), (550, 2, [2.0, 2.0])]
    twice = [good[0], good[0], good[7]]
    got = Counter(map(tuple, negatives.mined(frame(spark, good + odd + twice), F.col("vec_id") % 50 == 0).collect()))
    kept = whole(good) + [(350, 1, []), (400, 2, []), (450, 1, []), (500, 1, [256, 512]), (550, 2, [512, 512])]
    assert got == plain(kept, lambda k: k % 50 == 0)
    assert negatives.mined(frame(spark, good).limit(0), F.col("vec_id") % 50 == 0).count() == 0
    assert negatives.mined(frame(spark, good), F.col("vec_id") < 0).count() == 0


def test_large_scores_are_exact():
    r = random.Random(3)
    x = [[r.randrange(-(1 << 29), 1 << 29) for _ in range(5)] for _ in range(20)]
    got = negatives.products(np.array(x, float), np.array(x, float))
    assert got.tolist() == [[sum(p * q for p, q in zip(a, b, strict=True)) for b in x] for a in x]


def test_packed_keys_sort_as_they_should():
    r = random.Random(2)
    ends = [-(1 << 63), -1, 0, 1, (1 << 63) - 1]
    rows = [(r.randrange(3), r.choice(ends), r.randrange(2), r.choice(ends)) for _ in range(300)]
    keys = [packed(np.array([a]), np.array([s]), k, np.array([i])).tobytes() for a, s, k, i in rows]
    assert [unpacked(k) for k in keys] == rows
    assert [unpacked(k) for k in sorted(keys)] == sorted(rows, key=lambda t: (t[0], -t[1], t[2], t[3]))


def test_query_against_all_pairs(spark):
    """op11 on a whole table: labels changed where the id is divisible by 7, anchors divisible by 50."""
    from daybook.llm.queries import QUERIES

    base = "/root/testdata/sf0.001"
    rows = []
    for r in spark.read.parquet(f"{base}/embeddings.parquet").collect():
        if r.label is not None and r.embedding is not None and all(c is not None and np.isfinite(c) for c in r.embedding):
            rows.append((r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, [int(np.floor(256 * c)) for c in r.embedding]))
    got = Counter(map(tuple, QUERIES["op11_hard_negatives"](spark, base).collect()))
    assert got == plain(rows, lambda k: k % 50 == 0) and got
