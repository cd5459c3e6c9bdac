"""Targets against a water-filling loop; rounding against its invariants."""

import random
import re
from collections import Counter, defaultdict

import pytest

from pyspark.sql import functions as F

from daybook.llm import mix


def plain_targets(sizes):
    """Reshare by weight until no target is above twice its source's size."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    w = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    total, target, free = 1.5 * sum(sizes.values()), {}, set(order)
    while free:
        left = total - sum(target.values())
        level = left / sum(w[s] for s in free)
        over = {s for s in free if level * w[s] >= 2 * sizes[s]}
        if not over:
            return target | {s: level * w[s] for s in free}
        target |= {s: 2.0 * sizes[s] for s in over}
        free -= over
    return target


def rows(seed=1, n=900):
    r = random.Random(seed)
    out = []
    for i in range(n):
        s = r.choice(["a"] * 8 + ["b", "c", "dé", "Z", None])
        t = r.choice([None, "", " \t", "one"] + [" ".join(["w"] * r.randrange(1, 200))] * 20)
        out.append((i, t, s))
    return out + [(3, out[3][1], out[3][2])] * 150 + [(None, "x y z", "a"), (None, None, None)]


def size(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def test_targets_and_invariants(spark):
    data = rows()
    df = spark.createDataFrame([(*x, 5, 6) for x in data], "doc_id long, text string, source string, size int, p int")
    got = mix.mixed(df.repartition(5)).collect()
    assert Counter((r.doc_id, r.size, r.source) for r in got) == Counter((d, size(t), s) for d, t, s in data)
    sizes, taken = defaultdict(int), defaultdict(int)
    for d, t, s in data:
        sizes[s] += size(t)
    want = plain_targets(sizes)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 2
        factor = r.target / r.source_size
        if r.size:
            assert int(factor) <= r.copies <= int(factor) + 1
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= max(size(t) for _, t, x in data if x == s)
    again = mix.mixed(df.repartition(2)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))


def test_expected_copies_over_seeds(spark):
    """Each document's chance of the extra copy is its fractional probability."""
    data = [(i, " ".join(["w"] * (1 + i % 7 * 5)), "a" if i % 2 else "b") for i in range(160)]
    df = spark.createDataFrame(data, "doc_id long, text string, source string")
    units = df.selectExpr("doc_id", "0L key", "1L nth", "source", "80L docs",
                          "cast(regexp_count(text, 'w') as double) size", "0.3D p")
    total = Counter()
    for seed in range(12):
        total.update(r.doc_id for r in mix.pivotal(units, seed, block=8).collect() if r.up)
    assert 0.25 < sum(total.values()) / (160 * 12) < 0.35
    assert max(total.values()) < 11


def test_resampled(spark):
    data = rows(4, 200)
    df = spark.createDataFrame([(*x, 1) for x in data], "doc_id long, text string, source string, copies int").withColumns(
        {c: F.lit(7) for c in ("_mix_own", "_mix_id", "_mix_key", "_mix_source", "_mix_times", "_mix_nth", "key", "a.b")})
    want = Counter()
    for r in mix.mixed(df).collect():
        want[(r.doc_id, r.source, r.size)] += r.copies
    out = mix.resampled(df)
    assert out.columns == df.columns and {tuple(r)[4:] for r in out.collect()} == {(7,) * 8}
    got = Counter((r.doc_id, r.source, size(r.text)) for r in out.collect())
    assert got == +want


def test_empty_and_wordless(spark):
    schema = "doc_id long, text string, source string"
    assert mix.mixed(spark.createDataFrame([], schema)).count() == 0
    got = mix.mixed(spark.createDataFrame([(1, None, "a"), (2, " ", None)], schema)).collect()
    assert [(r.taken, r.target, r.source_size) for r in got] == [(0, 0.0, 0)] * 2
