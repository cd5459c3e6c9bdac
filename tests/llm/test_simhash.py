"""SimHash groups against a plain loop over all pairs."""

import random
import re
from collections import Counter

import xxhash
from pyspark.sql import functions as F

from daybook.llm import simhash


def plain_fp(text, k=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    grams = [" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))] if w else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_groups(rows, distance=4):
    fps = {i: plain_fp(t) for i, (_, t) in enumerate(rows)}
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in fps:
        for j in fps:
            if i < j and (fps[i] ^ fps[j]).bit_count() <= distance:
                parent[find(i)] = find(j)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in fps if find(j) == find(i) and rows[j][0] is not None]
        out.append((d, f"{fps[i]:016x}", min(ids) if ids else None))
    return out


def corpus():
    r = random.Random(3)
    vocab = [f"wo{i}rd" for i in range(300)] + ["Élan", "ÉLAN", "x y", "naïve"]
    rows = []
    for i in range(120):
        t = " ".join(r.choice(vocab) for _ in range(r.choice([1, 2, 3, 4, 9, 40, 300])))
        rows.append((i, t))
        if i % 4 == 0:
            w = t.split(" ")
            w[r.randrange(len(w))] = "changed"
            rows.append((1000 + i, "  ".join(w).upper()))
        if i % 5 == 0:
            rows.append((2000 + i, t + "\n"))
    rows += [(5000, None), (5001, ""), (5002, " \t\n"), (None, rows[0][1]), (0, rows[0][1]), (None, None)]
    rows.append((6000, "long " * 60000 + "end"))
    return rows


def test_groups_match_all_pairs(spark):
    rows = corpus()
    df = spark.createDataFrame([(d, t, 1, "c") for d, t in rows],
                               "doc_id long, text string, fp int, component string").repartition(3)
    got = simhash.simhash_groups(df).select("doc_id", "fingerprint", "component_id").collect()
    assert Counter(map(tuple, got)) == Counter(plain_groups(rows))
    large = simhash.simhash_groups(df, plan=simhash.LARGE_PLAN).select("doc_id", "fingerprint", "component_id")
    assert Counter(map(tuple, large.collect())) == Counter(map(tuple, got))


def test_links_within_distance(spark):
    r = random.Random(5)
    fps = set()
    for _ in range(60):
        x = r.getrandbits(64)
        fps.add(x)
        for d in (1, 2, 3, 4, 5, 6):
            y = x
            for b in r.sample(range(64), d):
                y ^= 1 << b
            fps.add(y)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 4}
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    for plan in (simhash.SMALL_PLAN, simhash.LARGE_PLAN):
        assert {tuple(x) for x in simhash.links(df, plan=plan).collect()} == want


def test_keep_one(spark):
    rows = corpus()
    df = spark.createDataFrame([(d, t, 7) for d, t in rows], "doc_id long, text string, _key int").withColumns(
        {c: F.lit(7) for c in ("_KEY_", "keep_id", "keep_key", "fp", "component_id", "a.b")})
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns and {tuple(r)[2:] for r in kept.collect()} == {(7,) * 7}
    got = Counter(r.doc_id for r in kept.collect())
    assert got == Counter({c: 1 for c in {c for _, _, c in plain_groups(rows)}})


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.simhash_groups(df).count() == 0
    assert simhash.keep_one(df.withColumn("fp", F.lit(1))).count() == 0
