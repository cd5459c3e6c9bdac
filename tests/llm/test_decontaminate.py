"""Matches against every window of every document, and the multi-index against a scan."""

import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from pyspark.sql import functions as F

from daybook.llm import decontaminate as d


def split(t):
    return re.findall(r"[a-z0-9\u0080-\U0010ffff]+", (t or "").lower())


def grams(w):
    return Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))


def plain(docs, items):
    out = set()
    for di, t in docs:
        w = split(t)
        for ii, s in items:
            v = split(s)
            if not v:
                continue
            if len(v) < 5:
                if any(w[i:i + len(v)] == v for i in range(len(w) - len(v) + 1)):
                    out.add((di, ii))
                continue
            b = grams(v)
            for i in range(max(1, len(w) - len(v) + 1)):
                a = grams(w[i:i + len(v)])
                if a and sum((a & b).values()) >= 0.8 * sum((a | b).values()):
                    out.add((di, ii))
                    break
    return out


def data():
    r = random.Random(6)
    vocab = [f"w{i}" for i in range(200)] + ["Été", "x9"]
    text = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    items = [(i, text(r.randrange(12, 60))) for i in range(40)]
    items += [(100, items[0][1]), (101, "short One, two"), (102, None), (103, "..."), (104, "a b c d e"),
              (105, "the same the same the same the same the same the same")]
    docs = [(i, text(r.randrange(0, 150))) for i in range(60)]
    for k, (_, s) in enumerate(items):
        if not s:
            continue
        docs.append((1000 + k, text(30) + ". " + s.upper() + "&&& " + text(40)))
        w = s.split()
        w[len(w) // 2] = "other"
        docs.append((2000 + k, text(10) + " " + " ".join(w) + " " + text(3)))
        docs.append((3000 + k, " ".join(s.split()[:len(w) // 2])))
        docs.append((4000 + k, " ".join(s.split()[1:]) + " " + text(30)))
    docs += [(5000, None), (5001, ""), (None, items[3][1]), (1000, docs[60][1]),
             (5002, text(90_000) + " " + items[5][1] + " " + text(5))]
    return docs, items


def test_matches_every_window(spark):
    docs, items = data()
    df = spark.createDataFrame([(*x, 1) for x in docs], "doc_id long, text string, item_id int").repartition(3)
    bench = spark.createDataFrame([(*x, 2) for x in items], "item_id long, text string, doc_id int")
    got = d.contamination(df, bench).collect()
    want = plain([x for x in docs if x[0] != 5002], items) | {(5002, 5)}
    found = {(r.doc_id, r.item_id) for r in got}
    assert found == {x for x in want}
    by = dict(docs)
    for r in got:
        if r.doc_id in by and r.doc_id and r.similarity == 1.0:
            w = split(by[r.doc_id])[r.first_word:r.first_word + r.n_words]
            assert w == split(dict(items)[r.item_id])
    df = df.withColumns({c: F.lit(7) for c in ("_own_key", "_hit_id", "_hit_key", "text_key", "item_id", "a.b")})
    clean = d.without_benchmark(df, bench)
    assert clean.columns == df.columns and {tuple(r)[-6:] for r in clean.collect()} == {(7,) * 6}
    assert Counter(r.doc_id for r in clean.collect()) == Counter(i for i, _ in docs if i not in {x for x, _ in want})


def test_swapped_parts(spark):
    """Items whose parts stand in another order, inside longer documents."""
    r = random.Random(8)
    fresh = iter(range(10 ** 6))
    text = lambda n: [f"w{next(fresh)}" for _ in range(n)]
    items, docs = [], []
    for k, (n, cut) in enumerate([(60, 30), (100, 50), (80, 20), (60, 45), (20, 10), (300, 100)]):
        w = text(n)
        items.append((k, " ".join(w)))
        docs.append((k, " ".join(text(50) + w[cut:] + w[:cut] + text(50))))
    w = [r.choice("abc") for _ in range(70)]  # few different shingles, each many times
    items.append((50, " ".join(w)))
    docs += [(50, " ".join(text(9) + w[30:] + w[:30] + w[:50])), (51, " ".join(text(9) + w[:8] * 30))]
    got = d.contamination(spark.createDataFrame(docs, "doc_id long, text string"),
                          spark.createDataFrame(items, "item_id long, text string")).collect()
    want = plain(docs, items)
    assert {(0, 0), (1, 1), (2, 2), (3, 3), (5, 5)} <= want
    assert {(x.doc_id, x.item_id) for x in got} == want
    for x in got:  # the best of all windows
        w, b = split(dict(docs)[x.doc_id]), grams(split(dict(items)[x.item_id]))
        tried = [grams(w[i:i + x.n_words]) for i in range(len(w) - x.n_words + 1)]
        sims = [sum((a & b).values()) / sum((a | b).values()) for a in tried]
        assert abs(x.similarity - max(sims)) < 1e-9 and abs(sims[x.first_word] - x.similarity) < 1e-9


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    docs, items = data()
    df = spark.createDataFrame(docs[:150], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    whole = {tuple(r) for r in d.contamination(df, bench).collect()}
    monkeypatch.setattr(d, "ITEM_BYTES", 1500)
    assert {tuple(r) for r in d.contamination(df, bench).collect()} == whole


def test_multi_index():
    r = np.random.default_rng(1)
    fps = r.integers(0, 2**63, 500).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    for radius, blocks in ((19, 8), (11, 4), (3, 4)):
        index = d.MultiIndex(fps, radius, blocks)
        for k in range(40):
            fp = fps[k]
            for b in r.choice(64, radius + 1 - k % 3, replace=False).tolist():
                fp ^= np.uint64(1 << b)
            want = np.flatnonzero(np.bitwise_count(fps ^ fp) <= radius)
            assert index.within(fp).tolist() == want.tolist()


def found(docs, items, **more):
    """(doc, item) of the items of five words or more, without Spark."""
    block = d.Items(items, **more)
    out = set()
    for a, h, rows, *_ in d._text_shingles(pa.array([t for _, t in docs], pa.string())):
        out |= {(docs[a + row][0], i) for row, k in block.matches(h, rows) for i in block.ids[k]}
    return out


@pytest.mark.parametrize("entries", [1, 1 << 20])
def test_shared_passages(monkeypatch, entries):
    """Items that share a passage, which is most of some of them, in texts that hold the passage alone or whole items."""
    monkeypatch.setattr(d, "ENTRIES", entries)
    r = random.Random(4)
    new = iter(range(10 ** 6))
    text = lambda n: " ".join(f"w{next(new)}" for _ in range(n))
    passage = text(30)
    items = [(k, f"{passage} {text(r.choice([1, 2, 4, 6, 12, 40]))}") for k in range(60)]
    items += [(100 + k, items[k][1]) for k in range(5)] + [(200, "so so so so so so so so so so"), (201, passage), (202, "x y z x y z x y z x y z x y")]
    docs = [(k, f"{text(20)} {passage} {text(20)}") for k in range(5)] + [(10, " ".join([passage] * 4)), (11, "so " * 300), (12, "x y z " * 50), (13, passage)]
    docs += [(20 + k, f"{text(9)} {r.choice(items)[1]} {text(9)} {r.choice(items)[1]}") for k in range(20)]
    docs += [(50 + k, " ".join(items[k][1].split()[r.randrange(6):])) for k in range(20)]
    want = plain(docs, items)
    assert found(docs, items) == want
    assert {i for _, i in found(docs, items, min_words=31)} == {i for _, i in want} - {200, 201, 202}


def test_passage_of_many_items():
    """Memory is bounded where many items share a passage that many texts hold."""
    new = iter(range(10 ** 7))
    text = lambda n: " ".join(f"w{next(new)}" for _ in range(n))
    passage = text(30)
    items = [(k, f"{passage} {text(20)}") for k in range(4000)]
    docs = [(k, f"{text(100)} {passage} {text(100)}") for k in range(300)] + [(1000, f"{text(5)} {items[77][1]} {text(5)}")]
    block = d.Items(items)
    (_, h, rows, *_), = d._text_shingles(pa.array([t for _, t in docs], pa.string()))
    tracemalloc.start()
    got = block.matches(h, rows)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [(row, block.ids[k]) for row, k in got] == [(300, [77])]
    assert peak < 50 << 20


def test_min_item_words(spark):
    docs = spark.createDataFrame([(1, "a short One two b"), (2, "nothing")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "short one, two"), (2, "b")], "item_id long, text string")
    for least, want in [(1, {1, 2}), (2, {1}), (4, set())]:
        assert {r.item_id for r in d.contamination(docs, bench, least).collect()} == want
        assert d.without_benchmark(docs, bench, least).count() == 2 - bool(want)


def test_empty(spark):
    docs = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert d.contamination(docs, none).count() == 0
    assert d.without_benchmark(docs, none).count() == 1
    assert d.contamination(docs.limit(0), spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")).count() == 0
