"""Runs against a plain search over all periods and starts; the query against a plain version of its contract."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from daybook.llm import repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(words, least=24, times=3):
    """Every maximal stretch of each period; a stretch that has a smaller period too is not of this one."""
    n, out = len(words), set()
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(least, times * q) and not any(
                    all(words[k] == words[k + r] for k in range(i, i + length - r)) for r in range(1, q)):
                out.add((i, length, q))
            i = max(j, i + 1) if j > i else i + 1
    return sorted(out, key=lambda t: (t[0], t[2]))


def left(words, found):
    gone = {k for s, n, q in found for k in range(s + q, s + n)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def made(r):
    """Random words of a small alphabet with stretches of many periods, side by side and inside each other."""
    out, letters = [], "abcd"[:r.randrange(1, 5)]
    for _ in range(r.randrange(1, 6)):
        root = [r.choice(letters) for _ in range(r.choice([1, 2, 3, 5, 7, 8, 9, 15, 16, 17, 20, 31, 33, 40]))]
        if r.random() < 0.3:
            root = root * 3 + [r.choice(letters)]
        out += (root * r.randrange(1, 30))[:r.randrange(1, 160)]
        out += [r.choice(letters + "xyz") for _ in range(r.randrange(0, 5))]
    return out


def test_found_against_all_periods():
    r = random.Random(5)
    docs = [made(r) for _ in range(250)] + [["a"] * k for k in (0, 1, 23, 24, 25)]
    names = {w: k for k, w in enumerate("abcdxyz")}
    words = np.array([names[w] for d in docs for w in d])
    rows = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    first = np.cumsum([0] + [len(d) for d in docs])
    got = [[] for _ in docs]
    for row, s, n, q in zip(*(x.tolist() for x in repeats.found(words, rows)), strict=True):
        got[row].append((s - int(first[row]), n, q))
    want = [plain(d) for d in docs]
    assert got == want and sum(map(len, want)) > 250
    assert {q for w in want for _, _, q in w} >= {1, 2, 3, 5, 8, 9, 16, 17, 33}


def test_every_period_at_its_least_length():
    r = random.Random(6)
    for q in range(1, 140):
        root = list(range(q))
        r.shuffle(root)
        n = max(24, 3 * q)
        for length in (n - 1, n, n + 1):
            words = np.array([999] + (root * 30)[:length] + [998])
            got = [x.tolist() for x in repeats.found(words, np.zeros(len(words), np.int64))]
            assert got == ([[0], [1], [length], [q]] if length >= n else [[]] * 4)


def test_one_word_a_million_times():
    words = np.zeros(1_000_000, np.int64)
    assert [x.tolist() for x in repeats.found(words, words)] == [[0], [0], [1_000_000], [1]]


def test_rows(spark):
    r = random.Random(7)
    texts = [" ".join(made(r)) for _ in range(60)] + ["\t a\n" * 30, "é  日 " * 40, "", " \n", None, "a b " * 60_000, "  " * 30]
    rows = [(k, t) for k, t in enumerate(texts)] + [(None, texts[60]), (3, texts[3]), (3, texts[3])]
    df = spark.createDataFrame([(*x, "own") for x in rows], "doc_id long, text string, runs string").repartition(3)
    got = sorted(((x.doc_id, [tuple(y) for y in x.runs], x.collapsed) for x in repeats.runs(df).collect()), key=str)
    want = []
    for k, t in rows:
        words = WORD.findall(t or "")
        found = plain(words) if len(words) < 1000 else [(0, len(words), 2)]
        want.append((k, found, left(words, found)))
    assert got == sorted(want, key=str)
    assert repeats.runs(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        repeats.runs(df, times=2)


def test_most_repeated(spark):
    lists = [[(5, 30, 3), (0, 24, 2), (9, 60, 5)], [(7, 24, 1), (2, 24, 1)], [(2, 48, 2), (2, 24, 1)], [], None]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(lists)], "k int, runs array<struct<start:long,length:long,period:long>>")
    got = {r.k: r.top and tuple(r.top) for r in df.select("k", repeats.most_repeated("runs").alias("top")).collect()}
    assert got == {0: (0, 24, 2), 1: (2, 24, 1), 2: (2, 24, 1), 3: None, 4: None}


def contract(doc_id, text):
    """The query's row for one document."""
    words = WORD.findall(text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = plain(words)
    top = min(found, key=lambda t: (-Fraction(t[1], t[2]), t[0], t[2]), default=None)
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in found)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(found), *(top or (None,) * 3), top and 1000 * top[1] // top[2], sha(lines), sha(left(words, found)))


def test_query_against_contract(spark, tmp_path):
    """op13 on the documents of sf0.001 that a quadratic version can do, and odd ones, as a table of their own."""
    from daybook.llm.queries import QUERIES

    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rows = [x for x in rows if len(WORD.findall(x[1] or "")) <= 1500]
    tens = [k for k in range(5000, 9000) if zlib.crc32(str(k).encode()) % 10 == 0][:60]
    r = random.Random(8)
    rows += [(k, " ".join(r.choice("abcdefgh") for _ in range(r.randrange(0, 300)))) for k in tens] + [(9999, None)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op13_periodic_runs"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert set(map(tuple, got.collect())) == {contract(*x) for x in rows}
