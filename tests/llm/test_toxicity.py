"""Restoring, scores on held-out rows, and defined results for odd rows."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from daybook.llm import toxicity, words

SYL = "an er on the re in st nd ou ea ing ed".split()
BAD = ["grumblok", "snarfle", "vexotic"]


def corpus(n=900, seed=2):
    r = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        w = ["".join(r.choice(SYL) for _ in range(r.randrange(1, 4))) for _ in range(r.randrange(20, 300))]
        bad = r.random() < 0.2
        if bad:
            for _ in range(r.randrange(2, 6)):
                w.insert(r.randrange(len(w)), r.choice(BAD) + r.choice(["", "s", "ing"]))
        docs.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    return docs, labels


def held(d):
    return zlib.crc32(str(d).encode()) % 3 == 1


@pytest.fixture(scope="module")
def fitted(spark):
    docs, labels = corpus()
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    return toxicity.trained(d, spark.createDataFrame(labels, "doc_id long, toxic int"))


def test_held_out(spark, fitted):
    docs, labels = corpus()
    got = {r.doc_id: r for r in toxicity.scored(spark.createDataFrame(docs, "doc_id long, text string"), fitted).collect()}
    wrong = sum(got[i].predicted != y for i, y in labels if held(i))
    assert wrong <= 2
    for i, r in got.items():
        assert r.held_out == held(i) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)


def test_hidden_words(spark, fitted):
    docs, labels = corpus(30, 9)
    base = next(t for (_, t), (_, y) in zip(docs, labels, strict=True) if not y)
    ways = ["grumbl0k snarf1e", "gr.um.bl.ok s-n-a-r-f-l-e", "gruuuumblok snarfffle", "g r u m b l o k then s n a r f l e",
            "$narfle vex0tic grumb|ok"]
    docs = [(k, f"{base} {w} {base[:50]} {w}") for k, w in enumerate(ways)] + [(9, base + " 10.5 2024 they're x-y-z (and) e.g. a+b")]
    got = {r.doc_id: r for r in toxicity.scored(spark.createDataFrame(docs, "doc_id long, text string"), fitted).collect()}
    assert [got[k].predicted for k in range(len(ways))] == [1] * len(ways)
    assert got[9].predicted == 0


def test_decode_is_the_best_path(fitted):
    """Viterbi against all readings of small lattices."""
    from itertools import product

    model = fitted[0]
    for token in ("gr0mb", "a1st", "th33", "s.t.o", "re4l"):
        best, text = -1e9, ""
        for reading in product(*toxicity._options(token)):
            t = "".join(reading)
            z = [0, 0, *map(toxicity._index, t), 0]
            s = sum(model[z[i], z[i + 1], z[i + 2]] for i in range(len(z) - 2)) + 3.0 * len(t)
            if s > best:
                best, text = s, t
        assert toxicity.decode(token, model) == text


def test_listed_spellings():
    """Few letters, signs at the end, spaced signs, short rows, and tokens and rows of any length."""
    vocab = "idiot loser shit asshole bitch dumbass ass scum you are a the and of words".split()
    cube = np.full((29, 29, 29), 0.01)
    for w in vocab:
        z = [0, 0, *map(toxicity._index, w), 0]
        for i in range(len(z) - 2):
            cube[z[i], z[i + 1], z[i + 2]] += 1
    model = np.log(cube / cube.sum(2, keepdims=True))
    model[1:, 0] = model[0, 0]

    def found(text):
        data, offsets = toxicity._lowered(pa.array([text]))
        data, _ = toxicity.restored(data, offsets, model, {})
        return data.tobytes().decode().split()

    for text, word in [("1d10t", "idiot"), ("l053r", "loser"), ("5h17", "shit"), ("a55h0l3", "asshole"), ("8!7ch", "bitch"),
                       ("an a$$ here", "ass"), ("dumba$$,", "dumbass"), ("l 0 s e r", "loser"), ("you a s s", "ass"),
                       ("x9z 2024 10.5", None)]:
        assert word in found(text) if word else not {*found(text)} & {*vocab}
    phrase = "youareadumbassandidiot"
    assert "idiot" in found(".".join(phrase)) and "dumbass" in found(" ".join(phrase))
    long = found(" ".join("thewordsofaloser" * 40))
    assert long.count("loser") >= 38
    assert toxicity.decode("-".join("loser" * 200), model) == "loser" * 200


def test_rare_toxic_words_beside_many_features(spark):
    """Over 60,000 features are in more toxic documents than the word that only toxic ones hold."""
    r = random.Random(3)
    common = " ".join("".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(8)) for _ in range(20_000))
    rows = [(common + (" snarfle" if k < 4 else ""), 1) for k in range(5)] + [(common, 0) for _ in range(20)]
    weights, _ = toxicity.fit(spark.createDataFrame(rows, "text string, toxic int"), np.full((29, 29, 29), -3.0))
    _, h, _ = toxicity.features(*toxicity._lowered(pa.array(["snarfle"])))
    assert {*h[0, -2:].tolist()} <= {*weights.keys.tolist()}
    assert len(weights.keys) < 20


def test_odd_rows(spark, fitted):
    docs = [(None, None, 1), (1, None, 1), (2, "", 1), (3, " \n", 1), (4, "snarfle " * 90_000, 1), (4, "the", 1), (4, "the", 1)]
    df = spark.createDataFrame(docs, "doc_id long, text string, score int")
    got = toxicity.scored(df, fitted).collect()
    assert len(got) == len(docs)
    empty = {r.score for r in got if r.doc_id in (1, 2, 3) or r.doc_id is None}
    assert len(empty) == 1 and empty.pop() < 0.5
    assert sum(r.predicted for r in got) == 1
    assert toxicity.scored(df.limit(0), fitted).count() == 0


def test_no_labels(spark):
    docs = spark.createDataFrame(corpus(20)[0], "doc_id long, text string")
    fit = toxicity.trained(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r.predicted for r in toxicity.scored(docs, fit).collect()} == {0}
    out = toxicity.without_toxic(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert out.count() == 20 and out.columns == docs.columns


def test_spans_and_features():
    data, offsets = words.buffers(pa.array(["ab  cd", None, "", "é x"]))
    s, e, r = words.spans(data, offsets, "space")
    assert [data[a:b].tobytes().decode() for a, b in zip(s, e, strict=True)] == ["ab", "cd", "é", "x"]
    assert r.tolist() == [0, 0, 3, 3]
    h = words.word_hashes(*[np.frombuffer(b"ab xx ab", np.uint8)], np.array([0, 3, 6]), np.array([2, 5, 8]))
    assert h[0] == h[2] != h[1]


@pytest.mark.parametrize("n", [50, 20_000])
def test_curve_of_separable_labels(n):
    """Labels that the evidence separates must not upset the fit."""
    r = np.random.default_rng(1)
    y = (r.random(n) < 0.1).astype(float)
    e, words_ = y * r.uniform(5, 300, n), r.integers(1, 5000, n)
    x = toxicity._inputs(e, words_)
    w = toxicity.logistic(x, y)
    p = 1 / (1 + np.exp(-(x @ w)))
    assert ((p >= 0.7) == (y == 1)).mean() > 0.97 and (p[y == 0] < 0.5).all()
    grad = x.T @ (y - p) - np.r_[1e-6, 1, 1, 1] * w
    assert np.abs(grad).max() < 1e-2 * n ** 0.5
