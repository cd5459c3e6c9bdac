"""Counts against the tokenizer itself; stitching against one concatenated stream."""

import random
from collections import Counter

import numpy as np
import pytest

from daybook.llm import tokens


def rows():
    r = random.Random(1)
    out = [(i, " ".join(r.choice(["the", "Élan", "x1", "  two", "\n"]) for _ in range(r.randrange(0, 60)))) for i in range(200)]
    return out + [(300, None), (301, ""), (302, "<|endoftext|> is text"), (7, out[7][1]), (7, out[7][1]), (None, "a b"),
                  (303, "long word " * 60_000)]


@pytest.mark.parametrize("block", [7, 64, 1 << 18])
def test_counts(spark, block):
    data = rows() if block > 7 else rows()[:-1]
    df = spark.createDataFrame([(*x, 3) for x in data], "doc_id long, text string, n_tokens int").repartition(3)
    encoder = tokens.load()
    got = tokens.token_counts(df, block_tokens=block).collect()
    assert Counter(map(tuple, got)) == Counter((d, len(encoder.encode_ordinary(t or ""))) for d, t in data)


def test_streams_from_elsewhere(spark):
    """Files of known tokens, cut anywhere, with and without a last separator."""
    r = np.random.default_rng(2)
    want, blocks = [], []
    for file in range(4):
        lengths = r.integers(0, 40, 30).tolist()
        stream = np.concatenate([np.r_[r.integers(0, 100, n), tokens.EOD] for n in lengths]).astype("<u2")
        want += [(file, k, n, True) for k, n in enumerate(lengths)]
        if file % 2:
            stream = np.r_[stream, [5, 5, 5]].astype("<u2")
            want.append((file, len(lengths), 3, False))
        cuts = np.sort(r.integers(0, len(stream) + 1, 12)).tolist()
        blocks += [(file, k, stream[a:b].tobytes()) for k, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(stream)], strict=True))]
    df = spark.createDataFrame([(f, b, bytearray(t)) for f, b, t in blocks], "file int, block long, tokens binary").repartition(5)
    assert Counter(map(tuple, tokens.counts(df).collect())) == Counter(want)


def test_empty(spark):
    assert tokens.token_counts(spark.createDataFrame([], "doc_id long, text string")).count() == 0
