"""Ids and texts against the tokenizer file's own library."""

import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from daybook.llm import bpe


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(bpe.TOKENIZER)
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder()


def as_ids(packed):
    return [np.frombuffer(x, "<u4").tolist() for x in packed]


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


ODD = ["", " ", "Hello  WORLD's <|endoftext|>x<|startoftext|><|ENDOFTEXT|>y", "é ́ á̧ Å Å",
       "a b c\x1cd\x85e f", "ΟΔΥΣΣΕΥΣ ΣΑΣ İI ß ﬁ", "don't WE'LL i'm 'S 's't", "12345 ½ ²③", "日本語のテキスト 👩‍👩‍👧 \U0001f600",
       "a" * 3000, "ab" * 700 + "!" * 900, "\u0000�​", "<|endoftext", "|endoftext|>", "</w> </w>a", "\t\n\v\f\r x", "𐐀𐐁 Ǆ ŉ"]


def test_ids(library, encoder):
    r = random.Random(1)
    letters = "abcdefghij zéñ'!?.#0189</w>|日ÅΣ"
    texts = ODD + ["".join(r.choice(letters) for _ in range(r.randrange(60))) for _ in range(2000)]
    chunks = sorted({c for t in texts for c in re.split("[ \t\n\v\f\r]+", t)})
    for _ in range(2):  # the second time from the memo
        ids = dict(zip(chunks, as_ids(encoder.chunks(chunks)), strict=True))
        assert [[k for c in re.split("[ \t\n\v\f\r]+", t) for k in ids[c]] for t in texts] == [ids_of(library, t) for t in texts]


def test_cuts_are_certain(library, encoder):
    """No token of the vocabulary holds a pair that is cut, and fragments put together are the word."""
    words = [library.pre_tokenizer.pre_tokenize_str(w)[0][0] for w in ("zqxjkvwq", "qzé", "wvxq", "the", "x")]
    symbols, first, of_word = encoder.fragments(words)
    names = {k: t for t, k in encoder.vocabulary.items()}
    assert "".join(names[k] for k in symbols.tolist()) == "".join(w + "</w>" for w in words)
    tokens = [[*t.removesuffix("</w>")[:-1], t.removesuffix("</w>")[-1:] + "</w>"] if t.endswith("</w>") else [*t]
              for t in encoder.vocabulary]
    held = {pair for t in tokens for pair in zip(t, t[1:], strict=False)}
    inner = set(first.tolist()) - set(first[of_word].tolist())
    assert len(inner) > 3
    for k in range(1, len(symbols)):
        if k not in first[of_word]:
            assert ((names[symbols[k - 1]], names[symbols[k]]) not in held) == (k in inner)


@pytest.mark.parametrize("long", [bpe.SHORT, 2])
def test_fragments_with_and_without_heap(library, monkeypatch, long):
    monkeypatch.setattr(bpe, "SHORT", long)
    r, encoder = random.Random(2), bpe.Encoder()
    words = sorted({"".join(r.choice("abeinorst") for _ in range(r.randrange(1, 40))) for _ in range(500)})
    assert as_ids(encoder.chunks(words)) == [ids_of(library, w) for w in words]


@settings(max_examples=300, deadline=None)
@given(text=st.text(max_size=40))
def test_any_text(library, encoder, text):
    assert sum(as_ids(encoder.chunks(re.split("[ \t\n\v\f\r]+", text))), []) == ids_of(library, text)


def test_rows(spark, library):
    r = random.Random(4)
    rows = list(enumerate(ODD + [" ".join(r.choice(["the", "Élan", "x1", "two", "\n"]) for _ in range(r.randrange(80))) for _ in range(300)]))
    rows += [(900, None), (None, "a b"), (None, None), (3, rows[3][1]), (3, rows[3][1]), (901, "word " * 300_000), (902, "q" * 200_000)]
    df = spark.createDataFrame([(*x, 5, "z") for x in rows], "doc_id long, text string, n_tokens int, decoded string").repartition(3)
    got = bpe.decoded(bpe.encoded(df)).collect()
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    want = []
    for k, t in rows:
        ids = ids_of(library, t)
        want.append((k, len(ids), np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)))
    assert sorted(((x.doc_id, x.n_tokens, bytes(x.ids), x.decoded) for x in got), key=key) == sorted(want, key=key)


def test_decoding_of_other_ids(spark, library):
    """Ids outside the vocabulary are left out; null has no text; clashing names are kept."""
    ids = [[5, 60000, 49407, 320], [], [1 << 31], [49406]]
    df = spark.createDataFrame([(k, bytearray(np.array(x, "<u4").tobytes()), "own") for k, x in enumerate(ids)] + [(9, None, "own")],
                               "k int, ids binary, decoded string")
    got = {r.k: (r.decoded, r.decoded_) for r in bpe.decoded(df).collect()}
    assert got == {k: ("own", library.decode([i for i in x if i < 49408], skip_special_tokens=False)) for k, x in enumerate(ids)} | {9: ("own", "")}
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.decoded(bpe.encoded(empty)).count() == 0


def test_query_against_library(spark, library):
    """op12 on a whole table."""
    import hashlib

    from daybook.llm.queries import QUERIES

    base = "/root/testdata/sf0.001"
    want = set()
    for r in spark.read.parquet(f"{base}/documents.parquet").collect():
        ids = ids_of(library, r.text)
        want.add((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                  hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert set(map(tuple, QUERIES["op12_bpe_round_trip"](spark, base).collect())) == want
