"""BPE encoding by forced boundaries, and decoding.

A merge joins two symbols that end and begin with certain characters of the
byte alphabet. A pair of neighbouring bytes that is no such joint in any merge
occurs inside no token of the vocabulary, so every encoding has a token border
there: the pair is a certain cut. Each word is cut at all of them, the fragments
are encoded apart from each other, and their ids are put one after the other. A
word's last byte carries the end-of-word sign, so (byte, last byte) pairs are
told from (byte, byte) pairs.

``encoded`` works on slices of Arrow text: they are cut into chunks at ASCII
white space, which no token crosses, and equal chunks are encoded once
(dictionary encoding, exact). Normalising a chunk and cutting it into words is
done by the tokenizer file's own rules. Fragments are merged by lowest rank,
then leftmost, all of one length in one matrix; long ones with a heap, so time is
n log n in a fragment's length. Rows never
leave their task: nothing is shuffled, and a task holds one slice (SLICE_BYTES of
text, or one longer text) and the ids of at most MEMO chunks and words besides.

``ids`` are flat little-endian unsigned 32-bit integers, as token files hold
them. ``decoded`` puts the tokens' strings together as the file's library does
without a decoder: with one space between, special tokens kept, ids outside the
vocabulary left out.

Null and empty texts, and those of white space alone, have no ids; no ids, or
null, decode to the empty text. Null, equal and repeated doc_ids are rows like
any others. Special strings inside a text are special tokens, as in the library.
Names of ``encoded`` are doc_id, n_tokens and ids; other columns are not read.
``decoded`` keeps all columns of its table. Empty tables give empty results.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .common import fresh
from .words import buffers, slices, span_codes, spans

TOKENIZER = "/opt/tokenizers/word_bpe_49k.json"
#: Chunks and words whose ids are remembered from slice to slice, and their longest length.
MEMO = 1 << 17
MEMO_CHARS = 64
#: Fragments of up to so many symbols are merged without a heap.
SHORT = 24
#: Chunks that are normalised and split in one call.
_TOGETHER = 2000
_NONE = 1 << 60
#: Marks special tokens among words; no character of the byte alphabet.
_SPECIAL = "\0"


class Encoder:
    """The BPE model of a tokenizer file with word ends, a normaliser and a word splitter.

    Symbols are vocabulary ids throughout. ``ranks`` of pairs are looked up in a
    sorted array of pair keys; rank r makes the symbol ``made[r]``.
    """

    def __init__(self, path: str = TOKENIZER):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("dropout") or model.get("ignore_merges") or model.get("byte_fallback") or (
                model.get("continuing_subword_prefix")):
            raise ValueError("a plain BPE model with an end-of-word suffix is needed")
        if spec["decoder"] is not None or any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("a file without a decoder, and with plain added tokens, is needed")
        rules = Tokenizer.from_file(path)
        self.normalize, self.split = rules.normalizer.normalize_str, rules.pre_tokenizer.pre_tokenize_str
        end: str = model["end_of_word_suffix"] or ""
        self.vocabulary: dict[str, int] = model["vocab"]
        self.special: dict[str, int] = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        size = self.size = max(self.vocabulary.values()) + 1
        keys = np.array([self.vocabulary[a] * size + self.vocabulary[b] for a, b in pairs], np.int64)
        self.made = np.array([self.vocabulary[a + b] for a, b in pairs], np.int64)
        self.ranks = np.argsort(keys, kind="stable")
        self.keys = keys[self.ranks]
        # the byte alphabet: characters that stand for one byte inside a word (0) and at its end (1)
        letters = [t for t in self.vocabulary if len(t) == 1]
        self.letters = np.full((2, 1 + max(map(ord, letters))), -1, np.int64)
        for c in letters:
            self.letters[0, ord(c)], self.letters[1, ord(c)] = self.vocabulary[c], self.vocabulary[c + end]
        #: joints[a, b]: some token holds byte b (of either kind) after byte a; every other pair is a certain cut.
        width = self.letters.shape[1]
        self.joints = np.zeros((width, 2 * width), bool)
        for a, b in pairs:
            self.joints[ord(a[-1]), ord(b[0]) + (width if b == b[0] + end else 0)] = True
        self.heap_ranks: dict[int, int] = {}
        self.special_ids = {_SPECIAL + t: k.to_bytes(4, "little") for t, k in self.special.items()}
        self.memo: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair of symbols, _NONE if they don't merge."""
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], _NONE)

    def fragments(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbols of all words, the first symbol of each fragment, and the first fragment of each word."""
        points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        last = np.zeros(len(points), np.int64)
        last[ends - 1] = 1
        cut = np.ones(len(points), bool)
        cut[1:] = (last[:-1] == 1) | ~self.joints[points[:-1], points[1:] + last[1:] * self.letters.shape[1]]
        first = np.flatnonzero(cut)
        return self.letters[last, points], first, np.searchsorted(first, np.r_[0, ends[:-1]])

    def merged(self, symbols: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all fragments, one after the other, and the number of each one's.

        The pair of lowest rank is merged, the leftmost first, until none is
        left. Fragments of one length are one matrix; a merge makes a line
        shorter by one, so it joins the lines of that length.
        """
        lengths = np.diff(np.r_[first, len(symbols)])
        n = np.ones(len(first), np.int64)
        done: list[tuple[np.ndarray, np.ndarray]] = [(np.flatnonzero(lengths == 1), symbols[first[lengths == 1], None])]
        for k in np.flatnonzero(lengths > SHORT).tolist():
            ids = self._by_heap(symbols[first[k]:first[k] + lengths[k]])
            n[k] = len(ids)
            done.append((np.array([k]), ids[None, :]))
        line, part, ranks = np.zeros(0, np.int64), np.zeros((0, SHORT), np.int64), np.zeros((0, SHORT - 1), np.int64)
        for size in range(SHORT, 1, -1):
            new = np.flatnonzero(lengths == size)
            fresh_part = symbols[first[new][:, None] + np.arange(size)]
            line = np.concatenate([line, new])
            part = np.concatenate([part, fresh_part])
            ranks = np.concatenate([ranks, self.rank(fresh_part[:, :-1], fresh_part[:, 1:])])
            at = ranks.argmin(1)
            least = ranks[np.arange(len(at)), at]
            over = least == _NONE
            n[line[over]] = size
            done.append((line[over], part[over]))
            line, part, ranks, at, least = line[~over], part[~over], ranks[~over], at[~over, None], least[~over]
            places = np.arange(size - 1)
            part = np.take_along_axis(part, places + (places > at), 1)
            rows, at = np.arange(len(at)), at[:, 0]
            part[rows, at] = self.made[least]
            places = places[:-1]
            ranks = np.take_along_axis(ranks, places + (places >= at[:, None]), 1)
            for ok, left in ((at > 0, at - 1), (at < size - 2, at)):
                ranks[rows[ok], left[ok]] = self.rank(part[rows[ok], left[ok]], part[rows[ok], left[ok] + 1])
        n[line] = 1
        done.append((line, part))
        begin = np.cumsum(n) - n
        out = np.empty(int(n.sum()), np.int64)
        for lines, ids in done:
            out[begin[lines][:, None] + np.arange(ids.shape[1])] = ids
        return out, n

    def _by_heap(self, part: np.ndarray) -> np.ndarray:
        if not self.heap_ranks:
            self.heap_ranks = dict(zip(self.keys.tolist(), self.ranks.tolist(), strict=True))
        symbols: list[int] = part.tolist()
        n = len(symbols)
        rank = self.heap_ranks.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        found = self.rank(part[:-1], part[1:])
        heap = [(int(found[k]), k) for k in np.flatnonzero(found != _NONE).tolist()]
        heapq.heapify(heap)
        while heap:
            r, k = heapq.heappop(heap)
            right = after[k]
            if symbols[k] < 0 or right >= n or rank(symbols[k] * self.size + symbols[right]) != r:
                continue
            symbols[k] = int(self.made[r])
            symbols[right] = -1
            after[k] = far = after[right]
            if far < n:
                before[far] = k
                if (r := rank(symbols[k] * self.size + symbols[far])) is not None:
                    heapq.heappush(heap, (r, k))
            near = before[k]
            if near >= 0 and (r := rank(symbols[near] * self.size + symbols[k])) is not None:
                heapq.heappush(heap, (r, near))
        return np.array([s for s in symbols if s >= 0], np.int64)

    def _pieces(self, texts: list[str]) -> list[list[str]]:
        """Words, and keys of special tokens, of each text."""
        out: list[list[str]] = [[] for _ in texts]
        easy = []
        for k, t in enumerate(texts):
            if len(t.split()) == 1 and not (self.cut_special and self.cut_special.search(t)):
                easy.append(k)
                continue
            for piece in self.cut_special.split(t) if self.cut_special else [t]:
                if piece in self.special:
                    out[k].append(_SPECIAL + piece)
                elif piece:
                    out[k] += [w for w, _ in self.split(self.normalize(piece))]
        for low in range(0, len(easy), _TOGETHER):  # texts without white space are normalised and split in one call
            some = easy[low:low + _TOGETHER]
            plain = self.normalize(" ".join([texts[k] for k in some]))
            ends = [*accumulate(len(t) + 1 for t in plain.split(" "))]
            if len(ends) != len(some):
                for k in some:
                    out[k] += [w for w, _ in self.split(self.normalize(texts[k]))]
                continue
            of = 0
            for word, (start, _) in self.split(plain):
                while start >= ends[of]:
                    of += 1
                out[some[of]].append(word)
        return out

    def _learned(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words, as little-endian bytes."""
        if not words:
            return {}
        symbols, first, of_word = self.fragments(words)
        ids, n = self.merged(symbols, first)
        ends = (4 * np.cumsum(np.add.reduceat(n, of_word))).tolist()
        flat = ids.astype("<u4").tobytes()
        return {w: flat[low:high] for w, low, high in zip(words, [0, *ends[:-1]], ends, strict=True)}

    def chunks(self, texts: list[str]) -> list[bytes]:
        """Ids, as little-endian bytes, of each of different texts that hold no ASCII white space; short ones are remembered."""
        memo, words = self.memo, self.words
        for known in (memo, words):
            if len(known) > MEMO:
                known.clear()
        words.update(self.special_ids)
        new = [t for t in texts if t not in memo]
        pieces = self._pieces(new)
        learned = self._learned([w for w in {w for p in pieces for w in p} if w not in words])
        words.update(learned)
        for t, p in zip(new, pieces, strict=True):
            memo[t] = words[p[0]] if len(p) == 1 else b"".join([words[w] for w in p])
        out = [memo[t] for t in texts]
        for known, some in ((memo, new), (words, learned)):
            for t in some:
                if len(t) > MEMO_CHARS:
                    del known[t]
        return out

    def strings(self) -> list[bytes]:
        """UTF-8 string of each id; empty where there is none."""
        names = self.vocabulary | self.special
        out = [b""] * (max(names.values(), default=-1) + 1)
        for name, k in names.items():
            out[k] = name.encode()
        return out


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each range, one range after the other."""
    ahead = np.cumsum(lengths) - lengths
    return np.repeat(starts - ahead, lengths) + np.arange(int(lengths.sum()))


def _binary(data: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Strings or byte strings of the given lengths that follow each other in data."""
    offsets = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    if offsets[-1] >= 1 << 31:
        raise ValueError("one row's result is over 2 GB")
    return pa.Array.from_buffers(kind, len(lengths), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def encoded(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """doc_id, n_tokens and ids (binary, little-endian unsigned 32-bit) of each row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer)
        for batch in batches:
            data, offsets = buffers(batch.column(1))
            for low, high in slices(data, offsets):
                part, at = data[offsets[low]:offsets[high]], offsets[low:high + 1] - offsets[low]
                starts, ends, rows = spans(part, at, "space")
                codes, chunks = span_codes(part, starts, ends)
                each = encoder.chunks(chunks.to_pylist())
                n = np.fromiter(map(len, each), np.int64, len(each)) // 4
                flat = np.frombuffer(b"".join(each), "<u4")
                lengths = n[codes]
                ids = flat[_ranges((np.cumsum(n) - n)[codes], lengths)]
                tokens = np.bincount(rows, lengths, high - low).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), pa.array(tokens), _binary(ids.view(np.uint8), 4 * tokens, pa.binary())],
                    ["doc_id", "n_tokens", "ids"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n_tokens long, ids binary")


#: Ids decoded at a time.
_DECODE_IDS = 1 << 20


def decoded(tokens: DataFrame, tokenizer: str = TOKENIZER, ids: str = "ids") -> DataFrame:
    """tokens with their text as ``decoded`` (a fresh name if taken); ``ids`` names the binary column."""
    name = fresh(tokens, "decoded")
    place = tokens.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = Encoder(tokenizer).strings()
        n = np.array([len(s) + 1 for s in names], np.int64)
        starts, table = np.cumsum(n) - n, np.frombuffer(b" ".join(names) + b" ", np.uint8)
        for batch in batches:
            values = batch.column(place).cast(pa.large_binary()).fill_null(b"")
            offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset:values.offset + len(values) + 1]
            raw = np.frombuffer(values.buffers()[2] or b"", np.uint8)
            for low, high in slices(raw, offsets - offsets[0], 4 * _DECODE_IDS):
                begin, end = int(offsets[low]), int(offsets[high])
                found = np.frombuffer(raw[begin:end].tobytes(), "<u4").astype(np.int64)
                known = found < len(names)
                known[known] = n[found[known]] > 1
                rows = np.repeat(np.arange(high - low), np.diff(offsets[low:high + 1]) // 4)[known]
                found = found[known]
                lengths = np.bincount(rows, n[found], high - low).astype(np.int64)
                text = table[_ranges(starts[found], n[found])]
                last = np.cumsum(lengths)[lengths > 0] - 1  # the space after a row's last token
                out = _binary(np.delete(text, last), np.maximum(lengths - 1, 0), pa.string())
                yield pa.RecordBatch.from_arrays([*batch.slice(low, high - low).columns, out], [*batch.schema.names, name])

    return tokens.mapInArrow(run, StructType([*tokens.schema.fields, StructField(name, StringType())]))
