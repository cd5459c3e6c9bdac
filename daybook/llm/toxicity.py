"""Toxicity scores over texts restored by a noisy-channel decoder.

1. Character model. Trigram counts of letters inside words are gathered from
   every text of the table (27 symbols: a-z and any other letter, plus word
   edges), so the model follows the corpus; the table of counts has a fixed
   size of 29 ** 3 cells.
2. Restoring. Words that hold stand-in signs beside letters (``1d10t``), runs
   of three or more equal letters (``stuuupid``), signs between single letters
   (``s.c.u.m``) and rows of single-letter words (``l o s e r``) become
   character lattices: a stand-in may be any letter it is used for, a run may
   be one or two letters, a separator is dropped or a word border. Viterbi
   decoding under the character model picks the letters, in overlapping windows
   of long lattices; it also refuses doubtful readings (``readings``). Restored words are scored beside the
   words as written, so clean text never loses a word.
3. Evidence. A feature is the first 3 to 7 bytes of a word or the whole word,
   lower-cased. Its weight is the log ratio of the shares of toxic and clean
   documents that hold it. A word's evidence is its strongest feature; a
   document's is the sum over its words.
4. Score. A logistic curve over evidence and length, fitted with each
   training document's own vote taken out of the weights.

Weights and curve are fitted on about TRAIN_ROWS labelled documents at most (a documented
bound; the doc_ids with the smallest hashes). Everything else covers all rows.
Only the text is scored. Null and empty texts get the score of no evidence.
Repeated rows score alike. Without toxic and clean training rows the score is
the share of toxic labels (0 if there are none).
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words
from .common import saved, text_key

#: About so many labelled documents at most fit the weights and the curve (their ids are broadcast).
TRAIN_ROWS = 20_000
PREFIX = range(3, 8)
#: A feature needs so many toxic documents, and such a log ratio.
MIN_TOXIC, MIN_RATIO, MAX_RATIO = 4, 1.5, 6.0
THRESHOLD = 0.7

#: What each stand-in sign may be read as (fixed values).
STAND_INS = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
             "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "*": "aeiou", "#": "h", "%": "x", "&": "a"}
SEPARATORS = ".-_*~'`/\\,:"
#: Lattices are decoded in windows of so many places, of which the last ones are read again in the next window.
WINDOW, OVERLAP = 200, 24
#: Stand-ins that are letters at the end of a word too; ``!`` there is punctuation.
_END_SIGNS = "$@+#|*%&"

# --- character model -------------------------------------------------------

_EDGE, _OTHER, _SYMBOLS = 0, 27, 29
_CLASS = np.full(256, _EDGE, np.int64)
_CLASS[97:123] = np.arange(1, 27)
_CLASS[65:91] = np.arange(1, 27)
_CLASS[0xC0:] = _OTHER  # the first byte of another letter; its later bytes are dropped


def _trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(_SYMBOLS ** 3, np.int64)
    for batch in batches:
        data, offsets = words.buffers(batch.column(0))
        for a, b in words.slices(data, offsets):
            part, cuts = data[offsets[a]:offsets[b]], offsets[a:b] - offsets[a]
            part = np.insert(part, cuts[cuts <= len(part)], 32)
            sign = _CLASS[part[(part < 0x80) | (part >= 0xC0)]]
            if len(sign) > 2:
                first, mid, last = sign[:-2], sign[1:-1], sign[2:]
                live = (mid > 0) & ((first > 0) | (last > 0))
                total += np.bincount((first * _SYMBOLS + mid)[live] * _SYMBOLS + last[live], minlength=len(total))
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["gram", "n"])


def character_model(docs: DataFrame) -> np.ndarray:
    """log P(third | first, second) over letters, from trigram counts of all texts."""
    counts = np.zeros(_SYMBOLS ** 3)
    for r in docs.select("text").mapInArrow(_trigrams, "gram long, n long").groupBy("gram").agg(
            F.sum("n").alias("n")).collect():  # at most 29 ** 3 rows
        counts[r.gram] = r.n
    cube = counts.reshape(_SYMBOLS, _SYMBOLS, _SYMBOLS)
    pair = cube.sum(0)
    single = pair.sum(0) + 1.0
    low = (pair + 5.0 * single / single.sum()) / (pair.sum(1, keepdims=True) + 5.0)
    full = (cube + 2.0 * low[None]) / (cube.sum(2, keepdims=True) + 2.0)
    return np.log(np.maximum(full, 1e-12))


def _options(token: str) -> list[list[str]]:
    """The lattice: for each place the strings it may stand for."""
    out, i = [], 0
    while i < len(token):
        c, j = token[i], i
        while j < len(token) and token[j] == c:
            j += 1
        run, i = j - i, j
        if c.isalpha():
            out.append([c * run] if run < 3 else [c, c * 2])
        elif c in STAND_INS:
            # a sign is a letter, or, if it also separates, nothing
            drop = [""] if c in SEPARATORS else []
            if run == 1:
                out.append([*STAND_INS[c], *drop])
            else:
                out.append([s * k for s in STAND_INS[c] for k in (1, 2)] + drop)
        elif c in SEPARATORS:
            out.append([""])
        else:
            return []
    return out


def _index(c: str) -> int:
    return ord(c) - 96 if "a" <= c <= "z" else _EDGE if c == " " else _OTHER


def _gain(a: int, b: int, c: str, model: np.ndarray) -> float:
    # the bonus offsets the cost of a letter, so that shorter readings don't win by length
    return model[a, b, _index(c)] + (3.0 if c != " " else 0.0)


def _best(lattice: list[list[str]], model: np.ndarray) -> tuple[float, str]:
    """Score and text of the likeliest reading, in overlapping windows."""
    text, low = "", 0
    while True:
        last = low + WINDOW >= len(lattice)
        x, y = ([_EDGE, _EDGE] + [_index(c) for c in text[-2:]])[-2:]
        beam = {(x, y): (0.0, "", None)}
        for place in lattice[low:low + WINDOW]:
            following: dict[tuple[int, int], tuple] = {}
            for (x, y), node in beam.items():
                for option in place:
                    a, b, s = x, y, node[0]
                    for c in option:
                        s += _gain(a, b, c, model)
                        a, b = b, _index(c)
                    if (a, b) not in following or following[a, b][0] < s:
                        following[a, b] = (s, option, node)
            beam = following
        _, _, node = max((v[0] + (model[a, b, _EDGE] if last else 0.0), (a, b), v) for (a, b), v in beam.items())
        path = []
        while node[2] is not None:
            path.append(node[1])
            node = node[2]
        path.reverse()
        text += "".join(path if last else path[:WINDOW - OVERLAP])
        if last:
            break
        low += WINDOW - OVERLAP
    score, a, b = 0.0, _EDGE, _EDGE
    for c in text:
        score += _gain(a, b, c, model)
        a, b = b, _index(c)
    return score + model[a, b, _EDGE], text


def decode(token: str, model: np.ndarray) -> str:
    """The likeliest reading of the token's lattice ('' if it has none)."""
    lattice = _options(token)
    return _best(lattice, model)[1] if lattice else ""


def readings(token: str, model: np.ndarray) -> str:
    """Restored words of a token, or of a row of single signs (with spaces between them).

    Where signs or spaces part single letters, a reading with word borders
    among them is given too. Tokens of which letters are less than half, that
    end in a stand-in, or rows that are short or hold stand-ins need a score
    above 0, that is, a likelier reading than letters of exp(-3) each.
    """
    signs = token.replace(" ", "")
    lattice = _options(signs)
    if not lattice:
        return ""
    score, text = _best(lattice, model)
    letters = sum(c.isalpha() for c in signs)
    if " " in token:
        doubtful = len(signs) < 4 or letters < len(signs)
    else:
        doubtful = letters * 2 < len(signs) - sum(c in SEPARATORS for c in signs) or signs[-1] in _END_SIGNS
    if doubtful and score <= 0:
        return ""
    if " " in token:
        parted = [place if not k else [*place, *(" " + option for option in place)] for k, place in enumerate(lattice)]
    elif re.search(r"[^\W\d_]{3}", signs):
        return text
    else:
        parted = [[*place, " "] if "" in place else place for place in lattice]
    other = _best(parted, model)[1] if parted != lattice else text
    return text if other.replace(" ", "") == other else f"{text} {other}"


# --- finding what to restore ------------------------------------------------

_MARK = np.zeros(256, bool)
_MARK[[ord(c) for c in {*STAND_INS, *SEPARATORS}]] = True
_EDGE_SIGNS = " \t\r\n\v\f.,;:!?\"'()[]{}<>&%$#*~_-|+"
_STAND_IN = np.zeros(256, bool)
_STAND_IN[[ord(c) for c in STAND_INS]] = True
_LAST = np.zeros(256, bool)
_LAST[[ord(c) for c in _END_SIGNS]] = True
_LEAD = np.zeros(256, bool)
_LEAD[[ord(c) for c in "0123456789@$!"]] = True


def suspects(data: np.ndarray, offsets: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Tokens to restore and their rows, from lower-case text."""
    starts, ends, rows = words.spans(data, offsets, "space")
    if not len(starts):
        return [], np.zeros(0, np.int64)
    letter, mark = words.KINDS["letter"][data], _MARK[data]
    lead = _LEAD[data]
    hit = np.zeros(len(data), bool)
    if len(data) > 3:
        hit[1:-1] = mark[1:-1] & letter[:-2] & letter[2:]
        hit[1:-2] |= mark[1:-2] & mark[2:-1] & letter[:-3] & letter[3:]
        hit[:-1] |= lead[:-1] & letter[1:]
        hit[1:] |= lead[1:] & letter[:-1] & (data[1:] < 58) & (data[1:] >= 48)
        hit[2:] |= letter[2:] & (data[2:] == data[1:-1]) & (data[1:-1] == data[:-2]) & (data[2:] < 0x80)
    hit[1:] |= _LAST[data[1:]] & letter[:-1]
    total = np.r_[0, np.cumsum(hit)]
    some = np.flatnonzero(total[ends] > total[starts])
    raw = data.tobytes()
    tokens: list[str] = []
    owner: list[int] = []
    for k in some.tolist():
        token = raw[starts[k]:ends[k]].decode("utf-8", "ignore")
        core = token.rstrip(_EDGE_SIGNS).lstrip(" \t.,;:?\"'()[]{}<>~_-")
        if len(core) > 2 and any(c.isalpha() for c in core) and (
                not core.isalpha() or re.search(r"(.)\1\1", core)):
            tokens.append(core)
            owner.append(int(rows[k]))
        # stand-ins at the end belong to the word, unless they also stand before it (as in *word*)
        longer = token.rstrip(" .,;:!?\"'()[]{}<>~_-").lstrip(" \t.,;:?\"'()[]{}<>~_-")
        if len(longer) > max(2, len(core)) and longer[-1] in _END_SIGNS and longer[0] != longer[-1] and any(
                c.isalpha() for c in longer):
            tokens.append(longer)
            owner.append(int(rows[k]))
    # rows of single letters or stand-ins: at least three one-sign words in a row, two of them letters
    at = np.minimum(starts, len(data) - 1)
    single = (ends - starts == 1) & (letter[at] | _STAND_IN[data[at]])
    if single.sum() >= 3:
        new = np.r_[True, ~single[:-1] | ~single[1:] | (rows[1:] != rows[:-1])]
        low = np.flatnonzero(new)
        high = np.r_[low[1:], len(starts)]
        n_letters = np.r_[0, np.cumsum(single & letter[at])]
        good = single[low] & (high - low >= 3) & (n_letters[high] - n_letters[low] >= 2)
        for a, b in zip(low[good].tolist(), high[good].tolist(), strict=True):
            tokens.append(" ".join(chr(raw[starts[k]]) for k in range(a, b)))
            owner.append(int(rows[a]))
    return tokens, np.array(owner, np.int64)


def restored(data: np.ndarray, offsets: np.ndarray, model: np.ndarray, known: dict[str, str]) -> tuple[np.ndarray, np.ndarray]:
    """Buffers like the input's, each row holding its restored words."""
    tokens, owner = suspects(data, offsets)
    out: list[list[str]] = [[] for _ in range(len(offsets) - 1)]
    for token, row in zip(tokens, owner.tolist(), strict=True):
        if token not in known:
            if len(known) >= 50_000:
                known.clear()
            known[token] = readings(token, model)
        if known[token]:
            out[row].append(known[token])
    return words.buffers(pa.array([" ".join(x) for x in out], pa.string()))


# --- features and evidence --------------------------------------------------

def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of each word, hash per prefix and whole word as columns, 0 where the word is shorter)."""
    starts, ends, rows = words.spans(data, offsets, "letter")
    keep = ends - starts >= PREFIX[0]
    n_row = np.bincount(rows, minlength=len(offsets) - 1)
    starts, ends, rows = starts[keep], ends[keep], rows[keep]
    out = np.zeros((len(starts), len(PREFIX) + 1), np.uint64)
    padded = np.r_[data, np.zeros(PREFIX[-1], np.uint8)]
    h = np.full(len(starts), 1469598103934665603, np.uint64)
    for k in range(PREFIX[-1]):
        h = (h ^ padded[starts + k]) * np.uint64(1099511628211)
        if k + 1 in PREFIX:
            out[:, k + 1 - PREFIX[0]] = np.where(ends - starts > k, words.mixed(h), 0)
    if len(starts):
        out[:, -1] = words.word_hashes(data, starts, ends) | np.uint64(1)
    return rows, out, n_row


class Weights:
    """Feature weights by hash; a bitmap answers most look-ups."""

    def __init__(self, keys: np.ndarray, toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int):
        order = np.argsort(keys)
        self.keys, self.toxic, self.clean = keys[order], toxic[order], clean[order]
        self.n_toxic, self.n_clean = n_toxic, n_clean
        self.bitmap = np.zeros(1 << 22, bool)
        self.bitmap[self.keys >> np.uint64(42)] = True

    def ratio(self, at: np.ndarray, own=None) -> np.ndarray:
        """Log ratios; own: 1 or 0 per entry, the label of the document whose vote is left out."""
        t, c, nt, nc = self.toxic[at], self.clean[at], self.n_toxic, self.n_clean
        if own is not None:
            t, c, nt, nc = t - own, c - (1 - own), nt - own, nc - (1 - own)
        r = np.log((t + 0.1) / (nt + 1.0)) - np.log((c + 0.5) / (nc + 1.0))
        return np.where((t >= MIN_TOXIC - 1) & (r >= MIN_RATIO), np.minimum(r, MAX_RATIO), 0.0)

    def evidence(self, data: np.ndarray, offsets: np.ndarray, own=None) -> tuple[np.ndarray, np.ndarray]:
        """Evidence and number of words of each row."""
        n = len(offsets) - 1
        rows, hashes, n_row = features(data, offsets)
        best = np.zeros(len(rows))
        for column in hashes.T if len(self.keys) else ():
            near = np.flatnonzero(self.bitmap[column >> np.uint64(42)])
            at = np.minimum(np.searchsorted(self.keys, column[near]), len(self.keys) - 1)
            same = self.keys[at] == column[near]
            near, at = near[same], at[same]
            best[near] = np.maximum(best[near], self.ratio(at, None if own is None else own[rows[near]]))
        return np.bincount(rows, best, minlength=n), n_row


def _inputs(evidence: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.stack([np.ones(len(n)), np.log1p(evidence), np.log1p(n), 10 * evidence / (n + 20.0)], 1)


def _lowered(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return words.buffers(pc.utf8_lower(pc.fill_null(column.cast(pa.large_string()), "")))


def _pieces(column: pa.Array, rows: int = 1000) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Lower-cased bytes and offsets of the column in pieces, so a large batch is not copied whole."""
    for low in range(0, len(column), rows):
        data, offsets = _lowered(column.slice(low, rows))
        for a, b in words.slices(data, offsets, 2 << 20):
            yield low + a, low + b, data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]


def _doc_features(part, cuts, model, known):
    """(row, feature) pairs, each once."""
    row, h, _ = features(part, cuts)
    row2, h2, _ = features(*restored(part, cuts, model, known))
    row, h = np.repeat(np.r_[row, row2], h.shape[1]), np.r_[h, h2].ravel()
    row, h = row[h > 0], h[h > 0]
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.r_[True, (row[1:] != row[:-1]) | (h[1:] != h[:-1])] if len(row) else np.zeros(0, bool)
    return row[new], h[new]


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Coefficients of the ridge logistic regression (first column: intercept, not shrunk).

    Newton steps with halving while the loss would rise: labels that the inputs
    separate perfectly leave the loss without a minimum but for the ridge.
    """
    pull = np.full(x.shape[1], ridge)
    pull[0] = 1e-6

    def loss(w):
        z = x @ w
        return np.logaddexp(0, z).sum() - (y * z).sum() + 0.5 * (pull * w * w).sum()

    w = np.zeros(x.shape[1])
    now = loss(w)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(pull), x.T @ (y - p) - pull * w)
        size = 1.0
        while loss(w + size * step) > now and size > 1e-6:
            size /= 2
        w = w + size * step
        new = loss(w)
        if now - new < 1e-9 * max(1.0, now):
            break
        now = new
    return w


def fit(train: DataFrame, model: np.ndarray) -> tuple[Weights, np.ndarray]:
    """Weights and curve from all rows (text, toxic) of train."""
    spark = train.sparkSession
    counts = {bool(r[0]): r[1] for r in train.groupBy(F.col("toxic") == 1).count().collect()}
    n_toxic, n_clean = counts.get(True, 0), counts.get(False, 0)
    empty = np.zeros(0, np.uint64)
    none = Weights(empty, np.zeros(0), np.zeros(0), n_toxic, n_clean)
    if not n_toxic or not n_clean:
        share = n_toxic / max(1, n_toxic + n_clean)
        return none, np.array([math.log((share + 1e-9) / (1 - share + 1e-9)), 0, 0, 0])
    lm = spark.sparkContext.broadcast(model)

    def documents(batches):
        known: dict[str, str] = {}
        for batch in batches:
            for _, _, part, cuts in _pieces(batch.column(0)):
                h, n = np.unique(_doc_features(part, cuts, lm.value, known)[1], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], ["f", "n"])

    def counted(rows, name):
        return rows.select("text").mapInArrow(documents, "f long, n long").groupBy("f").agg(F.sum("n").alias(name))

    often = counted(train.filter("toxic = 1"), "t").filter(F.col("t") >= MIN_TOXIC)
    both = often.join(counted(train.filter("toxic <> 1"), "c"), "f", "left").select("f", "t", F.coalesce("c", F.lit(0)).alias("c"))
    ratio = F.log((F.col("t") + 0.1) / (n_toxic + 1.0)) - F.log((F.col("c") + 0.5) / (n_clean + 1.0))
    found = both.filter(ratio >= MIN_RATIO).toArrow()  # bounded by the training rows
    f, t, c = (found.column(k).to_numpy() for k in range(3))
    weights = Weights(f.astype(np.int64).view(np.uint64), t.astype(float), c.astype(float), n_toxic, n_clean)
    shared = spark.sparkContext.broadcast(weights)

    def curve_rows(batches):
        known: dict[str, str] = {}
        for batch in batches:
            y = batch.column(1).to_numpy(zero_copy_only=False).astype(float)
            for a, b, part, cuts in _pieces(batch.column(0)):
                e, n = shared.value.evidence(part, cuts, y[a:b])
                e2, _ = shared.value.evidence(*restored(part, cuts, lm.value, known), y[a:b])
                yield pa.RecordBatch.from_arrays([pa.array(e + e2), pa.array(n), pa.array(y[a:b])], ["e", "n", "y"])

    rows = train.select("text", F.col("toxic").cast("int")).mapInArrow(curve_rows, "e double, n long, y double").toPandas()
    x, y = _inputs(rows.e.to_numpy(), rows.n.to_numpy()), rows.y.to_numpy()
    return weights, logistic(x, y)


def trained(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, Weights, np.ndarray]:
    """Character model of all docs; weights and curve from the labelled rows not held out."""
    own = saved(labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max("toxic").alias("toxic")).filter(~_held_out()), "toxic-labels")
    share = min(1.0, TRAIN_ROWS / max(1, own.count()))
    picked = own.filter(F.pmod(F.xxhash64("doc_id", F.lit(4)), F.lit(1 << 30)) <= int(share * (1 << 30)))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("text IS NOT NULL").join(
        F.broadcast(picked.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic")), "doc_id").select("text", "toxic")
    model = character_model(docs)
    return (model, *fit(saved(rows, "toxic-train"), model))


def _held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def scored(docs: DataFrame, fitted) -> DataFrame:
    """doc_id, text_key, held_out, score, predicted and n_restored of each row of docs."""
    model, weights, curve = fitted
    shared = docs.sparkSession.sparkContext.broadcast((model, weights, curve))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, weights, curve = shared.value
        known: dict[str, str] = {}
        for batch in batches:
            score = np.zeros(batch.num_rows)
            extra = np.zeros(batch.num_rows, np.int64)
            for a, b, part, cuts in _pieces(batch.column(3)):
                e, n = weights.evidence(part, cuts)
                e2, extra[a:b] = weights.evidence(*restored(part, cuts, model, known))
                score[a:b] = 1 / (1 + np.exp(-np.clip(_inputs(e + e2, n) @ curve, -30, 30)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(score), pa.array(extra)],
                                             ["doc_id", "text_key", "held_out", "score", "n_restored"])

    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"),
                      _held_out().alias("held_out"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        run, "doc_id long, text_key long, held_out boolean, score double, n_restored long")
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of docs that are not predicted toxic; same columns. Rows are scored in place, so no join is needed."""
    model, weights, curve = trained(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast((model, weights, curve))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, weights, curve = shared.value
        known: dict[str, str] = {}
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            for a, b, part, cuts in _pieces(batch.column(at)):
                e, n = weights.evidence(part, cuts)
                e2, _ = weights.evidence(*restored(part, cuts, model, known))
                keep[a:b] = 1 / (1 + np.exp(-np.clip(_inputs(e + e2, n) @ curve, -30, 30))) < THRESHOLD
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
