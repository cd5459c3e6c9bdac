"""Periodic runs of words by a sparse online DP over diagonals.

A run is a stretch of words with smallest period q (words q apart are equal) that
no neighbouring word extends, of at least max(LEAST, TIMES q) words. On the
diagonal of lag q, where word i is compared with word i - q, it is one unbroken
match. The DP goes over the positions in order: an earlier occurrence of what
stands at i makes the match on its lag longer by one; a lag that is not made
longer ends, and if it was long enough its run is emitted at once.

Single words have too many earlier occurrences (a text of one word repeated has
n^2 / 2), so the diagonals are made sparse by levels. Level g compares stretches
of g words and is answerable for the periods above g / 2 (the lowest level, for
all from 1) up to g. There the nearest earlier occurrence of a stretch is the
only one that can carry a run of the level: inside a run of smallest period
q <= g, a nearer occurrence at lag r < q would give at least q + r words the
periods q and r, hence their common divisor, which is smaller than q. And a run
holds a stretch together with the one q before it, as TIMES q >= q + g and
LEAST >= 2 x the lowest g for the level's periods. So each level has one active
lag at a position, a match is a stretch of equal lags, and a match of lag q from
i to j gives the run of words i - q to j + g - 1, whose smallest period is q.

Stretches are named exactly, not hashed: the name of 2g words is the pair of the
names of its halves, renumbered among those that occur twice in their document.
Others can have no earlier occurrence at any higher level and are left out, so
ordinary prose is gone after two or three levels. The levels end with the
longest document's n / TIMES. Time is n log n and memory is linear in a slice
(SLICE_BYTES of text, or one longer text); rows never leave their task.

Null and empty texts, and those of white space alone, have no runs and an empty
collapsed text. Null, equal and repeated doc_ids are rows like any others; other
columns are not read, whatever their names. Runs may overlap; a word goes if any
run holds it after that run's first period. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .words import buffers, slices, span_codes, spans

LEAST, TIMES = 24, 3
#: Words of the lowest level's stretches: at most LEAST words less the greatest period that LEAST decides (8).
_LOWEST = 16

_RUN = "struct<start:long,length:long,period:long>"


def _numbered(rows: np.ndarray, names: np.ndarray) -> np.ndarray:
    """Numbers for pairs (row, name), equal for equal pairs."""
    return np.unique(rows * (int(names.max(initial=0)) + 1) + names, return_inverse=True)[1].reshape(-1)


def _repeated(at: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and names of stretches that occur more than once."""
    twice = np.bincount(names)[names] > 1
    return at[twice], names[twice]


def _doubled(at: np.ndarray, names: np.ndarray, g: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and names of repeated stretches of 2g words, from those of g words (at is sorted; n words in all)."""
    where = np.full(n + g, -1, np.int64)
    where[at] = np.arange(len(at))
    right = where[at + g]
    at, left, right = at[right >= 0], names[right >= 0], names[right[right >= 0]]
    return _repeated(at, np.unique(left * (int(names.max(initial=0)) + 1) + right, return_inverse=True)[1].reshape(-1))


def _nearest(at: np.ndarray, names: np.ndarray) -> np.ndarray:
    """Distance of each stretch from its nearest earlier occurrence; 0 if it has none."""
    order = np.argsort(names, kind="stable")
    same = names[order[1:]] == names[order[:-1]]
    lag = np.zeros(len(at), np.int64)
    lag[order[1:][same]] = (at[order[1:]] - at[order[:-1]])[same]
    return lag


def found(words: np.ndarray, rows: np.ndarray, least: int = LEAST, times: int = TIMES) -> tuple[np.ndarray, ...]:
    """Row, start (counted over all words), length and period of each run.

    ``words`` are word numbers of many documents one after the other, ``rows``
    the sorted documents' numbers.
    """
    n = len(words)
    parts: list[tuple[np.ndarray, ...]] = []
    if n:
        longest = int(np.bincount(rows).max())
        # a word's name belongs to its document, so a stretch over a border occurs once and is left out
        at, names = _repeated(np.arange(n), _numbered(rows, words))
        g = 1
        while g < _LOWEST and len(at):
            at, names = _doubled(at, names, g, n)
            g *= 2
        low = 0
        while len(at) and times * (low + 1) <= longest:
            lag = _nearest(at, names)
            # a match goes on while the lag stays and the position moves on by one
            first = np.flatnonzero(np.r_[True, (lag[1:] != lag[:-1]) | (at[1:] != at[:-1] + 1)][:len(at)])
            last = np.r_[first[1:], len(at)] - 1
            q = lag[first]
            start, end = at[first] - q, at[last] + g
            good = (q > low) & (q <= g) & (end - start >= np.maximum(least, times * q))
            parts.append((rows[start[good]], start[good], (end - start)[good], q[good]))
            low = g
            at, names = _doubled(at, names, g, n)
            g *= 2
    if not parts:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    row, start, length, period = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((period, start))
    return row[order], start[order], length[order], period[order]


def _dropped(n: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Words that some run holds after its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    return np.cumsum(change)[:n] > 0


def _collapsed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray, n_rows: int) -> pa.Array:
    """The given words of each row, joined by one space."""
    n = ends - starts + 1
    ahead = np.cumsum(n) - n
    take = np.repeat(starts - ahead, n) + np.arange(int(n.sum()))
    text = np.append(data, np.uint8(0x20))[np.minimum(take, len(data))]
    text[ahead + n - 1] = 0x20  # what follows a word, white space of any kind or another text
    lengths = np.bincount(rows, n, n_rows).astype(np.int64)
    text = np.delete(text, np.cumsum(lengths)[lengths > 0] - 1)
    offsets = np.zeros(n_rows + 1, np.int64)
    np.cumsum(np.maximum(lengths - 1, 0), out=offsets[1:])
    return pa.Array.from_buffers(pa.large_string(), n_rows, [None, pa.py_buffer(offsets), pa.py_buffer(text)]).cast(pa.string())


def runs(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """doc_id, runs (start, length and period in words, by start, then period) and collapsed of each row of docs.

    ``collapsed`` is the text without the words that repeat a run's first
    period, joined by one space. ``times`` must be 3 or more and ``least`` 24 or
    more, on which the levels rest.
    """
    if times < TIMES or least < LEAST:
        raise ValueError(f"times must be at least {TIMES} and least at least {LEAST}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            data, offsets = buffers(batch.column(1))
            for low, high in slices(data, offsets):
                part, borders = data[offsets[low]:offsets[high]], offsets[low:high + 1] - offsets[low]
                starts, ends, rows = spans(part, borders, "space")
                words, _ = span_codes(part, starts, ends)
                row, start, length, period = found(words, rows, least, times)
                kept = ~_dropped(len(words), start, length, period)
                first = np.searchsorted(rows, np.arange(high - low))
                counts = np.zeros(high - low + 1, np.int32)
                np.cumsum(np.bincount(row, minlength=high - low), out=counts[1:])
                each = pa.StructArray.from_arrays([pa.array(x) for x in (start - first[row], length, period)], fields=list(kind.value_type))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), pa.ListArray.from_arrays(pa.array(counts), each).cast(kind),
                     _collapsed(part, starts[kept], ends[kept], rows[kept], high - low)], ["doc_id", "runs", "collapsed"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, f"doc_id long, runs array<{_RUN}>, collapsed string")


def most_repeated(runs: str | Column) -> Column:
    """The run of greatest length / period (compared exactly), then of smallest start, then period; null if there is none."""
    def later(a: Column, b: Column) -> Column:
        x, y = a["length"] * b["period"], b["length"] * a["period"]
        return (y > x) | ((y == x) & ((b["start"] < a["start"]) | ((b["start"] == a["start"]) & (b["period"] < a["period"]))))

    return F.aggregate(runs, F.lit(None).cast(_RUN), lambda a, b: F.when(a.isNull() | later(a, b), b).otherwise(a))
