"""Token counts by scanning flat token files for end-of-document ids.

``flat_files`` tokenises documents into flat streams: token ids one after the
other, an end-of-document id after each document, no index of where documents
begin. A stream is kept as fixed-size binary blocks (file, block, tokens), cut
without regard to documents, so any store that Spark writes to can hold it.

``counts`` knows only the blocks. Each block is searched for the separator at
once (numpy); its summary holds the tokens before the first and after the last
separator and the lengths between separators. A prefix scan over the block
summaries of a file gives each block the number of documents and the unfinished
length before it, which stitches documents that cross block borders.

``token_counts`` does both and names the documents by the list of doc_ids that
flat_files kept in stream order. Null and empty texts have 0 tokens. Special
strings inside a text are ordinary text. Rows repeated in full, and null ids,
are documents like any others. A stream without a last separator ends in a
document that is not terminated.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Word pattern of that vocabulary (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
EOD = 50256
BLOCK_TOKENS = 1 << 18


def load(path: str = TOKENIZER, pattern: str = PATTERN):
    """The byte-level BPE whose ranks are in the file at ``path``."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def flat_files(docs: DataFrame, tokenizer: str = TOKENIZER, eod: int = EOD,
               block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """file, block, tokens (binary, uint16) rows, and file, first, ids rows that list the doc_ids in order."""
    if eod >= 1 << 16:
        raise ValueError("token ids are stored in 16 bits")

    def row(file, block=None, tokens=None, first=None, ids=None):
        return pa.RecordBatch.from_arrays(
            [pa.array([file], pa.int32()), pa.array([block], pa.int64()), pa.array([tokens], pa.binary()),
             pa.array([first], pa.int64()), pa.array([ids], pa.list_(pa.int64()))],
            ["file", "block", "tokens", "first", "ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, file = load(tokenizer), TaskContext.get().partitionId()
        held: list[np.ndarray] = []
        n = block = first = 0
        for batch in batches:
            for low in range(0, batch.num_rows, 2000):
                part = batch.slice(low, 2000)
                for text in part.column(1):
                    ids = np.array([*(encoder.encode_ordinary(text.as_py() or "")), eod], np.uint16)
                    held.append(ids)
                    n += len(ids)
                    if n >= block_tokens:
                        flat = np.concatenate(held)
                        for k in range(0, n - block_tokens + 1, block_tokens):
                            yield row(file, block, flat[k:k + block_tokens].astype("<u2").tobytes())
                            block += 1
                        held = [flat[n - n % block_tokens:]]
                        n = len(held[0])
                yield row(file, first=first, ids=part.column(0).to_pylist())
                first += part.num_rows
        if n:
            yield row(file, block, np.concatenate(held).astype("<u2").tobytes())

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "file int, block long, tokens binary, first long, ids array<long>")


def counts(blocks: DataFrame, eod: int = EOD) -> DataFrame:
    """file, ordinal, n_tokens and terminated of each document in the blocks (file, block, tokens)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, ends, head, tail, inner = [], [], [], [], []
            for value in batch.column(2):
                ids = np.frombuffer(value.as_buffer(), "<u2")
                at = np.flatnonzero(ids == eod)
                n.append(len(ids))
                ends.append(len(at))
                head.append(int(at[0]) if len(at) else len(ids))
                tail.append(len(ids) - 1 - int(at[-1]) if len(at) else len(ids))
                inner.append((np.diff(at) - 1).tolist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(x, pa.int64()) for x in (n, ends, head, tail)),
                 pa.array(inner, pa.list_(pa.int64()))], ["file", "block", "n", "ends", "head", "tail", "inner"])

    parts = blocks.filter("tokens IS NOT NULL").select("file", "block", "tokens").mapInArrow(
        scan, "file int, block long, n long, ends long, head long, tail long, inner array<long>")
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    at = (parts.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
          .withColumn("ordinal", F.coalesce(F.sum("ends").over(before), F.lit(0)))
          .withColumn("cut", F.when(F.col("ends") > 0, F.col("start") + F.col("n") - F.col("tail")))
          .withColumn("carried", F.col("start") - F.coalesce(F.max("cut").over(before), F.lit(0)))
          .withColumn("is_last", F.col("block") == F.max("block").over(every)))
    done = at.filter("ends > 0").select("file", "ordinal", F.posexplode(F.concat(
        F.array(F.col("carried") + F.col("head")), "inner")).alias("k", "n_tokens")).select(
        "file", (F.col("ordinal") + F.col("k")).alias("ordinal"), "n_tokens", F.lit(True).alias("terminated"))
    left = F.when(F.col("ends") > 0, F.col("tail")).otherwise(F.col("carried") + F.col("n"))
    open_end = at.filter("is_last").select("file", (F.col("ordinal") + F.col("ends")).alias("ordinal"),
                                           left.alias("n_tokens"), F.lit(False).alias("terminated")).filter("n_tokens > 0")
    return done.union(open_end)


def token_counts(docs: DataFrame, tokenizer: str = TOKENIZER, eod: int = EOD,
                 block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """doc_id and n_tokens of each row of docs."""
    flat = saved(flat_files(docs, tokenizer, eod, block_tokens), "flat-tokens")
    names = flat.filter("ids IS NOT NULL").select("file", "first", F.posexplode("ids").alias("k", "doc_id")).select(
        "file", (F.col("first") + F.col("k")).alias("ordinal"), "doc_id")
    return counts(flat, eod).join(names, ["file", "ordinal"]).select("doc_id", "n_tokens")
