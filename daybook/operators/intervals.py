"""Interval union length per group (AG16) as a skew-bounded sweep.

Intervals are clipped to fixed time buckets (``bucket_minutes``). Inside a
(group, bucket) the union length is a sorted sweep: each piece adds the part
of it beyond the running maximum end of the earlier pieces. Buckets are
disjoint in time, so the group's union length is the sum over its buckets and
no island ever has to cross a bucket edge. A group's rows spread over its
buckets, and pieces with the same start are combined map-side first, so one
window partition never holds more distinct starts than a bucket can have.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daybook.functions.timeutil import col_

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _micros(c: str):
    return F.expr(f"timestampdiff(MICROSECOND, {_EPOCH}, {c})")


def union_length_micros(df: DataFrame, keys: list[str], start: str, end: str,
                        bucket_minutes: int = 60, out: str = "union_us") -> DataFrame:
    """Total covered microseconds of the union of [start, end] per key group.

    Overlapping and touching intervals merge; empty or inverted intervals add
    nothing. Groups whose intervals are all empty have no row: callers left
    join this onto their per-group aggregate (same keys, same partitioning)
    and read a missing length as 0.
    """
    w_us = int(bucket_minutes) * 60 * 1_000_000
    iv = (df.select(*keys, _micros(start).alias("_s"), _micros(end).alias("_e"))
          .filter(F.col("_e") > F.col("_s")))
    pieces = iv.select(
        *keys, "_s", "_e",
        F.explode(F.sequence(F.floor(F.col("_s") / w_us),
                             F.floor((F.col("_e") - 1) / w_us))).alias("_b"))
    pieces = pieces.select(
        *keys, "_b",
        F.greatest(F.col("_s"), F.col("_b") * w_us).alias("_ps"),
        F.least(F.col("_e"), (F.col("_b") + 1) * w_us).alias("_pe"))
    # pieces with the same start are combined map-side (most of a hot bucket's
    # pieces start at its edge), so what is exchanged is bounded by the distinct
    # starts; the sweep window then needs one more exchange on (keys, bucket)
    # of the combined rows, and the per-group sum shuffles one row per group
    # and task
    pieces = pieces.groupBy(*keys, "_b", "_ps").agg(F.max("_pe").alias("_pe"))
    w = (Window.partitionBy(*keys, "_b").orderBy("_ps")
         .rowsBetween(Window.unboundedPreceding, -1))
    covered = F.max("_pe").over(w)
    gain = F.greatest(F.lit(0), F.col("_pe") - F.greatest(F.col("_ps"), F.coalesce(covered, F.col("_ps"))))
    return (pieces.select(*keys, gain.alias("_g")).groupBy(*keys)
            .agg(F.sum("_g").cast("bigint").alias(out)))


def hours(c) -> "F.Column":
    return col_(c) / F.lit(3_600_000_000.0)
