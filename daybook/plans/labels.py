"""C15 against a table of labels: an index of prefixes instead of a list in the plan.

A raw label gets the canonical label that equals it; else the first one, in the
table's order, of which it is a prefix or which is a prefix of it, both cut to
``PREFIX`` characters and without regard to case; else the fallback.

Exact matches are joined first. The rest are looked up both ways by equality: a
cut raw label among the prefixes of the labels (exploded once, each prefix with
its first label), and the prefixes of the raw label among the cut labels. Raw
labels are made distinct before, so a label that most rows share is looked up
once, and every join is an equi-join whatever the number of labels.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX = 20


def _cut(c: str) -> Column:
    return F.lower(F.substring(c, 1, PREFIX))


def _prefixes(c: str) -> Column:
    return F.explode(F.transform(F.sequence(F.lit(0), F.length(c)), lambda n: F.substring(F.col(c), F.lit(1), n)))


def prefix_index(labels: DataFrame) -> DataFrame:
    """prefix and the position of the first label that has it. labels: pos, label."""
    cut = labels.select("pos", _cut("label").alias("cut"))
    return cut.select("pos", _prefixes("cut").alias("prefix")).groupBy("prefix").agg(F.min("pos").alias("pos"))


def normalised(raw: DataFrame, labels: DataFrame, fallback: str = "Other", column: str = "raw_label") -> DataFrame:
    """raw with the column ``label``. NULL gets the fallback; of equal labels the first counts."""
    texts = raw.select(F.col(column).alias("raw")).filter(F.col("raw").isNotNull()).distinct()
    first = labels.groupBy("label").agg(F.min("pos").alias("pos"))
    exact = texts.join(first, F.col("raw") == F.col("label")).select("raw", "label")
    rest = texts.join(first, F.col("raw") == F.col("label"), "left_anti").withColumn("cut", _cut("raw"))
    inside = rest.join(prefix_index(labels), F.col("cut") == F.col("prefix")).select("raw", "pos")
    whole = labels.groupBy(_cut("label").alias("prefix")).agg(F.min("pos").alias("pos"))
    around = rest.select("raw", _prefixes("cut").alias("p")).join(whole, F.col("p") == F.col("prefix")).select("raw", "pos")
    found = inside.unionByName(around).groupBy("raw").agg(F.min("pos").alias("pos"))
    by_prefix = found.join(labels.groupBy("pos").agg(F.min("label").alias("label")), "pos").select("raw", "label")
    every = exact.unionByName(by_prefix).withColumnsRenamed({"raw": "_raw", "label": "_label"})
    return raw.join(every, F.col(column) == F.col("_raw"), "left").select(
        *raw.columns, F.coalesce("_label", F.lit(fallback)).alias("label"))
