"""Per-id state that outlives the lookback window (AG14, C3).

The focus set of an id is the union of what its events ever said. A daily run
reads only its window of events, so the union is kept as a snapshot table, one
partition per day (``as_of``): the state of day d is the newest snapshot before
d merged with what the window's events say. A set union is idempotent, so the
whole window can be merged each day: late rows inside the window are taken in,
and a day that is run again gives the same snapshot.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.plans import features
from daybook.sources import partitioned as pt

COLUMNS = "id bigint, as_of date, focus_list array<string>"


def snapshot_table(path: str) -> pt.Table:
    return pt.table(path, COLUMNS, ["as_of"], ["id", "as_of"])


def before(spark: SparkSession, t: pt.Table, day: dt.date) -> DataFrame:
    """The newest snapshot older than day: id, focus_list; empty if there is none."""
    # partition values alone: no file is opened for the choice
    newest = spark.read.schema(t.schema).parquet(t.path).filter(F.col("as_of") < F.lit(day)).select("as_of").distinct() \
        .agg(F.max("as_of")).first()[0]
    rows = pt.read(spark, t).filter(F.col("as_of") == F.lit(newest)) if newest else pt.read(spark, t).filter(F.lit(False))
    return rows.select("id", "focus_list")


def merged(old: DataFrame, delta: DataFrame) -> DataFrame:
    """id, focus_list, user_focus of both, sorted and without repeats.

    One aggregate over old rows and delta rows, at most two for an id.
    """
    rows = old.select("id", "focus_list").unionByName(delta.select("id", "focus_list"))
    both = rows.groupBy("id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("focus_list")))).alias("focus_list"))
    return both.select("id", "focus_list",
                       F.when(F.size("focus_list") > 0, F.array_join("focus_list", ",")).alias("user_focus"))


def focus_as_of(spark: SparkSession, base: str, t: pt.Table, day: dt.date, events: DataFrame) -> DataFrame:
    """Focus of each id at day: the last snapshot and the window's events."""
    return merged(before(spark, t, day), features.focus_per_id(spark, base, events))


def keep(spark: SparkSession, t: pt.Table, day: dt.date, focus: DataFrame, run_at: str) -> None:
    """Write the snapshot of day."""
    pt.replace(spark, t, focus.select("id", F.lit(day).cast("date").alias("as_of"), "focus_list"), run_at)


def bootstrap(spark: SparkSession, base: str, t: pt.Table, day: dt.date, events: DataFrame) -> None:
    """The first snapshot, of all given events before day (one full read, once in a table's life)."""
    old = events.filter(F.col("ts") < F.lit(day.isoformat()).cast("timestamp_ntz"))
    keep(spark, t, day - dt.timedelta(days=1), features.focus_per_id(spark, base, old), f"{day} 00:00:00")
