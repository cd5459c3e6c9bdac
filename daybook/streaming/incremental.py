"""Incremental daily aggregates with Structured Streaming.

The reference handles late data by recomputing a day and overwriting its
partition. As a stream: new event files arrive in a folder; each micro-batch
finds the (local) days it touches, recomputes the per-(id, day) aggregates of
exactly those days from the full event folder, and replaces those day
partitions (dynamic overwrite). Rolling features are derived from the daily
table at read time, so they see every correction.

The touched-day set is bounded by the calendar span of a batch, so the
semi join that restricts the recompute broadcasts a small, bounded table.
Offsets and the file log live in the checkpoint location, so a restarted or
failed batch is replayed; the partition overwrite makes a replay idempotent.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.plans import features, roles
from daybook.sources.writes import overwrite_partitions

EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
# intervals end up to a day after they start; a touched day also refreshes the next one
DAY_SPILL = 1


def touched_days(batch: DataFrame) -> DataFrame:
    ev = roles.events_base(batch.sparkSession, "", batch)
    days = ev.select("day").distinct()
    spill = days.select(F.explode(F.sequence(F.date_sub("day", 1), F.date_add("day", DAY_SPILL))).alias("day"))
    return spill.distinct()


def recompute_days(spark: SparkSession, events_dir: str, days: DataFrame) -> DataFrame:
    """Daily aggregates of the given days, computed from every event that can fall on them."""
    low, high = days.agg(F.min("day"), F.max("day")).first()
    # two days of slack: time zone offsets and intervals that begin the day before
    ts = F.col("ts")
    full = spark.read.schema(EVENT_SCHEMA).parquet(events_dir).filter(
        (ts >= F.lit(str(low - dt.timedelta(days=2))).cast("timestamp_ntz"))
        & (ts < F.lit(str(high + dt.timedelta(days=3))).cast("timestamp_ntz")))
    agg = features.daily_event_aggregates(spark, "", events=full)
    return agg.join(F.broadcast(days), "day", "left_semi")


def start(spark: SparkSession, events_dir: str, out_path: str, checkpoint: str, available_now: bool = True):
    """Start the stream; with ``available_now`` it processes what is there and stops."""
    def each_batch(batch: DataFrame, epoch_id: int) -> None:
        if batch.isEmpty():
            return
        days = touched_days(batch).cache()
        try:
            out = recompute_days(spark, events_dir, days)
            overwrite_partitions(out, out_path, ["day"])
        finally:
            days.unpersist()

    stream = spark.readStream.schema(EVENT_SCHEMA).parquet(events_dir)
    writer = stream.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
