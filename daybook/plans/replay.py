"""Multi-day replay (J3): day n+1 reads the history written on day n.

The days are runs of the daily job (``job.run_day``) on tables of their own: each
reads the events of its window and the seven history partitions before its day,
and writes one new partition of history, output, features and snapshot. No
other day's files are touched, and a day that is run again is an upsert.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.plans import daily, job
from daybook.sources import partitioned as pt


def replay(spark: SparkSession, base: str, days: int = 3, start: str | None = None,
           store: job.Store | None = None) -> DataFrame:
    """Run ``days`` report days in sequence (default: the last ones of the data); the history rows written for them.

    Spark 4.1 with AQE can fail a day's plan ("Can't zip RDDs with unequal
    numbers of partitions") when a union's output partitioning is reused by a
    join; the union-partitioning shortcut is switched off for the replay and
    restored afterwards.
    """
    key = "spark.sql.unionOutputPartitioning"
    old = spark.conf.get(key, None)
    try:
        spark.conf.set(key, "false")
        last = daily.last_event_day(spark, base)
        first = dt.date.fromisoformat(start) if start else last - dt.timedelta(days=days - 1)
        store = store or job.new_store(spark)
        job.seed(spark, base, store, first)
        sources = job.read_once(spark, base, first, first + dt.timedelta(days=days - 1))
        for i in range(days):
            day = first + dt.timedelta(days=i)
            job.run_day(spark, base, store, day, f"{day + dt.timedelta(days=1)} 01:00:00", sources=sources)
    finally:
        if old is not None:
            spark.conf.set(key, old)
    return pt.read(spark, store.history).filter(F.col("message_date") >= F.lit(first))
