"""The daily job with its tables: features, output, history and the focus snapshot.

``run_day`` is one scheduled run. It reads the events of the lookback window
(pushed to the scan), the seven history partitions before the day and the last
snapshot, and writes one partition of each table:

* features, replaced with audit columns carried over (A5 A7 A9), read back for
  the rules by its partition (A3), so the rule plan starts from a written table;
* output and history, upserted by key (A6);
* the snapshot of the day (AG14).

A run can be repeated: it gives the same rows with one overwrite more.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions import constants as K
from daybook.plans import assemble, daily, history, render, roles, select, state
from daybook.sources import partitioned as pt
from daybook.sources import writes
from daybook.sources.tables import check_sources, load
from daybook.plans.roles import EVENT_COLS

HISTORY = ("id bigint, category string, message_date date, message_text string, rating string, positive_actions_used array<string>, "
           "opportunity_used string, character_count int, word_count int")
OUTPUT = "id bigint, insight_date date, insight string, score_name string, generated_at timestamp_ntz"


#: Without these no run starts; goals (customer) may be absent.
REQUIRED = ("events", "orders", "lineitem", "part")


@dataclass(frozen=True)
class Store:
    """Where a job's tables are. The feature table gets its columns from the first run."""

    root: str

    @property
    def history(self) -> pt.Table:
        return pt.table(f"{self.root}/history", HISTORY, ["message_date"], ["id", "category", "message_date"])

    @property
    def output(self) -> pt.Table:
        return pt.table(f"{self.root}/output", OUTPUT, ["insight_date"], ["id", "insight_date"])

    @property
    def focus(self) -> pt.Table:
        return state.snapshot_table(f"{self.root}/focus")

    def features(self, wide: DataFrame) -> pt.Table:
        schema = wide.withColumnRenamed("day", "report_date").withColumn("feature_version", F.lit("")).schema
        return pt.table(f"{self.root}/features", schema, ["report_date"], ["id", "report_date"])


def new_store(spark: SparkSession) -> Store:
    """Empty tables in a new folder of the shared folder."""
    store = Store(writes.new_table_path(spark, "daily-job"))
    for t in (store.history, store.output, store.focus):
        pt.create_if_absent(spark, t)
    return store


def history_before(spark: SparkSession, t: pt.Table, day: dt.date, days: int = 7) -> DataFrame:
    """The history partitions day-days .. day-1 and no other."""
    span = F.col("message_date").between(F.lit(day - dt.timedelta(days=days)), F.lit(day - dt.timedelta(days=1)))
    return pt.read(spark, t).filter(span)


@dataclass(frozen=True)
class Sources:
    """What several runs over the same tables share: the events of all their windows with parsed props, and the
    dimensions without a date, each written once."""

    events: DataFrame
    dims: assemble.Dims


def read_once(spark: SparkSession, base: str, first: dt.date, last: dt.date, lookback_days: int = K.LOOKBACK_DAYS) -> Sources:
    """The sources of the runs of first .. last; each run still reads its own window of them."""
    check_sources(spark, base, REQUIRED)
    path = writes.new_table_path(spark, "window-events")
    span = daily.pruned_events(spark, base, last, lookback_days + (last - first).days)
    roles.with_parsed_props(span).write.parquet(path)
    return Sources(spark.read.parquet(path), assemble.written_dims(spark, base))


def seed_focus(spark: SparkSession, base: str, store: Store, day: dt.date, lookback_days: int = K.LOOKBACK_DAYS) -> None:
    """The snapshot as earlier runs would have left it: the focus of the events before day's window."""
    events = load(spark, base, "events", EVENT_COLS)
    state.bootstrap(spark, base, store.focus, day - dt.timedelta(days=lookback_days + 1), events)


def seed(spark: SparkSession, base: str, store: Store, day: dt.date, lookback_days: int = K.LOOKBACK_DAYS) -> None:
    """Snapshot and the history of the seven days before day, for tables that have no past."""
    # the events of these messages: their local days are day-8 .. day-2, a local day starts up to two days from its UTC date
    past = history.history_from_events(spark, base, daily.pruned_events(spark, base, day, 9)).filter(
        F.col("message_date").between(F.lit(day - dt.timedelta(days=7)), F.lit(day - dt.timedelta(days=1))))
    pt.replace(spark, store.history, past, f"{day} 00:00:00")
    seed_focus(spark, base, store, day, lookback_days)


def run_day(spark: SparkSession, base: str, store: Store, day: dt.date, run_at: str,
            lookback_days: int = K.LOOKBACK_DAYS, version: str = "1", sources: Sources | None = None) -> None:
    """One report day: check the sources, read the window, write the day's partition of each table.

    ``sources`` are those of several runs, read before."""
    check_sources(spark, base, REQUIRED)
    events = daily.pruned_events(spark, base, day, lookback_days, sources.events if sources else None)
    focus_path = writes.new_table_path(spark, "focus")
    state.focus_as_of(spark, base, store.focus, day, events).write.parquet(focus_path)
    focus = spark.read.parquet(focus_path)
    state.keep(spark, store.focus, day, focus, run_at)

    wide = assemble.daily_wide(spark, base, events=events, report_day=day, focus=focus, dims=sources.dims if sources else None)
    features = store.features(wide)
    pt.create_if_absent(spark, features)
    pt.replace(spark, features, wide.withColumnRenamed("day", "report_date").withColumn("feature_version", F.lit(version)), run_at)

    rows = pt.read(spark, features).filter(F.col("report_date") == F.lit(day)).withColumnRenamed("report_date", "day")
    past = history.history_state(history_before(spark, store.history, day)).filter(F.col("day") == F.lit(day))
    result_path = writes.new_table_path(spark, "result")
    daily.messages(select.daily_result(spark, base, ctx=select.with_history(assemble.rule_inputs(rows), past))).write.parquet(result_path)
    result = spark.read.parquet(result_path)
    pt.upsert(spark, store.output, result.select(
        "id", F.col("day").alias("insight_date"), F.col("message_text").alias("insight"), F.col("rating").alias("score_name"),
        F.lit(run_at).cast("timestamp_ntz").alias("generated_at")), run_at)
    pt.upsert(spark, store.history, history.result_to_history(result), run_at)
