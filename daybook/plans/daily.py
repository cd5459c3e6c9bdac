"""The daily production run: one report day, pruned reads, early day filter.

The registered queries compute every day of the given tables. A scheduled
run needs one report day d, so:
  * events are read with ``ts >= d - lookback`` and ``ts < d + 2`` on the raw
    column (B5/O1): the predicate reaches the parquet scan (PushedFilters), so
    only the lookback window of a multi-year table is read (a local day can
    start up to a day away from its UTC timestamp, hence the margins);
  * the feature frame is filtered to d right after the window stage, before
    the dimension joins (O3);
  * the history is pruned to the 7 days the state reads;
  * the focus of an id, which has no date, comes from a snapshot and the window.
The result is the same as the all-days computation restricted to d whenever
no feature reaches further back than the lookback (the original's design).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions import constants as K
from daybook.plans import assemble, history, render, select, state
from daybook.sources import partitioned as pt
from daybook.sources.tables import load
from daybook.plans.roles import EVENT_COLS


def pruned_events(spark: SparkSession, base: str, report_day: dt.date, lookback_days: int,
                  source: DataFrame | None = None) -> DataFrame:
    """The window's events, of ``source`` (events read before) or of the table."""
    events = load(spark, base, "events", EVENT_COLS) if source is None else source
    lo = dt.datetime.combine(report_day - dt.timedelta(days=lookback_days + 1), dt.time())
    hi = dt.datetime.combine(report_day + dt.timedelta(days=2), dt.time())
    ts = F.col("ts")
    # string literals: a Python datetime literal would pass through the process time zone
    lo_lit = F.lit(lo.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    hi_lit = F.lit(hi.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    return events.filter((ts >= lo_lit) & (ts < hi_lit))


def messages(result: DataFrame) -> DataFrame:
    """The picked texts put together."""
    return result.withColumn("message_text", render.message_text(F.col("greeting"), F.col("action_texts"),
                                                                 F.col("opportunity_text")))


def report_day_result(spark: SparkSession, base: str, report_day: dt.date,
                      lookback_days: int = K.LOOKBACK_DAYS, snapshot: pt.Table | None = None) -> DataFrame:
    """The report day's messages. ``snapshot`` holds the focus of events before
    the window (``state``); without it the focus is read from all events."""
    ev = pruned_events(spark, base, report_day, lookback_days)
    focus = state.focus_as_of(spark, base, snapshot, report_day, ev) if snapshot else None
    ctx = assemble.rule_inputs(assemble.daily_wide(spark, base, ev, report_day, focus))
    hist = history.history_from_events(spark, base, events=ev).filter(
        F.col("message_date").between(F.lit(report_day - dt.timedelta(days=7)), F.lit(report_day - dt.timedelta(days=1))))
    past = history.history_state(hist).filter(F.col("day") == F.lit(report_day))
    return messages(select.daily_result(spark, base, ctx=select.with_history(ctx, past)))


def last_event_day(spark: SparkSession, base: str) -> dt.date:
    """UTC date of the newest event (one scalar; a scheduler passes the date instead)."""
    return load(spark, base, "events", ["ts"]).agg(F.max("ts")).first()[0].date()
