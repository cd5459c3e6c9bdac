"""Local-date arithmetic (B1-B3, B5) without session-zone dependence.

Timestamps are TIMESTAMP_NTZ in UTC with a separate minute offset column.
Local time is ``ts + offset minutes`` by interval arithmetic, so daylight
saving changes in the session zone cannot shift a day (D9); day ordering for
range frames uses ``unix_date`` (D10).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def local_ts(ts, offset_minutes) -> Column:
    """B1/B2: UTC NTZ timestamp shifted by an offset in minutes."""
    return col_(ts) + F.make_dt_interval(F.lit(0), F.lit(0), col_(offset_minutes).cast("int"),
                                         F.lit(0))


def local_date(ts, offset_minutes) -> Column:
    """B1: local calendar date of a UTC timestamp."""
    return F.to_date(local_ts(ts, offset_minutes))


def epoch_millis(ts) -> Column:
    """Milliseconds since the epoch of an NTZ timestamp (zone free)."""
    return F.expr(f"timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {ts})") \
        if isinstance(ts, str) else F.timestamp_diff("MILLISECOND", F.lit("1970-01-01").cast("timestamp_ntz"), ts)


def date_from_epoch_millis(ms) -> Column:
    """UTC date of an epoch-millisecond value, no session zone involved."""
    return F.date_from_unix_date(F.floor(col_(ms) / F.lit(86400000)).cast("int"))


def day_number(day) -> Column:
    """Integer day for RANGE frames (calendar days, not seconds)."""
    return F.unix_date(col_(day))


def lookback_filter(ts_col: str, feature_date, days: int) -> Column:
    """Raw-column predicate ``ts >= feature_date - days`` (pushed to parquet).

    Written on the raw column against a literal so the scan can use row-group
    statistics; never wrapped in a conversion.
    """
    start = F.lit(feature_date).cast("date") - F.expr(f"INTERVAL {int(days)} DAYS")
    return F.col(ts_col) >= start.cast("timestamp_ntz")


def lookback_any(ts_cols: list[str], feature_date, days: int) -> Column:
    """B5, several columns: any of them inside the window. A disjunction of raw
    columns against one literal, which is pushed to the scan as such."""
    each = [lookback_filter(x, feature_date, days) for x in ts_cols]
    out = each[0]
    for x in each[1:]:
        out = out | x
    return out
