"""Per-key ordered-day operators.

All of these run on one row per (id, day). They share one window spec
(partition by id, order by day), so Catalyst evaluates them in a single
Window operator after one exchange on id. A partition holds one entity's
days, which the calendar bounds, however many raw events the entity has.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from daybook.functions.exprs import flag
from daybook.functions.timeutil import col_, day_number


def by_day(id_col: str = "id", day_col: str = "day") -> WindowSpec:
    return Window.partitionBy(id_col).orderBy(day_col)


def range_days(n: int, id_col: str = "id", day_col: str = "day") -> WindowSpec:
    """Calendar frame of the last n days including today (RANGE, not ROWS: D1, D10)."""
    return Window.partitionBy(id_col).orderBy(day_number(day_col)).rangeBetween(-(n - 1), 0)


def rows_back(n: int, id_col: str = "id", day_col: str = "day") -> WindowSpec:
    """The reference's ROWS frame (last n logged rows, any age); kept for the D1 comparison."""
    return Window.partitionBy(id_col).orderBy(day_col).rowsBetween(-(n - 1), 0)


def gap_fill(df: DataFrame, id_col: str = "id", day_col: str = "day",
             flag_col: str = "is_logged", last_day: Column | None = None) -> DataFrame:
    """Dense id x day spine from each id's first logged day to ``last_day``
    (its own last logged day if that is later or no day is given), so a silent
    id still has a row on the report day.

    Each logged row emits itself plus the empty days up to the next logged
    row (``lead`` + ``explode(sequence)``), so no cross join and no global
    aggregate is needed. Output stays partitioned by id, so following windows
    on the same id reuse the exchange. Emitted gap rows carry NULL measures.
    """
    nxt = F.lead(day_col).over(by_day(id_col, day_col))
    measures = [c for c in df.columns if c not in (id_col, day_col)]
    with_next = df.withColumn("_next", nxt)
    end = F.col(day_col) if last_day is None else F.greatest(F.col(day_col), last_day)
    exploded = with_next.select(
        id_col, day_col, *measures,
        F.explode(F.sequence(F.col(day_col),
                             F.coalesce(F.date_sub(F.col("_next"), 1), end))).alias("_d"))
    logged = F.col("_d") == F.col(day_col)
    return exploded.select(
        id_col, F.col("_d").alias(day_col), logged.alias(flag_col),
        *[F.when(logged, F.col(c)).alias(c) for c in measures])


def prev_logged(c, id_col: str = "id", day_col: str = "day") -> Column:
    """Value on the previous day that had a value (any distance back)."""
    w = by_day(id_col, day_col).rowsBetween(Window.unboundedPreceding, -1)
    return F.last(col_(c), ignorenulls=True).over(w)


def prev_calendar_day(c, id_col: str = "id", day_col: str = "day") -> Column:
    """D3: value exactly one calendar day earlier (dense spine: lag 1)."""
    return F.lag(col_(c), 1).over(by_day(id_col, day_col))


def rolling(fn, c, days: int, id_col: str = "id", day_col: str = "day") -> Column:
    """Aggregate over the last ``days`` calendar days."""
    return fn(col_(c)).over(range_days(days, id_col, day_col))


def any_in_last(c, days: int, id_col: str = "id", day_col: str = "day") -> Column:
    """E5: 1 when the count column is > 0 on any of the last ``days`` days."""
    s = F.sum(F.coalesce(col_(c), F.lit(0))).over(range_days(days, id_col, day_col))
    return F.when(s > 0, F.lit(1)).otherwise(F.lit(0))


def days_with(cond, days: int, id_col: str = "id", day_col: str = "day") -> Column:
    """On how many of the last ``days`` calendar days the condition holds."""
    return F.sum(flag(col_(cond))).over(range_days(days, id_col, day_col))


def days_since(logged, id_col: str = "id", day_col: str = "day") -> Column:
    """Days from the latest day with ``logged`` true up to this day (0 on that day)."""
    w = by_day(id_col, day_col).rowsBetween(Window.unboundedPreceding, 0)
    last_day = F.max(F.when(col_(logged), F.col(day_col))).over(w)
    return F.datediff(F.col(day_col), last_day)


def band_offsets(center: int, lo: int, hi: int) -> list[int]:
    """Offsets of the as-of band in preference order: nearest to center, then newer."""
    return sorted(range(lo, hi + 1), key=lambda d: (abs(d - center), d))


def nearest_in_band(c, center: int = 14, lo: int = 10, hi: int = 18,
                    id_col: str = "id", day_col: str = "day") -> tuple[Column, Column]:
    """(value, days back) of the row ``lo..hi`` days earlier nearest to ``center``.

    Needs the dense spine (one row per calendar day), where ``lag(k)`` is the
    day k days back. Ties (13 vs 15) go to the newer day (D11). No self join;
    at most ``hi - lo + 1`` lags, all in the same Window operator.
    """
    w = by_day(id_col, day_col)
    offs = band_offsets(center, lo, hi)
    value = F.coalesce(*[F.lag(col_(c), k).over(w) for k in offs])
    back = F.coalesce(*[F.when(F.lag(col_(c), k).over(w).isNotNull(), F.lit(k)) for k in offs])
    return value, back


def pct_change(cur, prev) -> Column:
    """Percent change vs a previous value, NULL unless prev > 0."""
    return F.when(col_(prev) > 0, (col_(cur) - col_(prev)) / col_(prev) * F.lit(100.0))


@dataclass(frozen=True)
class AtDay:
    """The operators above for one day of each id: aggregates over its logged rows up to that day.

    A groupBy of the id over rows up to ``date`` gives what the window
    forms give on the dense spine's row of that day, without the spine: a day
    without a row adds nothing to a sum, and lags are rows of a given day.
    """

    date: dt.date
    day_col: str = "day"

    @property
    def day(self) -> Column:
        return F.lit(self.date).cast("date")

    def on(self, c, back: int = 0) -> Column:
        """The value on the day ``back`` days earlier (at most one row)."""
        return F.max(F.when(F.col(self.day_col) == F.date_sub(self.day, back), col_(c)))

    def _in_last(self, days: int) -> Column:
        return F.col(self.day_col) > F.date_sub(self.day, days)

    def prev_logged(self, c) -> Column:
        earlier = col_(c).isNotNull() & (F.col(self.day_col) < self.day)
        return F.max_by(col_(c), F.when(earlier, F.col(self.day_col)))

    def prev_calendar_day(self, c) -> Column:
        return self.on(c, 1)

    def rolling(self, fn, c, days: int) -> Column:
        return fn(F.when(self._in_last(days), col_(c)))

    def any_in_last(self, c, days: int) -> Column:
        s = F.sum(F.when(self._in_last(days), F.coalesce(col_(c), F.lit(0))))
        return F.when(s > 0, F.lit(1)).otherwise(F.lit(0))

    def days_with(self, cond, days: int) -> Column:
        return F.coalesce(F.sum(F.when(self._in_last(days), flag(col_(cond)))), F.lit(0))

    def days_since(self, logged) -> Column:
        return F.datediff(self.day, F.max(F.when(col_(logged), F.col(self.day_col))))

    def nearest_in_band(self, c, center: int = 14, lo: int = 10, hi: int = 18) -> tuple[Column, Column]:
        offs = band_offsets(center, lo, hi)
        return (F.coalesce(*[self.on(c, k) for k in offs]),
                F.coalesce(*[F.when(self.on(c, k).isNotNull(), F.lit(k)) for k in offs]))
