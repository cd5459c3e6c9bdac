"""Operator tests against brute force on small hand-made frames (boundary cases)."""

import datetime as dt
import random

from pyspark.sql import functions as F

from daybook.operators.intervals import union_length_micros
from daybook.operators.windows import band_offsets, gap_fill, nearest_in_band
from daybook.plans import history


def _ts(m):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m)


def test_interval_union_matches_sweep(spark):
    rnd = random.Random(7)
    rows, truth = [], {}
    for g in range(60):
        ivs = []
        for _ in range(rnd.randint(1, 8)):
            s = rnd.randint(0, 600)
            e = s + rnd.choice([0, 5, 30, 90, 200, 400])
            ivs.append((s, e))
            rows.append((g, _ts(s), _ts(e)))
        # brute force: sweep of sorted intervals (touching merges)
        tot, cur_s, cur_e = 0, None, None
        for s, e in sorted(ivs):
            if e <= s:
                continue
            if cur_e is None or s > cur_e:
                if cur_e is not None:
                    tot += cur_e - cur_s
                cur_s, cur_e = s, e
            else:
                cur_e = max(cur_e, e)
        if cur_e is not None:
            tot += cur_e - cur_s
        truth[g] = tot * 60_000_000
    df = spark.createDataFrame(rows, "g int, s timestamp_ntz, e timestamp_ntz")
    for bucket in (15, 60, 240):
        got = {r.g: r.union_us for r in union_length_micros(df, ["g"], "s", "e", bucket).collect()}
        assert {g: got.get(g, 0) for g in truth} == truth


def test_band_prefers_nearest_then_newer():
    assert band_offsets(14, 10, 18)[:3] == [14, 13, 15]


def test_nearest_in_band_on_spine(spark):
    # weights on days 0 (100) and 2 (102); on day 15 both are 15 and 13 days back -> 13 (newer) wins
    rows = [(1, dt.date(2024, 1, 1) + dt.timedelta(days=d), w) for d, w in [(0, 100.0), (2, 102.0), (16, 90.0)]]
    df = gap_fill(spark.createDataFrame(rows, "id long, day date, weight double"))
    v, back = nearest_in_band("weight")
    out = {r.day: (r.v, r.b) for r in df.select("day", v.alias("v"), back.alias("b")).collect()}
    assert out[dt.date(2024, 1, 16)] == (102.0, 13)
    assert out[dt.date(2024, 1, 12)] == (100.0, 11)
    assert out[dt.date(2024, 1, 10)] == (None, None)


def test_gap_fill_dense_and_flags(spark):
    rows = [(1, dt.date(2024, 1, 1), 5.0), (1, dt.date(2024, 1, 5), 7.0), (2, dt.date(2024, 1, 3), 1.0)]
    out = gap_fill(spark.createDataFrame(rows, "id long, day date, x double")).orderBy("id", "day").collect()
    assert [(r.id, r.day.day, r.is_logged, r.x) for r in out] == [
        (1, 1, True, 5.0), (1, 2, False, None), (1, 3, False, None), (1, 4, False, None), (1, 5, True, 7.0),
        (2, 3, True, 1.0)]


def test_streak_is_consecutive_days_ending_yesterday(spark):
    d0 = dt.date(2024, 1, 10)
    rows = [(1, "sleep", d0 - dt.timedelta(days=k), ["sleep_hours_met"], None) for k in (1, 2, 3, 5)]
    rows += [(1, "glucose", d0 - dt.timedelta(days=2), ["glucose_tir_met"], None)]
    h = spark.createDataFrame(rows, "id long, category string, message_date date, "
                                    "positive_actions_used array<string>, opportunity_used string")
    st = {(r.category, r.day): r.streak for r in history.category_streaks(h).collect()}
    assert st[("sleep", d0)] == 3
    assert st[("glucose", d0)] == 0
    assert st[("sleep", d0 - dt.timedelta(days=3))] == 0 or ("sleep", d0 - dt.timedelta(days=3)) in st
