"""The features of one day against the rows of that day on the dense spine; what a replayed day reads."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from daybook.plans import assemble, daily, features, job

BASE = "/root/testdata/sf0.001"
DAY = dt.date(2024, 3, 20)
KINDS = ["view", "click", "purchase", "signup", "error"]


@pytest.fixture(scope="module")
def events(spark):
    """Ids with every day, with gaps, with one old day, with days after the report day alone, and rows with nulls."""
    rnd = random.Random(5)
    rows = []
    for user in range(12):
        for back in range(-1, 36):
            if user == 10 and back != 30 or user == 11 and back >= 0 or rnd.random() < 0.1 * user and user < 10:
                continue
            for _ in range(1 + user % 3):
                ts = dt.datetime.combine(DAY, dt.time()) - dt.timedelta(days=back, seconds=-rnd.randrange(86400))
                rows.append((ts, user if user else None, rnd.choice(KINDS), rnd.choice([None, rnd.random() * 490]) if user == 3 else rnd.random() * 490,
                             None if user == 4 and back % 5 == 0 else f'{{"k": {rnd.randrange(-60, 400) if user == 5 else rnd.randrange(400)}}}'))
    return spark.createDataFrame(rows, "ts timestamp_ntz, user_id bigint, event_type string, value double, props string")


def near(v):
    return round(v, 9) if isinstance(v, float) else v


@pytest.mark.parametrize("back", [0, 1, 9])
def test_features_of_day_are_the_spine_rows_of_that_day(spark, events, back):
    day = DAY - dt.timedelta(days=back)
    # positive k alone: the spine form looks a meal type up by k
    given = events.filter("user_id is null or user_id <> 5")
    got = features.features_of_day(spark, BASE, day, events=given)
    want = features.daily_features(spark, BASE, events=given, last_day=day).filter(F.col("day") == F.lit(day))
    assert got.columns == want.columns and [f.dataType for f in got.schema] == [f.dataType for f in want.schema]

    def rows(df):
        return sorted((tuple(near(v) for v in r) for r in df.collect()), key=repr)
    assert rows(got) == rows(want)
    assert got.count() == 10  # id 11 has later days alone


def test_variety_counts_distinct_codes(spark):
    df = spark.createDataFrame([(1, 3), (1, 3), (1, -3), (1, 12), (2, None), (3, 0)], "g int, c int")
    got = {r.g: r.n for r in df.groupBy("g").agg(features._variety(F.col("c")).alias("n")).collect()}
    assert got == {1: 3, 2: 0, 3: 1}


def test_a_replayed_day_reads_no_source_table_again(spark):
    last = daily.last_event_day(spark, BASE)
    shared = job.read_once(spark, BASE, last - dt.timedelta(days=1), last)
    events = daily.pruned_events(spark, BASE, last, 36, shared.events)
    focus = features.focus_per_id(spark, BASE, events)
    wide = assemble.daily_wide(spark, BASE, events=events, report_day=last, focus=focus, dims=shared.dims)
    files = {f.rsplit("/", 2)[-1] for f in wide.inputFiles() if f.startswith(f"file://{BASE}")}
    assert not files, files
    own = assemble.daily_wide(spark, BASE, events=daily.pruned_events(spark, BASE, last, 36), report_day=last, focus=focus)
    assert wide.columns == own.columns
    some = ["id", "day", "active_prescription_count", "adherence_7d_avg", "video_total", "weight_goal_type", "steps", "steps_avg_7d"]
    assert sorted(map(repr, wide.select(*some).collect())) == sorted(map(repr, own.select(*some).collect()))
