"""Partition-wise writes: audit columns, files left alone, only touched partitions read, repeated and cut-off runs."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from daybook.plans import assemble, daily, features, history, job, state
from daybook.sources import partitioned as pt
from daybook.sources import writes

BASE = "/root/testdata/sf0.001"
RUNS = [f"2024-01-0{d} 01:00:00" for d in range(1, 6)]


def made(spark, tmp_path, columns="id bigint, day date, v string", key=("day", "id")):
    t = pt.table(str(tmp_path / "t"), columns, ["day"], list(key))
    pt.create_if_absent(spark, t)
    return t


def rows(spark, data, columns="id bigint, day date, v string"):
    return spark.createDataFrame([(i, d and dt.date(2024, 1, d), v) for i, d, v in data], columns)


def content(spark, t):
    return {(r.id, r.day and r.day.day): (r.v, r.created_at.day, r.last_modified_at.day, r.overwrite_count) for r in pt.read(spark, t).collect()}


def files(t):
    return {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{t.path}/*/part-*")}


def test_upsert_twice(spark, tmp_path):
    t = made(spark, tmp_path)
    assert pt.read(spark, t).count() == 0 and pt.read(spark, t).schema["overwrite_count"].dataType.simpleString() == "int"
    pt.upsert(spark, t, rows(spark, [(1, 1, "a"), (2, 1, "b"), (1, 2, "c"), (None, 2, "n"), (5, None, "p")]), RUNS[0])
    before = files(t)
    new = rows(spark, [(2, 1, "B"), (3, 1, "C")])
    pt.upsert(spark, t, new, RUNS[1])
    assert content(spark, t) == {(1, 1): ("a", 1, 1, 0), (2, 1): ("B", 1, 2, 1), (3, 1): ("C", 2, 2, 0), (1, 2): ("c", 1, 1, 0),
                                 (None, 2): ("n", 1, 1, 0), (5, None): ("p", 1, 1, 0)}
    pt.upsert(spark, t, new, RUNS[2])
    got = content(spark, t)
    assert got[2, 1] == ("B", 1, 3, 2) and got[3, 1] == ("C", 2, 3, 1) and got[1, 1] == ("a", 1, 1, 0) and len(got) == 6
    untouched = {p: m for p, m in before.items() if "day=2024-01-01" not in p}
    assert untouched and untouched == {p: m for p, m in files(t).items() if "day=2024-01-01" not in p}
    # null keys and the null partition meet their rows again
    pt.upsert(spark, t, rows(spark, [(None, 2, "N"), (5, None, "P")]), RUNS[3])
    got = content(spark, t)
    assert got[None, 2] == ("N", 1, 4, 1) and got[5, None] == ("P", 1, 4, 1) and len(got) == 6
    pt.create_if_absent(spark, t)
    assert content(spark, t) == got


def test_only_touched_partitions_are_read(spark, tmp_path):
    t = made(spark, tmp_path)
    pt.upsert(spark, t, rows(spark, [(1, 1, "a"), (1, 2, "b")]), RUNS[0])
    for p in glob.glob(f"{t.path}/day=2024-01-01/part-*"):
        with open(p, "wb") as f:
            f.write(b"no parquet")
    for p in glob.glob(f"{t.path}/day=2024-01-01/.part-*.crc"):
        os.remove(p)
    pt.upsert(spark, t, rows(spark, [(1, 2, "c"), (2, 3, "d")]), RUNS[1])
    pt.replace(spark, t, rows(spark, [(9, 2, "e")]), RUNS[2])
    late = pt.read(spark, t).filter(F.col("day") > dt.date(2024, 1, 1))
    assert sorted((r.id, r.v, r.overwrite_count) for r in late.collect()) == [(2, "d", 0), (9, "e", 0)]
    with pytest.raises(Exception, match="(?i)parquet"):
        pt.read(spark, t).collect()


def test_replace_carries_audit_columns(spark, tmp_path):
    t = made(spark, tmp_path)
    pt.replace(spark, t, rows(spark, [(1, 1, "a"), (2, 1, "b"), (1, 2, "c")]), RUNS[0])
    pt.replace(spark, t, rows(spark, [(2, 1, "B"), (3, 1, "C")]).drop("v"), RUNS[1])
    assert content(spark, t) == {(2, 1): (None, 1, 2, 1), (3, 1): (None, 2, 2, 0), (1, 2): ("c", 1, 1, 0)}


def test_a_swap_done_again_counts_once(spark, tmp_path):
    t = made(spark, tmp_path)
    pt.upsert(spark, t, rows(spark, [(1, 1, "a")]), RUNS[0])
    staged = pt.upsert(spark, t, rows(spark, [(1, 1, "b")]), RUNS[1])
    once = content(spark, t)
    pt.swap(spark, t, staged)
    assert content(spark, t) == once == {(1, 1): ("b", 1, 2, 1)}


def test_refused_and_empty_sources(spark, tmp_path):
    t = made(spark, tmp_path)
    assert pt.upsert(spark, t, rows(spark, []), RUNS[0]) is None and pt.replace(spark, t, rows(spark, []), RUNS[0]) is None
    with pytest.raises(ValueError, match="several rows"):
        pt.upsert(spark, t, rows(spark, [(1, 1, "a"), (1, 1, "b")]), RUNS[0])
    with pytest.raises(ValueError, match="no columns"):
        pt.upsert(spark, t, rows(spark, [(1, 1, "a")]).withColumn("w", F.lit(1)), RUNS[0])
    with pytest.raises(ValueError, match="key columns"):
        pt.upsert(spark, t, rows(spark, [(1, 1, "a")]).drop("id"), RUNS[0])
    with pytest.raises(ValueError):
        pt.table("x", "id bigint, day date", ["day"], ["id"])
    assert pt.read(spark, t).count() == 0


def test_evolved_columns(spark, tmp_path):
    t = made(spark, tmp_path)
    pt.upsert(spark, t, rows(spark, [(1, 1, "a"), (1, 2, "b")]), RUNS[0])
    wider = pt.evolved(t, "w int, v string")
    pt.upsert(spark, wider, rows(spark, [(1, 2, "c")]).withColumn("w", F.lit(7)), RUNS[1])
    assert sorted((r.day.day, r.v, r.w, r.overwrite_count) for r in pt.read(spark, wider).collect()) == [(1, "a", None, 0), (2, "c", 7, 1)]
    pt.upsert(spark, wider, rows(spark, [(1, 2, "d")]), RUNS[2])  # a run without the column keeps its value
    assert sorted((r.v, r.w) for r in pt.read(spark, wider).collect()) == [("a", None), ("d", 7)]
    with pytest.raises(ValueError):
        pt.evolved(t, "v int")


def plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


@pytest.fixture(scope="module")
def replayed(spark):
    store = job.new_store(spark)
    last = daily.last_event_day(spark, BASE)
    days = [last - dt.timedelta(days=1), last]
    job.seed(spark, BASE, store, days[1])  # writes the history of the days before
    seen = [{t.path: files(t) for t in (store.history, store.output, store.focus)}]
    for day in [days[1], days[1]]:
        job.run_day(spark, BASE, store, day, f"{day} 23:00:00")
        seen.append({t.path: files(t) for t in (store.history, store.output, store.focus)})
    return store, days, seen


def test_each_day_writes_its_own_partitions(spark, replayed):
    store, days, seen = replayed
    for one, two in zip(seen, seen[1:], strict=False):
        for path, after in two.items():
            assert {p: m for p, m in one[path].items() if str(days[1]) not in p} == {
                p: m for p, m in after.items() if str(days[1]) not in p}
    assert "message_date" in plan(job.history_before(spark, store.history, days[1])).split("PartitionFilters")[1].split("\n")[0]


def test_a_day_run_again(spark, replayed):
    store, days, _ = replayed
    counts = {(r.message_date, r.overwrite_count) for r in pt.read(spark, store.history).filter(
        F.col("message_date") >= days[0]).select("message_date", "overwrite_count").distinct().collect()}
    assert counts == {(days[0], 0), (days[1], 1)}
    counts.remove((days[0], 0))
    out = pt.read(spark, store.output)
    assert out.filter("insight is null").count() == 0
    assert {(r[0], r[1]) for r in out.select("insight_date", "overwrite_count").distinct().collect()} == counts
    want = daily.report_day_result(spark, BASE, days[1], snapshot=store.focus).count()
    assert out.filter(F.col("insight_date") == days[1]).count() == want
    wide = spark.read.parquet(f"{store.root}/features").filter(F.col("report_date") == days[1])
    assert wide.count() == want and {r[0] for r in wide.select("overwrite_count").collect()} == {1}


def test_snapshot_and_window_keep_every_focus(spark):
    store = job.new_store(spark)
    day = daily.last_event_day(spark, BASE)
    job.seed_focus(spark, BASE, store, day, 5)
    events = daily.pruned_events(spark, BASE, day, 5)
    focus = state.focus_as_of(spark, BASE, store.focus, day, events)
    full = {r.id: r.user_focus for r in features.focus_per_id(spark, BASE).collect()}
    assert {r.id: r.user_focus for r in focus.collect()} == full
    window = {r.id for r in features.focus_per_id(spark, BASE, events).collect()}
    assert len(window) < len(full)
    # a day that is run again, and the next day, start from snapshots that lose nothing
    for d in (day, day, day + dt.timedelta(days=1)):
        state.keep(spark, store.focus, d, state.focus_as_of(spark, BASE, store.focus, d, events), RUNS[0])
    assert {r.id: ",".join(r.focus_list) for r in state.before(spark, store.focus, day + dt.timedelta(days=2)).collect()} == full
    # no event outside the window is read
    wide = assemble.daily_wide(spark, BASE, events=events, report_day=day, focus=focus)
    scans = [x for x in plan(wide).split("Scan parquet")[1:] if "events.parquet" in x.split("\n\n")[0]]
    assert scans and all("GreaterThanOrEqual(ts," in x.split("\n\n")[0] for x in scans)


def test_history_categories():
    assert {k.split("_")[0] for k, _ in history.K.ACTION_CATEGORY_PREFIXES} >= {"food", "mental", "exercise", "med", "explore"}


def test_writes_go_where_told(spark):
    assert writes.new_table_path(spark, "a") != writes.new_table_path(spark, "a")
