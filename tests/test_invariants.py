"""Invariants and golden samples (survey section 5)."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from daybook.functions import constants as K
from daybook.operators.windows import gap_fill, prev_logged, range_days, rows_back
from daybook.plans import score, select
from daybook.sources import writes

BASE = "/root/testdata/sf0.001"


def test_golden_week_minutes(spark):
    # seven-day sample: minutes 25, 29, 20, 22, 20 on consecutive days
    days = [dt.date(2026, 4, 2) + dt.timedelta(days=i) for i in range(5)]
    df = spark.createDataFrame(list(zip([1] * 5, days, [25.0, 29.0, 20.0, 22.0, 20.0])),
                               "id long, day date, m double")
    out = df.select("day", F.sum("m").over(range_days(7)).alias("s"),
                    (F.col("m") - prev_logged("m")).alias("d")).orderBy("day").collect()
    assert out[-1].s == 116.0
    assert [r.d for r in out[1:]] == [4.0, -9.0, 2.0, -2.0]


def test_rows_vs_range_on_sparse_days(spark):
    # a 19-day gap inside a 7-row window: calendar sum 5, row sum 15
    rows = [(1, dt.date(2024, 1, d), 1.0) for d in range(1, 11)] + [(1, dt.date(2024, 1, 30), 5.0)]
    df = spark.createDataFrame(rows, "id long, day date, x double")
    r = df.select("day", F.sum("x").over(range_days(7)).alias("cal"),
                  F.sum("x").over(rows_back(7)).alias("rows")).filter("day = '2024-01-30'").first()
    assert (r.cal, r.rows) == (5.0, 11.0)


def test_score_example_tier(spark):
    # 34 of 50 plus 3 bonus -> 74 % -> Strong
    df = spark.createDataFrame([(37, 50)], "score int, max_score int")
    pct = F.col("score") * F.lit(100.0) / F.col("max_score")
    r = df.select(pct.alias("p"), score.tier(pct).alias("t")).first()
    assert round(r.p) == 74 and r.t == "Strong"
    assert df.select(score.tier(F.lit(0.0)).alias("t")).first().t == K.TIERS[-1][0]


def test_array_remove_null_is_null_compact_is_not(spark):
    r = spark.range(1).select(
        F.array_remove(F.array(F.lit("A"), F.lit(None).cast("string")), F.lit(None).cast("string")).alias("rm"),
        F.array_compact(F.array(F.lit("A"), F.lit(None).cast("string"))).alias("cp")).first()
    assert r.rm is None and r.cp == ["A"]


def test_partition_overwrite_is_idempotent(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="daybook-ow-"), "t")
    o = spark.read.parquet(f"{BASE}/orders.parquet").select("o_orderkey", "o_orderstatus")
    writes.overwrite_partitions(o, path, ["o_orderstatus"])
    once = spark.read.parquet(path).count()
    writes.overwrite_partitions(o, path, ["o_orderstatus"])
    assert spark.read.parquet(path).count() == once == o.count()


def test_upsert_twice_equals_once_plus_count(spark):
    o = spark.read.parquet(f"{BASE}/orders.parquet").select("o_orderkey", "o_totalprice")
    t = writes.with_audit(o.filter("o_orderkey % 2 = 0"), "2024-01-01")
    once = writes.upsert(t, o, ["o_orderkey"], "2024-01-02")
    twice = writes.upsert(once, o, ["o_orderkey"], "2024-01-03")
    a = {r.o_orderkey: r for r in once.collect()}
    b = {r.o_orderkey: r for r in twice.collect()}
    assert set(a) == set(b)
    assert all(b[k].overwrite_count == a[k].overwrite_count + 1 and b[k].o_totalprice == a[k].o_totalprice
               and b[k].created_at == a[k].created_at for k in a)


def test_selection_bounds(spark):
    res = select.daily_result(spark, BASE)
    rows = res.select("actions").collect()
    for r in rows:
        acts = r.actions
        free = [a for a in acts if a.tier == 2]
        assert len(free) <= K.MAX_POSITIVE_ACTIONS
        assert len(acts) >= 1
        cats = [a.category for a in acts]
        # a category repeats only when the pool has nothing else left
        if len(set(cats)) < len(cats):
            assert len(acts) <= K.MAX_POSITIVE_ACTIONS
