"""What the layouts spare: row groups, exchanges, rows; label index and rates against plain versions."""

import datetime as dt
import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from daybook.functions.timeutil import lookback_any
from daybook.plans import assemble, evalstats, labels
from daybook.sources import layouts
from tests.test_partitioned import plan


def scanned_rows(df):
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().apply("numOutputRows").value()


def test_lookup_reads_one_row_group(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(40_000).select((F.col("id") * 10).alias("id"), F.lit("x" * 50).alias("v"), F.sha2(F.col("id").cast("string"), 256).alias("w"),
                                    F.explode(F.array(*[F.lit(dt.date(2024, 1, d)) for d in (1, 2)])).alias("day"))
    layouts.write_for_lookup(df, path, ["day"], "id", row_group_bytes=1 << 18, ids_per_file=50_000)
    names = glob.glob(f"{path}/day=2024-01-01/*.parquet")
    groups = [(g.column(0).statistics.min, g.column(0).statistics.max) for f in names
              for m in [pq.ParquetFile(f).metadata] for g in (m.row_group(k) for k in range(m.num_row_groups))]
    assert len(groups) > 3 and all(a[1] < b[0] for a, b in zip(sorted(groups), sorted(groups)[1:], strict=False))
    found = layouts.lookup(spark, path, "day", dt.date(2024, 1, 1), "id", [200_000])
    assert [r.id for r in found.collect()] == [200_000]
    assert scanned_rows(found) <= 40_000 / len(groups) * 2
    # within the range, but not there: the bloom filter leaves nothing to read
    assert scanned_rows(layouts.lookup(spark, path, "day", dt.date(2024, 1, 1), "id", [200_005])) == 0
    assert "PartitionFilters: [isnotnull(day" in plan(found)
    layouts.write_for_lookup(df.filter("day = date'2024-01-02'").limit(5), path, ["day"], "id")
    assert spark.read.parquet(path).count() == 40_005


def test_bucketed_versions_join_without_exchange(spark):
    v1 = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n"), (4, None)], "k long, v string")
    v2 = spark.createDataFrame([(1, "a"), (2, "c"), (3, "d"), (4, None)], "k long, v string")
    old, new = (layouts.write_bucketed(v, "versions", ["k"], 4) for v in (v1, v2))
    diff = layouts.bucketed_changes(spark, old, new)
    assert "Exchange" not in plan(diff) and "SortMergeJoin" in plan(diff)
    assert {(r.k, r.change) for r in diff.collect()} == {(2, "update"), (3, "insert"), (None, "delete")}
    with pytest.raises(ValueError):
        layouts.bucketed_changes(spark, old, layouts.write_bucketed(v2, "versions", ["k"], 2))


def test_counts_come_from_footers(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).withColumn("p", F.col("id") % 3).write.partitionBy("p").parquet(path)
    with layouts._settings(spark, **layouts.FOOTERS):
        assert "PushedAggregation: [COUNT(*)]" in plan(layouts.counting(spark, path, ["p"]))
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    assert {tuple(r) for r in layouts.partition_counts(spark, path, ["p"]).collect()} == {(0, 34), (1, 33), (2, 33)}
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before != ""


def test_two_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    days = [None, "2024-01-01", "2024-03-01"]
    data = [(i, a, b) for i, (a, b) in enumerate((a, b) for a in days for b in days)]
    spark.createDataFrame(data, "k int, a string, b string").select(
        "k", F.col("a").cast("timestamp_ntz").alias("a"), F.col("b").cast("timestamp_ntz").alias("b")).write.parquet(path)
    kept = spark.read.parquet(path).filter(lookback_any(["a", "b"], "2024-03-05", 36))
    assert {r.k for r in kept.collect()} == {k for k, a, b in data if "2024-03-01" in (a, b)}
    assert "PushedFilters: [Or(GreaterThanOrEqual(a," in plan(kept)


def first_label(raw, known):
    if raw is None:
        return "Other"
    if raw in known:
        return raw
    r = raw[:20].lower()
    return next((x for x in known if x[:20].lower().startswith(r) or r.startswith(x[:20].lower())), "Other")


def test_label_table_equals_list(spark):
    known = ["Weight Loss and More Than Twenty", "weight", "Sleep", "sleepless", "Sleep", "Glücose", "a"]
    raws = [None, "", "Sleep", "SLEEP", "sle", "sleepl", "weight loss AND MORE than thirty", "Weigh", "weights", "glücose level", "x", "A", "ab", "Sleep"]
    raw = spark.createDataFrame([(i, r, "own") for i, r in enumerate(raws)], "k int, raw_label string, pos string")
    table = spark.createDataFrame(list(enumerate(known)), "pos int, label string")
    got = {r.k: r.label for r in labels.normalised(raw, table).collect()}
    assert got == {i: first_label(r, known) for i, r in enumerate(raws)}
    inline = raw.select("k", evalstats.normalise_label(F.col("raw_label"), known).alias("label"))
    assert {r.k: r.label for r in inline.filter("k > 0").collect()} == {k: v for k, v in got.items() if k}


def test_a_hundred_thousand_labels(spark):
    table = spark.range(100_000).select(F.col("id").alias("pos"), F.concat(F.lit("Label "), F.sha2(F.col("id").cast("string"), 256)).alias("label"))
    n = F.col("pos") % 3
    raw = table.select("pos", F.when(n == 0, F.col("label")).when(n == 1, F.upper(F.substring("label", 1, 19))).otherwise(F.lit("none")).alias("raw_label"))
    got = labels.normalised(raw, table.select("pos", "label")).groupBy((F.col("pos") % 3).alias("n")).agg(
        F.count("*").alias("rows"), F.count_if(F.col("label") == "Other").alias("other"),
        F.count_if(F.lower("label").startswith(F.lower("raw_label"))).alias("right"))
    assert {(r.n, r.rows, r.other, r.right) for r in got.collect()} == {(0, 33334, 0, 33334), (1, 33333, 0, 33333), (2, 33333, 33333, 0)}
    assert "CartesianProduct" not in plan(labels.normalised(raw, table)) and "NestedLoop" not in plan(labels.normalised(raw, table))


def test_rates_take_one_exchange(spark):
    v = evalstats.verdicts(spark, "/root/testdata/sf0.001")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rates, alone = plan(evalstats.rate_levels(v)), plan(v)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert rates.count(") Exchange") == alone.count(") Exchange") + 1


def test_first_nutrient_met(spark):
    """A row that meets two goals names the first in the fixed order; a goal of 0 is none."""
    names = [n for n, _ in assemble.NUTRIENTS]
    goals = [g for _, g in assemble.NUTRIENTS]
    data = [(1, *[100.0] * 8), (2, 10.0, 100.0, 100.0, 100.0, *[100.0] * 4), (3, 10.0, 10.0, 100.0, 100.0, *[100.0] * 4),
            (4, 100.0, 10.0, 10.0, 10.0, 0.0, 100.0, 100.0, 100.0)]
    df = spark.createDataFrame(data, "k int, " + ", ".join(f"{x} double" for x in names + goals))
    got = {r.k: (r.nutrient_name_met, r.total_nutrient_targets, r.n_90_110) for r in assemble.nutrient_counters(df).collect()}
    assert got == {1: ("protein", 4, 4), 2: ("carbs", 4, 3), 3: ("fat", 4, 2), 4: (None, 3, 0)}
