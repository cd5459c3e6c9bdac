"""Registered queries on written tables: partition-wise writes, layouts, replay, label tables, rates by grouping sets."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from daybook.plans import evalstats as ev
from daybook.plans import labels, replay
from daybook.registry import ORDER_COLS, order_versions, query, sel_rating
from daybook.sources import layouts
from daybook.sources import partitioned as pt
from daybook.sources import writes as wr
from daybook.sources.tables import load

ORDER_TABLE = ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
               "order_year int")
RUNS = ["2024-01-01 01:00:00", "2024-01-02 01:00:00", "2024-01-03 01:00:00"]
FIRST_TOUCHED_YEAR = 2000
SMALL = "abcdefghijklmnopqrstuvwxyz"


def by_year(df):
    return df.withColumn("order_year", F.year("o_orderdate"))


def yearly_orders(spark, base) -> tuple[pt.Table, object]:
    """A table of the first order version by year, written on the first run, and the second version's last years."""
    v1, v2 = order_versions(spark, base)
    t = pt.table(wr.new_table_path(spark, "orders_by_year"), ORDER_TABLE, ["order_year"], ["order_year", "o_orderkey"])
    pt.create_if_absent(spark, t)
    pt.replace(spark, t, by_year(v1), RUNS[0])
    return t, by_year(v2).filter(F.col("order_year") >= FIRST_TOUCHED_YEAR)


@query("partition_upsert")
def q_partition_upsert(spark, base):
    """The same rows upserted on two runs into a table on disk; only their years are read and rewritten."""
    t, late = yearly_orders(spark, base)
    for run in RUNS[1:]:
        pt.upsert(spark, t, late, run)
    return pt.read(spark, t)


@query("partition_recompute")
def q_partition_recompute(spark, base):
    """Two recomputations of the last years; audit columns carried from the partitions replaced, old keys gone."""
    t, late = yearly_orders(spark, base)
    for run in RUNS[1:]:
        pt.replace(spark, t, late, run)
    return pt.read(spark, t)


@query("evolved_partitions")
def q_evolved_partitions(spark, base):
    """A column added between two runs; partitions of the first run read NULL for it."""
    t, late = yearly_orders(spark, base)
    wider = pt.evolved(t, "price_band string")
    pt.upsert(spark, wider, late.withColumn("price_band", F.when(F.col("o_totalprice") > 100000, "high").otherwise("normal")), RUNS[1])
    return pt.read(spark, wider).groupBy("order_year", "price_band").agg(F.count("*").alias("n"))


@query("replay_3_days")
def q_replay_3_days(spark, base):
    """Three report days of the daily job on partitioned tables; each reads the history written the day before."""
    return replay.replay(spark, base, days=3).select(
        "id", "category", "message_date", F.array_join("positive_actions_used", ",").alias("keys"), "opportunity_used", "rating",
        "character_count", "word_count", "created_at", "overwrite_count")


@query("point_lookup")
def q_point_lookup(spark, base):
    """A3: some ids on one day of a written table, by partition, row-group statistics and bloom filter."""
    path = wr.new_table_path(spark, "rating_lookup")
    layouts.write_for_lookup(sel_rating(spark, base), path, ["day"], "id")
    return layouts.lookup(spark, path, "day", dt.date(2024, 1, 20), "id", [7, 42, 99]).select("id", "day", "score", "rating")


@query("bucketed_change_set")
def q_bucketed_change_set(spark, base):
    """Change set of two versions written into equal buckets; the join has no exchange."""
    old, new = (layouts.write_bucketed(v, "orders_version", ["o_orderkey"], 8) for v in order_versions(spark, base))
    return layouts.bucketed_changes(spark, old, new)


@query("footer_counts")
def q_footer_counts(spark, base):
    """Rows of each written partition from the file footers."""
    path = wr.new_table_path(spark, "orders_by_status_year")
    o = by_year(load(spark, base, "orders", ORDER_COLS))
    wr.overwrite_partitions(o, path, ["order_year", "o_orderstatus"])
    return layouts.partition_counts(spark, path, ["order_year", "o_orderstatus"])


@query("two_date_prune")
def q_two_date_prune(spark, base, feature_date: str = "2001-07-01", lookback_days: int = 365):
    """B5 (two columns): programs activated or changed inside the window; the disjunction reaches the scan."""
    from daybook.functions.timeutil import lookback_any
    li = load(spark, base, "lineitem", ["l_orderkey", "l_shipdate"]).groupBy("l_orderkey").agg(F.max("l_shipdate").alias("modified"))
    o = load(spark, base, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"])
    programs = o.join(li, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        F.col("o_custkey").alias("id"), "o_orderstatus", F.col("o_orderdate").alias("activated"), "modified")
    path = wr.new_table_path(spark, "programs")
    wr.clustered(programs, "activated").write.parquet(path)
    kept = spark.read.parquet(path).filter(lookback_any(["activated", "modified"], feature_date, lookback_days))
    return kept.groupBy("id").agg(
        F.max(F.when(F.col("o_orderstatus") == "O", 1).otherwise(0)).alias("has_active_program"),
        F.max(F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)).alias("has_completed_program"),
        F.count_if(F.col("o_orderstatus") == "O").alias("active_program_count"), F.count("*").alias("total_programs"))


@query("label_table_normalise")
def q_label_table_normalise(spark, base):
    """Raw labels against a table of labels (the words that begin documents) by prefix index."""
    docs = load(spark, base, "documents", ["doc_id", "source", "lang", "text"])
    word = F.lower(F.regexp_extract("text", r"^\s*(\S+\s+\S+\s+\S+)", 1))
    known = docs.select(F.concat_ws(" ", "lang", word).alias("label"), "doc_id").groupBy("label").agg(
        F.min("doc_id").alias("pos"))
    n = F.col("doc_id") % 4
    full = F.concat_ws(" ", "lang", word)
    raw = docs.select("doc_id", F.when(n == 0, full).when(n == 1, F.translate(F.concat(full, F.lit(" and more")), SMALL, SMALL.upper()))
                      .when(n == 2, F.substring(full, 1, 6)).otherwise(F.concat(F.lit("?"), "source")).alias("raw_label"))
    return labels.normalised(raw, known)


@query("rate_levels")
def q_rate_levels(spark, base):
    """AG18 AG20 F4: rates overall, by criterion, category, case, route, user and route by user in one aggregate."""
    return ev.rate_levels(ev.verdicts(spark, base))


@query("weak_criteria")
def q_weak_criteria(spark, base):
    """the criteria below the weak rate, the lowest first."""
    return ev.weak_criteria(ev.verdicts(spark, base))


@query("message_checks")
def q_message_checks(spark, base):
    """from/to values of told changes, numbers against the facts, rating label against the score."""
    from daybook.plans import daily, select
    return ev.message_checks(ev.sent_messages(daily.messages(select.daily_result(spark, base))))
