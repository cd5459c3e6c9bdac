"""Registered queries: one per operator group of the survey inventory.

Every entry takes (spark, table_dir) and returns a DataFrame over the whole
given tables. Doubles are rounded to 4 places at the end so results compare
exactly with the DuckDB oracle (``daybook.oracle``, ``daybook.oracle_tables``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from daybook.functions import constants as K
from daybook.functions.exprs import (any_of, band, case_label, flag, lenient_int, map_label,
                                     safe_pct)
from daybook.functions.timeutil import date_from_epoch_millis, epoch_millis
from daybook.operators.windows import rows_back, range_days
from daybook.plans import features as fe
from daybook.plans import roles

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def round4(c):
    """4-place rounding as ``round(x * 1e4) / 1e4`` (the multiply happens in
    double precision, so half-way cases land the same way as in the oracle)."""
    return F.round(c * F.lit(10000.0), 0) / F.lit(10000.0)


def finalize(df: DataFrame) -> DataFrame:
    return df.select(*[round4(F.col(f.name)).alias(f.name)
                       if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f.name)
                       for f in df.schema.fields])


def query(name: str):
    def deco(fn):
        QUERIES[name] = lambda spark, base: finalize(fn(spark, base))
        QUERIES[name].__doc__ = fn.__doc__
        return fn
    return deco


# cached per (session, base) within one call chain is not needed: plans are lazy.

# ---------------------------------------------------------------------------
# A / B: scans, local dates, filters, enum mapping
# ---------------------------------------------------------------------------

@query("local_day_counts")
def q_local_day_counts(spark, base):
    """A1 B1 AG6: events per (id, local day), journal presence count and constant flag."""
    ev = roles.events_base(spark, base)
    return ev.groupBy("id", "day").agg(
        F.count("*").alias("n_events"),
        F.count_if(F.col("k") % 7 == 0).alias("journal_entries"),
        F.lit(1).alias("logged_flag"))


@query("lookback_active_filter")
def q_lookback_active_filter(spark, base, feature_date: str = "2024-02-20", lookback_days: int = 36):
    """Lookback prune on the raw ts column, active status,
    soft-delete flag, meditation excluded, non-null value."""
    from daybook.functions.timeutil import lookback_filter
    ev = roles.events_base(spark, base).filter(lookback_filter("ts", feature_date, lookback_days))
    deleted = F.col("k") % 50 == 0
    kept = (ev.filter(F.col("status").isin(*K.ACTIVE_STATUS))
            .filter(~deleted)
            .filter(~((F.col("event_type") == "click") & (F.lit(30040) + F.col("k") % 8 == K.MEDITATION_EXERCISE_TYPE)))
            .filter(F.col("value").isNotNull()))
    return kept.groupBy("event_type").agg(F.count("*").alias("n_rows"), F.sum("value").alias("sum_value"))


@query("epoch_ms_days")
def q_epoch_ms_days(spark, base):
    """Epoch milliseconds -> UTC date, entries per day."""
    ev = roles.events_base(spark, base)
    ms = epoch_millis(F.col("ts"))
    return (ev.filter(F.col("k") % 11 == 0).select(date_from_epoch_millis(ms).alias("day"))
            .groupBy("day").agg(F.count("*").alias("entries")))


@query("enum_labels")
def q_enum_labels(spark, base):
    """B9 map literal (unknown -> NULL), B10 CASE chain, B12 lenient cast, B13 null default."""
    ev = roles.events_base(spark, base)
    raw = F.when(F.col("k") % 5 == 0, F.lit("x")).otherwise(F.col("k").cast("string"))
    out = ev.select(
        map_label(F.col("k") % 4, K.A1C_TARGET_MAPPING).alias("a1c_label"),
        case_label(F.element_at(F.array(*[F.lit(x) for x in K.MEAL_TYPE_MAPPING]),
                                (F.floor(F.col("k") / 3) % 4 + 1).cast("int")),
                   K.MEAL_TYPE_MAPPING).alias("meal_label"),
        (lenient_int(raw, 1) % 3).alias("lenient_mod3"),
        F.coalesce(map_label(F.col("k") % 4, K.A1C_TARGET_MAPPING), F.lit("none")).alias("a1c_or_none"))
    return out.groupBy("a1c_label", "meal_label", "lenient_mod3", "a1c_or_none").agg(F.count("*").alias("n"))


@query("json_focus_list")
def q_json_focus_list(spark, base):
    """B11 B22 AG14: JSON focus array -> sorted distinct list string -> split back."""
    f = fe.focus_per_id(spark, base)
    return f.select("id", "user_focus", F.size(F.split("user_focus", ",")).alias("n_focus"))


# ---------------------------------------------------------------------------
# AG: daily aggregates
# ---------------------------------------------------------------------------

def _agg(spark, base):
    return fe.daily_event_aggregates(spark, base)


@query("day_range_shares")
def q_day_range_shares(spark, base):
    """AG1 B14: readings, in-range / high / low / very-low shares, any-CGM flag."""
    return _agg(spark, base).filter("bg_count > 0").select(
        "id", "day", "bg_count", "tir_pct", "high_pct", "low_pct", "very_low_pct", "avg_bg", "cgm_day")


@query("day_sum_variety")
def q_day_sum_variety(spark, base):
    """AG2 AG3: minutes, sessions, distinct types; steps sum."""
    return _agg(spark, base).filter("activity_sessions > 0 OR steps IS NOT NULL").select(
        "id", "day", "active_minutes", "activity_sessions", "activity_variety", "meditation_count", "steps")


NUTRIENT_TOTALS = ["carbs", "protein", "fat", "calories", "fiber", "sugar", "added_sugars"]


@query("day_totals_vs_goal")
def q_day_totals_vs_goal(spark, base):
    """AG4 C11 B16 B17 B24: nutrient totals vs deduplicated goals, bands and counters."""
    d = _agg(spark, base).filter("meals > 0").select("id", "day", "meals", *NUTRIENT_TOTALS)
    counted = asm.nutrient_counters(d.join(fe.goals_per_id(spark, base), "id", "left"))
    return counted.select(
        "id", "day", "meals", *NUTRIENT_TOTALS, *[f"{n}_pct" for n, _ in asm.NUTRIENTS],
        "any_nutrient_met", "total_nutrient_targets", "n_90_110", "n_60_plus", "n_30_plus", "nutrient_name_met")


@query("last_kind_of_day")
def q_last_kind_of_day(spark, base):
    """AG5 E7: latest meal type and latest weight of each day."""
    return _agg(spark, base).filter("meals > 0 OR weight IS NOT NULL").select(
        "id", "day", "last_meal_type", "weight")


@query("status_flags_day")
def q_status_flags_day(spark, base):
    """AG7: per-day any-status flags with deleted rows removed."""
    return _agg(spark, base).filter("plan_entries > 0").select(
        "id", "day", "plan_entries", "plan_active", "plan_completed")


@query("state_snapshot")
def q_state_snapshot(spark, base):
    """AG8 AG9 AG10 E7 B9: per-id state from orders in one aggregate."""
    return fe.orders_dims(spark, base)


@query("program_days")
def q_program_days(spark, base):
    """AG10 C12: starts of active programs vs completions per (id, day), one conditional
    aggregate over a union (the full outer merge without a join)."""
    o = roles.orders_state(spark, base)
    starts = o.filter(F.col("o_orderstatus") != "F").select("id", F.to_date("o_orderdate").alias("day"), F.lit(1).alias("s"), F.lit(0).alias("c"))
    comps = o.filter(F.col("o_orderstatus") == "F").select(
        "id", F.date_add(F.to_date("o_orderdate"), 30).alias("day"), F.lit(0).alias("s"), F.lit(1).alias("c"))
    return starts.unionByName(comps).groupBy("id", "day").agg(
        F.sum("s").alias("programs_started"), F.sum("c").alias("programs_completed"))


# ---------------------------------------------------------------------------
# E: windows on the dense spine
# ---------------------------------------------------------------------------

def _feat(spark, base):
    return fe.daily_features(spark, base)


@query("delta_prev_logged")
def q_delta_prev_logged(spark, base):
    """Previous logged value and delta, previous calendar day, tolerance flag."""
    return _feat(spark, base).select(
        "id", "day", "is_logged", "active_minutes", "active_minutes_prev_logged",
        "active_minutes_delta_1d", "active_minutes_prev_day", "activity_same_or_more",
        "tir_pct", "tir_prev_logged", "tir_delta_1d", "tir_prev_day",
        "steps", "steps_prev_logged", "steps_delta_1d", "steps_improved",
        "sleep_rating", "sleep_rating_prev_logged", "sleep_rating_delta_1d")


@query("rolling_windows")
def q_rolling_windows(spark, base):
    """Calendar RANGE sums / averages / conditional day counts."""
    return _feat(spark, base).select(
        "id", "day", "weekly_active_minutes", "steps_avg_7d", "days_with_meals_7d",
        "sleep_avg_7d", "sleep_rating_avg_7d")


@query("any_7d_30d_flags")
def q_any_7d_30d_flags(spark, base):
    """E5: any-in-last-7 / -30 presence flags on the spine."""
    return _feat(spark, base).select(
        "id", "day", "meditation_7d", "meditation_30d", "journal_7d", "journal_30d",
        "plan_progress_7d", "plan_progress_30d", "grocery_7d", "program_7d",
        "video_completed_today", "video_completed_7d", "has_cgm", "has_step_tracker")


@query("rows_vs_range_gap")
def q_rows_vs_range_gap(spark, base):
    """ROWS(-6,0) over logged rows (reference) vs RANGE 7 calendar days (spec)."""
    d = _agg(spark, base).filter("active_minutes IS NOT NULL").select("id", "day", "active_minutes")
    return d.select(
        "id", "day",
        F.sum("active_minutes").over(rows_back(7)).alias("sum_7_rows"),
        F.sum("active_minutes").over(range_days(7)).alias("sum_7_days"))


@query("pct_change")
def q_pct_change(spark, base):
    """Latest weight per day, change vs the previous logged weight."""
    return _feat(spark, base).filter("weight IS NOT NULL").select(
        "id", "day", "weight", "weight_prev_logged", "weight_pct_change")


@query("days_since_last")
def q_days_since_last(spark, base):
    """Days since the last weight entry as of each day, 7/14/30 flags."""
    return _feat(spark, base).select(
        "id", "day", "days_since_last_weight", "weight_logged_7d", "weight_logged_14d",
        "weight_logged_30d")


@query("band_asof_14d")
def q_band_asof_14d(spark, base):
    """Weight 10-18 days back nearest to 14 (newer wins ties), change."""
    return _feat(spark, base).filter("weight_14d_ago IS NOT NULL").select(
        "id", "day", "weight", "weight_14d_ago", "weight_14d_days_back",
        "weight_change_lbs_14d", "weight_change_pct_14d")


@query("interval_union_hours")
def q_interval_union_hours(spark, base):
    """AG16 B2: merged sleep interval hours per (id, day of end), mean rating, count."""
    return _agg(spark, base).filter("sleep_count IS NOT NULL").select(
        "id", "day", "sleep_count", "sleep_rating", "sleep_hours")


# ---------------------------------------------------------------------------
# C: medications (star joins, semi join, capped adherence)
# ---------------------------------------------------------------------------

@query("capped_adherence")
def q_capped_adherence(spark, base):
    """AG11 AG12 C9 E6: two-level capped adherence and its 7-day calendar average."""
    return fe.medication_state(spark, base)["daily"]


@query("class_star_semi")
def q_class_star_semi(spark, base):
    """C5 C6 C7 AG13 AG15: prescriptions per id, glycemic class via star join, reminders."""
    return fe.medication_state(spark, base)["state"]


# ---------------------------------------------------------------------------
# assembly
# ---------------------------------------------------------------------------
from daybook.plans import assemble as asm  # noqa: E402
from daybook.plans import candidates as cand  # noqa: E402
from daybook.plans import history as hist  # noqa: E402
from daybook.plans import render as rnd  # noqa: E402
from daybook.plans import score as sc  # noqa: E402
from daybook.plans import select as sel  # noqa: E402


@query("daily_wide")
def q_daily_wide(spark, base):
    """Rule inputs per (id, day) from the assembled table."""
    ctx = asm.context(spark, base)
    return ctx.select(
        "id", "day", "has_cgm", "has_step_tracker", "has_medications", "has_weight_goal", "weight_goal_type",
        "has_active_journey", "has_exercise_program", F.array_join("focus_list", ",").alias("focus"),
        "a1c_group", "tir_positive", "meals", "any_nutrient_met", "nutrient_name_met", "n_90_110",
        "total_nutrient_targets", "within_maintenance", "takes_glycemic_lowering_med", "med_reminders_enabled")


@query("threshold_lookup")
def q_threshold_lookup(spark, base):
    """Per id glucose group -> thresholds via a broadcast 5-row table."""
    dims = fe.orders_dims(spark, base).select("id", "a1c_group")
    out = asm.with_thresholds(spark, dims)
    return out.select("id", F.coalesce("a1c_group", F.lit(K.DEFAULT_A1C_GROUP)).alias("a1c_group"),
                      "tir_positive", "tir_opportunity", "high_max", "low_max", "range_low", "range_high")


@query("null_profile")
def q_null_profile(spark, base):
    """Missing count of every column of the daily wide table (columns with any)."""
    f = asm.daily_wide(spark, base)
    cols = f.columns
    counts = f.agg(*[F.count_if(F.col(x).isNull()).alias(x) for x in cols])
    stacked = counts.select(F.explode(F.array(*[F.struct(F.lit(x).alias("column_name"),
                                                         F.col(x).alias("missing")) for x in cols])).alias("s"))
    return stacked.select("s.column_name", "s.missing").filter("missing > 0")


@query("eligibility_positive")
def q_eligibility_positive(spark, base):
    """Positive eligibility codes per (id, day), array joined to text."""
    w = asm.daily_wide(spark, base)
    e = cand.eligibility_arrays(w)
    return e.select("id", "day", F.array_join("eligible_positive", ",").alias("codes"),
                    F.size("eligible_positive").alias("n_codes"))


@query("eligibility_opportunity")
def q_eligibility_opportunity(spark, base):
    """H2: opportunity eligibility codes per (id, day)."""
    w = asm.daily_wide(spark, base)
    e = cand.eligibility_arrays(w)
    return e.select("id", "day", F.array_join("eligible_opportunity", ",").alias("codes"),
                    F.size("eligible_opportunity").alias("n_codes"))


@query("category_points")
def q_category_points(spark, base):
    """Points per category (NULL = category not included) and bonus."""
    return sc.category_points(asm.context(spark, base))


@query("daily_rating")
def q_daily_rating(spark, base):
    """Score, maximum, percentage, tier per (id, day). Flagship."""
    return sc.daily_rating(asm.context(spark, base))


@query("tier_distribution")
def q_tier_distribution(spark, base):
    """AG17: rows, distinct ids and count per tier by day."""
    return sc.tier_distribution(sc.daily_rating(asm.context(spark, base)))


# ---------------------------------------------------------------------------
# History state
# ---------------------------------------------------------------------------

@query("history_state")
def q_history_state(spark, base):
    """6-day categories and keys, weekly goal-weight count, shown yesterday."""
    st = hist.history_state(hist.history_from_events(spark, base))
    return st.select("id", "day", F.array_join("categories_6d", ",").alias("categories_6d"),
                     F.array_join("keys_6d", ",").alias("keys_6d"), "weight_msgs_7d", "weight_shown_yesterday")


@query("streaks")
def q_streaks(spark, base):
    """Consecutive days per category ending yesterday (cap 7)."""
    return hist.category_streaks(hist.history_from_events(spark, base)).filter("streak > 0")


# ---------------------------------------------------------------------------
# Candidates, priorities, selection
# ---------------------------------------------------------------------------

@query("candidates_positive")
def q_candidates_positive(spark, base):
    """Eligible positive actions with rendered text (before focus filter)."""
    ctx = sel.context_with_history(spark, base)
    return cand.positive_candidates(ctx).select("id", "day", "key", "category", "base", "text")


@query("candidates_opportunity")
def q_candidates_opportunity(spark, base):
    """H4 H5: eligible opportunities with base priority and text (tips picked unseen-first)."""
    ctx = sel.context_with_history(spark, base)
    return cand.opportunity_candidates(ctx).select("id", "day", "key", "category", "base", "text")


@query("priority_ranked")
def q_priority_ranked(spark, base):
    """Focus-filtered actions with priority and selection tier."""
    ctx = sel.context_with_history(spark, base)
    return sel.ranked_actions(ctx).select("id", "day", "key", "category", "priority", "tier", "allowed")


@query("top_actions")
def q_top_actions(spark, base):
    """Up to 2 actions per (id, day) with forced slots and category variety."""
    ctx = sel.context_with_history(spark, base)
    return sel.select_actions(sel.ranked_actions(ctx)).select(
        "id", "day", "slot", "tier", "key", "category", "priority", "text")


@query("top_opportunity")
def q_top_opportunity(spark, base):
    """Top opportunity per (id, day)."""
    ctx = sel.context_with_history(spark, base)
    return sel.select_opportunity(sel.ranked_opportunities(ctx)).select(
        "id", "day", "key", "category", "priority", "text")


@query("greeting_pick")
def q_greeting_pick(spark, base):
    """I4: greeting by hash rank per (id, day)."""
    ctx = asm.context(spark, base)
    return ctx.select("id", "day", sel.greeting_pick().alias("greeting"))


# ---------------------------------------------------------------------------
# I / J1: text and history rows
# ---------------------------------------------------------------------------

def _result(spark, base):
    r = sel.daily_result(spark, base)
    return r.withColumn("message_text", rnd.message_text(F.col("greeting"), F.col("action_texts"),
                                                         F.col("opportunity_text")))


@query("rendered_text")
def q_rendered_text(spark, base):
    """Message text, characters and words per (id, day)."""
    r = _result(spark, base)
    return r.select("id", "day", "rating", "message_text",
                    rnd.char_count(F.col("message_text")).alias("character_count"),
                    rnd.word_count(F.col("message_text")).alias("word_count"))


@query("history_rows")
def q_history_rows(spark, base):
    """Result -> one history row per touched category."""
    h = hist.result_to_history(_result(spark, base))
    return h.select("id", "category", "message_date", F.array_join("positive_actions_used", ",").alias("keys"),
                    "opportunity_used", "rating", "character_count", "word_count")


# ---------------------------------------------------------------------------
# evaluation statistics, reply parsing, label handling, text checks
# ---------------------------------------------------------------------------
from daybook.plans import evalstats as ev  # noqa: E402


@query("reply_parse_json")
def q_reply_parse_json(spark, base):
    """I8: judge replies -> verdict (fences stripped, JSON, regex fallback, default no)."""
    return ev.verdicts(spark, base).select("doc_id", "criterion", "category", "verdict", "passed", "reasoning")


@query("reply_parse_tagged")
def q_reply_parse_tagged(spark, base):
    """Tagged-line replies -> assessment and rationale."""
    return ev.tagged_replies(spark, base)


@query("pass_rates")
def q_pass_rates(spark, base):
    """AG18 AG22 F4: per-criterion totals, rate, band, weak / strong flags."""
    return ev.pass_rates(ev.verdicts(spark, base))


@query("category_rates")
def q_category_rates(spark, base):
    """AG18: category score as the mean of its criterion rates."""
    return ev.category_rates(ev.verdicts(spark, base))


@query("group_rates_route")
def q_group_rates_route(spark, base):
    """AG20: pass rate by route."""
    return ev.group_rates(ev.verdicts(spark, base), "source")


@query("group_rates_user")
def q_group_rates_user(spark, base):
    """AG20: pass rate by user."""
    return ev.group_rates(ev.verdicts(spark, base), "lang")


@query("bot_summary")
def q_bot_summary(spark, base):
    """AG21 D17: per-user totals, chart split, micro average, mean case rate, rate of each category."""
    return ev.bot_summary(ev.verdicts(spark, base))


@query("failures")
def q_failures(spark, base):
    """AG19: failed verdicts excluding judge errors."""
    return ev.failures(ev.verdicts(spark, base))


@query("verdict_pivot")
def q_verdict_pivot(spark, base):
    """AG23: wide verdict table, one column per criterion."""
    return ev.verdict_pivot(ev.verdicts(spark, base))


@query("label_frequency")
def q_label_frequency(spark, base):
    """AG24: value counts of the verdict label."""
    return ev.verdicts(spark, base).groupBy("verdict").agg(F.count("*").alias("n"))


@query("label_normalise")
def q_label_normalise(spark, base):
    """Exact, then 20-char case-insensitive prefix either way, then fallback."""
    n = ev.noisy_labels(spark, base)
    return n.select("doc_id", "raw_label", ev.normalise_label(F.col("raw_label")).alias("label"))


@query("prefix_classify")
def q_prefix_classify(spark, base):
    """Ordered prefix classes over conversation texts."""
    conv = load_conv(spark, base)
    return conv.select(ev.prefix_class(F.col("text")).alias("class")).groupBy("class").agg(F.count("*").alias("n"))


@query("value_substitute")
def q_value_substitute(spark, base):
    """C17: per-column value substitution maps; counts per substituted pair."""
    from daybook.sources.tables import load
    d = load(spark, base, "documents", ["lang", "source"])
    out = d.withColumns({"lang_name": F.col("lang"), "source_name": F.col("source")}) \
        .replace(ev.LANG_NAMES, subset=["lang_name"]).replace(ev.SOURCE_NAMES, subset=["source_name"])
    return out.groupBy("lang_name", "source_name").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("lang_name") != F.col("lang")).alias("lang_replaced"),
        F.count_if(F.col("source_name") != F.col("source")).alias("source_replaced"))


def load_conv(spark, base):
    from daybook.sources.tables import load
    return load(spark, base, "conversations", ["conv_id", "turn", "role", "text"])


@query("text_checks")
def q_text_checks(spark, base):
    """Measurable message checks on every assistant turn (whole texts)."""
    conv = load_conv(spark, base).filter(F.col("role") == "assistant")
    return ev.text_checks(conv).drop("role", "text")


@query("number_grounding")
def q_number_grounding(spark, base):
    """Numbers in each assistant turn must occur in the turn before."""
    return ev.number_grounding(spark, base)


# ---------------------------------------------------------------------------
# Writes on table versions derived from orders
# ---------------------------------------------------------------------------
from daybook.sources import writes as wr  # noqa: E402

ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]


def order_versions(spark, base):
    """v1: orders dated before 2001; v2: all orders, status 'P' removed, open orders repriced."""
    from daybook.sources.tables import load
    o = load(spark, base, "orders", ORDER_COLS)
    v1 = o.filter(F.col("o_orderdate") < F.lit("2001-01-01").cast("timestamp_ntz"))
    v2 = (o.filter(F.col("o_orderstatus") != "P")
          .withColumn("o_totalprice", F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice") + 1.0)
                      .otherwise(F.col("o_totalprice"))))
    return v1, v2


@query("change_set")
def q_change_set(spark, base):
    """Inserts, updates and deletes between two versions by key."""
    v1, v2 = order_versions(spark, base)
    return wr.change_set(v1, v2, ["o_orderkey"])


@query("upsert_audit")
def q_upsert_audit(spark, base):
    """v1 loaded on run 1, v2 upserted on run 2; final state with audit columns."""
    v1, v2 = order_versions(spark, base)
    return wr.upsert(wr.with_audit(v1, "2024-01-01"), v2, ["o_orderkey"], "2024-01-02")


@query("evolve_union")
def q_evolve_union(spark, base):
    """A new column appears in the second version; old rows read it as NULL."""
    v1, v2 = order_versions(spark, base)
    v2x = v2.withColumn("price_band", F.when(F.col("o_totalprice") > 100000, "high").otherwise("normal"))
    u = wr.evolve_union(v1.withColumn("version", F.lit(1)), v2x.withColumn("version", F.lit(2)))
    return u.groupBy("version", "price_band").agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("total"))


@query("partition_overwrite")
def q_partition_overwrite(spark, base):
    """v1 written partitioned by status, then v2 overwrites only its own
    partitions; the read-back state per partition."""
    v1, v2 = order_versions(spark, base)
    path = wr.new_table_path(spark, "orders_by_status")
    wr.overwrite_partitions(v1.withColumn("version", F.lit(1)), path, ["o_orderstatus"], "o_orderkey")
    wr.overwrite_partitions(v2.withColumn("version", F.lit(2)), path, ["o_orderstatus"], "o_orderkey")
    back = spark.read.parquet(path)
    return back.groupBy("o_orderstatus", "version").agg(F.count("*").alias("n"))


@query("clustered_layout")
def q_clustered_layout(spark, base):
    """Range-partitioned and sorted by id before writing; the rows read back from the files."""
    path = wr.new_table_path(spark, "rating_by_id")
    wr.clustered(sel_rating(spark, base), "id").write.parquet(path)
    return spark.read.parquet(path)


@query("partition_lookup")
def q_partition_lookup(spark, base):
    """A3: one day of a table partitioned by day (partition filter), restricted to an id list."""
    path = wr.new_table_path(spark, "rating_by_day")
    wr.overwrite_partitions(sel_rating(spark, base), path, ["day"])
    allow = fe.goals_per_id(spark, base).filter(F.col("has_weight_goal") == 1).select("id")
    back = spark.read.parquet(path).withColumn("day", F.col("day").cast("date"))
    return day_partition(back, "day", "2024-01-20", allow).select("id", "day", "score", "rating")


@query("key_categories")
def q_key_categories(spark, base):
    """H6: candidates of both kinds per key, with the category that the key's prefix gives."""
    ranked = sel.ranked(sel.context_with_history(spark, base))
    return ranked.groupBy("kind", "key").agg(F.count("*").alias("n")).withColumn("category", hist.key_category("key"))


def sel_rating(spark, base):
    return sc.daily_rating(asm.context(spark, base))


@query("column_comments")
def q_column_comments(spark, base):
    """Comments of a written table as read back, with each column's non-null rows; names
    that are not columns are reported without rows."""
    comments = {"tir_pct": "share of readings in 70-180", "weekly_active_minutes": "7-day calendar sum",
                "protein_target_pct": "named in the comments, not a column"}
    out, _, skipped = wr.with_comments(fe.daily_features(spark, base), comments)
    path = wr.new_table_path(spark, "commented")
    out.write.parquet(path)
    back = spark.read.parquet(path)
    kept = {f.name: f.metadata["comment"] for f in back.schema.fields if "comment" in f.metadata}
    counts = back.agg(*[F.count(x).alias(x) for x in kept])
    rows = [F.struct(F.lit(x).alias("column_name"), F.lit(True).alias("applied"), F.lit(t).alias("comment"),
                     F.col(x).alias("n_rows")) for x, t in kept.items()]
    rows += [F.struct(F.lit(x).alias("column_name"), F.lit(False).alias("applied"), F.lit(None).cast("string").alias("comment"),
                      F.lit(None).cast("long").alias("n_rows")) for x in skipped]
    return counts.select(F.inline(F.array(*rows)))


# ---------------------------------------------------------------------------
# A3 A4 F2 F3 I2 I3 I7 J3
# ---------------------------------------------------------------------------
from daybook.sources.tables import day_partition, first_per_key  # noqa: E402


@query("day_lookup")
def q_day_lookup(spark, base):
    """For every id, its newest scored day (first row per id, newest first)."""
    r = sel_rating(spark, base)
    return first_per_key(r, "id", [F.col("day").desc()]).select("id", "day", "score", "rating")


@query("day_ids")
def q_day_ids(spark, base):
    """A4 AG15: per day, distinct ids restricted to an allow-list (semi join, no IN list)."""
    r = sel_rating(spark, base)
    allow = fe.goals_per_id(spark, base).filter(F.col("has_weight_goal") == 1).select("id")
    ids = r.select("id", "day").distinct().join(allow, "id", "left_semi")
    return ids.groupBy("day").agg(F.count("*").alias("n_ids"))


@query("context_json")
def q_context_json(spark, base):
    """Per (id, day) JSON of all rule inputs; NULL fields dropped."""
    ctx = asm.context(spark, base)
    keys = [x for x in ctx.columns if x not in ("id", "day")]
    return ctx.select("id", "day", rnd.context_json(ctx, keys).alias("context"))


WEEKLY_INPUTS = ["sleep_hours", "sleep_avg_7d", "sleep_rating", "sleep_rating_avg_7d", "active_minutes",
                 "weekly_active_minutes", "took_all_meds", "med_adherence_7d_avg"]


@query("prompt_text")
def q_prompt_text(spark, base):
    """Weekly-context lines and the assembled prompt per (id, day)."""
    j = sel.daily_result(spark, base, carry=WEEKLY_INPUTS)
    wk = rnd.weekly_context(j)
    return j.select("id", "day", wk.alias("weekly_context"),
                    rnd.prompt_text(F.col("action_texts"), F.col("opportunity_text"), F.col("greeting"), wk)
                    .alias("prompt"))


@query("sheet_roundtrip")
def q_sheet_roundtrip(spark, base):
    """Documents written as a CSV sheet (untidy headers, quoted multi-line
    cells) and read back with trimmed headers and a rename map; per language
    and source: documents, characters, multi-line texts."""
    from daybook.sources.tables import load, read_sheet
    docs = load(spark, base, "documents", ["doc_id", "lang", "source", "text"])
    sheet = docs.toDF(" Doc Id ", "Language ", " Source", "Body")
    path = wr.new_table_path(spark, "sheet")
    wr.write_sheet(sheet, path)
    back = read_sheet(spark, path, rename={"Doc Id": "doc_id", "Language": "lang", "Source": "source",
                                           "Body": "text"})
    return back.groupBy("lang", "source").agg(
        F.count("*").alias("n_docs"), F.sum(F.length("text")).alias("n_chars"),
        F.count_if(F.col("text").contains("\n")).alias("multi_line"))


@query("report_day")
def q_report_day(spark, base):
    """The production daily run for the newest day in the data: lookback-pruned
    event scan, focus from the snapshot and the window, day filter before the dimension joins,
    rating and picks for that day."""
    from daybook.plans import daily, job
    d = daily.last_event_day(spark, base)
    store = job.new_store(spark)
    job.seed_focus(spark, base, store, d)
    res = daily.report_day_result(spark, base, d, snapshot=store.focus)
    return res.select("id", "day", "score", "rating", F.array_join("action_keys", ",").alias("actions"),
                      "opportunity_key", "message_text")


@query("tip_pick")
def q_tip_pick(spark, base):
    """H5: per (id, day) the food and sleep tip a suggestion would use: unseen in
    the last 6 days first, hash-ranked, all tips when every one was shown."""
    ctx = sel.context_with_history(spark, base)
    return ctx.select("id", "day", cand.tip_pick(K.FOOD_TIPS)["key"].alias("food_tip"),
                      cand.tip_pick(K.SLEEP_TIPS)["key"].alias("sleep_tip"))


@query("weekly_context")
def q_weekly_context(spark, base):
    """Per (id, day) the lines on the picked opportunity where yesterday and the 7-day view disagree."""
    j = sel.daily_result(spark, base, carry=WEEKLY_INPUTS)
    wk = rnd.weekly_context(j)
    return j.select("id", "day", wk.alias("weekly_context"),
                      F.size(F.filter(F.split(wk, "\n"), lambda x: x != "")).alias("n_lines"))


from daybook import registry_tables  # noqa: E402,F401  (registers its queries here)
