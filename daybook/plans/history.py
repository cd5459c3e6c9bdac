"""Message history state (J1 J2 E12 E13 E14 C13) and result -> history rows.

History rows are one per (id, category, message_date) with the action keys
used. The state for report day d reads days d-7 .. d-1. Instead of a range
join, each history row is fanned out to the 7 report days it can affect
(fixed fan-out, map-side), then one aggregate per (id, day) builds every
state field; streaks come from the sorted day offsets per category.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions import constants as K
from daybook.plans import roles

WEIGHT_GOAL_KEYS = ["weight_decreased", "weight_maintained"]

# history seed from the events table (category, positive key, opportunity key)
_EVENT_CATEGORY = {"view": "glucose", "click": "activity", "purchase": "steps",
                   "signup": "weight", "error": "sleep"}
_EVENT_KEY = {"view": "glucose_tir_met", "click": "activity_logged", "purchase": "steps_target_met",
              "error": "sleep_hours_met"}


def key_category(key) -> Column:
    """One shared ordered prefix mapping for engine and history."""
    k = F.col(key) if isinstance(key, str) else key
    out = None
    for prefix, cat in K.ACTION_CATEGORY_PREFIXES:
        out = F.when(k.startswith(prefix), F.lit(cat)) if out is None else out.when(k.startswith(prefix), F.lit(cat))
    return out.otherwise(F.lit("explore"))


def history_from_events(spark: SparkSession, base: str, events: DataFrame | None = None) -> DataFrame:
    """A history table derived from ``events`` (message_date = local day + 1)."""
    ev = roles.events_base(spark, base, events)
    et = F.col("event_type")
    cat = F.create_map(*[x for kv in _EVENT_CATEGORY.items() for x in map(F.lit, kv)])[et]
    key = F.when(et == "signup", F.when(F.col("k") % 2 == 0, F.lit("weight_decreased"))
                 .otherwise(F.lit("weight_logged"))) \
        .otherwise(F.create_map(*[x for kv in _EVENT_KEY.items() for x in map(F.lit, kv)])[et])
    food_tips = F.array(*[F.lit(k) for k, _ in K.FOOD_TIPS])
    sleep_tips = F.array(*[F.lit(k) for k, _ in K.SLEEP_TIPS])
    opp = (F.when(et == "error", F.element_at(sleep_tips, (F.col("k") % len(K.SLEEP_TIPS) + 1).cast("int")))
           .when(et == "purchase", F.element_at(food_tips, (F.col("k") % len(K.FOOD_TIPS) + 1).cast("int"))))
    rows = ev.select(F.col("id"), cat.alias("category"), F.date_add("day", 1).alias("message_date"),
                     key.alias("key"), opp.alias("opp"))
    return rows.groupBy("id", "category", "message_date").agg(
        F.array_sort(F.collect_set("key")).alias("positive_actions_used"),
        F.max("opp").alias("opportunity_used"))


def history_state(history: DataFrame, lookback: int = 7) -> DataFrame:
    """Per (id, day) state from the history of days d-7 .. d-1.

    Two aggregates in a line: per (id, day, category) (offsets, 6-day keys,
    goal-weight counts), then per (id, day). Every collected set is bounded
    by a fixed vocabulary (7 offsets, categories, tip keys)."""
    fan = history.select(
        "id", "category", "message_date", "positive_actions_used", "opportunity_used",
        F.explode(F.sequence(F.lit(1), F.lit(lookback))).alias("o"))
    fan = fan.withColumn("day", F.date_add("message_date", F.col("o")))
    goal = F.coalesce(F.arrays_overlap("positive_actions_used",
                                       F.array(*[F.lit(k) for k in WEIGHT_GOAL_KEYS])), F.lit(False))
    is_goal_weight = (F.col("category") == "weight") & goal
    six = F.col("o") <= K.CATEGORY_LOOKBACK_DAYS
    per_cat = fan.groupBy("id", "day", "category").agg(
        F.array_sort(F.collect_set("o")).alias("offs"),
        F.min("o").alias("first_o"),
        F.collect_set(F.when(six, F.col("opportunity_used"))).alias("keys6"),
        F.count_if(is_goal_weight).alias("goal_w"),
        F.max(is_goal_weight & (F.col("o") == 1)).alias("goal_y"))
    streak = F.aggregate("offs", F.lit(0), lambda acc, x: F.when(x == acc + 1, acc + 1).otherwise(acc))
    per_cat = per_cat.withColumn("streak", streak)
    return per_cat.groupBy("id", "day").agg(
        F.array_sort(F.collect_set(F.when(F.col("first_o") <= K.CATEGORY_LOOKBACK_DAYS, F.col("category"))))
        .alias("categories_6d"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("keys6")))).alias("keys_6d"),
        F.sum("goal_w").alias("weight_msgs_7d"),
        F.max("goal_y").alias("weight_shown_yesterday"),
        F.map_from_entries(F.array_sort(F.collect_list(
            F.when(F.col("streak") > 0, F.struct("category", "streak"))))).alias("category_streaks"))


def category_streaks(history: DataFrame, lookback: int = 7) -> DataFrame:
    """E12 as rows: (id, day, category, streak) with streak capped at ``lookback``."""
    fan = history.select("id", "category", "message_date",
                         F.explode(F.sequence(F.lit(1), F.lit(lookback))).alias("o"))
    fan = fan.withColumn("day", F.date_add("message_date", F.col("o")))
    per_cat = fan.groupBy("id", "day", "category").agg(F.array_sort(F.collect_set("o")).alias("offs"))
    return per_cat.select(
        "id", "day", "category",
        F.aggregate("offs", F.lit(0), lambda acc, x: F.when(x == acc + 1, acc + 1).otherwise(acc)).alias("streak"))


def result_to_history(result: DataFrame) -> DataFrame:
    """One history row per category touched by the picked actions and the opportunity."""
    acts = F.transform("actions", lambda a: F.struct(a["key"].alias("key"), a["category"].alias("category"),
                                                     F.lit(True).alias("is_action")))
    opp = F.array(F.struct(F.col("opportunity_key").alias("key"), F.col("opportunity_category").alias("category"),
                           F.lit(False).alias("is_action")))
    items = F.concat(F.coalesce(acts, F.array().cast(acts_type())), opp)
    rows = result.select("id", "day", "message_text", "rating", F.explode(items).alias("it"))
    out = rows.groupBy("id", F.col("it.category").alias("category"), F.col("day").alias("message_date")).agg(
        F.array_sort(F.collect_list(F.when(F.col("it.is_action"), F.col("it.key")))).alias("positive_actions_used"),
        F.max(F.when(~F.col("it.is_action"), F.col("it.key"))).alias("opportunity_used"),
        F.max("message_text").alias("message_text"), F.max("rating").alias("rating"))
    t = F.trim(F.regexp_replace("message_text", r"\s+", " "))
    return out.withColumns({
        "character_count": F.length("message_text"),
        "word_count": F.when(t == "", 0).otherwise(F.size(F.split(t, " "))),
    })


def acts_type() -> str:
    return "array<struct<key:string,category:string,is_action:boolean>>"
