"""Daily rating (G1-G13) and tier report (AG17) as column expressions.

Each category contributes (points, included) columns; a category outside the
user's focus or without its device adds nothing to the maximum, while an
included category without data scores 0 (NULL vs 0, trap 3).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions import constants as K
from daybook.functions.cache import per_context
from daybook.functions.exprs import ladder, safe_abs_lte, safe_eq, safe_gt, safe_gte, safe_lte, safe_range

CATEGORIES = ["weight", "glucose", "activity", "steps", "food_logging", "nutrient_targets",
              "sleep_duration", "sleep_rating", "medications", "mental_wellbeing"]


def focuses_including(category: str, focus_map: dict[str, list[str]]) -> list[str]:
    return [f for f, cats in focus_map.items() if category in cats]


def focus_allows(category: str, focus_map: dict[str, list[str]] = K.SCORING_FOCUS_MAP) -> Column:
    """No focus -> every category; else any active focus lists the category."""
    names = focuses_including(category, focus_map)
    hit = F.arrays_overlap(F.col("focus_list"), F.array(*[F.lit(n) for n in names])) if names else F.lit(False)
    return ~F.col("has_focus") | F.coalesce(hit, F.lit(False))


def category_points(ctx: DataFrame, keep: bool = False) -> DataFrame:
    return ctx.select(*(["*"] if keep else ["id", "day"]), *_point_columns())


@per_context
def _point_columns() -> list:
    c = F.col
    lose = c("has_weight_goal") & (c("weight_goal_type") == "lose")
    maintain = c("has_weight_goal") & (c("weight_goal_type") == "maintain")
    weight_pts = (
        F.when(F.coalesce(lose, F.lit(False)),
               F.when(safe_lte("weight_change_lbs_14d", -1.0), 5)
               .when(safe_range("weight_change_lbs_14d", -1.0, 1.0), 3).otherwise(0))
        .when(F.coalesce(maintain, F.lit(False)),
              F.when(safe_abs_lte("weight_change_pct_14d", 3.0), 5).otherwise(0))
        .otherwise(F.when(c("weight_logged_7d"), 5).when(c("weight_logged_14d"), 3)
                   .when(c("weight_logged_30d"), 1).otherwise(0)))
    # Both the enum name and the rule-sheet name select the target-8 ladder
    t8 = c("a1c_group").isin("dm_target_8", "a1c_target_8")
    a7, b7, c7 = K.GLUCOSE_POINTS["a1c_target_7"]
    a8, b8, c8 = K.GLUCOSE_POINTS["a1c_target_8"]
    glucose_pts = (F.when(t8, F.when(safe_gte("tir_pct", a8), 5).when(safe_gte("tir_pct", b8), 3)
                          .when(safe_lte("tir_pct", c8), 1).otherwise(0))
                   .otherwise(F.when(safe_gte("tir_pct", a7), 5).when(safe_gte("tir_pct", b7), 3)
                              .when(safe_lte("tir_pct", c7), 1).otherwise(0)))
    nutrient_pts = (F.when(~safe_gt("total_nutrient_targets", 0), 0)
                    .when(safe_eq("n_90_110", c("total_nutrient_targets")), 5)
                    .when(safe_eq("n_60_plus", c("total_nutrient_targets")), 3)
                    .when(safe_eq("n_30_plus", c("total_nutrient_targets")), 1).otherwise(0))
    mp = K.MENTAL_POINTS
    mental_pts = F.least(
        F.when(c("plan_active"), mp["action_plan_active"]).otherwise(0)
        + F.when(c("journal_7d"), mp["journal_7d"]).otherwise(0)
        + F.when(c("meditation_7d"), mp["meditation_7d"]).otherwise(0), F.lit(mp["cap"]))
    points = {
        "weight": weight_pts,
        "glucose": glucose_pts,
        "activity": ladder("weekly_active_minutes", K.ACTIVITY_POINTS),
        "steps": ladder("steps", K.STEPS_POINTS),
        "food_logging": ladder("meals", K.MEALS_POINTS),
        "nutrient_targets": nutrient_pts,
        "sleep_duration": ladder("sleep_hours", K.SLEEP_HOURS_POINTS),
        "sleep_rating": ladder("sleep_rating", K.SLEEP_RATING_POINTS),
        "medications": ladder("med_adherence_7d_avg", K.MED_ADHERENCE_POINTS),  # D16: 0-100 scale
        "mental_wellbeing": mental_pts,
    }
    device = {"glucose": c("has_cgm"), "steps": c("has_step_tracker"),
              "medications": c("has_medications"), "nutrient_targets": c("has_nutrient_goals")}
    included = {cat: focus_allows(cat) & device.get(cat, F.lit(True)) for cat in CATEGORIES}
    bp = K.BONUS_POINTS
    bonus = (F.when(c("video_completed_today"), bp["exercise_video_completed"]).otherwise(0)
             + F.when(c("program_started_today"), bp["exercise_program_started"]).otherwise(0)
             + F.when(c("grocery_today"), bp["grocery_shopping_online"]).otherwise(0)
             + F.when(c("meal_plan_today"), bp["ai_meal_plan_generated"]).otherwise(0)
             + F.when(c("article_today"), bp["article_read"]).otherwise(0)
             + F.when(c("lesson_today"), bp["lesson_completed"]).otherwise(0)
             + F.when(c("learn_video_today"), bp["learn_video_watched"]).otherwise(0))
    return [*[F.when(included[cat], points[cat]).alias(f"{cat}_pts") for cat in CATEGORIES],
            bonus.alias("bonus_pts")]


def tier(pct) -> Column:
    """First tier whose minimum the percentage reaches; below all -> last tier."""
    out = None
    for name, _, lo in K.TIERS:
        out = F.when(pct >= lo, F.lit(name)) if out is None else out.when(pct >= lo, F.lit(name))
    return out.otherwise(F.lit(K.TIERS[-1][0]))


def tier_description(pct) -> Column:
    out = None
    for _, desc, lo in K.TIERS:
        out = F.when(pct >= lo, F.lit(desc)) if out is None else out.when(pct >= lo, F.lit(desc))
    return out.otherwise(F.lit(K.TIERS[-1][1]))


def daily_rating(ctx: DataFrame, keep: bool = False) -> DataFrame:
    """G13; ``keep`` carries the input columns along (no branch, no re-join)."""
    pts = category_points(ctx, keep)
    score = sum(F.coalesce(F.col(f"{cat}_pts"), F.lit(0)) for cat in CATEGORIES) + F.col("bonus_pts")
    max_score = sum(F.when(F.col(f"{cat}_pts").isNotNull(), 5).otherwise(0) for cat in CATEGORIES)
    base_cols = [x for x in ctx.columns] if keep else ["id", "day"]
    out = pts.select(*base_cols, score.alias("score"), max_score.alias("max_score"), "bonus_pts")
    pct = F.when(F.col("max_score") > 0, F.col("score") * F.lit(100.0) / F.col("max_score")).otherwise(F.lit(0.0))
    return out.withColumn("percentage", pct).withColumns(
        {"rating": tier(F.col("percentage")), "rating_description": tier_description(F.col("percentage"))})


def tier_distribution(rating: DataFrame) -> DataFrame:
    """AG17: per day: rows, distinct ids, count per tier (one pass)."""
    return rating.groupBy("day").agg(
        F.count("*").alias("n_rows"), F.count_distinct("id").alias("n_ids"),
        *[F.count_if(F.col("rating") == name).alias(f"n_{name.lower()}") for name, _, _ in K.TIERS])
