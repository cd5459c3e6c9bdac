"""Daily wide table.

The event-derived columns already come out of one aggregate (the union
merge replaces the reference's chain of full outer joins on (id, day)); here
the per-id dimensions are joined on id and the rule-input projection is
built. The big side is partitioned by id after the window pass, so each
dimension join moves only the dimension side (or AQE broadcasts it).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions import constants as K
from daybook.functions.cache import per_context
from daybook.functions.exprs import any_of, band, flag, safe_pct, truthy
from daybook.plans import features as fe
from daybook.sources import writes

#: in the order in which the first nutrient met is named
NUTRIENTS = [("protein", "protein_goal"), ("carbs", "carb_goal"), ("fat", "fat_goal"),
             ("calories", "calories_goal")]


def threshold_table(spark: SparkSession) -> DataFrame:
    """Glucose thresholds by group, with an explicit row for the
    enum value the rule set lacks (dm_target_6 -> dm_target_7 values)."""
    rows = [(g, *v) for g, v in K.GLUCOSE_THRESHOLDS.items()]
    rows.append(("dm_target_6", *K.GLUCOSE_THRESHOLDS[K.DEFAULT_A1C_GROUP]))
    cols = "a1c_group string, tir_positive int, tir_opportunity int, high_max int, low_max int, range_low int, range_high int"
    return spark.createDataFrame(rows, cols)


def with_thresholds(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Broadcast lookup on coalesce(group, default); the table has 5 rows by construction."""
    th = F.broadcast(threshold_table(spark).withColumnRenamed("a1c_group", "_grp"))
    key = F.coalesce(F.col("a1c_group"), F.lit(K.DEFAULT_A1C_GROUP))
    return df.join(th, key == F.col("_grp"), "left").drop("_grp")


def nutrient_counters(df: DataFrame) -> DataFrame:
    """Percent of goal, 90-110 band, counters, first nutrient met."""
    lo, hi = K.NUTRITION_RANGE_PCT
    df = df.withColumns({f"{n}_pct": safe_pct(n, g) for n, g in NUTRIENTS})
    df = df.withColumns({f"{n}_in_band": band(f"{n}_pct", lo, hi) for n, _ in NUTRIENTS})
    return df.withColumns({
        "any_nutrient_met": any_of(*[f"{n}_in_band" for n, _ in NUTRIENTS]),
        "total_nutrient_targets": sum(flag(F.col(g) > 0) for _, g in NUTRIENTS),
        "n_90_110": sum(F.coalesce(F.col(f"{n}_in_band"), F.lit(0)) for n, _ in NUTRIENTS),
        "n_60_plus": sum(flag(F.col(f"{n}_pct") >= 60) for n, _ in NUTRIENTS),
        "n_30_plus": sum(flag(F.col(f"{n}_pct") >= 30) for n, _ in NUTRIENTS),
        "nutrient_name_met": F.coalesce(*[F.when(F.col(f"{n}_in_band") == 1, F.lit(n)) for n, _ in NUTRIENTS]),
    })


@dataclass(frozen=True)
class Dims:
    """What is known of an id without a date: the state of its orders, its goals, its prescriptions."""

    orders: DataFrame
    goals: DataFrame
    per_med: DataFrame


def read_dims(spark: SparkSession, base: str) -> Dims:
    return Dims(fe.orders_dims(spark, base), fe.goals_per_id(spark, base), fe.prescriptions_per_med(spark, base))


def written_dims(spark: SparkSession, base: str) -> Dims:
    """The dimensions computed once and written, for several runs over the same tables."""
    def kept(df: DataFrame, name: str) -> DataFrame:
        path = writes.new_table_path(spark, name)
        df.write.parquet(path)
        return spark.read.parquet(path)
    d = read_dims(spark, base)
    return Dims(kept(d.orders, "dim-orders"), kept(d.goals, "dim-goals"), kept(d.per_med, "dim-prescriptions"))


def daily_wide(spark: SparkSession, base: str, events: DataFrame | None = None,
               report_day=None, focus: DataFrame | None = None, dims: Dims | None = None) -> DataFrame:
    """Features + per-id dimensions + per-day medication adherence.

    With ``report_day`` the features are those of that day alone, before any
    dimension join (O3): the joins see one row per id instead of one per id
    and day. ``focus`` is the focus state of each id (a daily run's snapshot);
    without it, it is read from all events. ``dims`` are the dimensions
    without a date, if written before (``written_dims``).
    """
    dims = dims or read_dims(spark, base)
    if report_day is None:
        feat = fe.daily_features(spark, base, events=events)
        meds = fe.medication_state(spark, base, events=events, per_med=dims.per_med)
    else:
        feat = fe.features_of_day(spark, base, report_day, events=events)
        meds = fe.medication_state(spark, base, run_date=report_day, events=events, per_med=dims.per_med, days=7)
    wide = (feat
            # focus is state without a date: never from the lookback alone
            .join(fe.focus_per_id(spark, base) if focus is None else focus, "id", "left")
            .join(dims.orders, "id", "left")
            .join(dims.goals, "id", "left")
            .join(meds["state"], "id", "left")
            .join(meds["daily"].select("id", "day", "adherence_pct", "took_all_meds", "adherence_7d_avg",
                                       "glycemic_med_adherent"),
                  ["id", "day"], "left"))
    wide = nutrient_counters(wide)
    wide = with_thresholds(spark, wide)
    tol = K.WEIGHT_MAINTENANCE_TOLERANCE_PCT / 100.0
    return wide.withColumn(
        # Latest weight within +/- 3 % of the target, for goals to maintain it
        "within_maintenance",
        F.coalesce((F.col("weight_goal_type") == "maintain") & F.col("weight").between(F.col("target_weight") * (1 - tol),
                                           F.col("target_weight") * (1 + tol)), F.lit(False)))


def rule_inputs(wide: DataFrame) -> DataFrame:
    """The rule engine's per-(id, day) record as one projection with defaults."""
    return wide.select(*_rule_input_columns())


@per_context
def _rule_input_columns() -> list:
    c = F.col
    return [
        "id", "day",
        truthy("has_cgm").alias("has_cgm"),
        truthy("has_step_tracker").alias("has_step_tracker"),
        F.coalesce(c("active_prescription_count") > 0, F.lit(False)).alias("has_medications"),
        truthy("has_weight_goal").alias("has_weight_goal"),
        "weight_goal_type",
        truthy("has_active_journey").alias("has_active_journey"),
        truthy("journey_task_completed").alias("journey_task_completed"),
        truthy("has_active_exercise_program").alias("has_exercise_program"),
        truthy("has_nutrient_goals").alias("has_nutrient_goals"),
        F.coalesce(c("focus_list"), F.array().cast("array<string>")).alias("focus_list"),
        F.coalesce(F.size("focus_list") > 0, F.lit(False)).alias("has_focus"),
        F.coalesce(c("a1c_group"), F.lit(K.DEFAULT_A1C_GROUP)).alias("a1c_group"),
        "tir_positive", "tir_opportunity", "high_max", "low_max",
        "tir_pct", c("tir_prev_logged").alias("tir_prev"), "high_pct", "low_pct",
        "steps", c("steps_prev_logged").alias("steps_prev"),
        c("steps_prev_logged_day").alias("steps_prev_day"), "steps_avg_7d",
        "active_minutes", c("active_minutes_prev_logged").alias("active_prev"), "weekly_active_minutes",
        "video_completion_pct",
        "sleep_hours", c("sleep_prev_logged").alias("sleep_prev"), "sleep_rating", "sleep_avg_7d",
        "sleep_rating_avg_7d",
        truthy("took_all_meds").alias("took_all_meds"),
        c("adherence_7d_avg").alias("med_adherence_7d_avg"),
        truthy("med_reminders_enabled").alias("med_reminders_enabled"),
        truthy("takes_glycemic_lowering_med").alias("takes_glycemic_lowering_med"),
        truthy("glycemic_med_adherent").alias("glycemic_med_adherent"),
        "meals", "days_with_meals_7d",
        truthy("any_nutrient_met").alias("any_nutrient_met"), "nutrient_name_met", "last_meal_type",
        "n_90_110", "n_60_plus", "n_30_plus", "total_nutrient_targets",
        truthy("weight_logged_today").alias("weight_logged_today"),
        "weight_pct_change", "weight_change_lbs_14d", "weight_change_pct_14d",
        "weight_logged_7d", "weight_logged_14d", "weight_logged_30d", "days_since_last_weight",
        "within_maintenance",
        truthy("meditation_7d").alias("meditation_7d"), truthy("meditation_30d").alias("meditation_30d"),
        truthy("journal_7d").alias("journal_7d"), truthy("journal_30d").alias("journal_30d"),
        truthy("plan_active").alias("plan_active"), truthy("plan_progress_30d").alias("plan_progress_30d"),
        truthy("program_started_today").alias("program_started_today"),
        truthy("program_progress_today").alias("program_progress_today"),
        *[truthy(f"{n}_today").alias(f"{n}_today") for n in fe.BONUS_EVENTS],
        truthy("grocery_today").alias("grocery_today"),
        truthy("video_completed_today").alias("video_completed_today"),
    ]


def context(spark: SparkSession, base: str, events: DataFrame | None = None, report_day=None) -> DataFrame:
    return rule_inputs(daily_wide(spark, base, events, report_day))
