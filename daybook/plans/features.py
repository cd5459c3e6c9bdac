"""Daily feature build: events/dimensions -> one row per (id, day).

Plan shape (what ``explain`` shows):
  1. one projected scan of ``events``; every event-derived domain is a set of
     conditional aggregates in ONE groupBy(id, day) (partial aggregation
     map-side, one exchange). Sleep intervals and epoch-ms grocery rows have
     other day keys and are unioned in as rows before that aggregate.
  2. one exchange on id, then gap fill (dense spine) and every rolling /
     lag / as-of feature in Window operators that share (id, day) ordering.
  3. per-id dimensions (one aggregate per source table) joined on id: the
     big side is already partitioned by id, only the dimension side moves,
     or AQE broadcasts it when its runtime size is small.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions import constants as K
from daybook.functions.cache import per_context
from daybook.functions.exprs import case_label, flag, lenient_int, map_label, safe_pct
from daybook.operators.intervals import hours, union_length_micros
from daybook.operators import windows
from daybook.operators.windows import AtDay, gap_fill, pct_change, rolling
from daybook.functions.timeutil import date_from_epoch_millis, epoch_millis, local_date
from daybook.plans import roles


#: events that earn a bonus point on their day
BONUS_EVENTS = ("meal_plan", "article", "lesson", "learn_video")
#: count columns, where a day without a row has 0; measures have NULL there
COUNTS = ("bg_count", "activity_sessions", "meditation_count", "meals", "journal_entries", "grocery_entries",
          "program_starts", "program_completions", "program_steps", "plan_entries", "activity_variety",
          *[f"{n}_events" for n in BONUS_EVENTS])


def _cnt(cond):
    return F.count_if(F.coalesce(cond, F.lit(False)))


def _variety(code):
    """Number of distinct codes of an enum, all above -32 and below 32."""
    return F.coalesce(F.bit_count(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), code.cast("int")))),
                      F.lit(0)).cast("bigint")


def _pct_of(cond, base_cond):
    n = _cnt(base_cond)
    return F.when(n > 0, _cnt(base_cond & cond) * F.lit(100.0) / n)


def _event_aggregates(spark: SparkSession, base: str, sleep_bucket_minutes: int = 60,
                      events: DataFrame | None = None) -> DataFrame:
    """AG1-AG7 + AG16 in one aggregate over (id, day), the last meal type as its id.

    One scan emits, per event, its role rows keyed by the day each role uses
    (local day; UTC day of the epoch-ms value for grocery entries; local day
    of the interval end for sleep), so a single groupBy(id, day) computes every
    domain. Only the interval-union lengths need their own branch.
    """
    ev = roles.events_base(spark, base, events)
    r = roles.with_role_columns(ev)
    sleep_end = F.timestamp_add("SECOND", F.round(F.col("value") * 60).cast("bigint"), F.col("ts"))
    kinds = F.array_compact(F.array(
        F.struct(F.lit("main").alias("kind"), F.col("day").alias("rday")),
        F.when(F.col("k") % 11 == 0, F.struct(F.lit("grocery").alias("kind"),
                                               date_from_epoch_millis(epoch_millis(F.col("ts"))).alias("rday"))),
        F.when(F.col("event_type") == "error", F.struct(F.lit("sleep").alias("kind"),
                                                        local_date(sleep_end, "off").alias("rday")))))
    rows = r.select("*", F.inline(kinds)).drop("day").withColumnRenamed("rday", "day")
    main = F.col("kind") == "main"
    rows = rows.withColumns({
        **{f: F.col(f) & main for f in ["is_bg", "is_act", "is_video", "is_step", "is_weight", "is_prog",
                                        "is_prog_done", "is_prog_step", *[f"is_{n}" for n in BONUS_EVENTS], "is_meal", "is_journal", "is_plan", "is_meditation"]},
        "is_grocery": F.col("kind") == "grocery",
        "is_sleep": F.col("kind") == "sleep",
        "rating": (F.col("k") % 11).cast("double"),
    })
    sleep_len = union_length_micros(roles.sleep_intervals(ev), ["id", "day"], "start_ts", "end_ts",
                                    sleep_bucket_minutes)
    rows = rows.unionByName(sleep_len, allowMissingColumns=True)

    return rows.groupBy("id", "day").agg(*_daily_agg_exprs())


def daily_event_aggregates(spark: SparkSession, base: str, sleep_bucket_minutes: int = 60,
                           events: DataFrame | None = None) -> DataFrame:
    """AG1-AG7 + AG16 of each (id, day); ``events`` overrides the table read."""
    return _labelled(_event_aggregates(spark, base, sleep_bucket_minutes, events))


def _labelled(agg: DataFrame) -> DataFrame:
    """The label after the aggregate: the buffer stays primitive (hash aggregate)."""
    return agg.withColumn("last_meal_type", case_label("last_meal_type_id", K.MEAL_TYPE_MAPPING)) \
        .drop("last_meal_type_id")


@per_context
def _daily_agg_exprs() -> list:
    """Conditional aggregates of the one-pass daily aggregate (AG1-AG7, AG16)."""
    bg = F.col("is_bg")
    v = F.col("value")
    act = F.col("is_act") & ~F.col("is_meditation")
    meal = F.col("is_meal")
    sl = F.col("is_sleep")
    return [
        # AG1 glucose shares (B14 ratio over readings)
        _cnt(bg).alias("bg_count"),
        _pct_of(v.between(70, 180), bg).alias("tir_pct"),
        _pct_of(v > 180, bg).alias("high_pct"),
        _pct_of(v < 70, bg).alias("low_pct"),
        _pct_of(v < 54, bg).alias("very_low_pct"),
        F.avg(F.when(bg, v)).alias("avg_bg"),
        F.max(flag(bg & (F.col("source") == K.CGM_SOURCE_ID))).alias("cgm_day"),
        # AG2 activity (meditation excluded, B7), AG6 meditation presence
        F.sum(F.when(act, v)).alias("active_minutes"),
        _cnt(act).alias("activity_sessions"),
        # distinct over an enum: bits of a long, so the buffer stays primitive (hash aggregate)
        _variety(F.when(act, F.col("exercisetype") - 30040)).alias("activity_variety"),
        _cnt(F.col("is_meditation")).alias("meditation_count"),
        F.max(F.when(F.col("is_video"), F.col("video_pct"))).alias("video_completion_pct"),
        # AG3 steps (B8 non-null)
        F.sum(F.when(F.col("is_step"), F.col("steps_v"))).alias("steps"),
        # AG5/E7 latest weight of the day
        F.max_by(F.when(F.col("is_weight"), F.col("weight_v")), F.when(F.col("is_weight"), F.col("ts"))).alias("weight"),
        # AG4 nutrients + distinct meals, AG5 last meal type
        _variety(F.when(meal, F.col("meal_type_id"))).alias("meals"),
        F.sum(F.when(meal, v / 5)).alias("carbs"),
        F.sum(F.when(meal, v / 10)).alias("protein"),
        F.sum(F.when(meal, v / 15)).alias("fat"),
        F.sum(F.when(meal, v * 2)).alias("calories"),
        F.sum(F.when(meal, v / 20)).alias("fiber"),
        F.sum(F.when(meal, v / 8)).alias("sugar"),
        F.sum(F.when(meal, v / 25)).alias("added_sugars"),
        F.max_by(F.when(meal, F.col("meal_type_id")), F.when(meal, F.col("ts"))).alias("last_meal_type_id"),
        # AG6 presence counts
        _cnt(F.col("is_journal")).alias("journal_entries"),
        _cnt(F.col("is_grocery")).alias("grocery_entries"),
        _cnt(F.col("is_prog")).alias("program_starts"),
        _cnt(F.col("is_prog_done")).alias("program_completions"),
        *[_cnt(F.col(f"is_{n}")).alias(f"{n}_events") for n in BONUS_EVENTS],
        _cnt(F.col("is_prog_step")).alias("program_steps"),
        # AG7 any-status flags (deleted rows removed)
        _cnt(F.col("is_plan")).alias("plan_entries"),
        F.max(flag(F.col("is_plan") & (F.col("plan_status") == 1))).alias("plan_active"),
        F.max(flag(F.col("is_plan") & (F.col("plan_status") == 2))).alias("plan_completed"),
        # AG16 sleep: raw count / mean rating, merged-interval hours
        F.when(_cnt(sl) > 0, _cnt(sl)).alias("sleep_count"),
        F.avg(F.when(sl, F.col("rating"))).alias("sleep_rating"),
        F.when(_cnt(sl) > 0, hours(F.coalesce(F.max("union_us"), F.lit(0)))).alias("sleep_hours"),
    ]


def last_day_column(spark: SparkSession, base: str, last_day=None):
    """The report day, or the UTC date of the newest event as a scalar subquery (read from file statistics)."""
    if last_day is not None:
        return F.lit(last_day).cast("date")
    return roles.load(spark, base, "events", ["ts"]).agg(F.to_date(F.max("ts"))).scalar()


def daily_features(spark: SparkSession, base: str, meal_days_min: int = 1,
                   events: DataFrame | None = None, last_day=None) -> DataFrame:
    """Dense (id, day) frame with deltas, rolling windows and flags.

    Every id's days run to ``last_day``, the report day (default: the UTC date of the newest event).
    """
    daily = gap_fill(daily_event_aggregates(spark, base, events=events),
                     last_day=last_day_column(spark, base, last_day))
    daily = daily.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in COUNTS})
    stage1, stage2, stage3 = _feature_columns(meal_days_min)
    return daily.withColumns(stage1).withColumns(stage2).withColumns(stage3)


def features_of_day(spark: SparkSession, base: str, day: dt.date, meal_days_min: int = 1,
                    events: DataFrame | None = None) -> DataFrame:
    """The rows of ``daily_features`` with last day ``day`` that are of that day, one per id with a day up to it.

    One aggregate per id in the place of the spine and its windows: of the
    days before, only what the report day's columns need is computed.
    """
    at = AtDay(day)
    today = F.lit(day).cast("date")
    rows = _event_aggregates(spark, base, events=events).filter(F.col("day") <= today)
    measures = [c for c in rows.columns if c not in ("id", "day")]
    stage1, stage2, stage3 = _feature_columns(meal_days_min, at)
    back = stage1 | stage2
    video = back.pop("video_completed_today")
    out = rows.withColumn("video_completed_today", video).groupBy("id").agg(
        F.max(F.col("day") == today).alias("is_logged"), *[at.on(c).alias(c) for c in measures],
        *[v.alias(c) for c, v in back.items()])
    out = out.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in COUNTS})
    out = _labelled(out.withColumn("day", today)).withColumn("video_completed_today", video)
    return out.select("id", "day", "is_logged", *[c for c in measures if c != "last_meal_type_id"], "last_meal_type",
                      *stage1, *stage2).withColumns(stage3)


@per_context
def _feature_columns(meal_days_min: int, at: AtDay | None = None) -> tuple[dict, dict, dict]:
    """The look-back / flag columns of ``daily_features`` in three dependent stages: windows on the spine, or
    aggregates for one day."""
    op = at or windows
    w14, w14_back = op.nearest_in_band("weight", 14, 10, 18)
    stage1 = {
        # glucose
        "tir_prev_logged": op.prev_logged("tir_pct"),
        "tir_prev_day": op.prev_calendar_day("tir_pct"),
        "has_cgm": op.any_in_last("cgm_day", 30),
        # activity
        "active_minutes_prev_logged": op.prev_logged("active_minutes"),
        "active_minutes_prev_day": op.prev_calendar_day("active_minutes"),
        "weekly_active_minutes": op.rolling(F.sum, "active_minutes", 7),
        "meditation_7d": op.any_in_last("meditation_count", 7),
        "meditation_30d": op.any_in_last("meditation_count", 30),
        "video_completed_today": flag(F.col("video_completion_pct") >= K.EXERCISE_COMPLETION_PCT),
        # steps
        "steps_prev_logged": op.prev_logged("steps"),
        "steps_prev_logged_day": op.prev_logged(F.when(F.col("steps").isNotNull(), F.col("day"))),
        "steps_avg_7d": op.rolling(F.avg, "steps", 7),
        "has_step_tracker": op.any_in_last(F.when(F.col("steps").isNotNull(), 1), 30),
        # weight
        "weight_prev_logged": op.prev_logged("weight"),
        "days_since_last_weight": op.days_since(F.col("weight").isNotNull()),
        "weight_14d_ago": w14,
        "weight_14d_days_back": w14_back,
        # food (D4: days with at least ``meal_days_min`` meals)
        "days_with_meals_7d": op.days_with(F.col("meals") >= meal_days_min, 7),
        # presence flags
        "journal_7d": op.any_in_last("journal_entries", 7),
        "journal_30d": op.any_in_last("journal_entries", 30),
        "plan_progress_7d": op.any_in_last("plan_entries", 7),
        "plan_progress_30d": op.any_in_last("plan_entries", 30),
        "grocery_7d": op.any_in_last("grocery_entries", 7),
        "program_7d": op.any_in_last("program_steps", 7),
        # sleep
        "sleep_prev_logged": op.prev_logged("sleep_hours"),
        "sleep_rating_prev_logged": op.prev_logged("sleep_rating"),
        "sleep_avg_7d": op.rolling(F.avg, "sleep_hours", 7),
        "sleep_rating_avg_7d": op.rolling(F.avg, "sleep_rating", 7),
    }
    stage2 = {"video_completed_7d": op.any_in_last("video_completed_today", 7)}
    stage3 = {
        "tir_delta_1d": F.col("tir_pct") - F.col("tir_prev_logged"),
        "active_minutes_delta_1d": F.col("active_minutes") - F.col("active_minutes_prev_logged"),
        "activity_same_or_more": flag(
            (F.col("active_minutes") - F.col("active_minutes_prev_logged"))
            >= -K.ACTIVITY_DAILY_TOLERANCE_MINUTES),
        "steps_delta_1d": F.col("steps") - F.col("steps_prev_logged"),
        "steps_target_met": flag(F.col("steps") >= K.STEPS_DAILY_TARGET),
        "steps_improved": flag(F.col("steps") > F.col("steps_prev_logged")),
        "weight_logged_today": flag(F.col("weight").isNotNull()),
        "weight_pct_change": pct_change("weight", "weight_prev_logged"),
        "weight_change_lbs_14d": F.col("weight") - F.col("weight_14d_ago"),
        "weight_change_pct_14d": pct_change("weight", "weight_14d_ago"),
        "weight_logged_7d": F.coalesce(F.col("days_since_last_weight") <= 7, F.lit(False)),
        "weight_logged_14d": F.coalesce(F.col("days_since_last_weight") <= 14, F.lit(False)),
        "weight_logged_30d": F.coalesce(F.col("days_since_last_weight") <= 30, F.lit(False)),
        "meal_logged_today": flag(F.col("meals") >= 1),
        "sleep_delta_1d": F.col("sleep_hours") - F.col("sleep_prev_logged"),
        "sleep_rating_delta_1d": F.col("sleep_rating") - F.col("sleep_rating_prev_logged"),
        "sleep_hours_met": flag(F.col("sleep_hours") >= K.SLEEP_HOURS_TARGET),
        "sleep_rating_met": flag(F.col("sleep_rating") >= K.SLEEP_RATING_TARGET),
        "sleep_improved": flag(F.col("sleep_hours") > F.col("sleep_prev_logged")),
        "journal_today": flag(F.col("journal_entries") > 0),
        "meditation_today": flag(F.col("meditation_count") > 0),
        "grocery_today": flag(F.col("grocery_entries") > 0),
        "program_started_today": flag(F.col("program_starts") > 0),
        **{f"{n}_today": flag(F.col(f"{n}_events") > 0) for n in BONUS_EVENTS},
        "program_completed_today": flag(F.col("program_completions") > 0),
        "program_progress_today": flag(F.col("program_steps") > 0),
    }
    return stage1, stage2, stage3


# ---------------------------------------------------------------------------
# per-id dimensions
# ---------------------------------------------------------------------------

def focus_per_id(spark: SparkSession, base: str, events: DataFrame | None = None) -> DataFrame:
    """B11 + AG14: JSON array -> explode -> active ids -> sorted distinct names."""
    js = roles.focus_json(roles.events_base(spark, base, events))
    schema = "array<struct<MyFocusID:int,IsMyFocus:int,FocusOptionID:int>>"
    items = js.select("id", F.explode(F.from_json("myfocusdata", schema)).alias("f"))
    named = (items.filter(F.col("f.IsMyFocus") == 1)
             .select("id", map_label(F.col("f.MyFocusID"), K.FOCUS_ID_MAPPING).alias("focus"))
             .filter(F.col("focus").isNotNull()))
    agg = named.groupBy("id").agg(F.array_sort(F.collect_set("focus")).alias("focus_list"))
    return agg.select("id", "focus_list",
                      F.when(F.size("focus_list") > 0, F.array_join("focus_list", ",")).alias("user_focus"))


def orders_dims(spark: SparkSession, base: str) -> DataFrame:
    """One aggregate over orders per id: A1C target (E7 + B9), journey (AG8),
    video lifetime summary (AG9), program summary (AG10)."""
    o = roles.orders_state(spark, base)
    st = F.col("o_orderstatus")
    # journey rows: orders with key % 7 = 0 (see roles)
    journey = F.when(F.col("o_orderkey") % 7 == 0,
                     F.when(st == "O", 1).when(st == "F", 2).when(st == "P", 3))
    done = F.when(st == "F", 2).otherwise(1)
    # latest order by (date, key) as ONE exact decimal key (epoch seconds * 1e19 + key):
    # same order as the pair, and a primitive buffer keeps it a hash aggregate
    secs = F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("o_orderdate"))
    order_key = secs.cast("decimal(38,0)") * F.lit("10000000000000000000").cast("decimal(38,0)") + F.col("o_orderkey").cast("decimal(38,0)")
    latest = F.max_by(F.col("o_orderkey") % 3 + 1, order_key)
    agg = o.groupBy("id").agg(
        latest.cast("int").alias("a1c_target_id"),
        F.count_if(journey == 1).alias("active_journey_count"),
        F.count_if(journey == 2).alias("completed_journey_count"),
        F.count("*").alias("order_count"),
        F.count_if(done == 2).alias("completed_count"),
        F.count_if(done == 1).alias("active_program_count"),
    )
    return agg.select(
        "id", "a1c_target_id",
        map_label("a1c_target_id", K.A1C_TARGET_MAPPING).alias("a1c_group"),
        "active_journey_count", "completed_journey_count",
        flag(F.col("active_journey_count") > 0).alias("has_active_journey"),
        flag(F.col("completed_journey_count") > 0).alias("has_completed_journey"),
        flag((F.col("active_journey_count") > 0) & (F.col("completed_journey_count") > 0)).alias("journey_task_completed"),
        flag(F.col("completed_count") > 0).alias("video_ever_completed"),
        F.col("order_count").alias("video_total"),
        flag(F.col("order_count") > 0).alias("has_exercise_video_activity"),
        flag(F.col("active_program_count") > 0).alias("has_active_exercise_program"),
        flag(F.col("completed_count") > 0).alias("has_completed_exercise_program"),
        "active_program_count", F.col("completed_count").alias("programs_completed"),
    )


def goals_per_id(spark: SparkSession, base: str) -> DataFrame:
    """The latest active goal row of each id, enum mapped to a label before use."""
    cols = ["goal_type_id", "target_weight", "protein_goal", "carb_goal", "fat_goal", "calories_goal"]
    g = (roles.customer_goals(spark, base).filter(F.col("goal_status") == 1).groupBy("id")
         .agg(F.max_by(F.struct(*cols), F.struct("goal_start", *cols)).alias("g")).select("id", "g.*"))
    return g.withColumns({
        "weight_goal_type": map_label("goal_type_id", {1: "lose", 2: "maintain", 3: "gain"}),
        "has_weight_goal": flag(F.col("goal_type_id").isNotNull()),
        "has_nutrient_goals": flag(F.greatest("protein_goal", "carb_goal", "fat_goal", "calories_goal") > 0),
    })


def prescriptions_per_med(spark: SparkSession, base: str) -> DataFrame:
    """The active prescriptions of each id and medication, without a run date: ``rx_stop`` is the last
    discontinuation, ``rx_open`` tells of one that runs on."""
    src = roles.medication_sources(spark, base)
    rx = src["rx"].filter(F.col("statusid") == 1).withColumn("doses_per_day", lenient_int("frequencyvalue", 1))
    # one row per id and medication; the state is then an aggregate of it, so the prescriptions are joined once
    klass = src["class"].groupBy("medicationid").agg(F.max(flag(F.col("diabetesclass"))).alias("glycemic"))
    nonzero = flag(F.col("medicationreminder").isNotNull() & (F.col("medicationreminder").try_cast("int") != 0))
    return rx.groupBy("id", "medicationid").agg(
        F.count("*").alias("prescriptions"), F.sum("doses_per_day").alias("expected"),
        F.min("startdate").alias("rx_start"), F.max("discontinueddate").alias("rx_stop"),
        F.max(F.col("discontinueddate").isNull()).alias("rx_open"),
        F.max(nonzero).alias("reminder")).join(klass, "medicationid", "left").withColumn(
        "glycemic", F.coalesce("glycemic", F.lit(0)))


def medication_state(spark: SparkSession, base: str, run_date=None, events: DataFrame | None = None,
                     per_med: DataFrame | None = None, days: int | None = None) -> dict[str, DataFrame]:
    """C5 C6 C7 C9 AG11-AG13 E6: prescriptions, capped two-level adherence, reminders.

    Adherence follows D5: its days are those of each active prescription from
    the first dose day in the events read to ``run_date`` (the report day,
    D14), and a medication without a dose counts as 0 taken. The 7-day mean and
    the daily glycemic flag run on that dense frame. Doses of a medication
    without an active prescription do not count (C6). ``per_med`` are the
    prescriptions, if read before; with ``days`` the daily frame has the last
    ``days`` days only (7 are what the last day's mean needs).
    """
    src = roles.medication_sources(spark, base, events)
    end = last_day_column(spark, base, run_date)
    per_med = prescriptions_per_med(spark, base) if per_med is None else per_med
    per_med = per_med.withColumn("rx_end", F.greatest("rx_stop", F.when(F.col("rx_open"), end)))
    doses = src["dose"].filter(F.col("statusid") == 1)
    first = doses.agg(F.min("day")).scalar()
    low, high = F.greatest("rx_start", first), F.least("rx_end", end)
    if days is not None:
        low = F.greatest(low, F.date_sub(end, days - 1))
        doses = doses.filter(F.col("day").between(F.date_sub(end, days - 1), end))
    frame = per_med.filter(low <= high).select("id", "medicationid", "expected", "glycemic",
                                               F.explode(F.sequence(low, high)).alias("day"))
    taken = doses.groupBy("id", "medicationid", "day").agg(F.count("*").alias("taken"))
    frame = frame.join(taken, ["id", "medicationid", "day"], "left").withColumn("taken", F.coalesce("taken", F.lit(0)))
    daily = frame.groupBy("id", "day").agg(
        F.sum(F.least("taken", "expected")).alias("capped_taken"), F.sum("expected").alias("expected_total"),
        F.sum("taken").alias("doses_taken"),
        F.max(flag((F.col("glycemic") == 1) & (F.col("taken") > 0))).alias("glycemic_med_adherent"))
    daily = daily.withColumn(
        "adherence_pct", F.least(safe_pct("capped_taken", "expected_total"), F.lit(100.0)))
    daily = daily.withColumns({
        "took_all_meds": flag(F.col("adherence_pct") >= 100),
        "adherence_7d_avg": rolling(F.avg, "adherence_pct", 7),
    })
    state = per_med.groupBy("id").agg(
        F.sum("prescriptions").alias("active_prescription_count"), F.sum("expected").alias("expected_daily_doses"),
        F.max("reminder").alias("med_reminders_enabled"), F.max("glycemic").alias("takes_glycemic_lowering_med"))
    return {"daily": daily, "state": state}
