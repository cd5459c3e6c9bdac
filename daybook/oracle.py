"""DuckDB SQL oracles for the registered queries.

Each query in ``daybook.registry`` has an independent SQL formulation here,
run by the driver on the same parquet tables. The SQL does not mirror the
Spark plan: the as-of band is a self join with ``row_number``, the sleep
union is the classic islands query over raw intervals, the spine is
``generate_series``.

The CTEs below are composed per query with ``sql(...)``.
"""

from __future__ import annotations

from daybook.functions import constants as K

CTE: dict[str, str] = {}
DEPS: dict[str, list[str]] = {}


def cte(name: str, body: str, deps: list[str] | None = None) -> None:
    CTE[name] = body
    DEPS[name] = deps or []


def _order(names: list[str]) -> list[str]:
    seen: list[str] = []

    def visit(n):
        if n in seen:
            return
        for d in DEPS[n]:
            visit(d)
        seen.append(n)
    for n in names:
        visit(n)
    return seen


def sql(final: str, *needs: str) -> str:
    names = _order(list(needs))
    if not names:
        return final
    return "WITH " + ",\n".join(f"{n} AS (\n{CTE[n]}\n)" for n in names) + "\n" + final


def r4(expr: str) -> str:
    return f"round(CAST({expr} AS DOUBLE), 4)"


def _values(rows: list[tuple], cols: list[str]) -> str:
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return str(v)
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) AS t({', '.join(cols)})"


# ---------------------------------------------------------------------------
# roles (same derivations as daybook.plans.roles)
# ---------------------------------------------------------------------------
cte("evd", """
SELECT user_id AS id, ts, event_type, value, k, off, k % 4 AS status, k % 20 AS source,
       CAST(ts + to_minutes(off) AS DATE) AS day
FROM (SELECT user_id, ts, event_type, value,
             TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
             CAST((user_id % 25 - 12) * 60 AS INTEGER) AS off
      FROM events)""")

cte("roles", """
SELECT *, is_act AND exercisetype = 30045 AS is_meditation,
       CASE meal_type_id WHEN 1 THEN 'breakfast' WHEN 3 THEN 'lunch' WHEN 5 THEN 'dinner'
                         WHEN 12 THEN 'snack' END AS meal_type
FROM (SELECT *,
        event_type = 'view' AND status IN (1, 2) AS is_bg,
        event_type = 'click' AS is_act,
        30040 + k % 8 AS exercisetype,
        event_type = 'click' AND k % 10 = 0 AS is_video,
        least(value / 4.9, 100.0) AS video_pct,
        event_type = 'purchase' AS is_step,
        CAST(round(value * 40) AS BIGINT) AS steps_v,
        event_type = 'signup' AS is_weight,
        150.0 + value / 10 AS weight_v,
        event_type = 'signup' AND k % 5 = 0 AS is_prog,
        event_type = 'signup' AND k % 5 = 1 AS is_prog_done,
        event_type = 'signup' AND k % 5 = 2 AS is_prog_step,
        k % 3 = 0 AS is_meal,
        event_type = 'purchase' AND k % 9 = 0 AS is_meal_plan,
        event_type = 'view' AND k % 9 = 1 AS is_article,
        event_type = 'view' AND k % 9 = 2 AS is_lesson,
        event_type = 'click' AND k % 9 = 3 AS is_learn_video,
        [1, 3, 5, 12][(k // 3) % 4 + 1] AS meal_type_id,
        k % 7 = 0 AS is_journal,
        k % 13 = 0 AND k % 3 + 1 <> 3 AS is_plan,
        k % 3 + 1 AS plan_status
      FROM evd)""", ["evd"])

cte("groc", """
SELECT id, DATE '1970-01-01' + CAST(floor(epoch_ms(ts) / 86400000) AS INTEGER) AS day,
       TRUE AS is_grocery
FROM evd WHERE k % 11 = 0""", ["evd"])

cte("sleep_iv", """
SELECT id, start_ts, end_ts, rating, CAST(end_ts + to_minutes(off) AS DATE) AS day
FROM (SELECT id, ts AS start_ts, ts + to_seconds(CAST(round(value * 60) AS BIGINT)) AS end_ts,
             CAST(k % 11 AS DOUBLE) AS rating, off
      FROM evd WHERE event_type = 'error')""", ["evd"])

cte("sleep_islands", """
SELECT id, day, SUM(len) AS union_us FROM (
  SELECT id, day, island, date_diff('microsecond', min(start_ts), max(end_ts)) AS len FROM (
    SELECT *, SUM(CASE WHEN prev_end IS NULL OR start_ts > prev_end THEN 1 ELSE 0 END)
                OVER (PARTITION BY id, day ORDER BY start_ts, end_ts ROWS UNBOUNDED PRECEDING) AS island
    FROM (SELECT id, day, start_ts, end_ts,
                 max(end_ts) OVER (PARTITION BY id, day ORDER BY start_ts, end_ts
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_end
          FROM sleep_iv WHERE end_ts > start_ts))
  GROUP BY id, day, island)
GROUP BY id, day""", ["sleep_iv"])

cte("sleep_daily", """
SELECT s.id, s.day, s.sleep_count, s.sleep_rating,
       COALESCE(l.union_us, 0) / 3600000000.0 AS sleep_hours
FROM (SELECT id, day, count(*) AS sleep_count, avg(rating) AS sleep_rating
      FROM sleep_iv GROUP BY id, day) s
LEFT JOIN sleep_islands l USING (id, day)""", ["sleep_iv", "sleep_islands"])

cte("agg", """
SELECT id, day,
  count(*) FILTER (WHERE is_bg) AS bg_count,
  CASE WHEN count(*) FILTER (WHERE is_bg) > 0 THEN
    count(*) FILTER (WHERE is_bg AND value BETWEEN 70 AND 180) * 100.0 / count(*) FILTER (WHERE is_bg) END AS tir_pct,
  CASE WHEN count(*) FILTER (WHERE is_bg) > 0 THEN
    count(*) FILTER (WHERE is_bg AND value > 180) * 100.0 / count(*) FILTER (WHERE is_bg) END AS high_pct,
  CASE WHEN count(*) FILTER (WHERE is_bg) > 0 THEN
    count(*) FILTER (WHERE is_bg AND value < 70) * 100.0 / count(*) FILTER (WHERE is_bg) END AS low_pct,
  CASE WHEN count(*) FILTER (WHERE is_bg) > 0 THEN
    count(*) FILTER (WHERE is_bg AND value < 54) * 100.0 / count(*) FILTER (WHERE is_bg) END AS very_low_pct,
  avg(value) FILTER (WHERE is_bg) AS avg_bg,
  max(CASE WHEN is_bg AND source = 18 THEN 1 ELSE 0 END) AS cgm_day,
  sum(value) FILTER (WHERE is_act AND NOT is_meditation) AS active_minutes,
  count(*) FILTER (WHERE is_act AND NOT is_meditation) AS activity_sessions,
  count(DISTINCT exercisetype) FILTER (WHERE is_act AND NOT is_meditation) AS activity_variety,
  count(*) FILTER (WHERE is_meditation) AS meditation_count,
  max(video_pct) FILTER (WHERE is_video) AS video_completion_pct,
  CAST(sum(steps_v) FILTER (WHERE is_step) AS BIGINT) AS steps,
  arg_max(weight_v, ts) FILTER (WHERE is_weight) AS weight,
  count(DISTINCT meal_type_id) FILTER (WHERE is_meal) AS meals,
  sum(value / 5) FILTER (WHERE is_meal) AS carbs,
  sum(value / 10) FILTER (WHERE is_meal) AS protein,
  sum(value / 15) FILTER (WHERE is_meal) AS fat,
  sum(value * 2) FILTER (WHERE is_meal) AS calories,
  sum(value / 20) FILTER (WHERE is_meal) AS fiber,
  sum(value / 8) FILTER (WHERE is_meal) AS sugar,
  sum(value / 25) FILTER (WHERE is_meal) AS added_sugars,
  arg_max(meal_type, ts) FILTER (WHERE is_meal) AS last_meal_type,
  count(*) FILTER (WHERE is_journal) AS journal_entries,
  count(*) FILTER (WHERE is_grocery) AS grocery_entries,
  count(*) FILTER (WHERE is_prog) AS program_starts,
  count(*) FILTER (WHERE is_prog_done) AS program_completions,
  count(*) FILTER (WHERE is_meal_plan) AS meal_plan_events,
  count(*) FILTER (WHERE is_article) AS article_events,
  count(*) FILTER (WHERE is_lesson) AS lesson_events,
  count(*) FILTER (WHERE is_learn_video) AS learn_video_events,
  count(*) FILTER (WHERE is_prog_step) AS program_steps,
  count(*) FILTER (WHERE is_plan) AS plan_entries,
  max(CASE WHEN is_plan AND plan_status = 1 THEN 1 ELSE 0 END) AS plan_active,
  max(CASE WHEN is_plan AND plan_status = 2 THEN 1 ELSE 0 END) AS plan_completed,
  max(sleep_count) AS sleep_count, max(sleep_rating) AS sleep_rating, max(sleep_hours) AS sleep_hours
FROM (SELECT * FROM roles UNION ALL BY NAME SELECT * FROM groc
      UNION ALL BY NAME SELECT * FROM sleep_daily)
GROUP BY id, day""", ["roles", "groc", "sleep_daily"])

cte("dense", """
SELECT s.id, s.day, a.id IS NOT NULL AS is_logged, (s.day - DATE '1970-01-01') AS dn,
  a.* EXCLUDE (id, day, bg_count, activity_sessions, meditation_count, meals, journal_entries,
               grocery_entries, program_starts, program_completions, program_steps, plan_entries, activity_variety,
               meal_plan_events, article_events, lesson_events, learn_video_events),
  COALESCE(a.bg_count, 0) AS bg_count, COALESCE(a.activity_sessions, 0) AS activity_sessions,
  COALESCE(a.meditation_count, 0) AS meditation_count, COALESCE(a.meals, 0) AS meals,
  COALESCE(a.journal_entries, 0) AS journal_entries, COALESCE(a.grocery_entries, 0) AS grocery_entries,
  COALESCE(a.program_starts, 0) AS program_starts, COALESCE(a.program_completions, 0) AS program_completions,
  COALESCE(a.meal_plan_events, 0) AS meal_plan_events, COALESCE(a.article_events, 0) AS article_events,
  COALESCE(a.lesson_events, 0) AS lesson_events, COALESCE(a.learn_video_events, 0) AS learn_video_events,
  COALESCE(a.program_steps, 0) AS program_steps, COALESCE(a.plan_entries, 0) AS plan_entries,
  COALESCE(a.activity_variety, 0) AS activity_variety
FROM (SELECT id, CAST(unnest(generate_series(min(day), greatest(max(day), (SELECT CAST(max(ts) AS DATE) FROM events)), INTERVAL 1 DAY)) AS DATE) AS day
      FROM agg GROUP BY id) s
LEFT JOIN agg a USING (id, day)""", ["agg"])

cte("band", """
SELECT id, day, w AS weight_14d_ago, back AS weight_14d_days_back FROM (
  SELECT a.id, a.day, b.weight AS w, CAST(date_diff('day', b.day, a.day) AS INTEGER) AS back,
         row_number() OVER (PARTITION BY a.id, a.day
                            ORDER BY abs(date_diff('day', b.day, a.day) - 14), date_diff('day', b.day, a.day)) AS rn
  FROM dense a JOIN dense b
    ON a.id = b.id AND b.weight IS NOT NULL AND date_diff('day', b.day, a.day) BETWEEN 10 AND 18)
WHERE rn = 1""", ["dense"])

_W = "PARTITION BY id ORDER BY day"
_PREV = f"OVER ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"


def _rng(n):
    return f"OVER (PARTITION BY id ORDER BY dn RANGE BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def _any(c, n):
    return f"CASE WHEN sum(COALESCE({c}, 0)) {_rng(n)} > 0 THEN 1 ELSE 0 END"


cte("feat1", f"""
SELECT d.*, b.weight_14d_ago, b.weight_14d_days_back,
  last_value(tir_pct IGNORE NULLS) {_PREV} AS tir_prev_logged,
  lag(tir_pct) OVER ({_W}) AS tir_prev_day,
  {_any('cgm_day', 30)} AS has_cgm,
  last_value(active_minutes IGNORE NULLS) {_PREV} AS active_minutes_prev_logged,
  lag(active_minutes) OVER ({_W}) AS active_minutes_prev_day,
  sum(active_minutes) {_rng(7)} AS weekly_active_minutes,
  {_any('meditation_count', 7)} AS meditation_7d,
  {_any('meditation_count', 30)} AS meditation_30d,
  CASE WHEN video_completion_pct >= 90 THEN 1 ELSE 0 END AS video_completed_today,
  last_value(steps IGNORE NULLS) {_PREV} AS steps_prev_logged,
  max(CASE WHEN steps IS NOT NULL THEN day END) {_PREV} AS steps_prev_logged_day,
  avg(steps) {_rng(7)} AS steps_avg_7d,
  {_any('CASE WHEN steps IS NOT NULL THEN 1 END', 30)} AS has_step_tracker,
  last_value(weight IGNORE NULLS) {_PREV} AS weight_prev_logged,
  CAST(date_diff('day', max(CASE WHEN weight IS NOT NULL THEN day END)
       OVER ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), day) AS INTEGER) AS days_since_last_weight,
  CAST(sum(CASE WHEN meals >= 1 THEN 1 ELSE 0 END) {_rng(7)} AS BIGINT) AS days_with_meals_7d,
  {_any('journal_entries', 7)} AS journal_7d,
  {_any('journal_entries', 30)} AS journal_30d,
  {_any('plan_entries', 7)} AS plan_progress_7d,
  {_any('plan_entries', 30)} AS plan_progress_30d,
  {_any('grocery_entries', 7)} AS grocery_7d,
  {_any('program_steps', 7)} AS program_7d,
  last_value(sleep_hours IGNORE NULLS) {_PREV} AS sleep_prev_logged,
  last_value(sleep_rating IGNORE NULLS) {_PREV} AS sleep_rating_prev_logged,
  avg(sleep_hours) {_rng(7)} AS sleep_avg_7d,
  avg(sleep_rating) {_rng(7)} AS sleep_rating_avg_7d
FROM dense d LEFT JOIN band b USING (id, day)""", ["dense", "band"])

cte("feat", f"""
SELECT *,
  {_any('video_completed_today', 7)} AS video_completed_7d,
  tir_pct - tir_prev_logged AS tir_delta_1d,
  active_minutes - active_minutes_prev_logged AS active_minutes_delta_1d,
  CASE WHEN active_minutes - active_minutes_prev_logged >= -3 THEN 1 ELSE 0 END AS activity_same_or_more,
  steps - steps_prev_logged AS steps_delta_1d,
  CASE WHEN steps >= 10000 THEN 1 ELSE 0 END AS steps_target_met,
  CASE WHEN steps > steps_prev_logged THEN 1 ELSE 0 END AS steps_improved,
  CASE WHEN weight IS NOT NULL THEN 1 ELSE 0 END AS weight_logged_today,
  CASE WHEN weight_prev_logged > 0 THEN (weight - weight_prev_logged) / weight_prev_logged * 100.0 END AS weight_pct_change,
  weight - weight_14d_ago AS weight_change_lbs_14d,
  CASE WHEN weight_14d_ago > 0 THEN (weight - weight_14d_ago) / weight_14d_ago * 100.0 END AS weight_change_pct_14d,
  COALESCE(days_since_last_weight <= 7, FALSE) AS weight_logged_7d,
  COALESCE(days_since_last_weight <= 14, FALSE) AS weight_logged_14d,
  COALESCE(days_since_last_weight <= 30, FALSE) AS weight_logged_30d,
  CASE WHEN meals >= 1 THEN 1 ELSE 0 END AS meal_logged_today,
  sleep_hours - sleep_prev_logged AS sleep_delta_1d,
  sleep_rating - sleep_rating_prev_logged AS sleep_rating_delta_1d,
  CASE WHEN sleep_hours >= 7 THEN 1 ELSE 0 END AS sleep_hours_met,
  CASE WHEN sleep_rating >= 7 THEN 1 ELSE 0 END AS sleep_rating_met,
  CASE WHEN sleep_hours > sleep_prev_logged THEN 1 ELSE 0 END AS sleep_improved,
  CASE WHEN journal_entries > 0 THEN 1 ELSE 0 END AS journal_today,
  CASE WHEN meditation_count > 0 THEN 1 ELSE 0 END AS meditation_today,
  CASE WHEN grocery_entries > 0 THEN 1 ELSE 0 END AS grocery_today,
  CASE WHEN program_starts > 0 THEN 1 ELSE 0 END AS program_started_today,
  CASE WHEN program_completions > 0 THEN 1 ELSE 0 END AS program_completed_today,
  CASE WHEN meal_plan_events > 0 THEN 1 ELSE 0 END AS meal_plan_today,
  CASE WHEN article_events > 0 THEN 1 ELSE 0 END AS article_today,
  CASE WHEN lesson_events > 0 THEN 1 ELSE 0 END AS lesson_today,
  CASE WHEN learn_video_events > 0 THEN 1 ELSE 0 END AS learn_video_today,
  CASE WHEN program_steps > 0 THEN 1 ELSE 0 END AS program_progress_today
FROM feat1""", ["feat1"])

# per-id dimensions -----------------------------------------------------------
_focus_case = " ".join(f"WHEN {k} THEN '{v}'" for k, v in K.FOCUS_ID_MAPPING.items())
cte("focus", f"""
SELECT id, list_sort(list(DISTINCT focus)) AS focus_list,
       array_to_string(list_sort(list(DISTINCT focus)), ',') AS user_focus
FROM (SELECT id, CASE k % 14 {_focus_case} END AS focus
      FROM evd WHERE event_type = 'signup' AND k % 2 = 1)
WHERE focus IS NOT NULL GROUP BY id""", ["evd"])

cte("odims", """
SELECT id, a1c_target_id,
  CASE a1c_target_id WHEN 1 THEN 'dm_target_7' WHEN 2 THEN 'dm_target_8' WHEN 3 THEN 'dm_target_6' END AS a1c_group,
  active_journey_count, completed_journey_count,
  CASE WHEN active_journey_count > 0 THEN 1 ELSE 0 END AS has_active_journey,
  CASE WHEN completed_journey_count > 0 THEN 1 ELSE 0 END AS has_completed_journey,
  CASE WHEN active_journey_count > 0 AND completed_journey_count > 0 THEN 1 ELSE 0 END AS journey_task_completed,
  CASE WHEN completed_count > 0 THEN 1 ELSE 0 END AS video_ever_completed,
  order_count AS video_total,
  CASE WHEN order_count > 0 THEN 1 ELSE 0 END AS has_exercise_video_activity,
  CASE WHEN active_program_count > 0 THEN 1 ELSE 0 END AS has_active_exercise_program,
  CASE WHEN completed_count > 0 THEN 1 ELSE 0 END AS has_completed_exercise_program,
  active_program_count, completed_count AS programs_completed
FROM (SELECT o_custkey AS id,
        CAST(arg_max(o_orderkey % 3 + 1, (o_orderdate, o_orderkey)) AS INTEGER) AS a1c_target_id,
        count(*) FILTER (WHERE o_orderkey % 7 = 0 AND o_orderstatus = 'O') AS active_journey_count,
        count(*) FILTER (WHERE o_orderkey % 7 = 0 AND o_orderstatus = 'F') AS completed_journey_count,
        count(*) AS order_count,
        count(*) FILTER (WHERE o_orderstatus = 'F') AS completed_count,
        count(*) FILTER (WHERE o_orderstatus <> 'F') AS active_program_count
      FROM orders GROUP BY o_custkey)""")

cte("goals", """
SELECT id, goal_type_id, target_weight, protein_goal, carb_goal, fat_goal, calories_goal,
  CASE goal_type_id WHEN 1 THEN 'lose' WHEN 2 THEN 'maintain' WHEN 3 THEN 'gain' END AS weight_goal_type,
  CASE WHEN goal_type_id IS NOT NULL THEN 1 ELSE 0 END AS has_weight_goal,
  CASE WHEN protein_goal > 0 OR carb_goal > 0 OR fat_goal > 0 OR calories_goal > 0 THEN 1 ELSE 0 END AS has_nutrient_goals
FROM (SELECT c_custkey AS id,
        max(CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 1 WHEN 'BUILDING' THEN 2 WHEN 'MACHINERY' THEN 3 END) AS goal_type_id,
        max(150.0 + fmod(abs(c_acctbal), 50)) AS target_weight,
        max(20.0 + fmod(abs(c_acctbal), 40)) AS protein_goal,
        max(60.0 + fmod(abs(c_acctbal), 90)) AS carb_goal,
        max(15.0 + fmod(abs(c_acctbal), 30)) AS fat_goal,
        max(300.0 + fmod(abs(c_acctbal), 500)) AS calories_goal
      FROM customer WHERE c_acctbal >= 0 GROUP BY c_custkey)""")

# medications -----------------------------------------------------------------
# written from the reference's description, not from the Spark code: prescriptions x days first, doses joined on
cte("rx", """
SELECT o.o_custkey AS id, l.l_partkey % 2 AS medicationid, l.l_quantity,
       CASE (l.l_orderkey // 4) % 3 WHEN 2 THEN 2 ELSE 1 END AS doses_per_day,
       CAST(o.o_orderdate AS DATE) AS startdate,
       CASE WHEN o.o_orderstatus = 'F' THEN CAST(l.l_shipdate AS DATE) + 30
            ELSE (SELECT CAST(max(ts) AS DATE) FROM events) END AS rx_end
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
WHERE l.l_linenumber = 1 AND l.l_orderkey % 4 = 0 AND NOT (l.l_linestatus = 'F' AND o.o_orderstatus = 'F')""")

cte("dose_day", """
SELECT id, day, k % 2 AS medicationid, count(*) AS taken FROM evd
WHERE k % 8 <> 0 AND k % 10 <> 9 GROUP BY id, day, k % 2""", ["evd"])

cte("med_daily", """
SELECT *, avg(adherence_pct) OVER (PARTITION BY id ORDER BY day RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW)
            AS adherence_7d_avg
FROM (SELECT id, day, CAST(sum(least(taken, need)) AS BIGINT) AS capped_taken, CAST(sum(need) AS BIGINT) AS expected_total,
        CAST(sum(taken) AS BIGINT) AS doses_taken,
        least(sum(least(taken, need)) * 100.0 / sum(need), 100.0) AS adherence_pct,
        CASE WHEN sum(least(taken, need)) >= sum(need) THEN 1 ELSE 0 END AS took_all_meds,
        CASE WHEN bool_or(taken > 0 AND medicationid IN (SELECT p_partkey - 1 FROM part WHERE p_partkey IN (1, 2) AND p_size % 2 = 0))
             THEN 1 ELSE 0 END AS glycemic_med_adherent
      FROM (SELECT r.id, c.day, r.medicationid, r.need, COALESCE(d.taken, 0) AS taken
            FROM (SELECT id, medicationid, sum(doses_per_day) AS need, min(startdate) AS lo, max(rx_end) AS hi
                  FROM rx GROUP BY id, medicationid) r
            JOIN (SELECT CAST(unnest(generate_series((SELECT min(day) FROM dose_day),
                    (SELECT CAST(max(ts) AS DATE) FROM events), INTERVAL 1 DAY)) AS DATE) AS day) c
              ON c.day BETWEEN r.lo AND r.hi
            LEFT JOIN dose_day d ON d.id = r.id AND d.medicationid = r.medicationid AND d.day = c.day)
      GROUP BY id, day)""", ["rx", "dose_day"])

cte("med_state", """
SELECT id, count(*) AS active_prescription_count, CAST(sum(doses_per_day) AS BIGINT) AS expected_daily_doses,
  CAST(max(CASE WHEN l_quantity > 25 AND CAST(l_quantity AS INTEGER) % 2 <> 0 THEN 1 ELSE 0 END) AS INTEGER) AS med_reminders_enabled,
  CAST(max(CASE WHEN medicationid IN (SELECT p_partkey - 1 FROM part WHERE p_partkey IN (1, 2) AND p_size % 2 = 0)
           THEN 1 ELSE 0 END) AS INTEGER) AS takes_glycemic_lowering_med
FROM rx GROUP BY id""", ["rx"])


# ---------------------------------------------------------------------------
# query oracles
# ---------------------------------------------------------------------------
ORACLE: dict[str, str] = {}


def rounded(q: str, doubles: list[str]) -> str:
    if not doubles:
        return q
    rep = ", ".join(f"round(CAST({c} AS DOUBLE), 4) AS {c}" for c in doubles)
    return f"SELECT * REPLACE ({rep}) FROM ({q}) AS q"


def register(name: str, final: str, needs: list[str], doubles: list[str] | None = None) -> None:
    ORACLE[name] = sql(rounded(final, doubles or []), *needs)


register("local_day_counts", """
SELECT id, day, count(*) AS n_events, count(*) FILTER (WHERE k % 7 = 0) AS journal_entries,
       1 AS logged_flag
FROM evd GROUP BY id, day""", ["evd"])

register("lookback_active_filter", """
SELECT event_type, count(*) AS n_rows, sum(value) AS sum_value
FROM evd
WHERE ts >= CAST(DATE '2024-02-20' - INTERVAL 36 DAY AS TIMESTAMP)
  AND status IN (1, 2) AND NOT (k % 50 = 0)
  AND NOT (event_type = 'click' AND 30040 + k % 8 = 30045)
  AND value IS NOT NULL
GROUP BY event_type""", ["evd"], ["sum_value"])

register("epoch_ms_days", """
SELECT day, count(*) AS entries FROM groc GROUP BY day""", ["groc"])

register("enum_labels", """
SELECT a1c_label, meal_label, lenient_mod3, a1c_or_none, count(*) AS n FROM (
  SELECT CASE k % 4 WHEN 1 THEN 'dm_target_7' WHEN 2 THEN 'dm_target_8' WHEN 3 THEN 'dm_target_6' END AS a1c_label,
         CASE [1, 3, 5, 12][(k // 3) % 4 + 1] WHEN 1 THEN 'breakfast' WHEN 3 THEN 'lunch'
              WHEN 5 THEN 'dinner' WHEN 12 THEN 'snack' END AS meal_label,
         COALESCE(TRY_CAST(CASE WHEN k % 5 = 0 THEN 'x' ELSE CAST(k AS VARCHAR) END AS INTEGER), 1) % 3 AS lenient_mod3,
         COALESCE(CASE k % 4 WHEN 1 THEN 'dm_target_7' WHEN 2 THEN 'dm_target_8' WHEN 3 THEN 'dm_target_6' END, 'none') AS a1c_or_none
  FROM evd)
GROUP BY ALL""", ["evd"])

register("json_focus_list", """
SELECT id, user_focus, CAST(len(string_split(user_focus, ',')) AS INTEGER) AS n_focus FROM focus""", ["focus"])

register("day_range_shares", """
SELECT id, day, bg_count, tir_pct, high_pct, low_pct, very_low_pct, avg_bg, cgm_day
FROM agg WHERE bg_count > 0""", ["agg"], ["tir_pct", "high_pct", "low_pct", "very_low_pct", "avg_bg"])

register("day_sum_variety", """
SELECT id, day, active_minutes, activity_sessions, activity_variety, meditation_count, steps
FROM agg WHERE activity_sessions > 0 OR steps IS NOT NULL""", ["agg"], ["active_minutes"])

_NUTS = [("protein", "protein_goal"), ("carbs", "carb_goal"), ("fat", "fat_goal"), ("calories", "calories_goal")]
register("day_totals_vs_goal", f"""
SELECT id, day, meals, carbs, protein, fat, calories, fiber, sugar, added_sugars,
  {", ".join(f"{n}_pct" for n, _ in _NUTS)},
  greatest({", ".join(f"COALESCE({n}_in_band, 0)" for n, _ in _NUTS)}) AS any_nutrient_met,
  {" + ".join(f"(CASE WHEN {g} > 0 THEN 1 ELSE 0 END)" for _, g in _NUTS)} AS total_nutrient_targets,
  {" + ".join(f"COALESCE({n}_in_band, 0)" for n, _ in _NUTS)} AS n_90_110,
  {" + ".join(f"(CASE WHEN {n}_pct >= 60 THEN 1 ELSE 0 END)" for n, _ in _NUTS)} AS n_60_plus,
  {" + ".join(f"(CASE WHEN {n}_pct >= 30 THEN 1 ELSE 0 END)" for n, _ in _NUTS)} AS n_30_plus,
  COALESCE({", ".join(f"CASE WHEN {n}_in_band = 1 THEN '{n}' END" for n, _ in _NUTS)}) AS nutrient_name_met
FROM (SELECT *, {", ".join(f"CASE WHEN {n}_pct BETWEEN 90 AND 110 THEN 1 ELSE 0 END AS {n}_in_band" for n, _ in _NUTS)}
      FROM (SELECT a.id, a.day, a.meals, a.carbs, a.protein, a.fat, a.calories, a.fiber, a.sugar, a.added_sugars, g.*  EXCLUDE (id),
              {", ".join(f"CASE WHEN {g} > 0 THEN {n} / {g} * 100.0 END AS {n}_pct" for n, g in _NUTS)}
            FROM agg a LEFT JOIN goals g ON a.id = g.id WHERE a.meals > 0))""",
         ["agg", "goals"], ["carbs", "protein", "fat", "calories", "fiber", "sugar", "added_sugars"] + [f"{n}_pct" for n, _ in _NUTS])

register("last_kind_of_day", """
SELECT id, day, last_meal_type, weight FROM agg WHERE meals > 0 OR weight IS NOT NULL""", ["agg"], ["weight"])

register("status_flags_day", """
SELECT id, day, plan_entries, plan_active, plan_completed FROM agg WHERE plan_entries > 0""", ["agg"])

register("state_snapshot", "SELECT * FROM odims", ["odims"])

register("program_days", """
SELECT id, day, CAST(sum(s) AS BIGINT) AS programs_started, CAST(sum(c) AS BIGINT) AS programs_completed FROM (
  SELECT o_custkey AS id, CAST(o_orderdate AS DATE) AS day, 1 AS s, 0 AS c FROM orders WHERE o_orderstatus <> 'F'
  UNION ALL
  SELECT o_custkey, CAST(o_orderdate AS DATE) + 30, 0, 1 FROM orders WHERE o_orderstatus = 'F')
GROUP BY id, day""", [])

register("delta_prev_logged", """
SELECT id, day, is_logged, active_minutes, active_minutes_prev_logged, active_minutes_delta_1d,
  active_minutes_prev_day, activity_same_or_more, tir_pct, tir_prev_logged, tir_delta_1d, tir_prev_day,
  steps, steps_prev_logged, steps_delta_1d, steps_improved, sleep_rating, sleep_rating_prev_logged, sleep_rating_delta_1d
FROM feat""", ["feat"], ["sleep_rating", "sleep_rating_prev_logged", "sleep_rating_delta_1d", "active_minutes", "active_minutes_prev_logged", "active_minutes_delta_1d",
                         "active_minutes_prev_day", "tir_pct", "tir_prev_logged", "tir_delta_1d", "tir_prev_day"])

register("rolling_windows", """
SELECT id, day, weekly_active_minutes, steps_avg_7d, days_with_meals_7d, sleep_avg_7d, sleep_rating_avg_7d
FROM feat""", ["feat"], ["weekly_active_minutes", "steps_avg_7d", "sleep_avg_7d", "sleep_rating_avg_7d"])

register("any_7d_30d_flags", """
SELECT id, day, meditation_7d, meditation_30d, journal_7d, journal_30d, plan_progress_7d, plan_progress_30d,
  grocery_7d, program_7d, video_completed_today, video_completed_7d, has_cgm, has_step_tracker
FROM feat""", ["feat"])

register("rows_vs_range_gap", """
SELECT id, day,
  sum(active_minutes) OVER (PARTITION BY id ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS sum_7_rows,
  sum(active_minutes) OVER (PARTITION BY id ORDER BY (day - DATE '1970-01-01')
                            RANGE BETWEEN 6 PRECEDING AND CURRENT ROW) AS sum_7_days
FROM agg WHERE active_minutes IS NOT NULL""", ["agg"], ["sum_7_rows", "sum_7_days"])

register("pct_change", """
SELECT id, day, weight, weight_prev_logged, weight_pct_change FROM feat WHERE weight IS NOT NULL""",
         ["feat"], ["weight", "weight_prev_logged", "weight_pct_change"])

register("days_since_last", """
SELECT id, day, days_since_last_weight, weight_logged_7d, weight_logged_14d, weight_logged_30d FROM feat""",
         ["feat"])

register("band_asof_14d", """
SELECT id, day, weight, weight_14d_ago, weight_14d_days_back, weight_change_lbs_14d, weight_change_pct_14d
FROM feat WHERE weight_14d_ago IS NOT NULL""", ["feat"],
         ["weight", "weight_14d_ago", "weight_change_lbs_14d", "weight_change_pct_14d"])

register("interval_union_hours", """
SELECT id, day, sleep_count, sleep_rating, sleep_hours FROM agg WHERE sleep_count IS NOT NULL""",
         ["agg"], ["sleep_rating", "sleep_hours"])

register("capped_adherence", "SELECT * FROM med_daily", ["med_daily"], ["adherence_pct", "adherence_7d_avg"])

register("class_star_semi", "SELECT * FROM med_state", ["med_state"])


# ---------------------------------------------------------------------------
# assembly and rule inputs
# ---------------------------------------------------------------------------
def _bool(c):
    return f"COALESCE(CAST({c} AS BOOLEAN), FALSE)"


cte("wide0", """
SELECT f.*, fo.focus_list, fo.user_focus,
  od.a1c_target_id, od.a1c_group, od.active_journey_count, od.completed_journey_count, od.has_active_journey,
  od.has_completed_journey, od.journey_task_completed, od.video_ever_completed, od.video_total,
  od.has_exercise_video_activity, od.has_active_exercise_program, od.has_completed_exercise_program,
  od.active_program_count, od.programs_completed,
  g.goal_type_id, g.target_weight, g.protein_goal, g.carb_goal, g.fat_goal, g.calories_goal, g.weight_goal_type,
  g.has_weight_goal, g.has_nutrient_goals,
  ms.active_prescription_count, ms.expected_daily_doses, ms.med_reminders_enabled, ms.takes_glycemic_lowering_med,
  md.adherence_pct, md.took_all_meds, md.adherence_7d_avg, md.glycemic_med_adherent
FROM feat f LEFT JOIN focus fo ON f.id = fo.id LEFT JOIN odims od ON f.id = od.id
LEFT JOIN goals g ON f.id = g.id LEFT JOIN med_state ms ON f.id = ms.id
LEFT JOIN med_daily md ON f.id = md.id AND f.day = md.day""",
    ["feat", "focus", "odims", "goals", "med_state", "med_daily"])

cte("wide1", f"""
SELECT *,
  greatest({", ".join(f"COALESCE({n}_in_band, 0)" for n, _ in _NUTS)}) AS any_nutrient_met,
  {" + ".join(f"(CASE WHEN {g} > 0 THEN 1 ELSE 0 END)" for _, g in _NUTS)} AS total_nutrient_targets,
  {" + ".join(f"COALESCE({n}_in_band, 0)" for n, _ in _NUTS)} AS n_90_110,
  {" + ".join(f"(CASE WHEN {n}_pct >= 60 THEN 1 ELSE 0 END)" for n, _ in _NUTS)} AS n_60_plus,
  {" + ".join(f"(CASE WHEN {n}_pct >= 30 THEN 1 ELSE 0 END)" for n, _ in _NUTS)} AS n_30_plus,
  COALESCE({", ".join(f"CASE WHEN {n}_in_band = 1 THEN '{n}' END" for n, _ in _NUTS)}) AS nutrient_name_met
FROM (SELECT *, {", ".join(f"CASE WHEN {n}_pct BETWEEN 90 AND 110 THEN 1 ELSE 0 END AS {n}_in_band" for n, _ in _NUTS)}
      FROM (SELECT *, {", ".join(f"CASE WHEN {g} > 0 THEN {n} / {g} * 100.0 END AS {n}_pct" for n, g in _NUTS)}
            FROM wide0))""", ["wide0"])

_THR_ROWS = [(g, *v) for g, v in K.GLUCOSE_THRESHOLDS.items()] + [("dm_target_6", *K.GLUCOSE_THRESHOLDS[K.DEFAULT_A1C_GROUP])]
_THR = _values(_THR_ROWS, ["grp", "tir_positive", "tir_opportunity", "high_max", "low_max", "range_low", "range_high"])
_TOL = K.WEIGHT_MAINTENANCE_TOLERANCE_PCT / 100.0
cte("thr", _THR)
cte("wide", f"""
SELECT w.*, t.tir_positive, t.tir_opportunity, t.high_max, t.low_max, t.range_low, t.range_high,
  COALESCE(w.weight_goal_type = 'maintain' AND w.weight BETWEEN w.target_weight * {1 - _TOL!r} AND w.target_weight * {1 + _TOL!r}, FALSE) AS within_maintenance
FROM wide1 w LEFT JOIN thr t ON COALESCE(w.a1c_group, '{K.DEFAULT_A1C_GROUP}') = t.grp""", ["wide1", "thr"])

cte("ctx", f"""
SELECT id, day,
  {_bool('has_cgm')} AS has_cgm, {_bool('has_step_tracker')} AS has_step_tracker,
  COALESCE(active_prescription_count > 0, FALSE) AS has_medications,
  {_bool('has_weight_goal')} AS has_weight_goal, weight_goal_type,
  {_bool('has_active_journey')} AS has_active_journey,
  {_bool('journey_task_completed')} AS journey_task_completed,
  {_bool('has_active_exercise_program')} AS has_exercise_program,
  {_bool('has_nutrient_goals')} AS has_nutrient_goals,
  COALESCE(focus_list, CAST([] AS VARCHAR[])) AS focus_list,
  COALESCE(len(focus_list) > 0, FALSE) AS has_focus,
  COALESCE(a1c_group, '{K.DEFAULT_A1C_GROUP}') AS a1c_group,
  tir_positive, tir_opportunity, high_max, low_max,
  tir_pct, tir_prev_logged AS tir_prev, high_pct, low_pct,
  steps, steps_prev_logged AS steps_prev, steps_prev_logged_day AS steps_prev_day, steps_avg_7d,
  active_minutes, active_minutes_prev_logged AS active_prev, weekly_active_minutes, video_completion_pct,
  sleep_hours, sleep_prev_logged AS sleep_prev, sleep_rating, sleep_avg_7d, sleep_rating_avg_7d,
  {_bool('took_all_meds')} AS took_all_meds, adherence_7d_avg AS med_adherence_7d_avg,
  {_bool('med_reminders_enabled')} AS med_reminders_enabled,
  {_bool('takes_glycemic_lowering_med')} AS takes_glycemic_lowering_med,
  {_bool('glycemic_med_adherent')} AS glycemic_med_adherent,
  meals, days_with_meals_7d,
  {_bool('any_nutrient_met')} AS any_nutrient_met, nutrient_name_met, last_meal_type,
  n_90_110, n_60_plus, n_30_plus, total_nutrient_targets,
  {_bool('weight_logged_today')} AS weight_logged_today,
  weight_pct_change, weight_change_lbs_14d, weight_change_pct_14d,
  weight_logged_7d, weight_logged_14d, weight_logged_30d, days_since_last_weight, within_maintenance,
  {_bool('meditation_7d')} AS meditation_7d, {_bool('meditation_30d')} AS meditation_30d,
  {_bool('journal_7d')} AS journal_7d, {_bool('journal_30d')} AS journal_30d,
  {_bool('plan_active')} AS plan_active, {_bool('plan_progress_30d')} AS plan_progress_30d,
  {_bool('program_started_today')} AS program_started_today,
  {_bool('program_progress_today')} AS program_progress_today, {_bool('meal_plan_today')} AS meal_plan_today,
  {_bool('article_today')} AS article_today, {_bool('lesson_today')} AS lesson_today,
  {_bool('learn_video_today')} AS learn_video_today, {_bool('grocery_today')} AS grocery_today,
  {_bool('video_completed_today')} AS video_completed_today
FROM wide""", ["wide"])

register("daily_wide", """
SELECT id, day, has_cgm, has_step_tracker, has_medications, has_weight_goal, weight_goal_type,
  has_active_journey, has_exercise_program, array_to_string(focus_list, ',') AS focus, a1c_group, tir_positive,
  meals, any_nutrient_met, nutrient_name_met, n_90_110, total_nutrient_targets, within_maintenance,
  takes_glycemic_lowering_med, med_reminders_enabled
FROM ctx""", ["ctx"])

register("threshold_lookup", """
SELECT o.id, COALESCE(o.a1c_group, 'dm_target_7') AS a1c_group, t.tir_positive, t.tir_opportunity, t.high_max,
  t.low_max, t.range_low, t.range_high
FROM odims o LEFT JOIN thr t ON COALESCE(o.a1c_group, 'dm_target_7') = t.grp""", ["odims", "thr"])

_WIDE_COLS = """
    id day is_logged bg_count tir_pct high_pct low_pct very_low_pct avg_bg cgm_day active_minutes
    activity_sessions activity_variety meditation_count video_completion_pct steps weight meals carbs protein
    fat calories fiber sugar added_sugars journal_entries grocery_entries program_starts program_completions meal_plan_events
    article_events lesson_events learn_video_events program_steps plan_entries plan_active plan_completed
    sleep_count sleep_rating sleep_hours last_meal_type tir_prev_logged tir_prev_day has_cgm
    active_minutes_prev_logged active_minutes_prev_day weekly_active_minutes meditation_7d meditation_30d
    video_completed_today steps_prev_logged steps_prev_logged_day steps_avg_7d has_step_tracker weight_prev_logged
    days_since_last_weight weight_14d_ago weight_14d_days_back days_with_meals_7d journal_7d journal_30d
    plan_progress_7d plan_progress_30d grocery_7d program_7d sleep_prev_logged sleep_rating_prev_logged sleep_avg_7d sleep_rating_avg_7d
    video_completed_7d tir_delta_1d active_minutes_delta_1d activity_same_or_more steps_delta_1d
    steps_target_met steps_improved weight_logged_today weight_pct_change weight_change_lbs_14d
    weight_change_pct_14d weight_logged_7d weight_logged_14d weight_logged_30d meal_logged_today sleep_delta_1d sleep_rating_delta_1d
    sleep_hours_met sleep_rating_met sleep_improved journal_today meditation_today grocery_today
    program_started_today meal_plan_today article_today lesson_today learn_video_today program_completed_today
    program_progress_today focus_list user_focus a1c_target_id a1c_group active_journey_count
    completed_journey_count has_active_journey has_completed_journey journey_task_completed video_ever_completed
    video_total has_exercise_video_activity has_active_exercise_program has_completed_exercise_program active_program_count
    programs_completed goal_type_id
    target_weight protein_goal carb_goal fat_goal calories_goal weight_goal_type has_weight_goal
    has_nutrient_goals active_prescription_count expected_daily_doses med_reminders_enabled
    takes_glycemic_lowering_med adherence_pct took_all_meds adherence_7d_avg glycemic_med_adherent protein_pct
    carbs_pct fat_pct calories_pct protein_in_band carbs_in_band fat_in_band calories_in_band any_nutrient_met
    total_nutrient_targets n_90_110 n_60_plus n_30_plus nutrient_name_met tir_positive tir_opportunity high_max
    low_max range_low range_high within_maintenance
""".split()
register("null_profile", f"""
SELECT column_name, missing FROM (UNPIVOT (
  SELECT {", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in _WIDE_COLS)} FROM wide)
  ON COLUMNS(*) INTO NAME column_name VALUE missing) WHERE missing > 0""", ["wide"])

# ---------------------------------------------------------------------------
# H1 / H2 eligibility codes
# ---------------------------------------------------------------------------
_POS_CODES = [
    ("GLUCOSE_TIR_MET", "tir_pct >= 70"), ("GLUCOSE_TIR_IMPROVED", "tir_delta_1d > 0"),
    ("ACTIVITY_LOGGED", "active_minutes > 0"), ("ACTIVITY_MAINTAINED_OR_IMPROVED", "activity_same_or_more = 1"),
    ("STEPS_TARGET_MET", "steps_target_met = 1"), ("STEPS_IMPROVED", "steps_improved = 1"),
    ("MEAL_LOGGED", "meal_logged_today = 1"), ("NUTRIENT_TARGET_MET", "any_nutrient_met = 1"),
    ("SLEEP_HOURS_MET", "sleep_hours_met = 1"), ("SLEEP_RATING_MET", "sleep_rating_met = 1"),
    ("SLEEP_IMPROVED", "sleep_improved = 1"), ("MEDS_ALL_TAKEN", "took_all_meds = 1"),
    ("WEIGHT_LOGGED", "weight_logged_today = 1"), ("WEIGHT_DECREASED", "weight_pct_change < 0"),
    ("MEDITATION_OPENED", "meditation_today = 1"), ("JOURNAL_ENTRY", "journal_today = 1"),
    ("ACTION_PLAN_ACTIVE", "plan_active = 1"), ("ACTION_PLAN_COMPLETED", "plan_completed = 1"),
    ("GROCERY_SHOPPED", "grocery_today = 1"), ("JOURNEY_ACTIVE", "has_active_journey = 1"),
    ("JOURNEY_TASK_COMPLETED", "journey_task_completed = 1"),
    ("EXERCISE_VIDEO_COMPLETED", "video_completed_today = 1"),
    ("EXERCISE_PROGRAM_STARTED", "program_started_today = 1"),
    ("EXERCISE_PROGRAM_COMPLETED", "program_completed_today = 1"),
    ("EXERCISE_PROGRAM_PROGRESS", "program_progress_today = 1"),
]
_OPP_CODES = [
    ("GLUCOSE_IMPROVE_TIR", "tir_pct < 70"), ("GLUCOSE_REDUCE_HIGH", "high_pct > 25"),
    ("GLUCOSE_PREVENT_LOW", "low_pct > 4"), ("ACTIVITY_INCREASE_WEEKLY", "weekly_active_minutes < 150"),
    ("STEPS_INCREASE_DAILY", "steps_avg_7d < 6000"), ("FOOD_LOG_MEAL", "NOT COALESCE(meal_logged_today = 1, FALSE)"),
    ("FOOD_LOG_MORE_FREQUENTLY", "days_with_meals_7d < 1"), ("SLEEP_INCREASE_DURATION", "sleep_avg_7d < 7"),
    ("SLEEP_IMPROVE_QUALITY", "sleep_avg_7d >= 7 AND sleep_rating_avg_7d < 7"),
    ("MEDS_IMPROVE_ADHERENCE", "adherence_7d_avg < 50"), ("WEIGHT_LOG_ENTRY", "days_since_last_weight > 6"),
    ("MENTAL_TRY_MEDITATION", "NOT COALESCE(meditation_30d = 1, FALSE)"),
    ("MENTAL_TRY_JOURNALING", "NOT COALESCE(journal_30d = 1, FALSE)"),
    ("MENTAL_WORK_ON_ACTION_PLAN", "NOT COALESCE(plan_progress_30d = 1, FALSE)"),
    ("EXERCISE_CONTINUE_PROGRAM", "COALESCE(has_active_exercise_program = 1, FALSE) AND NOT COALESCE(program_7d = 1, FALSE)"),
    ("EXERCISE_START_PROGRAM", "NOT COALESCE(has_active_exercise_program = 1, FALSE) AND NOT COALESCE(has_exercise_video_activity = 1, FALSE)"),
    ("EXERCISE_COMPLETE_VIDEO", "COALESCE(has_exercise_video_activity = 1, FALSE) AND NOT COALESCE(video_completed_7d = 1, FALSE)"),
]


def _codes(rules):
    parts = ", ".join(f"CASE WHEN COALESCE({cond}, FALSE) THEN '{code}' END" for code, cond in rules)
    return f"list_filter([{parts}], lambda x: x IS NOT NULL)"


register("eligibility_positive", f"""
SELECT id, day, array_to_string(codes, ',') AS codes, CAST(len(codes) AS INTEGER) AS n_codes
FROM (SELECT id, day, {_codes(_POS_CODES)} AS codes FROM wide)""", ["wide"])
register("eligibility_opportunity", f"""
SELECT id, day, array_to_string(codes, ',') AS codes, CAST(len(codes) AS INTEGER) AS n_codes
FROM (SELECT id, day, {_codes(_OPP_CODES)} AS codes FROM wide)""", ["wide"])

# ---------------------------------------------------------------------------
# G: scoring
# ---------------------------------------------------------------------------
_CATS = ["weight", "glucose", "activity", "steps", "food_logging", "nutrient_targets", "sleep_duration",
         "sleep_rating", "medications", "mental_wellbeing"]


def _focus_allows(cat, fmap):
    names = [f for f, cats in fmap.items() if cat in cats]
    if not names:
        return "(NOT has_focus)"
    lst = ", ".join(f"'{n}'" for n in names)
    return f"(NOT has_focus OR COALESCE(list_has_any(focus_list, [{lst}]), FALSE))"


def _ladder(col, steps):
    return "CASE " + " ".join(f"WHEN {col} >= {b} THEN {p}" for b, p in steps) + " ELSE 0 END"


_a7, _b7, _c7 = K.GLUCOSE_POINTS["a1c_target_7"]
_a8, _b8, _c8 = K.GLUCOSE_POINTS["a1c_target_8"]
_PTS = {
    "weight": """CASE WHEN has_weight_goal AND weight_goal_type = 'lose' THEN
        (CASE WHEN weight_change_lbs_14d <= -1.0 THEN 5 WHEN weight_change_lbs_14d BETWEEN -1.0 AND 1.0 THEN 3 ELSE 0 END)
      WHEN has_weight_goal AND weight_goal_type = 'maintain' THEN
        (CASE WHEN abs(weight_change_pct_14d) <= 3.0 THEN 5 ELSE 0 END)
      ELSE (CASE WHEN weight_logged_7d THEN 5 WHEN weight_logged_14d THEN 3 WHEN weight_logged_30d THEN 1 ELSE 0 END) END""",
    "glucose": f"""CASE WHEN a1c_group IN ('dm_target_8', 'a1c_target_8') THEN
        (CASE WHEN tir_pct >= {_a8} THEN 5 WHEN tir_pct >= {_b8} THEN 3 WHEN tir_pct <= {_c8} THEN 1 ELSE 0 END)
      ELSE (CASE WHEN tir_pct >= {_a7} THEN 5 WHEN tir_pct >= {_b7} THEN 3 WHEN tir_pct <= {_c7} THEN 1 ELSE 0 END) END""",
    "activity": _ladder("weekly_active_minutes", K.ACTIVITY_POINTS),
    "steps": _ladder("steps", K.STEPS_POINTS),
    "food_logging": _ladder("meals", K.MEALS_POINTS),
    "nutrient_targets": """CASE WHEN NOT COALESCE(total_nutrient_targets > 0, FALSE) THEN 0
      WHEN n_90_110 = total_nutrient_targets THEN 5 WHEN n_60_plus = total_nutrient_targets THEN 3
      WHEN n_30_plus = total_nutrient_targets THEN 1 ELSE 0 END""",
    "sleep_duration": _ladder("sleep_hours", K.SLEEP_HOURS_POINTS),
    "sleep_rating": _ladder("sleep_rating", K.SLEEP_RATING_POINTS),
    "medications": _ladder("med_adherence_7d_avg", K.MED_ADHERENCE_POINTS),
    "mental_wellbeing": """least((CASE WHEN plan_active THEN 3 ELSE 0 END) + (CASE WHEN journal_7d THEN 1 ELSE 0 END)
      + (CASE WHEN meditation_7d THEN 1 ELSE 0 END), 5)""",
}
_DEV = {"glucose": "has_cgm", "steps": "has_step_tracker", "medications": "has_medications",
        "nutrient_targets": "has_nutrient_goals"}
cte("cpts", "SELECT id, day,\n" + ",\n".join(
    f"  CASE WHEN {_focus_allows(cat, K.SCORING_FOCUS_MAP)} AND {_DEV.get(cat, 'TRUE')} THEN {_PTS[cat]} END AS {cat}_pts"
    for cat in _CATS) + """,
  (CASE WHEN video_completed_today THEN 3 ELSE 0 END) + (CASE WHEN program_started_today THEN 1 ELSE 0 END) + (CASE WHEN meal_plan_today THEN 1 ELSE 0 END)
  + (CASE WHEN article_today THEN 1 ELSE 0 END) + (CASE WHEN lesson_today THEN 1 ELSE 0 END) + (CASE WHEN learn_video_today THEN 1 ELSE 0 END)
    + (CASE WHEN grocery_today THEN 1 ELSE 0 END) AS bonus_pts
FROM ctx""", ["ctx"])


def _tier_sql(col, idx):
    return "CASE " + " ".join(f"WHEN {col} >= {t[2]} THEN '{t[idx]}'" for t in K.TIERS) + f" ELSE '{K.TIERS[-1][idx]}' END"


cte("rating", f"""
SELECT id, day, score, max_score, bonus_pts, percentage,
  {_tier_sql('percentage', 0)} AS rating, {_tier_sql('percentage', 1).replace("'You", "'You")} AS rating_description
FROM (SELECT *, CASE WHEN max_score > 0 THEN CAST(score AS DOUBLE) * 100.0 / max_score ELSE 0.0 END AS percentage
      FROM (SELECT id, day, bonus_pts,
              {" + ".join(f"COALESCE({c}_pts, 0)" for c in _CATS)} + bonus_pts AS score,
              {" + ".join(f"(CASE WHEN {c}_pts IS NOT NULL THEN 5 ELSE 0 END)" for c in _CATS)} AS max_score
            FROM cpts))""", ["cpts"])

register("category_points", "SELECT * FROM cpts", ["cpts"])
register("daily_rating", "SELECT * FROM rating", ["rating"], ["percentage"])
register("tier_distribution", "SELECT day, count(*) AS n_rows, count(DISTINCT id) AS n_ids, " + ", ".join(
    f"count(*) FILTER (WHERE rating = '{t[0]}') AS n_{t[0].lower()}" for t in K.TIERS) + " FROM rating GROUP BY day",
    ["rating"])

# ---------------------------------------------------------------------------
# History state
# ---------------------------------------------------------------------------
_FT = "[" + ", ".join(f"'{k}'" for k, _ in K.FOOD_TIPS) + "]"
_ST = "[" + ", ".join(f"'{k}'" for k, _ in K.SLEEP_TIPS) + "]"
cte("hist", f"""
SELECT id, category, message_date, list_sort(list(DISTINCT key)) AS positive_actions_used, max(opp) AS opportunity_used
FROM (SELECT id,
        CASE event_type WHEN 'view' THEN 'glucose' WHEN 'click' THEN 'activity' WHEN 'purchase' THEN 'steps'
                        WHEN 'signup' THEN 'weight' WHEN 'error' THEN 'sleep' END AS category,
        day + 1 AS message_date,
        CASE WHEN event_type = 'signup' THEN (CASE WHEN k % 2 = 0 THEN 'weight_decreased' ELSE 'weight_logged' END)
             ELSE (CASE event_type WHEN 'view' THEN 'glucose_tir_met' WHEN 'click' THEN 'activity_logged'
                   WHEN 'purchase' THEN 'steps_target_met' WHEN 'error' THEN 'sleep_hours_met' END) END AS key,
        CASE WHEN event_type = 'error' THEN {_ST}[k % {len(K.SLEEP_TIPS)} + 1]
             WHEN event_type = 'purchase' THEN {_FT}[k % {len(K.FOOD_TIPS)} + 1] END AS opp
      FROM evd)
GROUP BY id, category, message_date""", ["evd"])

cte("hdays", """
SELECT DISTINCT id, message_date + CAST(o AS INTEGER) AS day FROM hist, range(1, 8) r(o)""", ["hist"])

cte("hstate", """
SELECT d.id, d.day,
  COALESCE(list_sort(list(DISTINCT h.category) FILTER (WHERE h.message_date >= d.day - 6)), CAST([] AS VARCHAR[])) AS categories_6d,
  COALESCE(list_sort(list(DISTINCT h.opportunity_used) FILTER (WHERE h.message_date >= d.day - 6
                                                              AND h.opportunity_used IS NOT NULL)), CAST([] AS VARCHAR[])) AS keys_6d,
  count(*) FILTER (WHERE h.category = 'weight'
                   AND list_has_any(h.positive_actions_used, ['weight_decreased', 'weight_maintained'])) AS weight_msgs_7d,
  bool_or(h.message_date = d.day - 1 AND h.category = 'weight'
          AND list_has_any(h.positive_actions_used, ['weight_decreased', 'weight_maintained'])) AS weight_shown_yesterday
FROM hdays d JOIN hist h ON h.id = d.id AND h.message_date BETWEEN d.day - 7 AND d.day - 1
GROUP BY d.id, d.day""", ["hdays", "hist"])

cte("hstreak", """
SELECT id, day, category, CAST(list_min(list_filter(range(1, 9), lambda o: NOT list_contains(offs, o))) - 1 AS INTEGER) AS streak
FROM (SELECT d.id, d.day, h.category, list(DISTINCT CAST(d.day - h.message_date AS BIGINT)) AS offs
      FROM hdays d JOIN hist h ON h.id = d.id AND h.message_date BETWEEN d.day - 7 AND d.day - 1
      GROUP BY d.id, d.day, h.category)""", ["hdays", "hist"])

register("history_state", """
SELECT id, day, array_to_string(categories_6d, ',') AS categories_6d, array_to_string(keys_6d, ',') AS keys_6d,
  weight_msgs_7d, weight_shown_yesterday FROM hstate""", ["hstate"])
register("streaks", "SELECT * FROM hstreak WHERE streak > 0", ["hstreak"])


# ---------------------------------------------------------------------------
# Candidates, priorities, selection, text, history rows
# ---------------------------------------------------------------------------
def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _tplq(key):
    return _q(K.POSITIVE_TEMPLATES[key][1])


cte("ctxh", """
SELECT c.*, COALESCE(h.categories_6d, CAST([] AS VARCHAR[])) AS categories_6d,
  COALESCE(h.keys_6d, CAST([] AS VARCHAR[])) AS keys_6d, COALESCE(h.weight_msgs_7d, 0) AS weight_msgs_7d,
  COALESCE(h.weight_shown_yesterday, FALSE) AS weight_shown_yesterday
FROM ctx c LEFT JOIN hstate h ON c.id = h.id AND c.day = h.day""", ["ctx", "hstate"])

_TIR_R = "CAST(CAST(round_even(tir_pct, 0) AS INTEGER) AS VARCHAR)"
_STEPS_F = "format('{:,}', CAST(steps AS BIGINT))"
_MIN = "CAST(CAST(trunc(active_minutes) AS INTEGER) AS VARCHAR)"
_POS_RULES = [
    ("has_cgm AND tir_pct >= tir_positive", "glucose_tir_met", "glucose", 1,
     f"replace({_tplq('glucose_tir_met')}, '{{tir_pct}}', {_TIR_R})"),
    ("has_cgm AND tir_prev IS NOT NULL AND tir_pct > tir_prev", "glucose_tir_improved", "glucose", 2,
     f"replace(replace({_tplq('glucose_tir_improved')}, '{{tir_pct}}', {_TIR_R}), '{{prev_tir}}', "
     "CAST(CAST(round_even(tir_prev, 0) AS INTEGER) AS VARCHAR))"),
    ("has_step_tracker AND steps >= 10000", "steps_target_met", "steps", 3,
     f"replace({_tplq('steps_target_met')}, '{{step_count}}', {_STEPS_F})"),
    ("has_step_tracker AND NOT COALESCE(steps >= 10000, FALSE) AND steps_prev IS NOT NULL AND steps > steps_prev",
     "steps_improved", "steps", 4,
     f"replace(replace({_tplq('steps_improved')}, '{{step_count}}', {_STEPS_F}), '{{prev_day_name}}', dayname(steps_prev_day))"),
    ("active_minutes > 0", "activity_logged", "activity", 5,
     f"replace({_tplq('activity_logged')}, '{{active_minutes}}', {_MIN})"),
    ("active_minutes > 0 AND active_prev IS NOT NULL AND active_minutes >= active_prev - 3", "activity_maintained",
     "activity", 6, f"replace({_tplq('activity_maintained')}, '{{active_minutes}}', {_MIN})"),
    ("video_completion_pct >= 90", "activity_video_completed", "activity", K.DEFAULT_TEMPLATE_PRIORITY, "''"),
    ("sleep_hours >= 7", "sleep_hours_met", "sleep", 7,
     f"replace({_tplq('sleep_hours_met')}, '{{sleep_hours}}', CAST(round_even(sleep_hours, 1) AS VARCHAR))"),
    ("NOT COALESCE(sleep_hours >= 7, FALSE) AND sleep_prev IS NOT NULL AND sleep_hours > sleep_prev",
     "sleep_improved", "sleep", 9, _tplq("sleep_improved")),
    ("sleep_rating >= 7", "sleep_rating_met", "sleep", 8,
     f"replace({_tplq('sleep_rating_met')}, '{{sleep_rating}}', CAST(CAST(trunc(sleep_rating) AS INTEGER) AS VARCHAR))"),
    ("has_medications AND took_all_meds", "medication_adherence", "medications", 10, _tplq("medication_adherence")),
    ("meals >= 1", "meal_logged", "food", 11,
     f"replace({_tplq('meal_logged')}, '{{meal_type}}', COALESCE(last_meal_type, 'meal'))"),
    ("any_nutrient_met", "nutrient_target_met", "food", 12,
     f"replace({_tplq('nutrient_target_met')}, '{{nutrient_name}}', COALESCE(nutrient_name_met, 'nutrient'))"),
    ("weight_logged_today", "weight_logged", "weight", 13, _tplq("weight_logged")),
    ("has_weight_goal AND weight_msgs_7d < 2 AND NOT weight_shown_yesterday AND weight_goal_type = 'lose' "
     "AND weight_pct_change < 0", "weight_decreased", "weight", 14, _tplq("weight_decreased")),
    ("has_weight_goal AND weight_msgs_7d < 2 AND NOT weight_shown_yesterday AND weight_goal_type = 'maintain' "
     "AND within_maintenance", "weight_maintained", "weight", 15, _tplq("weight_maintained")),
    ("has_active_journey AND journey_task_completed", "journey_task_completed", "journey", 0,
     _tplq("journey_task_completed")),
    ("meditation_30d", "meditation_opened", "mental_wellbeing", 16, _tplq("meditation_opened")),
    ("journal_30d", "journal_entry", "mental_wellbeing", 17, _tplq("journal_entry")),
    ("plan_progress_30d", "action_plan_progress", "mental_wellbeing", 18, _tplq("action_plan_progress")),
    ("program_started_today OR program_progress_today", "exercise_program_started", "activity", 6, _tplq("exercise_program_started")),
    ("meal_plan_today", "ai_meal_plan_generated", "food", 12, "'Acknowledge that they generated an AI meal plan'"),
    ("article_today", "article_read", "explore", 19, "'Praise them for reading a health article'"),
    ("learn_video_today", "video_watched", "explore", 20, "'Acknowledge they watched a health video'"),
    ("lesson_today", "lesson_completed", "explore", 20, "'Praise them for completing a health lesson'"),
]
cte("pos_rules", "\nUNION ALL\n".join(
    f"SELECT *, '{key}' AS key, '{cat}' AS category, {base} AS base, {text} AS text FROM ctxh "
    f"WHERE COALESCE({cond}, FALSE)" for cond, key, cat, base, text in _POS_RULES), ["ctxh"])
cte("pos", f"""
SELECT * FROM pos_rules
UNION ALL
SELECT c.*, 'app_login' AS key, 'explore' AS category, 99 AS base, {_tplq('app_login')} AS text
FROM ctxh c ANTI JOIN (SELECT DISTINCT id, day FROM pos_rules) p ON c.id = p.id AND c.day = p.day""", ["pos_rules"])


def _tip_cte(name, tips):
    vals = _values(list(tips), ["tkey", "ttext"])
    return f"""
SELECT id, day, tkey AS tip_key, ttext AS tip_text FROM (
  SELECT c.id, c.day, t.tkey, t.ttext,
         row_number() OVER (PARTITION BY c.id, c.day
                            ORDER BY CASE WHEN list_contains(c.keys_6d, t.tkey) THEN 1 ELSE 0 END,
                                     md5(CAST(c.id AS VARCHAR) || '|' || CAST(c.day AS VARCHAR) || '|' || t.tkey)) AS rn
  FROM ctxh c CROSS JOIN ({vals}) t)
WHERE rn = 1"""


cte("food_tip", _tip_cte("food_tip", K.FOOD_TIPS), ["ctxh"])
cte("sleep_tip", _tip_cte("sleep_tip", K.SLEEP_TIPS), ["ctxh"])

_OT = K.OPPORTUNITY_TEMPLATES
_TIR_LOW = "has_cgm AND COALESCE(tir_pct < tir_opportunity, FALSE)"
_B1 = "COALESCE(days_with_meals_7d < 1, FALSE)"
_B2 = "(takes_glycemic_lowering_med AND NOT glycemic_med_adherent AND NOT COALESCE(low_pct > low_max, FALSE))"
_B3 = "(takes_glycemic_lowering_med AND glycemic_med_adherent AND COALESCE(meals >= 2, FALSE))"
_HIGH = "has_cgm AND COALESCE(high_pct > high_max, FALSE)"
_ACT = "(has_step_tracker OR has_exercise_program) AND COALESCE(weekly_active_minutes < 150, FALSE)"
_M1 = "COALESCE(meals >= 1, FALSE)"
_D0 = "COALESCE(days_with_meals_7d = 0, FALSE)"
_GOOD = "(sleep_hours IS NOT NULL AND COALESCE(sleep_avg_7d >= 7, FALSE))"
_RAT = "COALESCE(sleep_rating_avg_7d >= 7, FALSE)"
_ANX = "COALESCE(list_contains(focus_list, 'Anxiety'), FALSE)"
_OPP_RULES = [
    ("(has_weight_goal OR COALESCE(list_contains(focus_list, 'Weight'), FALSE)) AND days_since_last_weight > 6",
     "'weight_log_prompt'", "weight", "CASE WHEN has_weight_goal THEN 80 ELSE 70 END", _q(_OT["weight_log_prompt"])),
    (f"{_TIR_LOW} AND {_B1}", "'glucose_log_food'", "glucose", "88", _q(_OT["glucose_log_food"])),
    (f"{_TIR_LOW} AND NOT {_B1} AND {_B2}", "'glucose_take_medication'", "glucose", "96",
     _q(_OT["glucose_take_medication"])),
    (f"{_TIR_LOW} AND NOT {_B1} AND NOT {_B2} AND {_B3}", "'glucose_contact_provider_prescribed'", "glucose", "85",
     _q(_OT["glucose_contact_provider_prescribed"])),
    (f"{_TIR_LOW} AND NOT {_B1} AND NOT {_B2} AND NOT {_B3}", "'glucose_pay_attention'", "glucose", "82",
     _q(_OT["glucose_pay_attention"])),
    (_HIGH, "'glucose_high_protein_fiber'", "glucose", "85", _q(_OT["glucose_high_protein_fiber"])),
    (_HIGH, "'glucose_post_meal_walk'", "glucose", "80", _q(_OT["glucose_post_meal_walk"])),
    (f"{_HIGH} AND NOT has_nutrient_goals", "'glucose_set_carb_goal'", "glucose", "75", _q(_OT["glucose_set_carb_goal"])),
    ("has_cgm AND low_pct > low_max", "'glucose_contact_provider'", "glucose", "95", _q(_OT["glucose_contact_provider"])),
    (_ACT, "'activity_be_active'", "activity", "70", _q(_OT["activity_be_active"])),
    (f"{_ACT} AND has_exercise_program", "'activity_exercise_program'", "activity", "75",
     _q(_OT["activity_exercise_program"])),
    ("has_step_tracker AND steps < 6000", "'steps_increase'", "steps", "65", _q(_OT["steps_increase"])),
    (f"{_M1} AND has_nutrient_goals AND NOT any_nutrient_met", "'food_nutrient_attention'", "food", "55",
     _q(_OT["food_nutrient_attention"])),
    (f"{_M1} AND NOT (has_nutrient_goals AND NOT any_nutrient_met)", "'food_continue_logging'", "food", "50",
     _q(_OT["food_continue_logging"])),
    (f"NOT {_M1} AND {_D0}", "'food_start_logging'", "food", "60", _q(_OT["food_start_logging"])),
    (f"NOT {_M1} AND NOT {_D0}", "ft.tip_key", "food", "45", "ft.tip_text"),
    (f"{_GOOD} AND {_RAT}", "'sleep_continue'", "sleep", "40", _q(_OT["sleep_continue"])),
    (f"({_GOOD} AND NOT {_RAT}) OR (NOT {_GOOD} AND sleep_hours IS NOT NULL AND sleep_avg_7d IS NOT NULL)",
     "st.tip_key", "sleep", f"CASE WHEN {_GOOD} THEN 65 ELSE 70 END", "st.tip_text"),
    ("sleep_hours IS NULL", "'sleep_log_prompt'", "sleep", "60", _q(_OT["sleep_log_prompt"])),
    ("has_medications AND COALESCE(med_adherence_7d_avg < 50, FALSE) AND NOT med_reminders_enabled AND NOT took_all_meds",
     "'medication_reminders'", "medications",
     "CASE WHEN COALESCE(list_contains(focus_list, 'Medications'), FALSE) THEN 97 ELSE 80 END",
     _q(_OT["medication_reminders"])),
    ("NOT meditation_30d", "'mental_try_meditation'", "mental_wellbeing", f"CASE WHEN {_ANX} THEN 78 ELSE 45 END",
     _q(_OT["mental_try_meditation"])),
    ("NOT journal_30d", "'mental_journaling'", "mental_wellbeing", f"CASE WHEN {_ANX} THEN 72 ELSE 40 END",
     _q(_OT["mental_journaling"])),
    ("NOT plan_progress_30d", "'mental_action_plan'", "mental_wellbeing", f"CASE WHEN {_ANX} THEN 78 ELSE 45 END",
     _q(_OT["mental_action_plan"])),
    ("TRUE", "'explore_browse'", "explore", "10", _q(_OT["explore_browse"])),
]
cte("opp", "\nUNION ALL\n".join(
    f"SELECT c.*, {key} AS key, '{cat}' AS category, CAST({base} AS INTEGER) AS base, {text} AS text "
    f"FROM ctxh c JOIN food_tip ft ON c.id = ft.id AND c.day = ft.day "
    f"JOIN sleep_tip st ON c.id = st.id AND c.day = st.day WHERE COALESCE({cond}, FALSE)"
    for cond, key, cat, base, text in _OPP_RULES), ["ctxh", "food_tip", "sleep_tip"])

register("candidates_positive", "SELECT id, day, key, category, base, text FROM pos", ["pos"])
register("candidates_opportunity", "SELECT id, day, key, category, base, text FROM opp", ["opp"])

_ACT_CATS = ["weight", "glucose", "food", "activity", "steps", "sleep", "medications", "mental_wellbeing",
             "journey", "explore"]
_ALLOWED = "(NOT has_focus OR CASE category " + " ".join(
    f"WHEN '{cat}' THEN " + (_focus_allows(cat, K.FOCUS_CATEGORY_MAP).replace("(NOT has_focus OR ", "(")
                             if any(cat in v for v in K.FOCUS_CATEGORY_MAP.values()) else "FALSE")
    for cat in _ACT_CATS) + " ELSE FALSE END)"
_BOOST = f"""(CASE WHEN NOT list_contains(categories_6d, category) THEN 200 ELSE 0 END)
  + (CASE WHEN COALESCE(s.streak, 0) >= 3 THEN -30 ELSE 0 END)
  + (CASE WHEN has_focus AND {_ALLOWED} THEN 60 ELSE 0 END)"""
_JIT = "md5(CAST(p.id AS VARCHAR) || '|' || CAST(p.day AS VARCHAR) || '|' || key)"

cte("pos_prio", f"""
SELECT p.*, {_ALLOWED} AS allowed, {_JIT} AS jitter,
  (100 - base) + (CASE WHEN key = 'journey_task_completed' AND has_active_journey THEN 100 ELSE 0 END)
  + (CASE WHEN starts_with(key, 'glucose_') AND has_cgm AND COALESCE(tir_pct >= tir_positive, FALSE) THEN 90 ELSE 0 END)
  + (CASE WHEN has_weight_goal AND category IN ('weight', 'food', 'activity', 'steps', 'sleep') THEN 80 ELSE 0 END)
  + {_BOOST} AS priority,
  key = 'journey_task_completed' AND has_active_journey AND journey_task_completed AS forced_journey
FROM pos p LEFT JOIN (SELECT id AS s_id, day AS s_day, category AS s_cat, streak FROM hstreak) s
  ON p.id = s.s_id AND p.day = s.s_day AND p.category = s.s_cat""", ["pos", "hstreak"])

cte("ranked", """
SELECT id, day, key, category, priority, tier, allowed, jitter, text FROM (
  SELECT *, max(CASE WHEN tier = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY id, day) AS forced_g FROM (
    SELECT *, CASE WHEN has_cgm AND (COALESCE(tir_pct >= tir_positive, FALSE)
                                     OR (tir_prev IS NOT NULL AND COALESCE(tir_pct > tir_prev, FALSE)))
                        AND category = 'glucose' AND grank = 1 THEN 1 ELSE 2 END AS tier
    FROM (SELECT *, row_number() OVER (PARTITION BY id, day, category ORDER BY priority DESC, jitter) AS grank
          FROM (SELECT *, bool_or(allowed) OVER (PARTITION BY id, day) AS any_allowed
                FROM pos_prio WHERE NOT forced_journey)
          WHERE allowed OR NOT any_allowed)))
WHERE NOT (category = 'glucose' AND tier = 2 AND forced_g = 1)
UNION ALL
SELECT id, day, key, category, priority, 0 AS tier, allowed, jitter, text FROM pos_prio WHERE forced_journey""",
    ["pos_prio"])

cte("top_acts", """
SELECT * FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY id, day ORDER BY tier,
                 CASE WHEN tier = 2 AND cat_rank > 1 THEN 1 ELSE 0 END, priority DESC, jitter) AS INTEGER) AS slot
  FROM (SELECT *, row_number() OVER (PARTITION BY id, day, category ORDER BY tier, priority DESC, jitter) AS cat_rank
        FROM ranked))
WHERE slot <= 2 OR tier < 2""", ["ranked"])

cte("top_opp", f"""
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY id, day ORDER BY priority DESC, jitter) AS rn FROM (
    SELECT p.*, {_JIT} AS jitter, base + {_BOOST} AS priority FROM (
      SELECT *, bool_or(allowed) OVER (PARTITION BY id, day) AS any_allowed FROM (
        SELECT *, {_ALLOWED} OR key IN ({", ".join(_q(k) for k in K.CLINICAL_SAFETY_OPPORTUNITIES)}) AS allowed FROM opp))
      p LEFT JOIN (SELECT id AS s_id, day AS s_day, category AS s_cat, streak FROM hstreak) s
  ON p.id = s.s_id AND p.day = s.s_day AND p.category = s.s_cat
    WHERE allowed OR NOT any_allowed))
WHERE rn = 1""", ["opp", "hstreak"])

_GREET = _values([(g,) for g in K.GREETINGS], ["g"])
cte("greet", f"""
SELECT id, day, g AS greeting FROM (
  SELECT c.id, c.day, t.g, row_number() OVER (PARTITION BY c.id, c.day
         ORDER BY md5(CAST(c.id AS VARCHAR) || '|' || CAST(c.day AS VARCHAR) || '|' || t.g)) AS rn
  FROM ctx c CROSS JOIN ({_GREET}) t)
WHERE rn = 1""", ["ctx"])

cte("result", """
SELECT g.id, g.day, g.greeting, r.rating, a.action_texts, o.key AS opportunity_key,
  o.category AS opportunity_category, o.text AS opportunity_text,
  concat_ws(' ', g.greeting, array_to_string(a.action_texts, '. '), o.text) AS message_text
FROM greet g JOIN rating r ON g.id = r.id AND g.day = r.day
LEFT JOIN (SELECT id, day, list(text ORDER BY slot) AS action_texts FROM top_acts GROUP BY id, day) a
  ON g.id = a.id AND g.day = a.day
LEFT JOIN top_opp o ON g.id = o.id AND g.day = o.day""", ["greet", "rating", "top_acts", "top_opp"])

_WC = "CASE WHEN trim(regexp_replace({t}, '\\s+', ' ', 'g')) = '' THEN 0 ELSE CAST(len(string_split(trim(regexp_replace({t}, '\\s+', ' ', 'g')), ' ')) AS INTEGER) END"

register("priority_ranked", "SELECT id, day, key, category, priority, tier, allowed FROM ranked", ["ranked"])
register("top_actions", "SELECT id, day, slot, tier, key, category, priority, text FROM top_acts", ["top_acts"])
register("top_opportunity", "SELECT id, day, key, category, priority, text FROM top_opp", ["top_opp"])
register("greeting_pick", "SELECT * FROM greet", ["greet"])
register("rendered_text", f"""
SELECT id, day, rating, message_text, CAST(length(message_text) AS INTEGER) AS character_count,
  {_WC.format(t='message_text')} AS word_count
FROM result""", ["result"])
register("history_rows", f"""
SELECT id, category, message_date, COALESCE(array_to_string(list_sort(list(key) FILTER (WHERE is_action)), ','), '') AS keys,
  max(key) FILTER (WHERE NOT is_action) AS opportunity_used, max(rating) AS rating,
  CAST(length(max(message_text)) AS INTEGER) AS character_count, {_WC.format(t='max(message_text)')} AS word_count
FROM (SELECT t.id, t.day AS message_date, t.key, t.category, TRUE AS is_action, r.rating, r.message_text
      FROM top_acts t JOIN result r ON t.id = r.id AND t.day = r.day
      UNION ALL
      SELECT id, day, opportunity_key, opportunity_category, FALSE, rating, message_text FROM result)
GROUP BY id, category, message_date""", ["top_acts", "result"])


# ---------------------------------------------------------------------------
# evaluation
# ---------------------------------------------------------------------------
_WE = "[^\\p{L}\\p{N}_]"
cte("verd", """
SELECT doc_id, source, lang, n_chars, criterion, CASE criterion WHEN 'quality' THEN 'content' WHEN 'safety' THEN 'tone' END AS category,
  verdict, verdict = 'yes' AS passed
FROM (SELECT *, CASE WHEN starts_with(reply, 'ERROR') THEN 'error'
                     WHEN fj IN ('yes', 'no') THEN fj
                     WHEN fb <> '' THEN fb ELSE 'no' END AS verdict
      FROM (SELECT *, lower(CASE WHEN json_valid(st) THEN json_extract_string(st, '$.verdict') END) AS fj,
                   lower(regexp_extract(reply, '(?i)"verdict"\\s*:\\s*"(yes|no)"', 1)) AS fb
            FROM (SELECT *, trim(regexp_replace(reply, '```(json)?', '', 'g')) AS st
                  FROM (SELECT l.doc_id, d.source, d.lang, d.n_chars, r.criterion,
                          CASE l.doc_id % 6
                            WHEN 0 THEN '```json' || chr(10) || '{"verdict": "' || r.truth || '", "reasoning": "checked"}' || chr(10) || '```'
                            WHEN 1 THEN '{"verdict": "' || r.truth || '", "reasoning": "checked"}'
                            WHEN 2 THEN 'Here it is: {"verdict" : "' || upper(r.truth) || '", "reasoning": "cut off", "x'
                            WHEN 3 THEN 'After review the verdict is ' || r.truth || '.'
                            WHEN 4 THEN 'The verdict was in their eyes.'
                            ELSE 'ERROR: request timed out' END AS reply
                        FROM labels l JOIN documents d ON l.doc_id = d.doc_id,
                        LATERAL (SELECT 'quality' AS criterion, CASE WHEN l.quality = 1 THEN 'yes' ELSE 'no' END AS truth
                                 UNION ALL
                                 SELECT 'safety', CASE WHEN l.toxic = 0 THEN 'yes' ELSE 'no' END) r))))""")

register("reply_parse_json", """
SELECT doc_id, criterion, category, verdict, passed,
  CASE WHEN doc_id % 6 IN (0, 1) THEN 'checked' WHEN doc_id % 6 = 2 THEN 'cut off'
       ELSE 'Could not parse judge response.' END AS reasoning FROM verd""", ["verd"])
register("reply_parse_tagged", """
SELECT doc_id, CASE WHEN doc_id % 5 >= 2 AND quality = 1 THEN 'yes' ELSE 'no' END AS assessment,
  CASE WHEN doc_id % 5 = 2 THEN 'No rationale provided' ELSE 'quality label ' || CAST(quality AS VARCHAR) END AS rationale
FROM labels""", [])
register("pass_rates", f"""
SELECT criterion, category, total, passed, pass_rate,
  CASE WHEN pass_rate >= {K.PASS_BAND[0]} THEN 'pass' WHEN pass_rate < {K.PASS_BAND[1]} THEN 'fail' ELSE 'warn' END AS band,
  pass_rate < {K.WEAK_CRITERION_RATE} AS weak, pass_rate >= {K.STRONG_CRITERION_RATE} AS strong
FROM (SELECT criterion, category, count(*) AS total, count(*) FILTER (WHERE passed) AS passed,
        CAST(count(*) FILTER (WHERE passed) AS DOUBLE) / count(*) AS pass_rate
      FROM verd GROUP BY criterion, category)""", ["verd"], ["pass_rate"])
register("category_rates", """
SELECT category, avg(rate) AS category_rate, count(*) AS n_criteria
FROM (SELECT category, criterion, avg(CAST(passed AS INTEGER)) AS rate FROM verd GROUP BY category, criterion)
GROUP BY category""", ["verd"], ["category_rate"])
for _n, _col in (("group_rates_route", "source"), ("group_rates_user", "lang")):
    register(_n, f"""
SELECT {_col}, count(*) AS total, count(*) FILTER (WHERE passed) AS passed, count(DISTINCT doc_id) AS cases,
  CAST(count(*) FILTER (WHERE passed) AS DOUBLE) / count(*) AS pass_rate
FROM verd GROUP BY {_col}""", ["verd"], ["pass_rate"])
register("bot_summary", """
SELECT lang, count(*) AS cases, count(*) FILTER (WHERE chart) AS with_chart,
  count(*) FILTER (WHERE NOT chart) AS without_chart, CAST(sum(p) AS DOUBLE) / sum(n) AS micro_rate,
  avg(CAST(p AS DOUBLE) / n) AS mean_case_rate, CAST(sum(cp) AS DOUBLE) / sum(cn) AS content_rate,
  CAST(sum(tp) AS DOUBLE) / sum(tn) AS tone_rate
FROM (SELECT lang, doc_id, count(*) AS n, count(*) FILTER (WHERE passed) AS p, bool_or(n_chars > 5000) AS chart,
        count(*) FILTER (WHERE criterion = 'quality') AS cn, count(*) FILTER (WHERE criterion = 'quality' AND verdict = 'yes') AS cp,
        count(*) FILTER (WHERE criterion = 'safety') AS tn, count(*) FILTER (WHERE criterion = 'safety' AND verdict = 'yes') AS tp
      FROM verd GROUP BY lang, doc_id)
GROUP BY lang""", ["verd"], ["micro_rate", "mean_case_rate", "content_rate", "tone_rate"])
register("failures", "SELECT criterion, doc_id, source, verdict FROM verd WHERE NOT passed AND verdict <> 'error'",
         ["verd"])
register("verdict_pivot", """
SELECT doc_id, max(verdict) FILTER (WHERE criterion = 'quality') AS quality,
  max(verdict) FILTER (WHERE criterion = 'safety') AS safety
FROM verd GROUP BY doc_id""", ["verd"])
register("label_frequency", "SELECT verdict, count(*) AS n FROM verd GROUP BY verdict", ["verd"])

_CANON = list(K.FOCUS_ID_MAPPING.values())
_CANON_L = "[" + ", ".join(_q(x) for x in _CANON) + "]"
register("label_normalise", f"""
SELECT doc_id, raw_label,
  COALESCE(CASE WHEN list_contains({_CANON_L}, raw_label) THEN raw_label END,
           list_filter({_CANON_L}, lambda x: starts_with(lower(left(x, 20)), lower(left(raw_label, 20)))
                                    OR starts_with(lower(left(raw_label, 20)), lower(left(x, 20))))[1],
           'Other') AS label
FROM (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN canon
                              WHEN 1 THEN lower(canon) || ' focus area of the user'
                              WHEN 2 THEN upper(left(canon, 4))
                              ELSE 'unknown-' || source END AS raw_label
      FROM (SELECT doc_id, source, {_CANON_L}[CAST(doc_id % {len(_CANON)} AS INTEGER) + 1] AS canon FROM documents))""", [])

_PREFIX = [("the ", "en_article"), ("th", "en_th"), ("le ", "fr_article"), ("la ", "fr_article"),
           ("el ", "es_article"), ("der ", "de_article"), ("die ", "de_article"), ("das ", "de_article")]
register("prefix_classify", "SELECT class, count(*) AS n FROM (SELECT CASE " + " ".join(
    f"WHEN starts_with(lower(ltrim(text)), {_q(p)}) THEN {_q(lab)}" for p, lab in _PREFIX)
    + " ELSE 'other' END AS class FROM conversations) GROUP BY class", [])
register("value_substitute", """
SELECT lang_name, source_name, count(*) AS n, count(*) FILTER (WHERE lang_name <> lang) AS lang_replaced,
  count(*) FILTER (WHERE source_name <> source) AS source_replaced
FROM (SELECT lang, source,
        CASE lang WHEN 'en' THEN 'English' WHEN 'fr' THEN 'French' WHEN 'de' THEN 'German' WHEN 'es' THEN 'Spanish'
                  ELSE lang END AS lang_name,
        CASE source WHEN 'src0' THEN 'primary' WHEN 'src1' THEN 'secondary' ELSE source END AS source_name
      FROM documents)
GROUP BY lang_name, source_name""", [])

_W = "CASE WHEN trim(regexp_replace({t}, '\\s+', ' ', 'g')) = '' THEN 0 ELSE CAST(len(string_split(trim(regexp_replace({t}, '\\s+', ' ', 'g')), ' ')) AS INTEGER) END"
_BANNED = "(^|" + _WE + ")(" + "|".join(K.BANNED_TERMS).replace("'", "''") + ")(" + _WE + "|$)"
register("text_checks", f"""
SELECT *, words_ok AND exclamations <= {K.MAX_EXCLAMATIONS} AND max_sentence_words <= {K.MAX_SENTENCE_WORDS}
  AND NOT banned_term AND NOT healthcare_one_word AND NOT double_space AND NOT starts_now AND NOT markdown
  AND NOT bullets AND NOT multi_paragraph AND NOT semicolon AND NOT ellipsis AND NOT dashes
  AND COALESCE(fk_grade BETWEEN {K.FK_GRADE_RANGE[0]} AND {K.FK_GRADE_RANGE[1]}, FALSE) AS passed_all
FROM (SELECT conv_id, turn, words, words BETWEEN {K.WORDS_RANGE[0]} AND {K.WORDS_RANGE[1]} AS words_ok,
        CAST(len(regexp_extract_all(text, '!')) AS INTEGER) AS exclamations,
        COALESCE(list_max(list_transform(
          list_filter(regexp_split_to_array(text, '[.!?]+'), lambda s: trim(regexp_replace(s, '\\s+', ' ', 'g')) <> ''),
          lambda s: {_W.format(t='s')})), 0) AS max_sentence_words,
        regexp_matches(lower(text), '{_BANNED}') AS banned_term,
        contains(lower(text), 'healthcare') AS healthcare_one_word,
        contains(text, '  ') AS double_space,
        regexp_matches(text, '(^|[.!?]\\s+)Now({_WE}|$)') AS starts_now,
        regexp_matches(text, '(?m)(\\*\\*|^#{{1,6}}\\s)') AS markdown,
        regexp_matches(text, '(?m)^\\s*([-*]|[0-9]+\\.)\\s') AS bullets,
        regexp_matches(text, '\\n\\s*\\n') AS multi_paragraph,
        contains(text, ';') AS semicolon,
        contains(text, '...') OR contains(text, '…') AS ellipsis,
        contains(text, '—') OR contains(text, '–') OR contains(text, ' - ') AS dashes,
        CASE WHEN words > 0 THEN 0.39 * (words / n_sent) + 11.8 * (syll / words) - 15.59 END AS fk_grade
      FROM (SELECT conv_id, turn, text, {_W.format(t='text')} AS words,
              greatest(len(regexp_extract_all(text, '[.!?]+')), 1) AS n_sent,
              len(regexp_extract_all(lower(text), '[aeiouy]+')) AS syll
            FROM conversations WHERE role = 'assistant'))""", [], ["fk_grade"])

register("number_grounding", """
SELECT conv_id, turn, CAST(len(m) AS INTEGER) AS n_numbers,
  CAST(len(list_filter(m, lambda x: NOT list_contains(s, x))) AS INTEGER) AS n_missing,
  len(list_filter(m, lambda x: NOT list_contains(s, x))) = 0 AS grounded
FROM (SELECT a.conv_id, a.turn,
        list_distinct(regexp_extract_all(replace(a.text, ',', ''), '[0-9]+(\\.[0-9]+)?')) AS m,
        list_distinct(regexp_extract_all(replace(COALESCE(b.text, ''), ',', ''), '[0-9]+(\\.[0-9]+)?')) AS s
      FROM conversations a LEFT JOIN conversations b ON a.conv_id = b.conv_id AND b.turn + 1 = a.turn
      WHERE a.role = 'assistant')""", [])


# ---------------------------------------------------------------------------
# writes on order versions
# ---------------------------------------------------------------------------
cte("v1", """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders
WHERE o_orderdate < TIMESTAMP '2001-01-01 00:00:00'""")
cte("v2", """SELECT o_orderkey, o_custkey, o_orderstatus,
  CASE WHEN o_orderstatus = 'O' THEN o_totalprice + 1.0 ELSE o_totalprice END AS o_totalprice, o_orderdate
FROM orders WHERE o_orderstatus <> 'P'""")
register("change_set", """
SELECT COALESCE(a.o_orderkey, b.o_orderkey) AS o_orderkey,
  CASE WHEN a.o_orderkey IS NULL THEN 'insert' WHEN b.o_orderkey IS NULL THEN 'delete' ELSE 'update' END AS change
FROM v1 a FULL OUTER JOIN v2 b ON a.o_orderkey = b.o_orderkey
WHERE a.o_orderkey IS NULL OR b.o_orderkey IS NULL
   OR a.o_custkey IS DISTINCT FROM b.o_custkey OR a.o_orderstatus IS DISTINCT FROM b.o_orderstatus
   OR a.o_totalprice IS DISTINCT FROM b.o_totalprice OR a.o_orderdate IS DISTINCT FROM b.o_orderdate""", ["v1", "v2"])
register("upsert_audit", """
SELECT COALESCE(t.o_orderkey, s.o_orderkey) AS o_orderkey,
  CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_custkey ELSE t.o_custkey END AS o_custkey,
  CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
  CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice,
  CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_orderdate ELSE t.o_orderdate END AS o_orderdate,
  CASE WHEN t.o_orderkey IS NOT NULL THEN DATE '2024-01-01' ELSE DATE '2024-01-02' END AS created_at,
  CASE WHEN s.o_orderkey IS NOT NULL THEN DATE '2024-01-02' ELSE DATE '2024-01-01' END AS last_modified_at,
  CASE WHEN s.o_orderkey IS NOT NULL AND t.o_orderkey IS NOT NULL THEN 1 ELSE 0 END AS overwrite_count
FROM v1 t FULL OUTER JOIN v2 s ON t.o_orderkey = s.o_orderkey""", ["v1", "v2"], ["o_totalprice"])
register("evolve_union", """
SELECT version, price_band, count(*) AS n, sum(o_totalprice) AS total FROM (
  SELECT o_totalprice, 1 AS version, CAST(NULL AS VARCHAR) AS price_band FROM v1
  UNION ALL
  SELECT o_totalprice, 2, CASE WHEN o_totalprice > 100000 THEN 'high' ELSE 'normal' END FROM v2)
GROUP BY version, price_band""", ["v1", "v2"], ["total"])
register("partition_overwrite", """
SELECT o_orderstatus, version, count(*) AS n FROM (
  SELECT o_orderstatus, 2 AS version FROM v2
  UNION ALL
  SELECT o_orderstatus, 1 FROM v1 WHERE o_orderstatus NOT IN (SELECT DISTINCT o_orderstatus FROM v2))
GROUP BY o_orderstatus, version""", ["v1", "v2"])

register("day_lookup", """
SELECT id, day, score, rating FROM (
  SELECT id, day, score, rating, row_number() OVER (PARTITION BY id ORDER BY day DESC) AS rn FROM rating)
WHERE rn = 1""", ["rating"])
register("day_ids", """
SELECT day, count(*) AS n_ids FROM (SELECT DISTINCT id, day FROM rating) r
WHERE id IN (SELECT id FROM goals WHERE has_weight_goal = 1) GROUP BY day""", ["rating", "goals"])

register("sheet_roundtrip", """
SELECT lang, source, count(*) AS n_docs, CAST(sum(length(text)) AS BIGINT) AS n_chars,
  count(*) FILTER (WHERE contains(text, chr(10))) AS multi_line
FROM documents GROUP BY lang, source""", [])

register("report_day", """
SELECT r.id, r.day, r.score, r.rating, COALESCE(a.actions, '') AS actions, o.key AS opportunity_key, res.message_text
FROM rating r
JOIN result res ON r.id = res.id AND r.day = res.day
LEFT JOIN (SELECT id, day, array_to_string(list(key ORDER BY slot), ',') AS actions FROM top_acts GROUP BY id, day) a
  ON r.id = a.id AND r.day = a.day
LEFT JOIN top_opp o ON r.id = o.id AND r.day = o.day
WHERE r.day = (SELECT CAST(max(ts) AS DATE) FROM events)""", ["rating", "result", "top_acts", "top_opp"])

register("tip_pick", """
SELECT f.id, f.day, f.tip_key AS food_tip, s.tip_key AS sleep_tip
FROM food_tip f JOIN sleep_tip s ON f.id = s.id AND f.day = s.day""", ["food_tip", "sleep_tip"])

_ONE = "CAST(round_even({}, 1) AS VARCHAR)"
cte("weekly", f"""
SELECT o.id, o.day, o.greeting, o.action_texts, o.opportunity_text, concat_ws(chr(10),
  CASE WHEN sleepy AND sleep_hours >= 7 AND sleep_avg_7d < 7
       THEN '- Yesterday''s sleep: ' || {_ONE.format('sleep_hours')} || 'h. 7-day average: ' || {_ONE.format('sleep_avg_7d')} || 'h (below 7h target).' END,
  CASE WHEN sleepy AND sleep_rating >= 7 AND sleep_rating_avg_7d < 7
       THEN '- Yesterday''s sleep rating: ' || CAST(CAST(trunc(sleep_rating) AS INTEGER) AS VARCHAR) || '/10. 7-day average rating: '
            || {_ONE.format('sleep_rating_avg_7d')} || '/10 (below 7 target).' END,
  CASE WHEN active AND active_minutes >= 20 AND weekly_active_minutes < 150
       THEN '- Yesterday''s active minutes: ' || CAST(CAST(trunc(active_minutes) AS INTEGER) AS VARCHAR)
            || '. Weekly total is below the recommended level. Encourage more activity today.' END,
  CASE WHEN opportunity_key = 'medication_reminders' AND took_all_meds AND med_adherence_7d_avg IS NOT NULL
       THEN '- Yesterday: took all meds. 7-day adherence average: '
            || CAST(CAST(round_even(med_adherence_7d_avg, 0) AS INTEGER) AS VARCHAR) || '% (below 50% threshold).' END) AS weekly_context
FROM (SELECT *, COALESCE(opportunity_category = 'sleep' OR starts_with(opportunity_key, 'sleep_'), FALSE) AS sleepy,
        COALESCE(opportunity_category = 'activity' OR starts_with(opportunity_key, 'activity_'), FALSE) AS active
      FROM result) o JOIN ctx c ON o.id = c.id AND o.day = c.day""", ["result", "ctx"])

register("weekly_context", """
SELECT id, day, weekly_context,
  CAST(len(list_filter(string_split(weekly_context, chr(10)), lambda x: x <> '')) AS INTEGER) AS n_lines
FROM weekly""", ["weekly"])

register("prompt_text", """
SELECT id, day, weekly_context,
  'Generate a brief, personalized health message with EXACTLY 1 paragraph:' || chr(10) || chr(10) || 'Start with "' || greeting
  || '" then weave in these points using your own natural wording:' || chr(10)
  || CASE WHEN len(action_texts) > 0 THEN array_to_string(list_transform(action_texts, lambda x: '- ' || x), chr(10))
          ELSE '- User logged into the app today' END
  || chr(10) || chr(10) || 'End with this suggestion (rephrase in your own words):' || chr(10)
  || COALESCE(opportunity_text, 'Browse the Explore section to learn more.') || chr(10) || chr(10)
  || CASE WHEN weekly_context <> '' THEN 'Weekly context that influenced the suggestion:' || chr(10) || weekly_context ELSE '' END
  || chr(10) || chr(10) || 'IMPORTANT: Do NOT copy the instructions above word-for-word. Use them as guidance and write the message in your own natural, conversational voice. Do NOT add ratings or generic motivation. Go directly from acknowledgment to suggestion. If weekly context is provided, use it to briefly explain why the suggestion matters even if yesterday looked good.' AS prompt
FROM weekly""", ["weekly"])

register("clustered_layout", "SELECT * FROM rating", ["rating"], ["percentage"])
register("partition_lookup", """
SELECT id, day, score, rating FROM rating
WHERE day = DATE '2024-01-20' AND id IN (SELECT id FROM goals WHERE has_weight_goal = 1)""", ["rating", "goals"])
register("key_categories", """
SELECT kind, key, count(*) AS n, CASE
  WHEN key LIKE 'glucose%' THEN 'glucose' WHEN key LIKE 'steps%' THEN 'steps'
  WHEN key LIKE 'activity%' OR key LIKE 'exercise%' THEN 'activity' WHEN key LIKE 'sleep%' THEN 'sleep'
  WHEN key LIKE 'med!_%' ESCAPE '!' OR key LIKE 'medication%' THEN 'medications'
  WHEN key LIKE 'meal%' OR key LIKE 'nutrient%' OR key LIKE 'ai_meal_plan%' OR key LIKE 'food%' THEN 'food'
  WHEN key LIKE 'weight%' THEN 'weight' WHEN key LIKE 'journey%' THEN 'journey'
  WHEN key LIKE 'meditation%' OR key LIKE 'journal%' OR key LIKE 'action_plan%' OR key LIKE 'mental%' THEN 'mental_wellbeing'
  ELSE 'explore' END AS category
FROM (SELECT 'action' AS kind, key FROM ranked
      UNION ALL
      SELECT 'opportunity', key FROM (
        SELECT key, allowed, bool_or(allowed) OVER (PARTITION BY id, day) AS any_allowed
        FROM (SELECT *, """ + _ALLOWED + " OR key IN (" + ", ".join(_q(k) for k in K.CLINICAL_SAFETY_OPPORTUNITIES) + """) AS allowed FROM opp))
      WHERE allowed OR NOT any_allowed)
GROUP BY kind, key""", ["ranked", "opp"])
register("column_comments", """
SELECT 'tir_pct' AS column_name, TRUE AS applied, 'share of readings in 70-180' AS comment, count(tir_pct) AS n_rows FROM feat
UNION ALL SELECT 'weekly_active_minutes', TRUE, '7-day calendar sum', count(weekly_active_minutes) FROM feat
UNION ALL SELECT 'protein_target_pct', FALSE, NULL, NULL""", ["feat"])
