"""Adapter from the given test tables to the reference's source roles.

The reference reads ~20 health tables; the test data has one ``events``
stream plus TPC-H style tables. Each role below is a projection of those
tables with a fixed, documented derivation, so every feature job reads the
given tables and grows with them. The same derivations are written as SQL in
``daybook.oracle`` for the DuckDB check.

events (one row per observation):
  id = user_id, offset minutes = (user_id % 25 - 12) * 60, k = props.k
  status = k % 4 (active: 1, 2), source = k % 20 (CGM: 18)
  glucose       event_type 'view', active status, reading = value
  activity      event_type 'click', minutes = value, exercisetype = 30040 + k % 8
                (30045 = meditation)
  video         'click' with k % 10 = 0, completion pct = least(value / 4.9, 100)
  steps         event_type 'purchase', steps = round(value * 40)
  weight        event_type 'signup', weight = 150 + value / 10
  program       'signup': start k % 5 = 0, completed k % 5 = 1, progress k % 5 = 2
  dose          k % 8 <> 0: medication k % 2 on the local day, statusid 2 (missed) if k % 10 = 9, else 1 (taken)
  food          k % 3 = 0, meal type id = [1, 3, 5, 12][(k div 3) % 4],
                carbs = value / 5, protein = value / 10, fat = value / 15, calories = value * 2
  journal       k % 7 = 0
  bonus events  AI meal plan 'purchase' with k % 9 = 0, article 'view' with k % 9 = 1,
                lesson 'view' with k % 9 = 2, learn video 'click' with k % 9 = 3
  action plan   k % 13 = 0, statusid = k % 3 + 1 (3 = deleted)
  grocery       k % 11 = 0, epoch milliseconds of ts, day = UTC date of those
  sleep         event_type 'error', start = ts, end = ts + round(value * 60) seconds,
                rating = k % 11, day = local date of end
  focus JSON    'signup' rows: {"MyFocusID": k % 14, "IsMyFocus": k % 2, "FocusOptionID": 0}
customer (per id = c_custkey):
  weight goal   segment AUTOMOBILE -> type 1, BUILDING -> 2, MACHINERY -> 3, else none;
                target weight = 150 + abs(c_acctbal) % 50; start 2023-01-01 + c_custkey % 365 days;
                status 2 (ended) where c_acctbal < 0, else 1 (active)
  nutrition     protein = 20 + abs(acctbal) % 40, carb = 60 + abs(acctbal) % 90,
  goals         fat = 15 + abs(acctbal) % 30, calories = 300 + abs(acctbal) % 500
orders (per id = o_custkey):
  a1c target    latest order by date, then key: a1ctarget = o_orderkey % 3 + 1
  journey       orders with o_orderkey % 7 = 0: status O -> 1 (active), F -> 2 (completed),
                P -> 3 (incomplete)
  video/program status F -> 2 (completed), else 1 (active); program started on o_orderdate
part / lineitem / orders (medications):
  class         parts 1 and 2 describe medications 0 and 1; diabetes class when p_size is even
  prescription  one per lineitem with l_linenumber = 1 and l_orderkey % 4 = 0: id = o_custkey,
                rx = l_orderkey, medication = l_partkey % 2, frequencyvalue by
                (l_orderkey div 4) % 3: 0 'daily' (lenient cast -> 1), else the number as text,
                start = o_orderdate, end = l_shipdate + 30 days when o_orderstatus = 'F',
                statusid 1 unless l_linestatus = 'F' and o_orderstatus = 'F' (2)
  schedule      reminder = (int(l_quantity) % 2) as text, for lines with l_quantity > 25
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions import constants as K
from daybook.functions.cache import per_context
from daybook.functions.exprs import case_label
from daybook.functions.timeutil import date_from_epoch_millis, epoch_millis, local_date
from daybook.sources.tables import load, load_optional

EVENT_COLS = ["ts", "user_id", "event_type", "value", "props"]


def with_parsed_props(ev: DataFrame) -> DataFrame:
    """Events with props as the column k; events that were parsed before stay as they are."""
    if "k" in ev.columns:
        return ev
    return ev.select("ts", "user_id", "event_type", "value", F.get_json_object("props", "$.k").try_cast("int").alias("k"))


def events_base(spark: SparkSession, base: str, events: DataFrame | None = None) -> DataFrame:
    ev = load(spark, base, "events", EVENT_COLS) if events is None else events
    out = with_parsed_props(ev).select(
        F.col("user_id").alias("id"), "ts", "event_type", "value", "k",
        ((F.col("user_id") % 25 - 12) * 60).cast("int").alias("off"))
    return out.withColumns({
        "status": F.col("k") % 4,
        "source": F.col("k") % 20,
        "day": local_date("ts", "off"),
    })


def with_role_columns(ev: DataFrame) -> DataFrame:
    first, second = _role_columns()
    return ev.withColumns(first).withColumns(second)


@per_context
def _role_columns() -> tuple[dict, dict]:
    et = F.col("event_type")
    k = F.col("k")
    return ({
        "is_bg": (et == "view") & F.col("status").isin(*K.ACTIVE_STATUS),
        "is_act": et == "click",
        "exercisetype": F.lit(30040) + k % 8,
        "is_video": (et == "click") & (k % 10 == 0),
        "video_pct": F.least(F.col("value") / 4.9, F.lit(100.0)),
        "is_step": et == "purchase",
        "steps_v": F.round(F.col("value") * 40).cast("bigint"),
        "is_weight": et == "signup",
        "weight_v": F.lit(150.0) + F.col("value") / 10,
        "is_prog": (et == "signup") & (k % 5 == 0),
        "is_prog_done": (et == "signup") & (k % 5 == 1),
        "is_prog_step": (et == "signup") & (k % 5 == 2),
        "is_meal": k % 3 == 0,
        "is_meal_plan": (et == "purchase") & (k % 9 == 0),
        "is_article": (et == "view") & (k % 9 == 1),
        "is_lesson": (et == "view") & (k % 9 == 2),
        "is_learn_video": (et == "click") & (k % 9 == 3),
        "meal_type_id": F.element_at(F.array(*[F.lit(x) for x in K.MEAL_TYPE_MAPPING]),
                                     (F.floor(k / 3) % 4 + 1).cast("int")),
        "is_journal": k % 7 == 0,
        "is_plan": (k % 13 == 0) & (k % 3 + 1 != 3),
        "plan_status": k % 3 + 1,
    }, {
        "is_meditation": F.col("is_act") & (F.col("exercisetype") == K.MEDITATION_EXERCISE_TYPE),
        "meal_type": case_label("meal_type_id", K.MEAL_TYPE_MAPPING),
    })


def grocery_rows(ev: DataFrame) -> DataFrame:
    """Epoch-ms entries (B3): the day is the UTC date of the millisecond value."""
    ms = epoch_millis(F.col("ts"))
    return (ev.filter(F.col("k") % 11 == 0)
            .select("id", date_from_epoch_millis(ms).alias("day")))


def sleep_intervals(ev: DataFrame) -> DataFrame:
    """B2: interval events, local start/end, day = local date of the end."""
    end = F.timestamp_add("SECOND", F.round(F.col("value") * 60).cast("bigint"), F.col("ts"))
    return (ev.filter(F.col("event_type") == "error")
            .select("id", F.col("ts").alias("start_ts"), end.alias("end_ts"),
                    (F.col("k") % 11).cast("double").alias("rating"), "off")
            .withColumn("day", local_date("end_ts", "off")))


def focus_json(ev: DataFrame) -> DataFrame:
    """One JSON array string per id, shaped like the reference's focus column.

    Built from the distinct items (at most 14 ids x 2 flags), so a hot id
    never collects an unbounded list into one group."""
    item = F.struct((F.col("k") % 14).alias("MyFocusID"), (F.col("k") % 2).alias("IsMyFocus"),
                    F.lit(0).alias("FocusOptionID"))
    return (ev.filter(F.col("event_type") == "signup")
            .groupBy("id").agg(F.to_json(F.array_sort(F.collect_set(item))).alias("myfocusdata")))


def customer_goals(spark: SparkSession, base: str) -> DataFrame:
    """Goals are optional: without their table every id is one without goals."""
    c = load_optional(spark, base, "customer", "c_custkey bigint, c_acctbal double, c_mktsegment string")
    a = F.abs(F.col("c_acctbal"))
    goal_type = (F.when(F.col("c_mktsegment") == "AUTOMOBILE", 1)
                 .when(F.col("c_mktsegment") == "BUILDING", 2)
                 .when(F.col("c_mktsegment") == "MACHINERY", 3))
    return c.select(
        F.col("c_custkey").alias("id"), goal_type.alias("goal_type_id"),
        (F.lit(150.0) + a % 50).alias("target_weight"),
        F.date_add(F.lit("2023-01-01").cast("date"), (F.col("c_custkey") % 365).cast("int")).alias("goal_start"),
        F.when(F.col("c_acctbal") < 0, 2).otherwise(1).alias("goal_status"),
        (F.lit(20.0) + a % 40).alias("protein_goal"), (F.lit(60.0) + a % 90).alias("carb_goal"),
        (F.lit(15.0) + a % 30).alias("fat_goal"), (F.lit(300.0) + a % 500).alias("calories_goal"))


def orders_state(spark: SparkSession, base: str) -> DataFrame:
    return load(spark, base, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"]) \
        .withColumnRenamed("o_custkey", "id")


def medication_sources(spark: SparkSession, base: str, events: DataFrame | None = None) -> dict[str, DataFrame]:
    """Class, prescriptions and schedule from part/lineitem/orders, doses from events."""
    part = load(spark, base, "part", ["p_partkey", "p_size"])
    li = load(spark, base, "lineitem", ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_linestatus",
                                        "l_shipdate"])
    orders = load(spark, base, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"])
    med_class = part.filter(F.col("p_partkey").between(1, 2)).select(
        (F.col("p_partkey") - 1).alias("medicationid"), (F.col("p_size") % 2 == 0).alias("diabetesclass"))
    li = li.filter((F.col("l_linenumber") == 1) & (F.col("l_orderkey") % 4 == 0))
    lo = li.join(orders.filter(F.col("o_orderkey") % 4 == 0), li.l_orderkey == orders.o_orderkey)
    every = F.expr("(l_orderkey div 4) % 3")
    rx = lo.select(
        F.col("o_custkey").alias("id"), F.col("l_orderkey").alias("medprescriptionid"),
        (F.col("l_partkey") % 2).alias("medicationid"),
        F.when(every == 0, F.lit("daily")).otherwise(every.cast("string")).alias("frequencyvalue"),
        F.to_date("o_orderdate").alias("startdate"),
        F.when(F.col("o_orderstatus") == "F", F.date_add(F.to_date("l_shipdate"), 30)).alias("discontinueddate"),
        F.when((F.col("l_linestatus") == "F") & (F.col("o_orderstatus") == "F"), 2).otherwise(1).alias("statusid"),
        # The schedule of a prescription is on the same line
        F.when(F.col("l_quantity") > 25, (F.col("l_quantity").cast("int") % 2).cast("string")).alias("medicationreminder"))
    dose = events_base(spark, base, events).filter(F.col("k") % 8 != 0).select(
        "id", "day", (F.col("k") % 2).cast("bigint").alias("medicationid"),
        F.when(F.col("k") % 10 == 9, 2).otherwise(1).alias("statusid"))
    return {"class": med_class, "rx": rx, "dose": dose}
