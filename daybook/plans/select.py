"""Focus filter, priorities and diversified top-k selection.

All windows are partitioned by (id, day); the input is already partitioned
by id, which satisfies that clustering, so selection adds no exchange. A
group holds at most the number of rules (bounded), whatever the data size.

Selection with forced slots as ranks (exact for the reference's greedy):
  tier 0  journey_task_completed when the journey is active and a task is
          done (taken from all actions, exempt from the focus filter)
  tier 1  best glucose action when CGM and TIR met target or improved;
          the other glucose actions leave the pool
  tier 2  the rest: first one action per category (best first), then
          anything left, by priority and hash jitter
Forced rows are always kept; the rest fill up to ``k`` in total.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daybook.functions import constants as K
from daybook.functions.cache import per_context
from daybook.functions.exprs import safe_gte
from daybook.plans import assemble, candidates, history, score

c = F.col
ACTION_CATEGORIES = ["weight", "glucose", "food", "activity", "steps", "sleep", "medications",
                     "mental_wellbeing", "journey", "explore"]


def allowed_categories() -> Column:
    """H7: categories that the active focuses list, one array per id and day."""
    lists = F.create_map(*[x for focus, cats in K.FOCUS_CATEGORY_MAP.items() for x in (
        F.lit(focus), F.array(*[F.lit(cat) for cat in cats if cat in ACTION_CATEGORIES]).cast("array<string>"))])
    none = F.array().cast("array<string>")
    return F.coalesce(F.flatten(F.transform("focus_list", lambda f: F.coalesce(F.try_element_at(lists, f), none))), none)


def category_allowed(cat: Column) -> Column:
    """H7: category in any active focus list (no focus -> all allowed)."""
    return ~c("has_focus") | F.array_contains("_listed", cat)


def with_history(ctx: DataFrame, state: DataFrame) -> DataFrame:
    """History state joined on (id, day); no history reads as empty."""
    return ctx.join(state, ["id", "day"], "left").withColumns({
        "categories_6d": F.coalesce(c("categories_6d"), F.array().cast("array<string>")),
        "keys_6d": F.coalesce(c("keys_6d"), F.array().cast("array<string>")),
        "weight_msgs_7d": F.coalesce(c("weight_msgs_7d"), F.lit(0)),
        "weight_shown_yesterday": F.coalesce(c("weight_shown_yesterday"), F.lit(False)),
        "category_streaks": F.coalesce(c("category_streaks"), F.create_map().cast("map<string,int>")),
    })


def _streak(cat: Column) -> Column:
    return F.coalesce(F.try_element_at(c("category_streaks"), cat), F.lit(0))


def _common_boosts(cat: Column) -> Column:
    pr = K.PRIORITY_RULES
    novelty = F.when(~F.array_contains(c("categories_6d"), cat), pr["not_shown_6_days"]).otherwise(0)
    streak = F.when(_streak(cat) >= pr["streak_override_days"], -pr["streak_priority_penalty"]).otherwise(0)
    focus = F.when(c("has_focus") & category_allowed(cat), pr["user_focus_area"]).otherwise(0)
    return novelty + streak + focus


def context_with_history(spark: SparkSession, base: str) -> DataFrame:
    ctx = assemble.context(spark, base)
    state = history.history_state(history.history_from_events(spark, base))
    return with_history(ctx, state)


def ranked(ctx: DataFrame) -> DataFrame:
    """Positive actions and opportunities in ONE Generate, tagged by ``kind``,
    focus-filtered (H7), prioritised (H8-H10) and tiered (H11, H12).

    Every later step is a window on (id, day, kind[, category]) or a filter,
    so the rule inputs are computed once and no branch is joined back.
    """
    e = _ranked_exprs()
    df = ctx.withColumn("_listed", allowed_categories()).select("*", e["inline"])
    df = df.withColumns({"priority": e["priority"], "forced": e["forced"], "allowed": e["allowed"],
                         "jitter": e["jitter"]})
    df = df.withColumn("_any", e["any_allowed"]).filter(e["keep"])
    df = df.withColumn("tier", e["tier"])
    return df.withColumn("_fg", e["forced_g"]).filter(e["drop_glucose"]).drop("_any", "_fg", "_listed")


@per_context
def _ranked_exprs() -> dict:
    pos = F.transform(candidates.positive_array(), lambda x: F.struct(F.lit("action").alias("kind"), x["key"].alias("key"),
                                                                     x["category"].alias("category"), x["base"].alias("base"),
                                                                     x["text"].alias("text")))
    opp = F.transform(candidates.opportunity_array(), lambda x: F.struct(F.lit("opportunity").alias("kind"), x["key"].alias("key"),
                                                                        x["category"].alias("category"), x["base"].alias("base"),
                                                                        x["text"].alias("text")))
    inline = F.inline(F.concat(pos, opp))
    pr = K.PRIORITY_RULES
    cat = c("category")
    is_act = c("kind") == "action"
    journey = F.when((c("key") == "journey_task_completed") & c("has_active_journey"), pr["journey_active"]).otherwise(0)
    good_tir = F.when(c("key").startswith("glucose_") & c("has_cgm") & safe_gte("tir_pct", c("tir_positive")),
                      pr["cgm_with_good_tir"]).otherwise(0)
    wgoal = F.when(c("has_weight_goal") & cat.isin("weight", "food", "activity", "steps", "sleep"),
                   pr["weight_goal_active"]).otherwise(0)
    prio = F.when(is_act, (F.lit(100) - c("base")) + journey + good_tir + wgoal).otherwise(c("base")) + _common_boosts(cat)
    forced = is_act & (c("key") == "journey_task_completed") & c("has_active_journey") & c("journey_task_completed")
    allowed = category_allowed(cat) | (~is_act & c("key").isin(*K.CLINICAL_SAFETY_OPPORTUNITIES))
    w_kind = Window.partitionBy("id", "day", "kind")
    any_allowed = F.max(F.when(~c("forced"), c("allowed"))).over(w_kind)
    keep = c("forced") | c("allowed") | ~F.coalesce(c("_any"), F.lit(False))
    order = [c("priority").desc(), c("jitter")]
    g_rank = F.row_number().over(Window.partitionBy("id", "day", "kind", "category").orderBy(*order))
    tir_ok = c("has_cgm") & (safe_gte("tir_pct", c("tir_positive"))
                            | (c("tir_prev").isNotNull() & F.coalesce(c("tir_pct") > c("tir_prev"), F.lit(False))))
    tier = (F.when(c("forced"), 0)
            .when(is_act & tir_ok & (cat == "glucose") & (g_rank == 1), 1).otherwise(2))
    forced_g = F.max(F.when(c("tier") == 1, 1).otherwise(0)).over(w_kind)
    # the forced glucose pick removes the other glucose actions
    drop_glucose = ~(is_act & (cat == "glucose") & (c("tier") == 2) & (c("_fg") == 1))
    return {"inline": inline, "priority": prio, "forced": forced, "allowed": allowed,
            "jitter": candidates.jitter("id", "day", "key"), "any_allowed": any_allowed, "keep": keep,
            "tier": tier, "forced_g": forced_g, "drop_glucose": drop_glucose}


def selected(rk: DataFrame, k: int = K.MAX_POSITIVE_ACTIONS) -> DataFrame:
    """H13/H14 (E15, E16): forced tiers, then one action per new category, then
    the rest, up to ``k`` actions; the top opportunity."""
    order = [c("priority").desc(), c("jitter")]
    is_act = c("kind") == "action"
    cat_rank = F.row_number().over(Window.partitionBy("id", "day", "kind", "category").orderBy(c("tier"), *order))
    r = rk.withColumn("cat_rank", cat_rank)
    second_pass = F.when(is_act & (c("tier") == 2) & (c("cat_rank") > 1), 1).otherwise(0)
    slot = F.row_number().over(Window.partitionBy("id", "day", "kind").orderBy(c("tier"), second_pass, *order))
    r = r.withColumn("slot", slot)
    return r.filter(F.when(is_act, (c("slot") <= k) | (c("tier") < 2)).otherwise(c("slot") == 1))


def ranked_actions(ctx: DataFrame) -> DataFrame:
    return ranked(ctx).filter(c("kind") == "action")


def select_actions(rk: DataFrame, k: int = K.MAX_POSITIVE_ACTIONS) -> DataFrame:
    return selected(rk, k).filter(c("kind") == "action")


def ranked_opportunities(ctx: DataFrame) -> DataFrame:
    return ranked(ctx).filter(c("kind") == "opportunity")


def select_opportunity(rk: DataFrame) -> DataFrame:
    return selected(rk).filter(c("kind") == "opportunity")


def greeting_pick() -> Column:
    """I4: greeting chosen by hash rank over the fixed list."""
    items = F.array(*[F.lit(g) for g in K.GREETINGS])
    ranked = F.transform(items, lambda g: F.struct(
        F.md5(F.concat_ws("|", c("id").cast("string"), c("day").cast("string"), g)).alias("h"), g.alias("g")))
    return F.array_min(ranked)["g"]


def daily_result(spark: SparkSession, base: str, k: int = K.MAX_POSITIVE_ACTIONS,
                 ctx: DataFrame | None = None, carry: list[str] | None = None) -> DataFrame:
    """The per-(id, day) selection: rating, greeting, picked actions, opportunity.

    One linear plan: rule inputs -> rating / greeting columns -> candidate
    Generate -> windows -> one aggregate back to (id, day). The windows and
    the final aggregate reuse the id partitioning of the feature stage.
    """
    ctx = ctx if ctx is not None else context_with_history(spark, base)
    scored = score.daily_rating(ctx, keep=True).withColumn("greeting", greeting_pick())
    sel = selected(ranked(scored), k)
    is_act = c("kind") == "action"
    out = sel.groupBy("id", "day").agg(
        F.first("greeting").alias("greeting"), F.first("score").alias("score"),
        F.first("max_score").alias("max_score"), F.first("percentage").alias("percentage"),
        F.first("rating").alias("rating"), F.first("rating_description").alias("rating_description"),
        F.array_sort(F.collect_list(F.when(is_act, F.struct("tier", "slot", "key", "category", "priority", "text"))))
        .alias("actions"),
        F.max(F.when(~is_act, F.struct("key", "category", "priority", "text"))).alias("_opp"),
        *[F.first(x).alias(x) for x in (carry or [])])
    return out.select(
        *(carry or []), "id", "day", "greeting", "score", "max_score", "percentage", "rating", "rating_description", "actions",
        c("_opp.key").alias("opportunity_key"), c("_opp.category").alias("opportunity_category"),
        c("_opp.priority").alias("opportunity_priority"), c("_opp.text").alias("opportunity_text"),
        F.transform("actions", lambda a: a["key"]).alias("action_keys"),
        F.transform("actions", lambda a: a["text"]).alias("action_texts"))
