"""Message text assembly (I2 I3 I5 I6 I7) as string expressions.

The remote text-generation call is not part of this library; the prompt
column is its input and the rendered bullet text its deterministic stand-in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions import constants as K

c = F.col


def weekly_context(df: DataFrame) -> Column:
    """Lines where yesterday and the 7-day view disagree, for the picked opportunity only."""
    key, category = c("opportunity_key"), c("opportunity_category")

    def about(name):
        return F.coalesce((category == name) | key.startswith(f"{name}_"), F.lit(False))

    def one(x):
        return F.bround(x, 1).cast("string")
    lines = [
        F.when(about("sleep") & (c("sleep_hours") >= K.SLEEP_HOURS_TARGET) & (c("sleep_avg_7d") < K.SLEEP_HOURS_TARGET),
               F.concat(F.lit("- Yesterday's sleep: "), one("sleep_hours"), F.lit("h. 7-day average: "),
                        one("sleep_avg_7d"), F.lit("h (below 7h target)."))),
        F.when(about("sleep") & (c("sleep_rating") >= K.SLEEP_RATING_TARGET)
               & (c("sleep_rating_avg_7d") < K.SLEEP_RATING_TARGET),
               F.concat(F.lit("- Yesterday's sleep rating: "), c("sleep_rating").cast("int").cast("string"),
                        F.lit("/10. 7-day average rating: "), one("sleep_rating_avg_7d"), F.lit("/10 (below 7 target)."))),
        F.when(about("activity") & (c("active_minutes") >= 20)
               & (c("weekly_active_minutes") < K.ACTIVITY_WEEKLY_TARGET_MINUTES),
               F.concat(F.lit("- Yesterday's active minutes: "), c("active_minutes").cast("int").cast("string"),
                        F.lit(". Weekly total is below the recommended level. Encourage more activity today."))),
        F.when((key == "medication_reminders") & c("took_all_meds") & c("med_adherence_7d_avg").isNotNull(),
               F.concat(F.lit("- Yesterday: took all meds. 7-day adherence average: "),
                        F.bround("med_adherence_7d_avg", 0).cast("int").cast("string"), F.lit("% (below 50% threshold)."))),
    ]
    return F.concat_ws("\n", *lines)


def prompt_text(actions_text: Column, opportunity_text: Column, greeting: Column, context: Column) -> Column:
    """Bullet list + opportunity + greeting into the prompt template, with its defaults."""
    bullets = F.array_join(F.transform(actions_text, lambda t: F.concat(F.lit("- "), t)), "\n")
    bullets = F.when(F.coalesce(F.size(actions_text), F.lit(0)) > 0, bullets).otherwise(F.lit(K.NO_ACTIONS_FACT))
    block = F.when(F.coalesce(context, F.lit("")) != "", F.concat(F.lit(K.WEEKLY_CONTEXT_HEADING), context))
    out = F.lit(K.USER_PROMPT_TEMPLATE)
    for name, val in (("{greeting}", greeting), ("{positive_facts_list}", bullets),
                      ("{opportunity_suggestion}", F.coalesce(opportunity_text, F.lit(K.NO_OPPORTUNITY_TEXT))),
                      ("{weekly_context}", block)):
        out = F.replace(out, F.lit(name), F.coalesce(val, F.lit("")))
    return out


def message_text(greeting: Column, actions_text: Column, opportunity_text: Column) -> Column:
    """Deterministic message from the picked texts; greeting and fallback text when nothing was picked."""
    body = F.concat_ws(" ", F.array_join(actions_text, ". "), opportunity_text)
    return F.concat_ws(" ", greeting, F.when(F.length(F.trim(body)) > 0, body).otherwise(F.lit(K.FALLBACK_MESSAGE)))


def word_count(text) -> Column:
    """words = whitespace-separated tokens; empty text -> 0."""
    t = F.trim(F.regexp_replace(text, r"\s+", " "))
    return F.when(t == "", 0).otherwise(F.size(F.split(t, " ")))


def char_count(text) -> Column:
    return F.length(text)


def context_json(df: DataFrame, keys: list[str]) -> Column:
    """JSON of the listed fields in order; NULL fields are dropped."""
    return F.to_json(F.struct(*[c(k) for k in keys]))
