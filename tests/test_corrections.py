"""Rules that an oracle alone would not show: rows that exist, cuts that must not bite, odd inputs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from daybook import registry, session
from daybook.plans import assemble, daily, evalstats, features
from daybook.sources import writes
from daybook.sources.tables import load

BASE = "/root/testdata/sf0.01"


def test_medication_ladder_sees_every_step(spark):
    got = {r[0] for r in registry.QUERIES["category_points"](spark, BASE).select("medications_pts").distinct().collect()}
    assert {0, 1, 3, 5} <= set(got)


def test_missed_doses_are_in_the_denominator(spark):
    d = features.medication_state(spark, BASE)["daily"]
    r = d.agg(*[F.expr(f"count_if({x})") for x in ("doses_taken = 0", "doses_taken = 0 AND adherence_pct <> 0",
                                                   "adherence_pct > 100", "capped_taken > expected_total")]).first()
    assert r[0] > 0 and tuple(r)[1:] == (0, 0, 0)


def test_short_lookback_keeps_focus_and_every_id(spark):
    day = daily.last_event_day(spark, BASE)
    events = daily.pruned_events(spark, BASE, day, 5)
    ids = {r.id for r in events.select(F.col("user_id").alias("id")).distinct().collect()}
    cut = {r.id: r.user_focus for r in assemble.daily_wide(spark, BASE, events, day).select("id", "user_focus").collect()}
    full = {r.id: r.user_focus for r in features.focus_per_id(spark, BASE).select("id", "user_focus").collect()}
    assert set(cut) == ids
    assert all(cut[i] == full.get(i) for i in cut)


def test_report_day_has_every_id(spark):
    day = daily.last_event_day(spark, BASE)
    n = load(spark, BASE, "events", ["user_id"]).distinct().count()
    assert daily.report_day_result(spark, BASE, day).count() == n


def test_upsert_keeps_columns_of_either_side(spark):
    old = writes.with_audit(spark.createDataFrame([(1, "a", 7), (2, "b", 8)], "k int, v string, only_old int"), "2024-01-01")
    new = spark.createDataFrame([(2, "c", 1.5), (3, "d", 2.5)], "k int, v string, only_new double")
    got = {r.k: r for r in writes.upsert(old, new, ["k"], "2024-01-02").collect()}
    assert (got[1].v, got[1].only_old, got[1].only_new, got[1].overwrite_count) == ("a", 7, None, 0)
    assert (got[2].v, got[2].only_old, got[2].only_new, got[2].overwrite_count) == ("c", 8, 1.5, 1)
    assert (got[3].v, got[3].only_old, got[3].only_new, got[3].overwrite_count) == ("d", None, 2.5, 0)
    assert got[1].last_modified_at == got[3].last_modified_at - dt.timedelta(days=1)


@pytest.mark.parametrize("reply,verdict,reasoning", [
    ("The verdict was in their eyes.", "no", "Could not parse judge response."),
    ('x {"verdict" : "YES", "reasoning": "r", ', "yes", "r"),
    ('```json\n{"verdict": "no", "reasoning": "q"}\n```', "no", "q"),
    ("ERROR: late", "error", "Could not parse judge response."), ("", "no", "Could not parse judge response."),
])
def test_judge_replies(spark, reply, verdict, reasoning):
    df = spark.createDataFrame([(reply,)], "reply string")
    r = df.select(evalstats.parse_json_verdict(F.col("reply")), evalstats.parse_json_reasoning(F.col("reply"))).first()
    assert tuple(r) == (verdict, reasoning)


def test_scratch_folder_needs_a_local_master(monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = type("C", (), {"get": staticmethod(lambda k, d=None: d)})()
    with pytest.raises(ValueError):
        session.checkpoint_dir(Session())
