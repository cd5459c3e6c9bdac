"""Selection windows vs a greedy model of the reference's loop (random cases)."""

import random

from pyspark.sql import functions as F

from daybook.plans import select


def greedy(rows, k=2):
    """rows: (key, category, priority, jitter, journey_forced, tir_ok)."""
    journey = [r for r in rows if r[0] == "journey_task_completed" and r[4]]
    pool = sorted([r for r in rows if r not in journey], key=lambda r: (-r[2], r[3]))
    picked = list(journey)
    if rows and rows[0][5]:
        g = [r for r in pool if r[1] == "glucose"]
        if g:
            picked.append(g[0])
            pool = [r for r in pool if r[1] != "glucose"]
    used = {r[1] for r in picked}
    for r in pool:
        if len(picked) >= k:
            break
        if r[1] not in used:
            picked.append(r)
            used.add(r[1])
    for r in pool:
        if len(picked) >= k:
            break
        if r not in picked:
            picked.append(r)
    return sorted(r[0] for r in picked)


def test_select_actions_matches_greedy(spark):
    rnd = random.Random(3)
    cats = ["glucose", "sleep", "food", "activity"]
    rows, cases = [], {}
    for case in range(300):
        tir_ok = rnd.random() < 0.5
        jf = rnd.random() < 0.3
        items = []
        for i in range(rnd.randint(1, 6)):
            cat = rnd.choice(cats)
            items.append((f"{cat}_{i}", cat, rnd.randint(0, 5) * 10, f"{rnd.random():.6f}", jf, tir_ok))
        if jf:
            items.append(("journey_task_completed", "journey", 400, "0", True, tir_ok))
        cases[case] = items
        for key, cat, prio, jit, _, _ in items:
            g_rank_tier = 2
            rows.append((case, key, cat, prio, jit, tir_ok, key == "journey_task_completed"))
    df = spark.createDataFrame(rows, "id long, key string, category string, priority int, jitter string, "
                                     "tir_ok boolean, is_journey boolean").withColumn("day", F.lit("2024-01-01").cast("date"))
    from pyspark.sql.window import Window
    pool = df.filter(~F.col("is_journey"))
    g_rank = F.row_number().over(Window.partitionBy("id", "day", "category").orderBy(F.col("priority").desc(), "jitter"))
    pool = pool.withColumn("_g", g_rank).withColumn(
        "tier", F.when(F.col("tir_ok") & (F.col("category") == "glucose") & (F.col("_g") == 1), 1).otherwise(2))
    pool = pool.withColumn("_f", F.max(F.when(F.col("tier") == 1, 1).otherwise(0)).over(Window.partitionBy("id", "day")))
    pool = pool.filter(~((F.col("category") == "glucose") & (F.col("tier") == 2) & (F.col("_f") == 1))).drop("_g", "_f")
    ranked = pool.unionByName(df.filter("is_journey").withColumn("tier", F.lit(0))).withColumn("kind", F.lit("action"))
    got = {}
    for r in select.select_actions(ranked).collect():
        got.setdefault(r.id, []).append(r.key)
    for case, items in cases.items():
        assert sorted(got.get(case, [])) == greedy(items), case
