"""Mixing sources to target word counts by pivotal dependent rounding.

Targets: sources in code point order (null last) weigh 3, 1, 2, repeating, and
share 150 % of all words; a target stops at twice its source's words and the
excess goes to the others by weight until none is above.

A source's factor target / words gives each of its documents floor(factor)
copies for sure and one more with the fractional probability p. Pairs of
documents exchange expected words (size times p): one of the two, drawn so that
both keep their expected value, becomes 0 or 1, the other carries the rest on.
A pair's expected words stay the same to the last bit of arithmetic, so a
source misses its target by less than the one document left at the end.

The pairing is a reduction tree: documents are dealt by hash to blocks of
about BLOCK, a block is worked off in one row, large documents first, and its
one undecided document goes to the next level. A source with a third of all
rows is many blocks on many tasks. Random numbers are hashes of the pair and
the level: reruns agree.

Only DataFrame functions. Null text counts as size 0; documents of size 0 take
no words; rows repeated in full are counted and dealt like any others. The
distinct sources, not the documents, pass through one window task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, n_words, saved, text_key, unit_hash

WEIGHTS = (3, 1, 2)
TOTAL_SHARE = 1.5
MAX_REPEAT = 2.0
BLOCK = 64


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = TOTAL_SHARE,
                   most: float = MAX_REPEAT) -> DataFrame:
    """source, source_size, docs, target from rows (source, size, n).

    The level at which uncapped sources share by weight follows from the
    sources in order of cap / weight: those below it are at their caps.
    """
    per = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"),
                                      F.sum("n").alias("docs"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    per = per.withColumn("w", weight).withColumn("cap", most * F.col("source_size"))
    order = Window.orderBy(F.col("cap") / F.col("w"), "w", F.col("source").asc_nulls_last())
    upto = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy(F.lit(1))
    per = per.withColumn("total", share * F.sum("source_size").over(every))
    level = (F.col("total") - F.coalesce(F.sum("cap").over(upto), F.lit(0.0))) / F.sum("w").over(rest)
    per = per.withColumn("level", level).withColumn("capped", F.col("level") * F.col("w") >= F.col("cap"))
    shared = F.min(F.when(~F.col("capped"), F.struct(F.col("cap") / F.col("w"), "level"))).over(every)["level"]
    return per.select("source", "source_size", "docs",
                      F.when(F.col("capped"), F.col("cap")).otherwise(F.least(shared * F.col("w"), F.col("cap")))
                      .alias("target"))


def _step(level: int, seed: int):
    """One exchange: the carried document and the next one become one decision and one carry."""

    def step(acc, x):
        c = acc["carry"]
        a, p, b, q = c["size"], c["p"], x["size"], x["p"]
        words = a * p + b * q
        to_c, to_x = b * q >= a * (1 - p), a * p >= b * (1 - q)  # the receiver gets full
        p1 = F.when(to_c, F.lit(1.0)).otherwise(words / a)
        q1 = F.when(to_c, (words - a) / b).otherwise(F.lit(0.0))
        q2 = F.when(to_x, F.lit(1.0)).otherwise(words / b)
        p2 = F.when(to_x, (words - b) / a).otherwise(F.lit(0.0))
        chance = F.when(p1 > p2, (p - p2) / (p1 - p2)).otherwise(F.lit(1.0))
        first = unit_hash(c["doc_id"], c["key"], c["nth"], x["doc_id"], x["key"], x["nth"], F.lit(level), F.lit(seed)) < chance

        def row(r, prob):
            return F.struct(r["size"].alias("size"), r["doc_id"].alias("doc_id"), r["key"].alias("key"),
                            r["nth"].alias("nth"), prob.alias("p"))

        c_done = (first & to_c) | (~first & ~to_x)
        done = F.when(c_done, row(c, F.when(first, F.lit(1.0)).otherwise(F.lit(0.0)))).otherwise(
            row(x, F.when(first, F.lit(0.0)).otherwise(F.lit(1.0))))
        carry = F.when(c_done, row(x, F.when(first, q1).otherwise(q2))).otherwise(
            row(c, F.when(first, p1).otherwise(p2)))
        return F.struct(carry.alias("carry"), F.concat(acc["done"], F.array(done)).alias("done"))

    return step


def pivotal(units: DataFrame, seed: int = 8, block: int = BLOCK) -> DataFrame:
    """(source, doc_id, key, nth, size, up): 0 or 1 for each unit with 0 < p < 1 and size > 0.

    units: source, docs (rows of the source), doc_id, key, nth, size double, p.
    """
    unit = "struct<size:double,doc_id:bigint,key:bigint,nth:bigint,p:double>"
    most = units.agg(F.max("docs")).first()[0] or 0
    now = units.withColumn("blocks", F.greatest(F.ceil(F.col("docs") / block), F.lit(1)))
    decided, level = None, 0
    while True:
        rows = F.array_sort(F.collect_list(F.struct((-F.col("size")).alias("order"), unit_hash(
            "doc_id", "key", "nth", F.lit(seed)).alias("tie"), F.struct("size", "doc_id", "key", "nth", "p").alias("u"))))
        step = now.groupBy("source", "blocks", F.pmod(F.xxhash64("doc_id", "key", "nth", F.lit(level + seed * 64)),
                                                      F.col("blocks")).alias("block")).agg(rows.alias("rows"))
        step = step.select("source", "blocks", F.transform("rows", lambda r: r["u"]).alias("rows")).select(
            "source", "blocks", F.aggregate(
                F.slice("rows", 2, F.size("rows")),
                F.struct(F.element_at("rows", 1).cast(unit).alias("carry"),
                         F.array().cast(f"array<{unit}>").alias("done")), _step(level, seed)).alias("r"))
        step = saved(step, "mix-level")
        done = step.select("source", F.explode("r.done").alias("d")).select("source", "d.*")
        decided = done if decided is None else decided.union(done)
        left = step.select("source", "blocks", "r.carry.*")
        last = left.filter("blocks = 1")
        decided = decided.union(last.withColumn("p", F.when(unit_hash(
            "doc_id", "key", "nth", F.lit(seed + 1)) < F.col("p"), F.lit(1.0)).otherwise(F.lit(0.0)))
            .select("source", "size", "doc_id", "key", "nth", "p"))
        most = -(-most // block)
        if most <= 1:
            break
        now = left.filter("blocks > 1").withColumn("blocks", F.ceil(F.col("blocks") / block))
        level += 1
    return decided.select("source", "doc_id", "key", "nth", "size", F.col("p").cast("int").alias("up"))


def mixed(docs: DataFrame, seed: int = 8) -> DataFrame:
    """doc_id, key, source, size, source_size, target, copies, taken: one row per row of docs.

    docs needs doc_id, text and source. copies is 0, 1 or 2; taken = copies * size.
    """
    units = saved(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("key"), "source",
                              n_words().alias("size"))
                  .groupBy("doc_id", "key", "source", "size").agg(F.count("*").alias("n")), "mix-units")
    targets = saved(source_targets(units), "mix-targets")
    rows = units.alias("u").join(targets.alias("t"), F.col("u.source").eqNullSafe(F.col("t.source"))).select(
        "doc_id", "key", "u.source", "size", "source_size", "docs", "target",
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)).alias("factor"),
        F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("nth"))
    rows = rows.withColumn("base", F.floor("factor")).withColumn("p", F.col("factor") - F.col("base"))
    draws = (F.col("p") > 0) & (F.col("size") > 0)
    sure = rows.filter(~draws).select("doc_id", "key", "source", "size", F.lit(0).alias("up"))
    drawn = pivotal(rows.filter(draws).withColumn("size", F.col("size").cast("double")), seed)
    out = sure.union(drawn.select("doc_id", "key", "source", F.col("size").cast("long").alias("size"), "up"))
    factor = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    return (out.alias("o").join(targets.alias("t"), F.col("o.source").eqNullSafe(F.col("t.source")))
            .withColumn("copies", (factor + F.col("up")).cast("int"))
            .select("doc_id", "key", "o.source", "size", "source_size", "target", "copies",
                    (F.col("copies") * F.col("size")).cast("long").alias("taken")))


def resampled(docs: DataFrame, seed: int = 8) -> DataFrame:
    """docs with each row as often as the mix takes it (0, 1 or 2 times); same columns.

    Rows of one doc_id, text and source are one row taken as often as all of them together.
    """
    own, times, nth = (fresh(docs, c) for c in ("_mix_own", "_mix_times", "_mix_nth"))
    copies = mixed(docs, seed).groupBy("doc_id", "key", "source").agg(F.sum("copies").alias(times)).filter(F.col(times) > 0)
    keyed = docs.withColumn(own, text_key()).dropDuplicates(["doc_id", own, "source"])
    joined = keyed.join(copies, keyed["doc_id"].cast("long").eqNullSafe(copies["doc_id"])
                        & (keyed[own] == copies["key"]) & keyed["source"].eqNullSafe(copies["source"])).select(
        *[keyed[f"`{c}`"] for c in docs.columns], copies[times])
    return joined.withColumn(nth, F.explode(F.sequence(F.lit(1).cast("long"), F.col(times)))).select(
        *[F.col(f"`{c}`") for c in docs.columns])
