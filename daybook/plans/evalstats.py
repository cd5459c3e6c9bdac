"""Message-quality evaluation as DataFrame jobs (C15-C17, AG18-AG24, I8-I11).

Judge replies, verdicts and messages are tables; every statistic is a
groupBy over the long (case, criterion) form. Text checks run on whole
texts with built-in regex functions (JVM side, no Python UDF).

Inputs from the given tables:
  replies   labels x documents: one reply per (doc, criterion) for the
            criteria 'quality' (quality = 1) and 'safety' (toxic = 0), in four
            shapes by doc_id % 4: fenced JSON, bare JSON, free text with a
            verdict word, and an error string
  routes    documents.source; users: documents.lang
  messages  assistant turns of ``conversations``; sources: the turn before
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daybook.functions import constants as K
from daybook.sources.tables import load

c = F.col
CRITERIA = {"quality": "content", "safety": "tone"}


# ---------------------------------------------------------------------------
# I8 / I9 reply parsing
# ---------------------------------------------------------------------------

def judge_replies(spark: SparkSession, base: str) -> DataFrame:
    lab = load(spark, base, "labels", ["doc_id", "quality", "toxic"])
    docs = load(spark, base, "documents", ["doc_id", "source", "lang", "n_chars"])
    j = lab.join(docs, "doc_id")
    rows = j.select("doc_id", "source", "lang", "n_chars", F.explode(F.array(
        F.struct(F.lit("quality").alias("criterion"),
                 F.when(c("quality") == 1, "yes").otherwise("no").alias("truth")),
        F.struct(F.lit("safety").alias("criterion"),
                 F.when(c("toxic") == 0, "yes").otherwise("no").alias("truth")))).alias("r"))
    v = c("r.truth")
    shape = c("doc_id") % 6
    reply = (F.when(shape == 0, F.concat(F.lit('```json\n{"verdict": "'), v, F.lit('", "reasoning": "checked"}\n```')))
             .when(shape == 1, F.concat(F.lit('{"verdict": "'), v, F.lit('", "reasoning": "checked"}')))
             .when(shape == 2, F.concat(F.lit('Here it is: {"verdict" : "'), F.upper(v), F.lit('", "reasoning": "cut off", "x')))
             .when(shape == 3, F.concat(F.lit("After review the verdict is "), v, F.lit(".")))
             .when(shape == 4, F.lit("The verdict was in their eyes."))
             .otherwise(F.lit("ERROR: request timed out")))
    return rows.select("doc_id", "source", "lang", "n_chars", c("r.criterion").alias("criterion"),
                       reply.alias("reply"))


VERDICT_FALLBACK = r'(?i)"verdict"\s*:\s*"(yes|no)"'
REASONING_FALLBACK = r'"reasoning"\s*:\s*"([^"]+)"'
WORD_EDGE = r"[^\p{L}\p{N}_]"


def parse_json_verdict(reply: Column) -> Column:
    """I8: strip code fences, read $.verdict, else a regex fallback; error replies
    give 'error'; anything else defaults to 'no'."""
    stripped = F.trim(F.regexp_replace(reply, r"```(json)?", ""))
    from_json = F.lower(F.get_json_object(stripped, "$.verdict"))
    fallback = F.lower(F.regexp_extract(reply, VERDICT_FALLBACK, 1))
    return (F.when(reply.startswith("ERROR"), F.lit("error"))
            .when(from_json.isin("yes", "no"), from_json)
            .when(fallback != "", fallback).otherwise(F.lit("no")))


def parse_json_reasoning(reply: Column) -> Column:
    """I8: $.reasoning, else a regex fallback, else a fixed note."""
    stripped = F.trim(F.regexp_replace(reply, r"```(json)?", ""))
    return F.coalesce(F.get_json_object(stripped, "$.reasoning"),
                      F.nullif(F.regexp_extract(reply, REASONING_FALLBACK, 1), F.lit("")),
                      F.lit("Could not parse judge response."))


def verdicts(spark: SparkSession, base: str) -> DataFrame:
    r = judge_replies(spark, base)
    v = parse_json_verdict(c("reply"))
    crit_cat = F.create_map(*[F.lit(x) for kv in CRITERIA.items() for x in kv])
    return r.select("doc_id", "source", "lang", "n_chars", "criterion",
                    crit_cat[c("criterion")].alias("category"), v.alias("verdict"),
                    parse_json_reasoning(c("reply")).alias("reasoning"),
                    (v == "yes").alias("passed"))


def tagged_replies(spark: SparkSession, base: str) -> DataFrame:
    """I9: 'ASSESSMENT:' / 'RATIONALE:' lines; a line that says yes is yes, all else and no line is no.

    The fixture leaves the lines out of some replies and words others freely.
    """
    lab = load(spark, base, "labels", ["doc_id", "quality"])
    shape = c("doc_id") % 5
    txt = F.concat(F.lit("Review of case "), c("doc_id").cast("string"),
                   F.when(shape == 0, "").when(shape == 1, "\nASSESSMENT: unclear")
                   .otherwise(F.concat(F.lit("\nASSESSMENT: "), F.when(c("quality") == 1, "Yes, it does").otherwise("NO"))),
                   F.when(shape == 2, "").otherwise(F.concat(F.lit("\nRATIONALE: quality label "), c("quality").cast("string"))))
    said = F.lower(F.regexp_extract("reply", r"(?m)^ASSESSMENT:(.*)$", 1))
    return lab.select("doc_id", txt.alias("reply")).select(
        "doc_id",
        F.when(said.contains("yes"), "yes").otherwise("no").alias("assessment"),
        F.when(c("reply").rlike(r"(?m)^RATIONALE:"), F.trim(F.regexp_extract("reply", r"(?m)^RATIONALE:(.*)$", 1)))
        .otherwise(F.lit("No rationale provided")).alias("rationale"))


# ---------------------------------------------------------------------------
# AG18-AG24 statistics
# ---------------------------------------------------------------------------

def band_label(rate: Column) -> Column:
    """AG22: >= 0.8 pass, < 0.5 fail, else warn."""
    hi, lo = K.PASS_BAND
    return F.when(rate >= hi, "pass").when(rate < lo, "fail").otherwise("warn")


def pass_rates(v: DataFrame) -> DataFrame:
    """AG18 + AG22 + F4: per criterion counts, rate, band, weak/strong flags."""
    out = v.groupBy("criterion", "category").agg(
        F.count("*").alias("total"), F.count_if("passed").alias("passed"))
    rate = c("passed") / c("total")
    return out.select("criterion", "category", "total", "passed", rate.alias("pass_rate"),
                      band_label(rate).alias("band"),
                      (rate < K.WEAK_CRITERION_RATE).alias("weak"),
                      (rate >= K.STRONG_CRITERION_RATE).alias("strong"))


def weak_criteria(v: DataFrame) -> DataFrame:
    """criteria below the weak rate, the lowest first (a fixed list of criteria, so one window)."""
    place = F.row_number().over(Window.orderBy("pass_rate", "criterion"))
    return pass_rates(v).filter("weak").select(place.alias("place"), "criterion", "category", "pass_rate")


#: AG18 AG20: name of each level and what it groups by.
RATE_LEVELS = {"overall": (), "criterion": ("criterion",), "category": ("category",), "case": ("doc_id",), "route": ("source",),
               "user": ("lang",), "user_route": ("lang", "source")}
RATE_KEYS = ["criterion", "category", "doc_id", "source", "lang"]


def rate_levels(v: DataFrame) -> DataFrame:
    """AG18 AG20: rates at every level by GROUPING SETS: one aggregate, combined before its one exchange.

    A case is judged on every criterion, so ``cases`` counts the rows of the
    first criterion (of the category's first one at that level).
    """
    first_of = {cat: min(k for k, x in CRITERIA.items() if x == cat) for cat in CRITERIA.values()}
    marked = v.select(*RATE_KEYS, c("passed").cast("int").alias("p"),
                      (c("criterion") == min(CRITERIA)).cast("int").alias("case"),
                      c("criterion").isin(*first_of.values()).cast("int").alias("case_of_category"))
    sets = [[c(k) for k in by] for by in RATE_LEVELS.values()]
    out = marked.groupingSets(sets, *[c(k) for k in RATE_KEYS]).agg(
        F.grouping_id(*RATE_KEYS).alias("gid"), F.count("*").alias("total"), F.sum("p").alias("passed"),
        F.sum("case").alias("by_case"), F.sum("case_of_category").alias("by_category"))
    n, level = len(RATE_KEYS), None
    for name, by in RATE_LEVELS.items():
        gid = sum(1 << (n - 1 - i) for i, k in enumerate(RATE_KEYS) if k not in by)
        level = F.when(c("gid") == gid, name) if level is None else level.when(c("gid") == gid, name)
    cases = F.when(c("level") == "criterion", c("total")).when(c("level") == "category", c("by_category")).otherwise(c("by_case"))
    return out.withColumn("level", level).select("level", *RATE_KEYS, "total", "passed", cases.alias("cases"),
                                                 (c("passed") / c("total")).alias("pass_rate"))


def category_rates(v: DataFrame) -> DataFrame:
    """AG18: category score = mean of its criterion rates."""
    per = v.groupBy("category", "criterion").agg(F.avg(F.col("passed").cast("int")).alias("rate"))
    return per.groupBy("category").agg(F.avg("rate").alias("category_rate"), F.count("*").alias("n_criteria"))


def group_rates(v: DataFrame, by: str) -> DataFrame:
    """AG20: pass rate by a grouping column (route or user)."""
    out = v.groupBy(by).agg(F.count("*").alias("total"), F.count_if("passed").alias("passed"),
                            F.count_distinct("doc_id").alias("cases"))
    return out.withColumn("pass_rate", c("passed") / c("total"))


def bot_summary(v: DataFrame) -> DataFrame:
    """AG21 (D17): per user: cases, with/without chart, summed passes over summed totals, the
    mean rate of a case, and the summed passes over totals of each category's criteria."""
    groups = list(dict.fromkeys(CRITERIA.values()))
    of = {g: c("category") == g for g in groups}
    case = v.groupBy("lang", "doc_id").agg(
        F.count("*").alias("n"), F.count_if("passed").alias("p"), F.max(c("n_chars") > 5000).alias("chart"),
        *[F.count_if(of[g]).alias(f"n_{g}") for g in groups], *[F.count_if(of[g] & c("passed")).alias(f"p_{g}") for g in groups])
    return case.groupBy("lang").agg(
        F.count("*").alias("cases"), F.count_if("chart").alias("with_chart"),
        F.count_if(~c("chart")).alias("without_chart"),
        (F.sum("p") / F.sum("n")).alias("micro_rate"),
        F.avg(c("p") / c("n")).alias("mean_case_rate"),
        *[F.try_divide(F.sum(f"p_{g}"), F.sum(f"n_{g}")).alias(f"{g}_rate") for g in groups])


def failures(v: DataFrame) -> DataFrame:
    """AG19: failed (case, criterion) pairs, excluding judge errors."""
    return v.filter(~c("passed") & (c("verdict") != "error")).select("criterion", "doc_id", "source", "verdict")


def verdict_pivot(v: DataFrame) -> DataFrame:
    """AG23: one column per criterion (values listed: no extra pass to find them)."""
    return v.groupBy("doc_id").pivot("criterion", list(CRITERIA)).agg(F.first("verdict"))


# ---------------------------------------------------------------------------
# C15-C17 label handling
# ---------------------------------------------------------------------------

CANONICAL = list(K.FOCUS_ID_MAPPING.values())


def noisy_labels(spark: SparkSession, base: str) -> DataFrame:
    d = load(spark, base, "documents", ["doc_id", "source"])
    canon = F.element_at(F.array(*[F.lit(x) for x in CANONICAL]), (c("doc_id") % len(CANONICAL) + 1).cast("int"))
    shape = c("doc_id") % 4
    raw = (F.when(shape == 0, canon)
           .when(shape == 1, F.concat(F.lower(canon), F.lit(" focus area of the user")))
           .when(shape == 2, F.upper(F.substring(canon, 1, 4)))
           .otherwise(F.concat(F.lit("unknown-"), c("source"))))
    return d.select("doc_id", raw.alias("raw_label"))


def normalise_label(raw: Column, canonical: list[str] = CANONICAL, width: int = 20,
                    fallback: str = "Other") -> Column:
    """Exact match, else case-insensitive prefix match (either way, first
    ``width`` chars) in list order, else fallback. Array functions over the
    fixed list: no join."""
    lst = F.array(*[F.lit(x) for x in canonical])
    exact = F.filter(lst, lambda x: x == raw)
    r = F.lower(F.substring(raw, 1, width))
    pref = F.filter(lst, lambda x: F.lower(F.substring(x, 1, width)).startswith(r)
                    | r.startswith(F.lower(F.substring(x, 1, width))))
    return F.coalesce(F.try_element_at(exact, F.lit(1)), F.try_element_at(pref, F.lit(1)), F.lit(fallback))


PREFIX_CLASSES = [("the ", "en_article"), ("th", "en_th"), ("le ", "fr_article"), ("la ", "fr_article"),
                  ("el ", "es_article"), ("der ", "de_article"), ("die ", "de_article"), ("das ", "de_article")]


def prefix_class(text: Column, rules: list[tuple[str, str]] = PREFIX_CLASSES, default: str = "other") -> Column:
    """Ordered prefix classification (listed order, first match wins)."""
    t = F.lower(F.ltrim(text))
    out = None
    for p, lab in rules:
        out = F.when(t.startswith(p), lab) if out is None else out.when(t.startswith(p), lab)
    return out.otherwise(default)


LANG_NAMES = {"en": "English", "fr": "French", "de": "German", "es": "Spanish"}
SOURCE_NAMES = {"src0": "primary", "src1": "secondary"}


# ---------------------------------------------------------------------------
# I10 / I11 text checks
# ---------------------------------------------------------------------------

def _words(text: Column) -> Column:
    t = F.trim(F.regexp_replace(text, r"\s+", " "))
    return F.when(t == "", 0).otherwise(F.size(F.split(t, " ")))


def text_checks(texts: DataFrame, text_col: str = "text") -> DataFrame:
    """Measurable guideline checks in one projection."""
    t = c(text_col)
    lo = F.lower(t)
    words = _words(t)
    sentences = F.filter(F.split(t, r"[.!?]+"), lambda s: F.trim(F.regexp_replace(s, r"\s+", " ")) != "")
    max_sent = F.coalesce(F.array_max(F.transform(sentences, lambda s: _words(s))), F.lit(0))
    n_sent = F.greatest(F.size(F.regexp_extract_all(t, F.lit(r"[.!?]+"), 0)), F.lit(1))
    syll = F.size(F.regexp_extract_all(lo, F.lit(r"[aeiouy]+"), 0))
    fk = F.when(words > 0, F.lit(0.39) * (words / n_sent) + F.lit(11.8) * (syll / words) - F.lit(15.59))
    banned = "(^|" + WORD_EDGE + ")(" + "|".join(K.BANNED_TERMS) + ")(" + WORD_EDGE + "|$)"
    return texts.withColumns({
        "words": words,
        "words_ok": words.between(*K.WORDS_RANGE),
        "exclamations": F.size(F.regexp_extract_all(t, F.lit("!"), 0)),
        "max_sentence_words": max_sent,
        "banned_term": lo.rlike(banned),
        "healthcare_one_word": lo.contains("healthcare"),
        "double_space": t.contains("  "),
        "starts_now": t.rlike(r"(^|[.!?]\s+)Now(" + WORD_EDGE + "|$)"),
        "markdown": t.rlike(r"(?m)(\*\*|^#{1,6}\s)"),
        "bullets": t.rlike(r"(?m)^\s*([-*]|[0-9]+\.)\s"),
        "multi_paragraph": t.rlike(r"\n\s*\n"),
        "semicolon": t.contains(";"),
        "ellipsis": t.contains("...") | t.contains("…"),
        "dashes": t.contains("—") | t.contains("–") | t.contains(" - "),
        "fk_grade": fk,
    }).withColumn(
        "passed_all",
        c("words_ok") & (c("exclamations") <= K.MAX_EXCLAMATIONS) & (c("max_sentence_words") <= K.MAX_SENTENCE_WORDS)
        & ~c("banned_term") & ~c("healthcare_one_word") & ~c("double_space") & ~c("starts_now") & ~c("markdown")
        & ~c("bullets") & ~c("multi_paragraph") & ~c("semicolon") & ~c("ellipsis") & ~c("dashes")
        & F.coalesce(c("fk_grade").between(*K.FK_GRADE_RANGE), F.lit(False)))


def numbers(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.regexp_replace(text, ",", ""), F.lit(r"[0-9]+(\.[0-9]+)?"), 0))


def number_grounding(spark: SparkSession, base: str) -> DataFrame:
    """Every number in an assistant turn must appear in the turn before it."""
    conv = load(spark, base, "conversations", ["conv_id", "turn", "role", "text"])
    msg = conv.filter(c("role") == "assistant").select("conv_id", "turn", c("text").alias("msg"))
    src = conv.select("conv_id", (c("turn") + 1).alias("turn"), c("text").alias("src"))
    j = msg.join(src, ["conv_id", "turn"], "left")
    m, s = numbers(c("msg")), numbers(F.coalesce(c("src"), F.lit("")))
    missing = F.array_except(m, s)
    return j.select("conv_id", "turn", F.size(m).alias("n_numbers"), F.size(missing).alias("n_missing"),
                    (F.size(missing) == 0).alias("grounded"))


#: Words after which a change between two values is told.
CHANGE_WORDS = ["went up", "went down", "rose", "fell", "increased", "decreased", "improved", "dropped", "up", "down"]
_NUMBER = r"[0-9]+(?:\.[0-9]+)?"


def sentences(text: Column) -> Column:
    """Sentences of a text; a point inside a number ends none."""
    return F.split(text, r"[.!?]+(?:\s+|$)")


def change_checks(text: Column) -> dict[str, Column]:
    """Sentences that tell a change in numbers, and those of them that lack the starting or the ending value.

    The change word binds the pair that follows it: ``from a to b`` with no
    other number before it. A difference alone is no pair.
    """
    word = r"(?i)\b(?:" + "|".join(CHANGE_WORDS) + r")\b"
    told = F.filter(sentences(text), lambda s: s.rlike(word + r".*[0-9]"))
    paired = F.filter(told, lambda s: s.rlike(word + rf"[^0-9]*\bfrom {_NUMBER}%? to {_NUMBER}"))
    return {"changes": F.size(told), "unpaired_changes": F.size(told) - F.size(paired)}


def grounding_checks(text: Column, source: Column) -> dict[str, Column]:
    """Numbers of a text and those of them that the source lacks (thousands commas ignored)."""
    found = numbers(text)
    return {"n_numbers": F.size(found), "n_missing": F.size(F.array_except(found, numbers(source)))}


def rating_checks(text: Column, percentage: Column) -> dict[str, Column]:
    """The rating labels that a text names, and whether the score gives no other.

    A label counts where it stands with its capital letter as a word of its own.
    """
    names = F.array(*[F.lit(name) for name, _, _ in K.TIERS])
    named = F.filter(names, lambda n: F.regexp_like(text, F.concat(F.lit(r"\b"), n, F.lit(r"\b"))))
    due = F.coalesce(*[F.when(percentage >= low, F.lit(name)) for name, _, low in K.TIERS])
    return {"labels_named": F.array_join(named, ","), "label_fits": F.forall(named, lambda n: F.coalesce(n == due, F.lit(False)))}


def sent_messages(result: DataFrame) -> DataFrame:
    """The daily messages as a remote writer might send them back: some as they are, some with
    digits exchanged, a starting value left out or a rating label put in (by id and day)."""
    text, shape = c("message_text"), (c("id") + F.dayofmonth("day")) % 5
    sent = (F.when(shape == 1, F.regexp_replace(text, "([0-9])([0-9])", "$2$1"))
            .when(shape == 2, F.regexp_replace(text, r"from [0-9.]+% to", "to"))
            .when(shape == 3, F.concat(text, F.lit(". You are Strong today!")))
            .when(shape == 4, F.concat(text, F.lit(". Your rating is "), c("rating"), F.lit("."))).otherwise(text))
    return result.withColumn("sent", sent)


def message_checks(result: DataFrame) -> DataFrame:
    """I10 I11 on sent messages against the facts and the score of their day."""
    facts = F.concat_ws(" ", c("action_texts"), c("opportunity_text"))
    checks = change_checks(c("sent")) | grounding_checks(c("sent"), facts) | rating_checks(c("sent"), c("percentage"))
    out = result.select("id", "day", "rating", *[v.alias(k) for k, v in checks.items()])
    return out.withColumn("accurate", (c("unpaired_changes") == 0) & (c("n_missing") == 0) & c("label_fits"))
