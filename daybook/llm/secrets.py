"""Secret scans: a random forest over candidate findings.

Candidates, in whole texts:

- the value assigned to a credential name (``token = ...``, ``"API_KEY": "..."``,
  ``Authorization: Bearer ...``), of any length and any signs, in quotes up to
  the closing quote of the line, else up to white space or a bracket;
- the password of credentials in an address (``scheme://user:password@host``);
- any other run of 16 or more letters, digits and the signs of base64 and
  identifiers, with dotted parts of 8 or more (as in web tokens) and ``=`` only
  as padding at its end.

Features: length, shares of digits, capitals and signs, number of different
characters, transitions between character classes, whether it is all hex,
coverage by dictionary words, path hints, and what the neighbouring words say
(a credential name before it, an assignment, an address, quotes, a placeholder
or example near it).

The dictionary is a table of all words that make up DICTIONARY_SHARE of the
words of all texts (and occur DICTIONARY_COUNT times), whatever their number.
The words of candidates meet it in a join whose keys are salted, so that no
frequent word falls to one task. The forest is trained on labelled findings
(doc_id, nth, label), at most about TRAIN_FINDINGS of them (a documented bound,
by hash). ``rule_labels`` makes such labels where nobody has, only for findings
that are clear; the forest judges all others by what those share.

Only DataFrame functions and Spark's own forest. Null and empty texts have no
candidates; a NUL sign in a text counts as a space; null paths give no hint;
rows repeated in full give repeated findings; columns other than doc_id, path
and text play no part, whatever their names; an empty table gives an empty
result. Equal scores need no order: every finding is returned, masked: at most
four first characters (fewer of short ones), length and a digest.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved

#: Words of credential names, placeholders and test paths (fixed values).
NAME = (r"(?i:token|secret|passw(?:or)?d|passphrase|pwd|api[_-]?key|access[_-]?key|private[_-]?key|auth(?:orization)?"
        r"|credential|bearer)s?(?![a-z])")
PLACEHOLDER = r"(?i)example|dummy|placeholder|changeme|your[_-]|xxxx|sample|fake|test"
TEST_PATH = r"(?i)(^|/)(tests?|examples?|fixtures?|samples?|mocks?|docs?)(/|_|$)"

#: Every repetition is bounded or possessive: linear in the text, and no recursion.
_ASSIGNED = (r"(?<![\w-])[\w-]{0,64}?" + NAME + r"[\w-]{0,32}+[\"']?\s{0,8}(?:=>|:=|={1,3}|:)\s{0,8}[\"']?"
             r"(?:(?i:bearer|basic)\s{1,4}+)?")
_BEARER = r"(?<![\w-])(?i:bearer)\s{1,4}+"
_VALUE = r"(?<=[\"'])[^\"'\r\n]++(?=[\"'])|[^\s\"'<>,;(){}\[\]]++"
_ADDRESS = r"://[^\s:/@]{1,64}:"
_RUN = r"[A-Za-z0-9_+/-]{16,}+(?:\.[A-Za-z0-9_+/-]{8,}+)*+(?:={1,2}(?![A-Za-z0-9_+/=\"'-]))?"
CANDIDATE = rf"({_ASSIGNED}|{_BEARER}(?=\S{{8}}))({_VALUE})|({_ADDRESS})([^\s/@]++)(?=@)|(?<![A-Za-z0-9_+/-])({_RUN})"

NEIGHBOUR_CHARS = 120
DICTIONARY_SHARE = 2e-6
DICTIONARY_COUNT = 5
SALTS = 16
TRAIN_FINDINGS = 20_000
TREES, DEPTH, SEED = 24, 6, 10

FEATURES = ("length", "digits", "capitals", "signs", "distinct", "transitions", "hex", "covered", "named", "assigned",
            "address", "quoted", "placeholder", "test_path", "line_end")


def dictionary(docs: DataFrame) -> DataFrame:
    """word of every word of 3 to 24 letters that is frequent in all texts."""
    words = docs.select(F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("word")).filter("length(word) BETWEEN 3 AND 24")
    counts = saved(words.groupBy("word").agg(F.count("*").alias("n")), "secret-words")
    total = counts.agg(F.sum("n")).first()[0] or 0
    return counts.filter(F.col("n") >= max(float(DICTIONARY_COUNT), DICTIONARY_SHARE * total)).select("word")


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, path, nth, candidate, before, after of every candidate of every text."""
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("path").cast("string").alias("path"),
                       F.translate(F.col("text").cast("string"), "\0", " ").alias("text")).filter(
        F.col("text").rlike(CANDIDATE))
    # pieces 1, 3, 5, ... are the candidates, those around them the text between
    cut = text.select("doc_id", "path", F.split(
        F.regexp_replace("text", CANDIDATE, "$1$3\0$2$4$5\0"), "\0", -1).alias("piece"))
    at = lambda k: F.get("piece", k)
    found = F.transform(F.sequence(F.lit(0), F.floor(F.size("piece") / 2).cast("int") - 1), lambda k: F.struct(
        at(k * 2 + 1).alias("candidate"), F.right(at(k * 2), F.lit(NEIGHBOUR_CHARS)).alias("before"),
        F.left(at(k * 2 + 2), F.lit(NEIGHBOUR_CHARS)).alias("after")))
    return cut.select("doc_id", "path", F.posexplode(found).alias("nth", "c")).select(
        "doc_id", "path", "nth", "c.candidate", "c.before", "c.after")


def _count(text: str, signs: str) -> F.Column:
    return F.length(text) - F.length(F.regexp_replace(text, signs, ""))


def _covered(found: DataFrame, words: DataFrame) -> DataFrame:
    """finding, known: letters of each finding's candidate that stand in dictionary words (none: no row).

    A candidate's words are its runs of letters, cut where a small letter meets a capital.
    """
    parts = F.split(F.lower(F.regexp_replace("candidate", "(?<=[a-z])(?=[A-Z])", " ")), "[^a-z]+")
    held = found.select("finding", F.explode(parts).alias("word")).filter("length(word) >= 3").withColumn(
        "salt", F.pmod(F.xxhash64("finding"), F.lit(SALTS)))
    spread = words.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>")))
    return held.join(spread, ["word", "salt"]).groupBy("finding").agg(F.sum(F.length("word")).alias("known"))


def with_features(found: DataFrame, words: DataFrame) -> DataFrame:
    """found with FEATURES; ``words`` is the dictionary."""
    found = saved(found.withColumn("finding", F.monotonically_increasing_id()), "secret-found")
    found = found.join(_covered(found, words), "finding", "left")
    c = F.col("candidate")
    n = F.length(c)
    share = lambda signs: _count("candidate", signs) / n
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(
        c, "[A-Z]+", "U"), "[a-z]+", "l"), "[0-9]+", "9"), "[^Ul9]+", "-")
    flag = lambda cond: F.coalesce(cond, F.lit(False)).cast("double")
    around = F.concat_ws(" ", "before", "candidate", "after")
    return found.select(
        "doc_id", "nth", "candidate", n.cast("double").alias("length"), share("[0-9]").alias("digits"),
        share("[A-Z]").alias("capitals"), share("[^A-Za-z0-9]").alias("signs"),
        F.size(F.array_distinct(F.split(c, ""))).cast("double").alias("distinct"),
        ((F.length(classes) - 1) / n).alias("transitions"), flag(c.rlike("^([0-9a-f]+|[0-9A-F]+)$")).alias("hex"),
        (F.coalesce("known", F.lit(0)) / n).alias("covered"), flag(F.col("before").rlike(f"({_ASSIGNED}|{_BEARER})$")).alias("named"),
        flag(F.col("before").rlike(r"[=:]\s*[\"']?$") & ~F.col("before").rlike(_ADDRESS + "$")).alias("assigned"),
        flag(F.col("before").rlike(_ADDRESS + "$") & F.col("after").startswith("@")).alias("address"),
        flag(F.col("before").rlike("[\"']$") & F.col("after").rlike("^[\"']")).alias("quoted"),
        flag(around.rlike(PLACEHOLDER)).alias("placeholder"), flag(F.col("path").rlike(TEST_PATH)).alias("test_path"),
        flag(F.col("after").rlike("^[\"',;]*(\\n|$)")).alias("line_end"))


def rule_labels(rows: DataFrame) -> DataFrame:
    """(doc_id, nth, label) of the findings of with_features that a plain rule finds clear.

    Secret: quoted or not, after a credential name or in an address, digits and
    other signs mixed, nearly no dictionary words, no placeholder near it.
    Harmless: nearly all dictionary words, a placeholder near it, or neither
    name nor assignment before it. All others get no label.
    """
    told = (F.col("named") + F.col("address")) > 0
    secret = told & (F.col("digits") > 0) & (F.col("digits") < 1) & (F.col("covered") < 0.3) & (F.col("length") >= 6) & (
        F.col("placeholder") == 0)
    harmless = (F.col("covered") >= 0.8) | (F.col("placeholder") == 1) | (~told & (F.col("assigned") == 0))
    return rows.select("doc_id", "nth", F.when(secret, 1.0).when(harmless, 0.0).alias("label")).filter("label IS NOT NULL")


def train(rows: DataFrame, labels: DataFrame):
    """The forest, or None without findings of both labels."""
    labels = labels.filter("label IS NOT NULL").groupBy("doc_id", "nth").agg(F.max("label").cast("double").alias("label"))
    by = {r.label: r.n for r in labels.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(by) < 2:
        return None
    share = {y: min(1.0, TRAIN_FINDINGS / 2 / n) for y, n in by.items()}  # half of the bound for each label
    keep = F.when(F.col("label") > 0, F.lit(share.get(1.0, 1.0))).otherwise(F.lit(share.get(0.0, 1.0)))
    picked = labels.filter(F.pmod(F.xxhash64("doc_id", "nth"), F.lit(1 << 30)) <= keep * (1 << 30))
    data = saved(rows.join(F.broadcast(picked), ["doc_id", "nth"]).select(*FEATURES, "label"), "secret-train")
    data = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(data).select("features", "label")
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="sqrt",
                                  cacheNodeIds=False).fit(data)


def scan(docs: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """doc_id, nth, masked, digest, n_chars, probability, is_secret of every candidate.

    docs: doc_id, path, text. labels: (doc_id, nth, label); without any, rule_labels
    of the documents whose crc32(doc_id) mod 3 is not 1.
    """
    rows = saved(with_features(candidates(docs), dictionary(docs)), "secret-candidates")
    if labels is None:
        labels = rule_labels(rows.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1))
    forest = train(rows, labels)
    first = F.least(F.lit(4), F.floor(F.length("candidate") / 4).cast("int"))
    shown = ["doc_id", "nth", F.concat(F.left("candidate", first), F.lit("…")).alias("masked"),
             F.sha2("candidate", 256).alias("digest"), F.length("candidate").alias("n_chars")]
    if forest is None:
        return rows.select(*shown, F.lit(0.0).alias("probability"), F.lit(False).alias("is_secret"))
    scored = forest.transform(VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows))
    p = vector_to_array("probability")[1]
    return scored.select(*shown, F.round(p, 6).alias("probability"), (p >= 0.5).alias("is_secret"))
