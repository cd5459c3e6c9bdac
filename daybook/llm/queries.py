"""Queries of the training-data operators, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, decontaminate, html_text, itq, licenses, mix, negatives, repeats, secrets, shard, simhash, tokens,
               toxicity)
from .common import WORD, n_words, read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return register


@query("op1_html_text")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extracted(read(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


@query("op2_decontaminate")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents, with the best window of each."""
    return decontaminate.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).select(
        "doc_id", "item_id", "similarity", "first_word", "n_words")


@query("op3_token_counts")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, counted in flat token files."""
    return tokens.token_counts(read(spark, sf_dir, "documents"))


@query("op4_toxicity")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned from the labels that are not held out."""
    docs = read(spark, sf_dir, "documents")
    return toxicity.scored(docs, toxicity.trained(docs, read(spark, sf_dir, "labels"))).select(
        "doc_id", "held_out", "score", "predicted")


def _as_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents laid out as files, as they have no paths: source / language / 16 ids / id.

    A document of under 80 words whose last line is licence wording stands for
    its directory's licence file.
    """
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    last = F.lower(F.element_at(F.split("text", "\n"), -1))
    name = F.when((n_words() < 80) & last.contains("licen"), F.lit("LICENSE")).otherwise(
        F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    return docs.select("doc_id", "text", F.concat_ws("/", "source", "lang", F.expr("cast(doc_id div 16 as string)"), name).alias("path"))


@query("op5_license_scan")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence of every document, by its header or its directory's licence file."""
    return licenses.licenses(_as_files(spark, sf_dir))


@query("op6_itq_near_dedup")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and groups of all embeddings at cosine 0.9."""
    return itq.near_duplicates(read(spark, sf_dir, "embeddings"))


@query("op7_simhash_groups")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash groups of all documents: four-word shingles, four differing bits."""
    return simhash.simhash_groups(read(spark, sf_dir, "documents")).select(
        "doc_id", "fingerprint", "component_id")


@query("op8_mix_sources")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of every document in the mix, by pivotal dependent rounding."""
    return mix.mixed(read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


@query("op9_feistel_shards")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document; law ``rows``: shard counts differ by one at most."""
    return shard.shard_rows(read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@query("op10_secret_scan")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every secret candidate of every document with the forest's probability."""
    return secrets.scan(_as_files(spark, sf_dir))


@query("op11_hard_negatives")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every 50th embedding, some labels moved on by one."""
    rows = read(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mined(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)


@query("op12_bpe_round_trip")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document and the text they decode to, as digests."""
    done = bpe.decoded(bpe.encoded(read(spark, sf_dir, "documents")))
    return done.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def _repeating(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, those with crc32(doc_id) divisible by 10 made periodic from some word on."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text").withColumn(
        "h", F.crc32(F.col("doc_id").cast("string").cast("binary")))
    made = (docs.withColumn("w", F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1))))
            .withColumn("n", F.size("w")).withColumn("g", F.expr("h div 10"))
            .withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
            .withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)")))
    return made.select("doc_id", F.when(F.col("a").isNotNull(), F.expr(
        "array_join(transform(sequence(0, n - 1), i -> w[int(if(i < a, i, a + (i - a) % p))]), ' ')")).otherwise(
        F.col("text")).alias("text"))


@query("op13_periodic_runs")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document: their number, the one that repeats most often, digests of all and of what is left."""
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))), "")
    return repeats.runs(_repeating(spark, sf_dir)).withColumn("top", repeats.most_repeated("runs")).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "top.start", "top.length", "top.period",
        F.expr("1000 * top.length div top.period").alias("exponent_milli"), F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
