"""Table writes (A5-A12) on plain parquet.

No MERGE on parquet: an upsert is a full outer join of target and source on
the key, written to a new location (never over the path being read). Only
the partitions present in a frame are replaced (dynamic overwrite).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.session import scratch_path


def overwrite_partitions(df: DataFrame, path: str, partition_cols: list[str], within: str | None = None) -> None:
    """A5: replace only the partitions present in ``df`` (dynamic overwrite).

    With ``within`` the rows are dealt out in ranges of (partition, within)
    first, so that a task writes few partitions and a large one has many tasks.
    """
    if within:
        parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        df = df.repartitionByRange(parts, *partition_cols, within).sortWithinPartitions(*partition_cols, within)
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_cols).parquet(path))


def clustered(df: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """Range-partition by key and sort within partitions before a write
    (the parquet analogue of clustering a partition by id)."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, key).sortWithinPartitions(key)


def upsert(target: DataFrame, source: DataFrame, keys: list[str], run_date: str) -> DataFrame:
    """Update-or-insert by key with audit columns.

    created_at is kept for existing keys and set to ``run_date`` for new ones;
    last_modified_at is ``run_date`` for every key in the source;
    overwrite_count is +1 for updated keys, 0 for inserted ones, unchanged for
    keys only in the target. Columns of either side only are kept: NULL for
    rows that come from the other side (A8).
    """
    audit = ["created_at", "last_modified_at", "overwrite_count"]
    source = source.drop(*audit)
    values = [c for c in dict.fromkeys([*target.columns, *source.columns]) if c not in keys and c not in audit]
    t = target.withColumn("_in_t", F.lit(True))
    s = source.withColumn("_in_s", F.lit(True))
    tcols = {c: F.col(f"t.{c}") for c in target.columns}
    j = t.alias("t").join(s.alias("s"), keys, "full_outer")
    in_t = F.coalesce(F.col("t._in_t"), F.lit(False))
    in_s = F.coalesce(F.col("s._in_s"), F.lit(False))
    run = F.lit(run_date).cast("date")
    return j.select(
        *keys,
        *[(tcols[c] if c not in source.columns else
           F.when(in_s, F.col(f"s.{c}")).otherwise(tcols.get(c, F.lit(None)))).alias(c) for c in values],
        F.coalesce(tcols["created_at"], run).alias("created_at"),
        F.when(in_s, run).otherwise(tcols["last_modified_at"]).alias("last_modified_at"),
        F.when(in_s & in_t, tcols["overwrite_count"] + 1).when(in_s, F.lit(0))
        .otherwise(tcols["overwrite_count"]).alias("overwrite_count"))


def with_audit(df: DataFrame, run_date: str) -> DataFrame:
    run = F.lit(run_date).cast("date")
    return df.withColumns({"created_at": run, "last_modified_at": run, "overwrite_count": F.lit(0)})


def evolve_union(old: DataFrame, new: DataFrame) -> DataFrame:
    """Union by name; columns missing on either side become NULL."""
    return old.unionByName(new, allowMissingColumns=True)


def change_set(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Insert / update / delete rows between two versions by key.

    Rows compare by a SHA-256 of their non-key values as JSON (NULL-safe)."""
    vals = [c for c in new.columns if c not in keys]

    def h(df, name):
        return df.select(*keys, F.sha2(F.to_json(F.struct(*vals)), 256).alias(name))
    j = h(old, "_ho").join(h(new, "_hn"), keys, "full_outer")
    kind = (F.when(F.col("_ho").isNull(), "insert").when(F.col("_hn").isNull(), "delete")
            .when(F.col("_ho") != F.col("_hn"), "update"))
    return j.select(*keys, kind.alias("change")).filter(F.col("change").isNotNull())


def with_comments(df: DataFrame, comments: dict[str, str]) -> tuple[DataFrame, list[str], list[str]]:
    """A10: attach column comments as metadata; report applied vs skipped names."""
    applied = [c for c in comments if c in df.columns]
    skipped = [c for c in comments if c not in df.columns]
    out = df
    for c in applied:
        out = out.withMetadata(c, {"comment": comments[c]})
    return out, applied, skipped


def write_sheet(df: DataFrame, path: str) -> None:
    """CSV with a header row, every cell quoted (multi-line text kept whole)."""
    (df.write.mode("overwrite").option("header", True).option("quoteAll", True)
     .option("quote", '"').option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def new_table_path(spark: SparkSession, name: str) -> str:
    """A fresh location under the shared checkpoint folder for a written version."""
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
