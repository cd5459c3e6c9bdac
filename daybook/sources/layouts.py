"""Written layouts that spare a read or a shuffle.

* ``write_for_lookup``: rows clustered by id inside each partition, small row
  groups and a Parquet bloom filter on the id, so that a point lookup (day, id)
  prunes to one partition, skips row groups by their statistics and the rest by
  the filter.
* ``Bucketed``: versions of a table hashed into the same buckets by key, which
  join on the key without an exchange.
* ``partition_counts``: rows of each partition from file footers, no row read.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.sources import writes


def write_for_lookup(df: DataFrame, path: str, partition_by: list[str], id_col: str, row_group_bytes: int = 8 << 20,
                     ids_per_file: int = 1_000_000) -> None:
    """Replace the partitions of df by files sorted by id, with a bloom filter on the id."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (df.repartitionByRange(parts, *partition_by, id_col).sortWithinPartitions(*partition_by, id_col)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("parquet.block.size", row_group_bytes)
     .option(f"parquet.bloom.filter.enabled#{id_col}", "true")
     .option(f"parquet.bloom.filter.expected.ndv#{id_col}", ids_per_file)
     .partitionBy(*partition_by).parquet(path))


def lookup(spark: SparkSession, path: str, day_col: str, day, id_col: str, ids: list[int]) -> DataFrame:
    """A3: the rows of some ids on one day. The few ids are literals, so they reach the scan."""
    return spark.read.parquet(path).filter((F.col(day_col) == F.lit(day)) & F.col(id_col).isin(*ids))


@dataclass(frozen=True)
class Bucketed:
    """A table hashed into ``buckets`` by ``key``; its data lie at ``path``, its bucketing in the catalog."""

    name: str
    path: str
    key: tuple[str, ...]
    buckets: int

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.name)


def write_bucketed(df: DataFrame, name: str, key: list[str], buckets: int) -> Bucketed:
    """Write df as a new bucketed table. One exchange by the key leaves one sorted file a bucket."""
    spark = df.sparkSession
    name = f"{name}_{uuid.uuid4().hex}"
    path = writes.new_table_path(spark, name)
    (df.repartition(buckets, *key).write.bucketBy(buckets, *key).sortBy(*key).option("path", path).format("parquet")
     .saveAsTable(name))
    return Bucketed(name, path, tuple(key), buckets)


def bucketed_changes(spark: SparkSession, old: Bucketed, new: Bucketed) -> DataFrame:
    """Insert, update and delete keys between two versions in equal buckets; no exchange."""
    if (old.key, old.buckets) != (new.key, new.buckets):
        raise ValueError("the versions are bucketed differently")
    return writes.change_set(old.read(spark), new.read(spark), list(old.key))


@contextmanager
def _settings(spark: SparkSession, **conf: str):
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


FOOTERS = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


def partition_counts(spark: SparkSession, path: str, partition_by: list[str]) -> DataFrame:
    """Rows of each partition, from the row counts in the file footers.

    Only the v2 Parquet source pushes an aggregate down, and only while these
    settings hold, so the counts are taken at once: one row a partition.
    """
    with _settings(spark, **FOOTERS):
        counted = counting(spark, path, partition_by)
        rows, schema = counted.collect(), counted.schema
    return spark.createDataFrame(rows, schema)


def counting(spark: SparkSession, path: str, partition_by: list[str]) -> DataFrame:
    """The aggregate that ``partition_counts`` pushes down."""
    return spark.read.parquet(path).groupBy(*partition_by).agg(F.count("*").alias("n_rows"))
