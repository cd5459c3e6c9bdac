"""Partitioned Parquet tables that are written day by day.

A ``Table`` is a folder, a schema, its partition columns and its key. Reads
name the schema, so partitions written before a column existed give NULL for
it (A8) and an empty table has its types. Writes replace whole partitions:

1. The source is written to the shared folder once: its partitions are listed,
   its keys are checked, and it is joined, from the same rows.
2. Of the table only the partitions that the source holds are read
   (``PartitionFilters``), whatever the table's age.
3. The new content of these partitions is staged: written whole to the shared
   folder, in ranges of (partition, key), so that a file holds one partition's
   range of keys and a hot partition is spread over tasks (A9).
4. The staged rows are swapped in by dynamic partition overwrite. It can be
   repeated: staged rows already carry their audit columns, so a swap that was
   cut off and done again counts an overwrite once. Files of other partitions
   stay as they are.

The list of partitions reaches the driver, as it does in every listing of the
table's folder; no rows do.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from daybook.sources import writes

AUDIT = "created_at timestamp_ntz, last_modified_at timestamp_ntz, overwrite_count int"
AUDIT_COLS = ["created_at", "last_modified_at", "overwrite_count"]


@dataclass(frozen=True)
class Table:
    """``key`` includes the partition columns, so a key lives in one partition."""

    path: str
    schema: StructType
    partition_by: tuple[str, ...]
    key: tuple[str, ...]

    def __post_init__(self):
        names = set(self.schema.names)
        if not set(self.partition_by) <= set(self.key) <= names or not set(AUDIT_COLS) <= names:
            raise ValueError("the key holds the partition columns, the schema the key and the audit columns")


def table(path: str, columns: str | StructType, partition_by: list[str], key: list[str]) -> Table:
    """A table of the given columns and the audit columns."""
    given = columns if isinstance(columns, StructType) else StructType.fromDDL(columns)
    audit = StructType.fromDDL(AUDIT)
    fields = [f for f in given.fields if f.name not in AUDIT_COLS] + audit.fields
    return Table(path, StructType(fields), tuple(partition_by), tuple(key))


def create_if_absent(spark: SparkSession, t: Table) -> None:
    """The table's folder; an existing table keeps its rows (A6, create if absent)."""
    spark.createDataFrame([], t.schema).write.mode("append").partitionBy(*t.partition_by).parquet(t.path)


def read(spark: SparkSession, t: Table) -> DataFrame:
    """All columns of the table's schema; NULL where a file has no such column."""
    return spark.read.schema(t.schema).parquet(t.path)


def partitions_of(df: DataFrame, t: Table) -> list[tuple]:
    """The partitions that df has rows for."""
    return [tuple(r) for r in df.select(*t.partition_by).distinct().collect()]


def in_partitions(t: Table, values: list[tuple]) -> Column:
    """Condition on the partition columns alone, which prunes the listing."""
    kinds = {f.name: f.dataType for f in t.schema.fields}
    each = [reduce(Column.__and__, [F.col(c).eqNullSafe(F.lit(v).cast(kinds[c])) for c, v in zip(t.partition_by, row, strict=True)])
            for row in values]
    return reduce(Column.__or__, each) if each else F.lit(False)


def _staged_source(spark: SparkSession, t: Table, source: DataFrame) -> tuple[DataFrame, list[tuple]]:
    missing = set(t.key) - set(source.columns)
    if missing:
        raise ValueError(f"the source lacks key columns {sorted(missing)}")
    unknown = set(source.columns) - set(t.schema.names)
    if unknown:
        raise ValueError(f"the table has no columns {sorted(unknown)}: evolve its schema first")
    kinds = {f.name: f.dataType for f in t.schema.fields}
    source = source.select(*[F.col(c).cast(kinds[c]).alias(c) for c in source.columns if c not in AUDIT_COLS])
    path = writes.new_table_path(spark, "source")
    source.write.parquet(path)
    held = spark.read.schema(source.schema).parquet(path)
    twice = held.groupBy(*t.key).count().filter("count > 1").limit(1).count()
    if twice:
        raise ValueError(f"the source has several rows for one key {t.key}")
    return held, partitions_of(held, t)


def _swap_in(spark: SparkSession, t: Table, rows: DataFrame) -> str:
    """Stage rows, then replace their partitions; the path of the staged rows."""
    staged = writes.new_table_path(spark, "staged")
    order = [*t.partition_by, *[k for k in t.key if k not in t.partition_by]]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (rows.select(*t.schema.names).repartitionByRange(parts, *order).sortWithinPartitions(*order)
     .write.partitionBy(*t.partition_by).parquet(staged))
    swap(spark, t, staged)
    return staged


def swap(spark: SparkSession, t: Table, staged: str) -> None:
    """Replace the partitions that were staged; may be repeated."""
    writes.overwrite_partitions(spark.read.schema(t.schema).parquet(staged), t.path, list(t.partition_by))


def _joined(spark: SparkSession, t: Table, source: DataFrame, values: list[tuple], how: str) -> tuple[DataFrame, Column, Column]:
    old = read(spark, t).filter(in_partitions(t, values)).withColumn("_old", F.lit(True))
    new = source.withColumn("_new", F.lit(True))
    # NULL keys meet as equal: they are keys of the written table too
    on = reduce(Column.__and__, [F.col(f"n.{k}").eqNullSafe(F.col(f"o.{k}")) for k in t.key])
    j = new.alias("n").join(old.alias("o"), on, how)
    return j, F.coalesce(F.col("_old"), F.lit(False)), F.coalesce(F.col("_new"), F.lit(False))


def upsert(spark: SparkSession, t: Table, source: DataFrame, run_at: str) -> str | None:
    """Update or insert by key, reading and replacing only the source's partitions.

    Rows of these partitions that the source lacks stay. A matched row keeps
    created_at and the columns that the source lacks, and counts one overwrite
    more; a new row has count 0. Returns where the rows were staged, None for
    an empty source.
    """
    source, values = _staged_source(spark, t, source)
    if not values:
        return None
    j, in_old, in_new = _joined(spark, t, source, values, "full_outer")
    run = F.lit(run_at).cast("timestamp_ntz")
    given = set(source.columns)

    def value(c: str) -> Column:
        if c not in given:
            return F.col(f"o.{c}")
        return F.when(in_new, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}"))

    rows = j.select(
        *[value(c).alias(c) for c in t.schema.names if c not in AUDIT_COLS],
        F.when(in_old, F.col("o.created_at")).otherwise(run).alias("created_at"),
        F.when(in_new, run).otherwise(F.col("o.last_modified_at")).alias("last_modified_at"),
        F.when(in_old & in_new, F.coalesce(F.col("o.overwrite_count"), F.lit(0)) + 1).when(in_new, 0)
        .otherwise(F.col("o.overwrite_count")).cast("int").alias("overwrite_count"))
    return _swap_in(spark, t, rows)


def replace(spark: SparkSession, t: Table, frame: DataFrame, run_at: str) -> str | None:
    """Recompute whole partitions, carrying the audit columns of the rows they replace.

    A key that was there keeps created_at and counts one overwrite more; a new
    one starts at 0; a key that the frame lacks is gone. Columns that the frame
    lacks are NULL.
    """
    frame, values = _staged_source(spark, t, frame)
    if not values:
        return None
    j, in_old, _ = _joined(spark, t, frame, values, "left")
    run = F.lit(run_at).cast("timestamp_ntz")
    kinds = {f.name: f.dataType for f in t.schema.fields}
    rows = j.select(
        *[(F.col(f"n.{c}") if c in frame.columns else F.lit(None).cast(kinds[c])).alias(c)
          for c in t.schema.names if c not in AUDIT_COLS],
        F.coalesce(F.col("o.created_at"), run).alias("created_at"), run.alias("last_modified_at"),
        F.when(in_old, F.coalesce(F.col("o.overwrite_count"), F.lit(0)) + 1).otherwise(0).cast("int").alias("overwrite_count"))
    return _swap_in(spark, t, rows)


def evolved(t: Table, columns: str) -> Table:
    """The table with further columns; its files stay, and read NULL for them."""
    new = StructType.fromDDL(columns)
    kinds = {f.name: f.dataType for f in t.schema.fields}
    for f in new.fields:
        if kinds.get(f.name, f.dataType) != f.dataType:
            raise ValueError(f"column {f.name} is {kinds[f.name].simpleString()} already")
    return Table(t.path, StructType([*t.schema.fields, *[f for f in new.fields if f.name not in kinds]]), t.partition_by, t.key)
