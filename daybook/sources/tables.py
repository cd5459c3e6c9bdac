"""Table access (A1, A3, A4, A13) and source checks.

Reads are always projected: callers pass the columns they need so the parquet
scan's ReadSchema holds only those, and filters written on raw columns reach
the scan as PushedFilters.
"""

from __future__ import annotations

import os
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table_path(base: str, name: str) -> str:
    return os.path.join(base, f"{name}.parquet")


def load(spark: SparkSession, base: str, name: str, columns: Iterable[str] | None = None) -> DataFrame:
    """A1: projected scan of one table."""
    df = spark.read.parquet(table_path(base, name))
    if columns is not None:
        df = df.select(*columns)
    return df


def absent(spark: SparkSession, base: str, names: Iterable[str]) -> list[str]:
    """Those of the tables that are not there."""
    out = []
    for name in names:
        try:
            spark.read.parquet(table_path(base, name))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            out.append(name)
    return out


def check_sources(spark: SparkSession, base: str, required: Iterable[str]) -> None:
    """Raise one error that names every absent table, before any work is done."""
    missing = absent(spark, base, required)
    if missing:
        raise ValueError(f"{len(missing)} source table(s) not found: " + ", ".join(f"{n} ({table_path(base, n)})" for n in missing))


def load_optional(spark: SparkSession, base: str, name: str, schema: str) -> DataFrame:
    """The named columns of a table that may be absent: then no rows, so that joins give typed NULLs."""
    if absent(spark, base, [name]):
        return spark.createDataFrame([], schema)
    return load(spark, base, name, StructType.fromDDL(schema).names)


def day_partition(df: DataFrame, day_col: str, day, ids: DataFrame | None = None,
                  id_col: str = "id") -> DataFrame:
    """A3/A4: rows of one report day, optionally restricted to an id list.

    The day predicate is on the partition column (partition pruning); the id
    list is applied as a semi join, never as an IN literal list.
    """
    out = df.filter(F.col(day_col) == F.lit(day).cast("date"))
    if ids is not None:
        out = out.join(ids.select(id_col).distinct(), id_col, "left_semi")
    return out


def first_per_key(df: DataFrame, key: str, order_cols: list) -> DataFrame:
    """the first row per key under an ordering (LIMIT 1 per id)."""
    w = Window.partitionBy(key).orderBy(*order_cols)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def read_sheet(spark: SparkSession, path: str, rename: dict[str, str] | None = None,
               schema: str | None = None) -> DataFrame:
    """CSV with quoted multi-line cells, trimmed headers, rename map, blank rows dropped."""
    reader = (spark.read.option("header", True).option("multiLine", True)
              .option("quote", '"').option("escape", '"')
              .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    df = reader.schema(schema).csv(path) if schema else reader.csv(path)
    df = df.toDF(*[c.strip() for c in df.columns])
    if rename:
        df = df.withColumnsRenamed({k: v for k, v in rename.items() if k in df.columns})
    non_blank = None
    for c in df.columns:
        cond = F.trim(F.col(c).cast("string")) != ""
        non_blank = cond if non_blank is None else (non_blank | cond)
    return df.filter(F.coalesce(non_blank, F.lit(False)))
