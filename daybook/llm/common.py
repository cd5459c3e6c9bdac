"""Shared helpers of the training-data operators.

``saved`` is the only lineage cut used here: it writes Parquet into the folder
that ``spark.checkpoint.dir`` names and reads it back, so a lost executor
never loses an intermediate result. ``blank`` gives an operator the columns it
needs, whatever else the table holds.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: XXH64-based random numbers use this many bits of the hash.
_UNIT_BITS = 53


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables.

    ``spark.checkpoint.dir`` if it is set. Only a local master, whose driver
    and executors are one process, may fall back to a temporary folder.
    """
    set_by_user = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir")
    if set_by_user:
        return set_by_user.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="daybook-shared-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def saved(df: DataFrame, name: str = "part") -> DataFrame:
    """Write df to the shared folder and read it back (a lineage cut)."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, wanted: str) -> str:
    """A column name starting with ``wanted`` that df does not have."""
    taken = {c.lower() for c in df.columns}
    name = wanted
    while name.lower() in taken:
        name += "_"
    return name


def unit_hash(*cols) -> F.Column:
    """Uniform double in [0, 1) from XXH64 of the columns: the same on every run."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 64 - _UNIT_BITS) / F.lit(float(1 << _UNIT_BITS))


def text_key(text: str = "text") -> F.Column:
    """Digest that tells apart rows of one doc_id with different texts; null text has its own."""
    return F.when(F.col(text).isNull(), F.lit(-1).cast("long")).otherwise(F.xxhash64(F.col(text)))


#: Words of the size and fingerprint contracts: runs of other than space and \t-\r.
WORD = "[^\\x20\\x09-\\x0D]+"


def n_words(text: str = "text") -> F.Column:
    """Number of words of the whole text, 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
