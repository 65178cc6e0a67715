"""What the operators of this subpackage share: table reading, the shared folder, tokens."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed value of the contracts: a word is a maximal run of other characters than these.
WORD_BREAKS = "\x20\x09\x0a\x0b\x0c\x0d"
WORD_BREAK_CLASS = r"[\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors and the driver share.

    It is the session's ``spark.checkpoint.dir``. Only where that is unset, as in
    single-machine tests, a temporary folder is set in its place; off a single machine that is an error.
    """
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith(("local[", "local-cluster[")):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        where = tempfile.mkdtemp(prefix="mudlark-shared-")
        spark.conf.set("spark.checkpoint.dir", where)
        spark.sparkContext.setCheckpointDir(where)
    return where


def materialise(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: cuts the lineage and
    keeps a result that several steps read from being computed again."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words_of(text: Column) -> Column:
    """Words of a text as an array; null and blank texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_BREAK_CLASS), "")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
