"""Cutting a plan's lineage in the folder that all executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where that is unset, as in tests, a temporary folder."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith(("local[", "local-cluster[")) and spark.sparkContext.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        spark.conf.set("spark.checkpoint.dir", where := tempfile.mkdtemp(prefix="mudlark-checkpoint-"))
        spark.sparkContext.setCheckpointDir(where)
    return where


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
