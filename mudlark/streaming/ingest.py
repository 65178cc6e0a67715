"""Incremental ingest: new sample files are annotated and appended once, whatever was there before."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from mudlark.operators.annotate import annotate
from mudlark.sources.readers import TOPHIT_REPORT, sample_of


def ingest_hits(spark: SparkSession, path: str, out: str, checkpoint: str, trembl: DataFrame, subsystems: DataFrame, lineage: DataFrame | None = None) -> StreamingQuery:
    """Annotates hit reports that came since the last run and appends them to Parquet by sample.

    The joins are with fixed tables, so there is no state; aggregates stay batch jobs on the result. A batch is
    written under its own number, so that one that is repeated after a failure replaces itself."""
    rows = spark.readStream.schema(TOPHIT_REPORT).option("sep", "\t").option("quote", "").csv(path)
    rows = rows.select(sample_of(F.col("_metadata.file_path")).alias("sample_id"), *[c for c in rows.columns if c != "sample_id"])

    def write(batch: DataFrame, number: int) -> None:
        done = annotate(batch, trembl, subsystems, lineage)
        done.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
