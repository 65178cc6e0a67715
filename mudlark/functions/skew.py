"""Joins that stay even when a few keys hold most rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Part of the rows that is looked at for heavy keys, and share of these from which a key counts as heavy: so there are
#: fewer than 1 / HEAVY of them, which bounds what is broadcast.
SAMPLE, HEAVY, SEED = 0.02, 0.005, 1

#: Rows of a task at most, on average, where a step is dealt by the number of its rows and not by the session's settings.
TASK_ROWS = 250_000

#: Bytes of a reference table, as JSON, up to which the driver and every executor hold the whole of it. They are measured: the planner guesses
#: from the files, and sees neither how far these are packed nor the copies of heavy keys.
WHOLE = 8 << 20


def tasks_for(rows: DataFrame) -> int:
    """Tasks over which ``rows`` are dealt, so that what one holds does not grow with their number. They are counted: a pass, or for Parquet its footers."""
    return max(1, -(-rows.count() // TASK_ROWS))


def fits_whole(table: DataFrame) -> bool:
    """Whether what is grouped from a table's rows may be broadcast: one pass over it. Never where the session has no broadcasts."""
    if table.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold").startswith("-"):
        return False
    return (table.select(F.sum(F.octet_length(F.to_json(F.struct("*"))))).head()[0] or 0) <= WHOLE


def sized(reference: DataFrame, whole: bool) -> DataFrame:
    """A reference that is broadcast, or shuffled whatever the planner guesses of its size."""
    return F.broadcast(reference) if whole else reference.hint("merge")


def left_join_spread(rows: DataFrame, reference: DataFrame, key: str, salts: int | None = None, sample: float = SAMPLE, seen: Callable[[], DataFrame] | None = None, tasks: int | None = None, whole: bool = False) -> DataFrame:
    """``rows`` left-joined with ``reference`` on ``key``, with the reference's other columns behind.

    Heavy keys are found in a sample of the rows. Their rows are dealt over ``salts`` keys (four for each shuffle partition if not given) by
    a hash of the row, and their reference rows repeated as often. Rows without a key meet nothing; they are dealt in the same way
    instead of meeting in one task. A key that the sample misses is not heavy; the result does not hang on the sample. ``seen``: gives a
    stored sample of the keys, for rows that would be computed once more for it. ``tasks``: over how many both sides are dealt, at least, for
    tables of any size; without it the session's settings decide. Repeated reference rows are never broadcast. ``whole``: a reference that
    ``fits_whole`` is, once, and no row is moved."""
    if whole:
        return rows.join(sized(reference.withColumnRenamed(key, "key_"), True), F.col(key) == F.col("key_"), "left").drop("key_")
    salts = salts or 4 * max(tasks or 0, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    keys = rows.select(key).sample(sample, SEED) if seen is None else seen().select(key)
    counts = keys.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("heavy_")).agg(F.count("*").alias("n_"))
    total = counts.select(F.sum("n_")).scalar()
    heavy = F.broadcast(counts.where(F.col("n_") >= total * HEAVY).select("heavy_"))  # fewer than 1 / HEAVY rows
    of_row = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]), F.lit(salts)).cast("int")
    left = rows.join(heavy, F.col(key) == F.col("heavy_"), "left").withColumn("salt_", F.when(F.col("heavy_").isNotNull() | F.col(key).isNull(), of_row).otherwise(0)).drop("heavy_")
    right = reference.withColumnRenamed(key, "key_").join(heavy, F.col("key_") == F.col("heavy_"), "left")
    right = right.withColumn("turn_", F.explode(F.when(F.col("heavy_").isNotNull(), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0))))).drop("heavy_")
    if tasks:
        left, right = left.repartition(tasks, key, "salt_"), right.repartition(tasks, "key_", "turn_")
    return left.join(sized(right, False), (F.col(key) == F.col("key_")) & (F.col("salt_") == F.col("turn_")), "left").drop("key_", "turn_", "salt_")
