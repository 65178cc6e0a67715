"""Sinks: matrices, sequence files, tables and documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def samples_of(rows: DataFrame, column: str = "sample_id") -> list[str]:
    """Sorted names of the columns of a matrix; as many as there are samples."""
    return sorted(r[0] for r in rows.select(column).distinct().collect())


def matrix(rows: DataFrame, value: str, category: str = "category", sample: str = "sample_id", samples: Sequence[str] | None = None, label: str | None = None) -> DataFrame:
    """Categories by samples, both sorted, absent cells 0. The samples are given to the pivot, so that it is one pass."""
    names = list(samples) if samples is not None else samples_of(rows, sample)
    wide = rows.groupBy(F.col(category).alias(label or category)).pivot(sample, names).agg(F.sum(value))
    return wide.fillna(0, names).orderBy(label or category)


def transposed(rows: DataFrame, value: str, categories: Sequence[str], category: str = "taxon", sample: str = "sample_id") -> DataFrame:
    """Samples by the given categories. Prefer the long form for many."""
    return rows.groupBy(sample).pivot(category, list(categories)).agg(F.sum(value)).fillna(0, list(categories)).orderBy(sample)


def write_matrix(wide: DataFrame, path: str, comment: str | None = None) -> None:
    """Tab-separated with a header; a comment becomes a first line of its own."""
    if comment is None:
        wide.coalesce(1).write.mode("overwrite").option("sep", "\t").option("header", True).csv(path)
        return
    names = wide.columns
    head = wide.sparkSession.createDataFrame([(0, f"# {comment}"), (1, "\t".join(names))], "o int, value string")
    order = [F.concat_ws("\t", *[F.coalesce(F.col(f"`{n}`").cast("string"), F.lit("")) for n in names])]
    head.union(wide.select(F.lit(2), *order)).repartitionByRange(1, "o").sortWithinPartitions("o", "value").select("value").write.mode("overwrite").text(path)


def fasta_lines(rows: DataFrame, name: str = "seq_id", seq: str = "seq", keep: Sequence[str] = ()) -> DataFrame:
    return rows.select(*keep, F.concat(F.lit(">"), F.col(name), F.lit("\n"), F.col(seq)).alias("value"))


def fastq_lines(rows: DataFrame, header: str = "header", keep: Sequence[str] = ()) -> DataFrame:
    return rows.select(*keep, F.concat_ws("\n", F.concat(F.lit("@"), F.col(header)), "seq", F.lit("+"), "qual").alias("value"))


def write_lines(lines: DataFrame, path: str, by: str | None = None, compression: str = "gzip") -> None:
    """Text of the column ``value``; with ``by`` in a folder for each of its values, from which readers take the sample's name."""
    writer = lines.write.mode("overwrite").option("compression", compression)
    (writer.partitionBy(by) if by else writer).text(path)


def write_fasta(rows: DataFrame, path: str, name: str = "seq_id", compression: str = "gzip", by: str | None = None) -> None:
    write_lines(fasta_lines(rows, name, keep=[by] if by else []), path, by, compression)


def write_fastq(rows: DataFrame, path: str, compression: str = "gzip", by: str | None = None) -> None:
    write_lines(fastq_lines(rows, keep=[by] if by else []), path, by, compression)


def write_by_cluster(rows: DataFrame, path: str, cluster: str = "cluster_id", name: str = "seq_id") -> None:
    """A folder of gzip FASTA for each cluster: one file of a small one, and of a large one as many as it has times the session's
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes``, each written by a task of its own."""
    lines = rows.select(F.col(cluster), F.concat(F.lit(">"), F.col(name), F.lit("\n"), F.col("seq")).alias("value"))
    lines.hint("rebalance", cluster).write.mode("overwrite").partitionBy(cluster).option("compression", "gzip").text(path)


def write_ranks(counts: DataFrame, path: str) -> None:
    """Long tables of counts by rank and sample."""
    counts.write.mode("overwrite").partitionBy("rank", "sample_id").option("sep", "\t").csv(path)


def lineage_columns(rows: DataFrame) -> DataFrame:
    """Lineages as seven columns; rows of another shape are left out."""
    parts = F.split("lineage", ";")
    names = ("kingdom", "phylum", "class_", "order_", "family", "genus", "species")
    return rows.where(F.size(parts) == 7).withColumns({n: parts[i] for i, n in enumerate(names)}).drop("lineage")


def save(rows: DataFrame, name: str, by: str = "sample_id") -> None:
    """Loads the samples of ``rows`` into a table partitioned by sample, which is made if it is not there.

    A sample that is loaded again is replaced, others stay: so loading sample by sample, or one twice, equals one load of all, and a
    load that failed can be repeated. Columns are matched by name; other columns than the table's are an error. A sample without rows is left
    as it was."""
    spark = rows.sparkSession
    rows = rows.hint("rebalance", by)  # few files for each sample, several tasks for a large one
    if not spark.catalog.tableExists(name):
        rows.write.partitionBy(by).saveAsTable(name)
        return
    columns = spark.table(name).columns
    if sorted(columns) != sorted(rows.columns):
        raise ValueError(f"{name} has the columns {columns}, not {rows.columns}")
    mode = "spark.sql.sources.partitionOverwriteMode"  # a table's insert heeds the session's setting alone
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        rows.select(*columns).write.mode("overwrite").insertInto(name)
    finally:
        spark.conf.set(mode, before)


def save_star(star: dict[str, DataFrame], path: str) -> None:
    for name, df in star.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")


#: Column that each table of a star is bucketed and sorted by.
STAR_KEYS = {"roles": "role_id", "role_subsystems": "role_id", "subsystems": "subsystem_id", "uniprot_patric_role": "uniprot_id"}


#: Rows of a bucket at most, on average; a bucket is what one task writes, sorts and reads.
BUCKET_ROWS, LEAST_BUCKETS = 250_000, 16


def store_star(star: dict[str, DataFrame], prefix: str, folder: str, buckets: int | None = None) -> dict[str, DataFrame]:
    """The star as tables ``<prefix>_<name>`` in a folder that all executors share, bucketed and sorted by the columns that lookups ask
    for, with their sizes kept, so that joins with small tables need no hint. Built once; ``stored_star`` gives them again.

    If no number of ``buckets`` is given, a table's rows are written as they come and counted first, and its buckets follow their number."""
    spark = next(iter(star.values())).sparkSession
    for name, df in star.items():
        key, table = STAR_KEYS[name], f"{prefix}_{name}"
        n = buckets
        if n is None:
            df.write.mode("overwrite").parquet(f"{folder}/{table}_rows")
            df = spark.read.parquet(f"{folder}/{table}_rows")
            n = max(LEAST_BUCKETS, -(-df.count() // BUCKET_ROWS))
        df.repartition(n, key).write.mode("overwrite").bucketBy(n, key).sortBy(key).option("path", f"{folder}/{table}").saveAsTable(table)
        spark.sql(f"analyze table {table} compute statistics")
    return stored_star(spark, prefix, star)


def stored_star(spark: SparkSession, prefix: str, names=tuple(STAR_KEYS)) -> dict[str, DataFrame]:
    return {name: spark.table(f"{prefix}_{name}") for name in names}


def as_document(rows: DataFrame, key: str, value: str) -> DataFrame:
    """One JSON document of a small summary table."""
    return rows.agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct(key, value))))).alias("value"))
