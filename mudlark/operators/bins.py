"""Contigs, clusters of contigs, and assembly graphs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def concatenated(contigs: DataFrame, least_length: int = 2000, keep_names: bool = False, length: str = "len") -> DataFrame:
    """Contigs of all samples that are long enough, named ``S<sample number>C<contig>``; samples are numbered in
    order of their names."""
    samples = contigs.select("sample_id").distinct().withColumn("sample_no", F.dense_rank().over(Window.orderBy("sample_id")))
    rows = contigs.where(F.col(length) >= least_length).join(samples, "sample_id")
    name = F.col("contig_id") if keep_names else F.concat(F.lit("S"), F.col("sample_no").cast("string"), F.lit("C"), F.col("contig_id"))
    return rows.withColumn("name", name)


def last_cluster(clusters: DataFrame, order: str | None = None) -> DataFrame:
    """One cluster for each contig: the last by ``order``, or the greatest."""
    pick = F.max_by("cluster_id", order) if order else F.max("cluster_id")
    return clusters.groupBy("contig_id").agg(pick.alias("cluster_id"))


def clustered(contigs: DataFrame, clusters: DataFrame) -> DataFrame:
    """Contigs with their cluster; others are left out."""
    return contigs.join(last_cluster(clusters), "contig_id")


def cluster_lengths(rows: DataFrame, keys: tuple[str, ...] = ("cluster_id",), length: str = "len") -> DataFrame:
    """Contigs and total length of each cluster; give ``group_id`` among the keys for separate assemblies."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n_contigs"), F.sum(length).alias("length"))


def length_histogram(lengths: DataFrame) -> DataFrame:
    return lengths.groupBy("length").agg(F.count("*").alias("n")).orderBy("length")


def long_clusters(rows: DataFrame, least: int = 0, keys: tuple[str, ...] = ("cluster_id",), length: str = "len") -> DataFrame:
    """Contigs of clusters with a total length of ``least`` at least: lengths first, then the contigs wanted."""
    return rows.join(cluster_lengths(rows, keys, length).where(F.col("length") >= least).select(*keys), list(keys), "left_semi")


def grouped_samples(files: DataFrame, groups: DataFrame) -> DataFrame:
    """Read files ``(file)`` with the group whose pattern their name holds. A file of no group is left out; one of
    several fails. A name's substrings of the patterns' lengths are joined with the patterns, so lists of any size will do."""
    sizes = groups.select(F.collect_set(F.length("pattern"))).scalar()
    fits = F.filter("sizes_", lambda n: n <= F.length("file"))
    parts = F.flatten(F.transform(fits, lambda n: F.transform(F.sequence(F.lit(1), F.length("file") - n + 1), lambda i: F.col("file").substr(i, n))))
    pieces = files.withColumn("sizes_", sizes).select("file", F.explode(F.array_distinct(parts)).alias("pattern"))
    rows = pieces.join(groups, "pattern")
    one = rows.groupBy("file").agg(F.count_distinct("group").alias("n"), F.min("group").alias("group"))
    message = F.concat(F.lit("several groups for "), F.col("file"))
    return one.select("file", F.when(F.col("n") == 1, F.col("group")).otherwise(F.raise_error(message)).alias("group"))


def named_by_prefix(folders: DataFrame, metadata: DataFrame) -> DataFrame:
    """Folders ``(folder)`` with the metadata whose key they start with: their prefixes of the keys' lengths are joined with the keys."""
    sizes = metadata.select(F.collect_set(F.length("key"))).scalar()
    prefixes = F.transform(F.filter("sizes_", lambda n: n <= F.length("folder")), lambda n: F.left(F.col("folder"), n))
    return folders.withColumn("sizes_", sizes).withColumn("key", F.explode(prefixes)).join(metadata, "key").select(*folders.columns, *metadata.columns)


def graph(fastg: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Segments and links of an assembly graph from FASTG records ``(header, seq)``.

    A header is ``A':B,C';``: a segment, a quote if reverse, and what follows it. Only forward records are segments."""
    parts = F.split(F.regexp_replace("header", "[;>]", ""), ":")
    rows = fastg.select(parts[0].alias("a"), F.get(parts, F.lit(1)).alias("next"), "seq")
    name = lambda c: F.replace(c, F.lit("'"), F.lit(""))
    strand = lambda c: F.when(F.endswith(c, F.lit("'")), "-").otherwise("+")
    segments = rows.where(~F.col("a").endswith("'")).select(F.col("a").alias("id"), "seq", F.length("seq").alias("len"))
    links = rows.where("next is not null").select("a", F.explode(F.split("next", ",")).alias("b"))
    return segments, links.select(name(F.col("a")).alias("src"), strand(F.col("a")).alias("src_strand"), name(F.col("b")).alias("dst"), strand(F.col("b")).alias("dst_strand"))


def gfa(segments: DataFrame, links: DataFrame) -> DataFrame:
    """Lines of a graph file."""
    s = segments.select(F.concat_ws("\t", F.lit("S"), "id", "seq", F.concat(F.lit("LN:i:"), F.col("len").cast("string"))).alias("value"))
    return s.union(links.select(F.concat_ws("\t", F.lit("L"), "src", "src_strand", "dst", "dst_strand", F.lit("0M"))))
