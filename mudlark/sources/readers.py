"""Scans of tool output tables and sequence files as DataFrames with explicit schemas.

Every table gets ``sample_id`` from its file's name, or from its folder where that is named like ``sample_id=S1``, as Spark
names the folders of what it writes by a column. Gzip files are one task each (they can't be split); write
them to Parquet once if they are read again.

Spark tells gzip by a file's name. A file that is gzip under another name is an error that says so; readers with ``by_content`` look at
the first bytes instead, and read a file as what it is under any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mudlark.sources.splits import RANGE, FastqSource, TextSource, in_ranges, reachable

TOPHIT_REPORT = "uniref_id string, n_aligned long, unique_cov double, target_cov double, identity double, taxid int, rank string, name string"
TOPHIT_ALN = "dna_id string, uniref_id string, percent_identity double, alignment_length int, gaps int, mismatches int, query_start int, query_end int, subject_start int, subject_end int, evalue double, bitscore int"
CLADE_REPORT = "pct double, clade_count long, taxon_count long, rank string, taxid int, name string"
LINKOUT = "uniprot_id string, patric_id string"
SUBSYSTEMS = "superclass string, class string, subclass string, subsystem_name string, func string"
INTERMEDIATE = "patric_id string, role string, superclass string, class string, subclass string, subsystem_name string"
TREMBL = "uniprot string, func string"

#: Endings that make a file's kind, longest first where one holds another.
KINDS = {
    "tophit_report_subsystems_taxa": "_tophit_report_subsystems_taxa.gz",
    "tophit_report_subsystems": "_tophit_report_subsystems.gz",
    "tophit_report": "_tophit_report.gz",
    "tophit_aln": "_tophit_aln.gz",
    "lca_taxonomy": "_lca_taxonomy.tsv.gz",
    "lca": "_lca.tsv.gz",
    "report": "_report.gz",
}


def kind_of(path: str = "path") -> Column:
    """A file's kind by its ending; null for others."""
    out = F.lit(None).cast("string")
    for kind, ending in reversed(KINDS.items()):
        out = F.when(F.col(path).endswith(ending), kind).otherwise(out)
    return out


def sample_of(path: Column) -> Column:
    """Sample name of a path: the value of a last folder ``column=value`` (a plain one, without escapes), else the file's name up to its
    kind's ending, or without extensions."""
    name, folder = F.regexp_extract(path, r"([^/]+)$", 1), F.regexp_extract(path, r"/\w+=([^/]+)/[^/]+$", 1)
    endings = "|".join(e.replace(".", r"\.") for e in KINDS.values())
    return F.when(folder != "", folder).when(name.rlike(f"({endings})$"), F.regexp_replace(name, f"({endings})$", "")).otherwise(F.regexp_replace(name, r"(\.[A-Za-z]+)+$", ""))


def _refused(file: Column) -> Column:
    return F.raise_error(F.concat(file, F.lit(" is gzip but its name does not end in .gz: rename it, or read it with by_content=True")))


def _text(spark: SparkSession, path, by_content: bool = False, sep: str | None = None) -> DataFrame:
    """``file, block, value``: lines, or what stands between ``sep``, of files whose content agrees with their names (or of any, by content)."""
    if by_content:
        return in_ranges(spark, TextSource, path).select("file", F.lit(0).cast("long").alias("block"), "value")
    rows = (spark.read.option("lineSep", sep) if sep else spark.read).text(path)
    # a gzip file's first line begins with these bytes, no text does
    gzip = F.substring(F.col("value").cast("binary"), 1, 3) == F.lit(bytearray(b"\x1f\x8b\x08"))
    file = F.col("_metadata.file_path")
    return rows.select(file.alias("file"), F.col("_metadata.file_block_start").alias("block"), F.when(gzip, _refused(file)).otherwise(F.col("value")).alias("value"))


def _table(spark: SparkSession, path, schema: str, comment: str | None = None, by_content: bool = False) -> DataFrame:
    options = {"sep": "\t", "quote": "", "mode": "PERMISSIVE"}
    if by_content:
        rows = _text(spark, path, True)
        rows = rows.where(~F.col("value").startswith(comment)) if comment else rows
        # the delimiter stays the lines' own
        return rows.select(sample_of(F.col("file")).alias("sample_id"), F.from_csv("value", schema, options).alias("x")).select("sample_id", "x.*")
    reader = spark.read.schema(schema).options(**options)
    rows = (reader.option("comment", comment) if comment else reader).csv(path)
    (first, *rest), file = [c for c in rows.columns if c != "sample_id"], F.col("_metadata.file_path")
    # the same bytes as text: the second is no UTF-8
    ok = F.when(F.col(first).cast("string").startswith("\x1f\ufffd\x08"), _refused(file)).otherwise(F.col(first)).alias(first)
    return rows.select(sample_of(file).alias("sample_id"), ok, *rest)


def _lines(spark: SparkSession, path) -> DataFrame:
    return _text(spark, path).select("file", "block", F.monotonically_increasing_id().alias("seen"), "value")


def numbered_lines(spark: SparkSession, path) -> DataFrame:
    """``file, row_no, value``: lines with their number in the file from 0, also where a file is split.

    Only the line counts of the splits are summed up in order, not the lines."""
    lines = _lines(spark, path)
    blocks = lines.groupBy("file", "block").agg(F.min("seen").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("file", "block", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return lines.join(blocks, ["file", "block"]).select("file", (F.col("seen") - F.col("first") + F.col("before")).alias("row_no"), "value")


def read_fastq(spark: SparkSession, path, range_bytes: int = RANGE, by_spark: bool | None = None) -> DataFrame:
    """Reads ``sample_id, read_id, header, seq, qual``; fails on records of another shape.

    Each byte range of a file finds its own first record, so nothing is shuffled; gzip is told by content. Paths that only Spark can open
    (``by_spark``; found out where it is not given) are read by lines that are numbered and put together."""
    paths = [path] if isinstance(path, str) else list(path)
    if by_spark or (by_spark is None and not reachable(paths)):
        rows = _fastq_of_lines(spark, path)
    else:
        rows = in_ranges(spark, FastqSource, paths, range_bytes)
    return rows.select(sample_of(F.col("file")).alias("sample_id"), F.split("header", " ")[0].alias("read_id"), "header", "seq", "qual")


def _fastq_of_lines(spark: SparkSession, path) -> DataFrame:
    lines = numbered_lines(spark, path).withColumn("record", F.floor(F.col("row_no") / 4)).withColumn("at", F.col("row_no") % 4)
    rows = lines.groupBy("file", "record").agg(*[F.max(F.when(F.col("at") == i, F.col("value"))).alias(c) for i, c in enumerate(("head", "seq", "plus", "qual"))])
    wrong = (
        F.when(F.coalesce(~F.col("head").startswith("@"), F.lit(True)), "a record does not start with @")
        .when(F.coalesce(~F.col("plus").startswith("+"), F.lit(True)), "a record has no + line")
        .when(F.coalesce(F.length("seq") != F.length("qual"), F.lit(True)), "sequence and quality differ in length")
    )
    head = F.when(wrong.isNull(), F.col("head")).otherwise(F.raise_error(F.concat(wrong, F.lit(" in "), F.col("file"))))
    return rows.select("file", F.substr(head, F.lit(2)).alias("header"), "seq", "qual")


def mate_of(name: Column) -> Column:
    """The name of a pair's second file, from that of its first: the first ``R1`` in it becomes ``R2``; null without one."""
    return F.when(name.contains("R1"), F.regexp_replace(name, r"^(.*?)R1", "$1R2"))


def read_ranks(spark: SparkSession, path: str) -> DataFrame:
    """All tables below a folder written by rank and sample, as one: ``taxon, count, rpm, rank, sample_id``."""
    return spark.read.schema("taxon string, count long, rpm double, rank string, sample_id string").option("sep", "\t").csv(path)


def read_fasta(spark: SparkSession, path, whole_id: bool = True) -> DataFrame:
    """Sequences ``sample_id, seq_id, header, seq`` with wrapped lines joined; fails on a file that has no header."""
    rows = _text(spark, path, sep="\n>").select("file", "value").where(F.trim("value") != "")
    # the first record of a file is the only one that still has its sign; a row for each file says whether there is one
    headed = rows.groupBy("file").agg(F.max(F.ltrim("value").startswith(">")).alias("headed"))
    rows = rows.join(headed, "file").withColumn("value", F.when(F.col("headed"), F.col("value")).otherwise(F.raise_error(F.concat(F.lit("no sequence header in "), F.col("file")))))
    text = F.regexp_replace("value", r"^\s*>", "")
    parts = F.split(text, "\n", 2)
    rows = rows.select("file", F.trim(parts[0]).alias("header"), F.regexp_replace(F.coalesce(F.get(parts, F.lit(1)), F.lit("")), r"\s", "").alias("seq"))
    name = F.when(F.col("header") != "", F.col("header")).otherwise(F.raise_error(F.concat(F.lit("a sequence has no header in "), F.col("file"))))
    return rows.select(sample_of(F.col("file")).alias("sample_id"), (name if whole_id else F.split(name, r"\s")[0]).alias("seq_id"), "header", "seq")


def read_sam(spark: SparkSession, path, by_content: bool = False) -> tuple[DataFrame, DataFrame]:
    """Alignments, and the ``@SQ`` header lines, of SAM text."""
    lines = _text(spark, path, by_content).select(sample_of(F.col("file")).alias("sample_id"), "value")
    c = F.split("value", "\t")
    rows = lines.where(~F.col("value").startswith("@")).select("sample_id", c[0].alias("read_id"), c[1].cast("int").alias("flag"), c[2].alias("rname"), c[3].cast("long").alias("pos"), c[4].cast("int").alias("mapq"), F.get(c, F.lit(9)).alias("seq"), F.get(c, F.lit(10)).alias("qual"))
    return rows, lines.where(F.col("value").startswith("@SQ"))


def read_tophit_report(spark: SparkSession, path, by_content: bool = False) -> DataFrame:
    return _table(spark, path, TOPHIT_REPORT, by_content=by_content)


def read_tophit_aln(spark: SparkSession, path, by_content: bool = False) -> DataFrame:
    return _table(spark, path, TOPHIT_ALN, by_content=by_content)


def read_lca(spark: SparkSession, path, lineage: bool = True, by_content: bool = False) -> DataFrame:
    """Labels of reads; with ``lineage`` its text is the last column, whatever their number."""
    c = F.split("value", "\t")
    rows = _text(spark, path, by_content).select(sample_of(F.col("file")).alias("sample_id"), "value")
    out = rows.select("sample_id", c[0].alias("dna_id"), c[1].try_cast("int").alias("taxid"), F.get(c, F.lit(2)).alias("rank"), F.get(c, F.lit(3)).alias("name"), *([F.element_at(c, -1).alias("lineage")] if lineage else []))
    return out


def read_annotated(spark: SparkSession, path, form: str | None = None, by_content: bool = False) -> DataFrame:
    """Annotated hits of either format, told apart row by row: the weight is in the 14th column, or else the 15th.

    ``form``: "v2" (weight in the 14th column) or "v1" where it is known. Rows of fewer than 14 columns are left out."""
    c = F.split("value", "\t", -1)
    rows = _text(spark, path, by_content).select(sample_of(F.col("file")).alias("sample_id"), c.alias("c")).where(F.size("c") >= 14)
    at13, at14 = F.get("c", F.lit(13)).try_cast("double"), F.get("c", F.lit(14)).try_cast("double")
    second = at13.isNotNull() if form is None else F.lit(form == "v2")
    weight = F.when(second, at13).otherwise(at14)
    lineage = F.nullif(F.get("c", F.when(second, 14).otherwise(15)), F.lit(""))
    names = ("func", "superclass", "class", "subclass", "subsystem_name")
    return rows.select(
        "sample_id",
        F.get("c", F.lit(0)).alias("uniref_id"),
        F.get("c", F.lit(1)).try_cast("long").alias("n_aligned"),
        F.get("c", F.lit(5)).try_cast("int").alias("taxid"),
        F.get("c", F.lit(6)).alias("rank"),
        F.get("c", F.lit(7)).alias("name"),
        *[F.nullif(F.get("c", F.lit(8 + i)), F.lit("")).alias(n) for i, n in enumerate(names)],
        weight.alias("weight"),
        lineage.alias("lineage"),
    )


def read_report(spark: SparkSession, path) -> DataFrame:
    """Clade reports with their row numbers; hit reports among the files are left out."""
    c = F.split("value", "\t")
    rows = numbered_lines(spark, path).where(~F.col("file").endswith("_tophit_report.gz"))
    return rows.select(sample_of(F.col("file")).alias("sample_id"), "row_no", c[0].try_cast("double").alias("pct"), c[1].try_cast("long").alias("clade_count"), c[2].try_cast("long").alias("taxon_count"), c[3].alias("rank"), c[4].try_cast("int").alias("taxid"), c[5].alias("name"))


def read_flagstat(spark: SparkSession, path) -> DataFrame:
    """Mapped and total reads from lines of JSON, one object by sample each; lines that are none are left out."""
    kind = "map<string, struct<`QC-passed reads`: struct<mapped: long, total: long, `mapped %`: double>>>"
    rows = _text(spark, path).select(F.explode(F.from_json("value", kind)).alias("sample_id", "x"))
    x = F.col("x.`QC-passed reads`")
    return rows.select("sample_id", x["mapped"].alias("mapped"), x["total"].alias("total"), x["mapped %"].alias("mapped_pct"))


def read_linkout(spark: SparkSession, path) -> DataFrame:
    """Protein and gene ids, trimmed; blank ones and a header row are left out."""
    rows = spark.read.schema(LINKOUT).option("sep", "\t").option("quote", "").csv(path)
    rows = rows.select(F.trim("uniprot_id").alias("uniprot_id"), F.trim("patric_id").alias("patric_id")).where("uniprot_id <> '' and patric_id <> ''")
    return rows.where(~(F.lower("uniprot_id").isin("uniprot_id", "uniprot", "uniprotkb") | F.lower("patric_id").isin("patric_id", "patric")))


def read_genome_subsystems(spark: SparkSession, path) -> DataFrame:
    """Subsystem tables of genomes: columns 3 and 7 to 11 of rows with 11 columns at least."""
    c = F.split("value", "\t", -1)
    rows = _text(spark, path).where(F.size(c) >= 11)
    names = {"patric_id": 2, "role": 6, "superclass": 7, "class": 8, "subclass": 9, "subsystem_name": 10}
    return rows.select(*[F.nullif(F.trim(c[i]), F.lit("")).alias(n) for n, i in names.items()])


def read_intermediate(spark: SparkSession, path) -> DataFrame:
    """Gene, role and hierarchy; comment lines and rows of fewer than two columns are left out."""
    rows = spark.read.schema(INTERMEDIATE).option("sep", "\t").option("quote", "").option("comment", "#").csv(path)
    return rows.where("role is not null").select("patric_id", *[F.nullif(F.trim(c), F.lit("")).alias(c) for c in rows.columns[1:]])


def read_trembl(spark: SparkSession, path) -> DataFrame:
    return spark.read.schema(TREMBL).option("sep", "\t").option("quote", "").csv(path)


def read_subsystems(spark: SparkSession, path) -> DataFrame:
    return spark.read.schema(SUBSYSTEMS).option("sep", "\t").option("quote", "").csv(path)


def read_taxonomy_dump(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Tables ``nodes`` (with scientific names), ``merged`` and ``delnodes`` of a taxonomy dump."""

    def rows(name):
        return spark.read.text(f"{folder}/{name}.dmp").select(F.transform(F.split("value", r"\|"), lambda x: F.trim(x, F.lit("\t "))).alias("c"))

    c = lambda i: F.get("c", F.lit(i))
    nodes = rows("nodes").select(c(0).cast("int").alias("taxid"), c(1).cast("int").alias("parent"), c(2).alias("rank"))
    names = rows("names").where(c(3) == "scientific name").groupBy(c(0).cast("int").alias("taxid")).agg(F.min(c(1)).alias("name"))
    return {
        "nodes": nodes.join(names, "taxid", "left"),
        "merged": rows("merged").select(c(0).cast("int").alias("old"), c(1).cast("int").alias("new")),
        "delnodes": rows("delnodes").select(c(0).cast("int").alias("taxid")),
    }


def read_clusters(spark: SparkSession, path) -> DataFrame:
    """Cluster and contig, without comment and header lines, numbered so that the last row can win."""
    c = F.split("value", "\t")
    rows = numbered_lines(spark, path).where(~F.col("value").startswith("#") & ~F.col("value").startswith("clustername"))
    return rows.where(F.size(c) >= 2).select(c[0].alias("cluster_id"), c[1].alias("contig_id"), "row_no")


def read_metadata(spark: SparkSession, path) -> DataFrame:
    return spark.read.schema("old string, new string").option("sep", "\t").csv(path).where("new is not null")


def read_groups(spark: SparkSession, path) -> DataFrame:
    """Groups and the patterns of their files; lines that hold "Sample" are headers."""
    rows = spark.read.text(path).where(~F.col("value").contains("Sample"))
    c = F.split("value", "\t")
    return rows.where(F.size(c) >= 2).select(c[0].alias("group"), F.trim(c[1]).alias("pattern"))


def read_matrix(spark: SparkSession, path, category: str = "category") -> DataFrame:
    """A matrix of samples by category back in long form."""
    wide = spark.read.option("sep", "\t").option("header", True).csv(path)
    first, samples = wide.columns[0], wide.columns[1:]
    out = wide.unpivot(F.col(f"`{first}`"), [F.col(f"`{s}`") for s in samples], "sample_id", "value")
    return out.select("sample_id", F.col(f"`{first}`").alias(category), F.col("value").cast("double").alias("value"))


def best_files(files: DataFrame) -> DataFrame:
    """Of each sample's annotated files ``(path)`` the one with lineages, else the plain one."""
    rows = files.withColumn("kind", kind_of()).where(F.col("kind").startswith("tophit_report_subsystems"))
    rows = rows.withColumn("sample_id", sample_of(F.col("path")))
    return rows.groupBy("sample_id").agg(F.max_by("path", F.struct(F.length("kind"), "path")).alias("path"))
