"""Registered queries that write a view in the formats of the tools, and read it back by the scans.

Files lie in the shared folder, in a folder of their own for each run. ``FILES`` lists (name, query, views, SQL): the SQL says what the
view holds, so it knows nothing of files.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mudlark.functions.checkpoints import checkpointed, shared_folder
from mudlark.operators import profile, refdb
from mudlark.plans.fixtures import view
from mudlark.sources import readers, sinks
from mudlark.streaming.ingest import ingest_hits


def _folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/files-{uuid.uuid4().hex}"


def _tabbed(*columns: Column | str) -> Column:
    """Fields of a line; a null is an empty one."""
    return F.concat_ws("\t", *[F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in columns]).alias("value")


def _put(spark: SparkSession, lines: DataFrame, by: str | None = "sample_id", compression: str = "gzip") -> str:
    path = _folder(spark)
    sinks.write_lines(lines, path, by, compression)
    return path


# --- sequences ---------------------------------------------------------------------------------------------


def _fastq(spark: SparkSession, sf_dir: str, compression: str, by_spark: bool) -> DataFrame:
    path = _folder(spark)
    rows = view(spark, sf_dir, "fx_seqs").withColumn("qual", F.expr("repeat('@', length(seq))"))
    sinks.write_fastq(rows, path, compression, by="sample_id")
    rows = readers.read_fastq(spark, path, by_spark=by_spark)
    return rows.select("sample_id", "read_id", "header", F.md5("seq").alias("seq_md5"), F.length("qual").alias("n"))


FASTQ = "select sample_id, split_part(header, ' ', 1) as read_id, header, md5(seq) as seq_md5, cast(length(seq) as int) as n from fx_seqs"


def _fasta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences wrapped at 60 letters."""
    path = _folder(spark)
    rows = view(spark, sf_dir, "fx_seqs").withColumn("seq", F.regexp_replace("seq", "(.{60})", "$1\n"))
    sinks.write_fasta(rows, path, "header", by="sample_id")
    return readers.read_fasta(spark, path, whole_id=False).select("sample_id", "seq_id", "header", F.md5("seq").alias("seq_md5"), F.length("seq").alias("n"))


def _clusters_of_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _folder(spark)
    rows = view(spark, sf_dir, "fx_seqs").select(F.col("sample_id").alias("cluster_id"), F.split("header", " ")[0].alias("seq_id"), "seq")
    sinks.write_by_cluster(rows, path)
    return readers.read_fasta(spark, path).select(F.col("sample_id").alias("cluster_id"), "seq_id", F.md5("seq").alias("seq_md5"))


SAM_COLUMNS = ("sample_id", "read_id", "flag", "rname", "pos", "mapq", "seq", "qual")


def _sam(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = view(spark, sf_dir, "fx_sam")
    lines = rows.select("sample_id", _tabbed("read_id", "flag", "rname", "pos", "mapq", F.lit("4M"), F.lit("*"), F.lit(0), F.lit(0), "seq", "qual"))
    heads = rows.select("sample_id", "rname").distinct().select("sample_id", _tabbed(F.lit("@SQ"), F.concat(F.lit("SN:"), "rname")))
    return readers.read_sam(spark, _put(spark, heads.union(lines)))


# --- hits, labels, reports ---------------------------------------------------------------------------------

REPORT_COLUMNS = ("uniref_id", "n_aligned", "unique_cov", "target_cov", "identity", "taxid", "rank", "name")


def _report_files(spark: SparkSession, sf_dir: str) -> str:
    return _put(spark, view(spark, sf_dir, "fx_report_rows").select("sample_id", _tabbed(*REPORT_COLUMNS)))


def _alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.lit(0)
    lines = view(spark, sf_dir, "fx_aln_rows").select("sample_id", _tabbed("dna_id", "uniref_id", "percent_identity", "alignment_length", "gaps", n, n, n, n, n, F.lit("1.2E-23"), "bitscore"))
    return readers.read_tophit_aln(spark, _put(spark, lines)).select("sample_id", "dna_id", "uniref_id", "percent_identity", "alignment_length", "gaps", "evalue", "bitscore")


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of two lengths: the lineage is the last field of either."""
    rows = view(spark, sf_dir, "fx_lca").join(view(spark, sf_dir, "fx_lineage"), "taxid")
    n = F.lit(1)
    short, long = (_tabbed("dna_id", "taxid", F.lit("clade"), "name", *more, "lineage") for more in ((), (n, n, n, n)))
    lines = rows.select("sample_id", F.when(F.col("taxid") % 2 == 0, short).otherwise(long).alias("value"))
    return readers.read_lca(spark, _put(spark, lines))


ANNOTATED_COLUMNS = ("sample_id", "uniref_id", "n_aligned", "taxid", "func", "superclass", "subsystem_name", "weight", "lineage")


def _annotated(spark: SparkSession, sf_dir: str, form: str | None) -> DataFrame:
    """Both formats in the same files, told apart by row; or one of them, with a field that would mislead where it is not given. Every seventh
    line is cut short."""
    zero, none = F.lit(0.5), F.lit("x")
    head = ("uniref_id", "n_aligned", zero, zero, zero, "taxid", F.lit("species"), none, "func", "superclass", none, none, "subsystem_name")
    second, first = _tabbed(*head, "weight", "lineage"), _tabbed(*head, "size" if form else "func", "weight", "lineage")
    line = first if form else F.when(F.col("form") % 2 == 0, second).otherwise(first)
    line = F.when(F.col("form") == 7, F.substring_index(line, "\t", 13)).otherwise(line)
    lines = view(spark, sf_dir, "fx_annotated").select("sample_id", line.alias("value"))
    return readers.read_annotated(spark, _put(spark, lines), form).select(*ANNOTATED_COLUMNS)


ANNOTATED = "select sample_id, uniref_id, n_aligned, taxid, func, superclass, subsystem_name, weight, nullif(lineage, '') as lineage from fx_annotated where form <> 7"


def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = profile.check_lineages(_annotated(spark, sf_dir, None).where("lineage is not null"))
    return rows.groupBy("sample_id", "lineage").agg(F.count("*").alias("n"), F.sum("n_aligned").alias("hits"))


def _clade_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report has an order, so each is one file."""
    rows = view(spark, sf_dir, "fx_report").repartition("sample_id").sortWithinPartitions("sample_id", "row_no")
    lines = rows.select("sample_id", _tabbed(F.lit("1.5"), "clade_count", F.lit(2), "rank", F.col("row_no") % 1000000, F.concat(F.lit("  "), "name")))
    rows = readers.read_report(spark, _put(spark, lines))
    return rows.select("sample_id", "row_no", "pct", "clade_count", "taxon_count", "rank", "taxid", F.trim("name").alias("name"))


def _flag_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One object for each sample, and a line that is none."""
    sums = view(spark, sf_dir, "fx_flagstat").groupBy("sample_id").agg(F.coalesce(F.sum("mapped"), F.lit(0)).alias("mapped"), F.count("*").alias("total"))
    value = F.create_map("sample_id", F.struct(F.struct("mapped", "total", F.lit(75.5).alias("mapped %")).alias("QC-passed reads")))
    lines = sums.select(F.explode(F.array(F.to_json(value), F.lit("not json"))).alias("value"))
    return readers.read_flagstat(spark, _put(spark, lines, None))


# --- reference tables --------------------------------------------------------------------------------------


def _linkout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With spaces around ids, a header and rows without an id."""
    rows = view(spark, sf_dir, "fx_linkout").select(_tabbed(F.concat(F.lit(" "), "uniprot_id"), F.concat("patric_id", F.lit(" "))))
    odd = view(spark, sf_dir, "fx_linkout").select(F.explode(F.array(F.lit("UniProt_ID\tPATRIC_ID"), _tabbed(F.lit(" "), "patric_id"), _tabbed("uniprot_id", F.lit("")))).alias("value"))
    return readers.read_linkout(spark, _put(spark, rows.union(odd), None)).groupBy("uniprot_id", "patric_id").agg(F.count("*").alias("n"))


def _genome_subsystems(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = F.lit("x")
    whole = _tabbed(x, x, F.concat(F.lit("fig|"), "func"), x, x, x, "func", "superclass", F.lit(" "), "subclass", "subsystem_name")
    lines = view(spark, sf_dir, "fx_subsystems").select(F.explode(F.array(whole, _tabbed(x, "func"))).alias("value"))
    return readers.read_genome_subsystems(spark, _put(spark, lines, None))


def _intermediate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "fx_subsystems")
    whole = _tabbed(F.concat(F.lit("fig|"), "func"), "func", "superclass", F.lit(""), "subclass", "subsystem_name")
    lines = rows.select(F.explode(F.array(whole, F.concat(F.lit("#"), "func"), F.concat(F.lit("fig|"), "func"))).alias("value"))
    return readers.read_intermediate(spark, _put(spark, lines, None))


def _taxonomy_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes with their scientific names, merged and deleted ones as one table."""
    folder, nodes = _folder(spark), view(spark, sf_dir, "fx_nodes")
    row = lambda *c: F.concat(F.concat_ws("\t|\t", *[(F.col(x) if isinstance(x, str) else x).cast("string") for x in c]), F.lit("\t|")).alias("value")
    put = lambda df, name: sinks.write_lines(df, f"{folder}/{name}.dmp", compression="none")
    put(nodes.select(row("taxid", "parent", "rank")), "nodes")
    put(nodes.select(F.explode(F.array(row("taxid", "name", F.lit(""), F.lit("scientific name")), row("taxid", F.lit("a name"), F.lit(""), F.lit("common name")))).alias("value")), "names")
    put(nodes.where("taxid % 3 = 0").select(row(F.col("taxid") + 500000, "taxid")), "merged")
    put(nodes.where("taxid % 3 = 1").select(row(F.col("taxid") + 600000)), "delnodes")
    got = readers.read_taxonomy_dump(spark, folder)
    none = F.lit(None).cast("string")
    merged = got["merged"].select(F.lit("merged").alias("kind"), F.col("old").alias("taxid"), F.col("new").alias("parent"), none.alias("rank"), none.alias("name"))
    deleted = got["delnodes"].select(F.lit("deleted"), "taxid", F.lit(None).cast("int"), none, none)
    return got["nodes"].select(F.lit("node").alias("kind"), "taxid", "parent", "rank", "name").unionByName(merged).union(deleted)


def _cluster_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each contig twice in its file, with its cluster last; header and comment lines between. A contig's lines are one value, so they stay
    together whichever of a sample's files they come to."""
    block = F.concat_ws("\n", F.lit("clustername\tcontigname"), _tabbed(F.lit("earlier"), "contig_id"), F.lit("# comment"), _tabbed("cluster_id", "contig_id"))
    lines = view(spark, sf_dir, "fx_contigs").select("sample_id", block.alias("value"))
    return readers.read_clusters(spark, _put(spark, lines)).groupBy("contig_id").agg(F.max_by("cluster_id", "row_no").alias("cluster_id"))


def _lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Renaming and group lists as one table."""
    metadata = view(spark, sf_dir, "fx_metadata").select(F.explode(F.array(_tabbed("old", "new"), F.col("old"))).alias("value"))
    groups = view(spark, sf_dir, "fx_groups").select(F.explode(F.array(F.lit("Group\tSample"), _tabbed("bin_group", F.concat("pattern", F.lit(" "))))).alias("value"))
    renames = readers.read_metadata(spark, _put(spark, metadata, None)).select(F.lit("name").alias("kind"), F.col("old").alias("a"), F.col("new").alias("b"))
    return renames.union(readers.read_groups(spark, _put(spark, groups, None)).select(F.lit("group"), "group", "pattern"))


# --- matrices and tables -----------------------------------------------------------------------------------


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "fx_report_rows").groupBy("sample_id", F.col("uniref_id").alias("category")).agg(F.sum("n_aligned").alias("total"))


CELLS = "select sample_id, uniref_id as category, cast(sum(n_aligned) as bigint) as total from fx_report_rows group by 1, 2"


def _matrix_read_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _folder(spark)
    sinks.write_matrix(sinks.matrix(_cells(spark, sf_dir), "total"), path)
    return readers.read_matrix(spark, path).where("value > 0")


def _commented_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _folder(spark)
    sinks.write_matrix(sinks.matrix(_cells(spark, sf_dir).where("sample_id in ('S0', 'S1')"), "total", samples=["S0", "S1"], label="protein"), path, "counts")
    return spark.read.text(path)


def _rank_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "fx_report_rows").groupBy("sample_id", F.concat(F.lit("r"), F.col("taxid") % 3).alias("rank"), F.col("uniref_id").alias("taxon")).agg(F.sum("n_aligned").alias("count"))
    path = _folder(spark)
    sinks.write_ranks(rows.select("taxon", "count", (F.col("count") / 4).alias("rpm"), "rank", "sample_id"), path)
    return readers.read_ranks(spark, path)


def _loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads of half of the samples, of the others, and of a part once more, into one table; then what is in it."""
    rows, name = view(spark, sf_dir, "fx_report_rows"), f"load_{uuid.uuid4().hex}"
    try:
        for part in ("sample_id < 'S4'", "sample_id >= 'S4'", "sample_id between 'S2' and 'S5'"):
            sinks.save(rows.where(part), name)
        return checkpointed(spark.table(name).groupBy("sample_id", "uniref_id").agg(F.count("*").alias("n"), F.sum("n_aligned").alias("hits")))
    finally:
        spark.sql(f"drop table if exists {name}")


def _lineage_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.lineage_columns(_annotated(spark, sf_dir, None)).select("sample_id", "uniref_id", "n_aligned", "kingdom", "phylum", "species")


def _resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that had done the genomes of one protein goes on with the rest, from its file."""
    rows = view(spark, sf_dir, "fx_linkout").withColumn("genome", refdb.genome_of()).groupBy("genome").agg(F.count("*").alias("n"))
    path = _folder(spark)
    rows.where("n > 2").withColumn("run", F.lit(1)).write.parquet(path)
    return refdb.resumed(rows, spark.read.parquet(path), ["genome"], lambda todo: todo.withColumn("run", F.lit(2)))


def _file_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "fx_paths")
    return rows.select("path", readers.kind_of().alias("kind"), readers.sample_of(F.col("path")).alias("sample_id"), readers.mate_of(F.col("path")).alias("mate"))


def ingested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits by sample and superclass after two runs over a folder into which files came between: the first half of the samples, then
    the rest."""
    source, out, kept = _folder(spark), _folder(spark), _folder(spark)
    lines = view(spark, sf_dir, "fx_hits").select("sample_id", _tabbed("uniref_id", "n_aligned", F.lit(0.5), F.lit(0.5), F.lit(0.5), "taxid", F.lit("species"), F.lit("x")))
    trembl, subsystems = view(spark, sf_dir, "fx_trembl"), view(spark, sf_dir, "fx_subsystems")
    for half in ("sample_id < 'S4'", "sample_id >= 'S4'"):
        lines.where(half).write.mode("append").partitionBy("sample_id").option("compression", "gzip").text(source)
        ingest_hits(spark, source, out, kept, trembl, subsystems).awaitTermination()
    return spark.read.parquet(out).groupBy("sample_id", "superclass").agg(F.count("*").alias("n"), F.round(F.sum("weight"), 6).alias("weight"))


INGESTED = " select sample_id, superclass, count(*) as n, round(sum(weight), 6) as weight from ann group by 1, 2"

FILES = [
    ("scan_fastq", lambda s, d: _fastq(s, d, "none", False), "fx_seqs", FASTQ),
    ("scan_fastq_gzip_by_lines", lambda s, d: _fastq(s, d, "gzip", True), "fx_seqs", FASTQ),
    ("scan_fasta", _fasta, "fx_seqs", "select sample_id, split_part(header, ' ', 1) as seq_id, rtrim(header) as header, md5(seq) as seq_md5, cast(length(seq) as int) as n from fx_seqs"),
    ("scan_fasta_by_cluster", _clusters_of_sequences, "fx_seqs", "select sample_id as cluster_id, split_part(header, ' ', 1) as seq_id, md5(seq) as seq_md5 from fx_seqs"),
    ("scan_sam", lambda s, d: _sam(s, d)[0], "fx_sam", f"select {', '.join(SAM_COLUMNS)} from fx_sam"),
    ("scan_sam_targets", lambda s, d: _sam(s, d)[1], "fx_sam", "select distinct sample_id, concat('@SQ', chr(9), 'SN:', rname) as value from fx_sam"),
    ("scan_hit_report", lambda s, d: readers.read_tophit_report(s, _report_files(s, d)), "fx_report_rows", "select * from fx_report_rows"),
    ("scan_hit_report_by_content", lambda s, d: readers.read_tophit_report(s, _report_files(s, d), by_content=True), "fx_report_rows", "select * from fx_report_rows"),
    ("scan_alignment_table", _alignments, "fx_aln_rows", "select sample_id, dna_id, uniref_id, percent_identity, alignment_length, gaps, cast('1.2E-23' as double) as evalue, bitscore from fx_aln_rows"),
    ("scan_labels", _labels, "fx_lca fx_lineage", "select sample_id, dna_id, cast(fx_lca.taxid as int) as taxid, 'clade' as rank, name, lineage from fx_lca join fx_lineage on fx_lineage.taxid = fx_lca.taxid"),
    ("scan_annotated", lambda s, d: _annotated(s, d, None), "fx_annotated", ANNOTATED),
    ("scan_annotated_fixed", lambda s, d: _annotated(s, d, "v1"), "fx_annotated", ANNOTATED),
    ("checked_lineages", _checked, "fx_annotated", "select sample_id, lineage, count(*) as n, cast(sum(n_aligned) as bigint) as hits from fx_annotated where form <> 7 and lineage <> '' group by 1, 2"),
    ("scan_clade_report", _clade_reports, "fx_report", """select sample_id, cast(row_number() over (partition by sample_id order by row_no) - 1 as bigint) as row_no, cast(1.5 as double) as pct, clade_count, cast(2 as bigint) as taxon_count, rank,
 cast(row_no % 1000000 as int) as taxid, trim(name) as name from fx_report"""),
    ("scan_flag_statistics", _flag_statistics, "fx_flagstat", "select sample_id, cast(coalesce(sum(mapped), 0) as bigint) as mapped, count(*) as total, cast(75.5 as double) as mapped_pct from fx_flagstat group by 1"),
    ("scan_linkout", _linkout, "fx_linkout", "select uniprot_id, patric_id, count(*) as n from fx_linkout group by 1, 2"),
    ("scan_genome_subsystems", _genome_subsystems, "fx_subsystems", "select concat('fig|', func) as patric_id, trim(func) as role, superclass, cast(null as varchar) as class, subclass, subsystem_name from fx_subsystems"),
    ("scan_intermediate", _intermediate, "fx_subsystems", "select concat('fig|', func) as patric_id, func as role, superclass, cast(null as varchar) as class, subclass, subsystem_name from fx_subsystems"),
    ("scan_taxonomy_dump", _taxonomy_dump, "fx_nodes", """select 'node' as kind, taxid, parent, rank, name from fx_nodes union all select 'merged', taxid + 500000, taxid, null, null from fx_nodes where taxid % 3 = 0
 union all select 'deleted', taxid + 600000, null, null, null from fx_nodes where taxid % 3 = 1"""),
    ("scan_clusters", _cluster_lists, "fx_contigs", "select distinct contig_id, cluster_id from fx_contigs"),
    ("scan_name_and_group_lists", _lists, "fx_metadata fx_groups", "select 'name' as kind, old as a, new as b from fx_metadata union all select 'group', bin_group, pattern from fx_groups"),
    ("scan_matrix", _matrix_read_again, "fx_report_rows", f"select sample_id, category, cast(total as double) as value from ({CELLS}) c"),
    ("matrix_with_comment", _commented_matrix, "fx_report_rows", f"""with c as ({CELLS}) select '# counts' as value union all select concat('protein', chr(9), 'S0', chr(9), 'S1') union all
 select concat(category, chr(9), coalesce(sum(total) filter (sample_id = 'S0'), 0), chr(9), coalesce(sum(total) filter (sample_id = 'S1'), 0)) from c where sample_id in ('S0', 'S1') group by category"""),
    ("matrix_transposed", lambda s, d: sinks.transposed(_cells(s, d), "total", ["UniRef50_P1", "UniRef50_P2", "UniRef50_none"], "category"), "fx_report_rows", f"""with c as ({CELLS}) select sample_id,
 cast(coalesce(sum(total) filter (category = 'UniRef50_P1'), 0) as bigint) as "UniRef50_P1", cast(coalesce(sum(total) filter (category = 'UniRef50_P2'), 0) as bigint) as "UniRef50_P2", cast(0 as bigint) as "UniRef50_none" from c group by 1"""),
    ("rank_tables", _rank_tables, "fx_report_rows", """select uniref_id as taxon, cast(sum(n_aligned) as bigint) as count, sum(n_aligned) / 4.0::double as rpm, concat('r', taxid % 3) as rank, sample_id
 from fx_report_rows group by uniref_id, taxid % 3, sample_id"""),
    ("loaded_by_sample", _loaded, "fx_report_rows", "select sample_id, uniref_id, count(*) as n, cast(sum(n_aligned) as bigint) as hits from fx_report_rows group by 1, 2"),
    ("lineage_table", _lineage_table, "fx_annotated", "select sample_id, uniref_id, n_aligned, split_part(lineage, ';', 1) as kingdom, split_part(lineage, ';', 2) as phylum, split_part(lineage, ';', 7) as species from fx_annotated where form <> 7 and lineage <> ''"),
    ("resumed_genomes", _resumed, "fx_linkout", "select genome, n, case when n > 2 then 1 else 2 end as run from (select regexp_extract(patric_id, '^fig\\|(.*?)\\.peg\\.', 1) as genome, count(*) as n from fx_linkout group by 1)"),
    ("file_kinds", _file_kinds, "fx_paths", """with k as (select path, regexp_extract(path, '(_tophit_report_subsystems_taxa|_tophit_report_subsystems|_tophit_report|_tophit_aln|_lca_taxonomy|_lca)(\\.tsv)?\\.gz$', 1) as k, split_part(path, '/', 2) as s from fx_paths)
 select path, nullif(substr(k, 2), '') as kind, case when k = '' then concat(s, '_R1') else s end as sample_id, case when k = '' then replace(path, '_R1', '_R2') end as mate from k"""),
    ("best_annotated_files", lambda s, d: readers.best_files(view(s, d, "fx_paths")), "fx_paths", """select sample_id, path from (select split_part(path, '/', 2) as sample_id, path, row_number() over (partition by split_part(path, '/', 2) order by length(path) desc) as r
 from fx_paths where contains(path, '_subsystems')) where r = 1"""),
]
