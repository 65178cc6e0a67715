"""Registered profiling queries over the fixture views, and the same rows as SQL.

A query whose result hangs on a hash of the engine has no SQL.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mudlark.functions.checkpoints import shared_folder
from mudlark.functions.skew import left_join_spread, tasks_for
from mudlark.operators import annotate as an
from mudlark.operators import bins, flow, profile, reads, refdb, taxonomy
from mudlark.plans import files
from mudlark.plans.fixtures import view, with_views
from mudlark.sources import sinks

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}
EXCLUDED_TAXA = ("C3;", "p__NATION_7")


def _register(name: str, query: Query, views: str = "", sql: str | None = None) -> None:
    _QUERIES[name] = query
    if sql is not None:
        _SQL[name] = with_views(views, sql)


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), 6) for c in columns})


# --- functional profiles -----------------------------------------------------------------------------------

HITS = "fx_hits fx_trembl fx_subsystems"
ANNOTATED = """with fun as (select uniprot as accession, min(func) as func from fx_trembl group by uniprot),
 nsub as (select func, count(*) as n from fx_subsystems group by func),
 ann as (select h.*, nullif(regexp_extract(h.uniref_id, '^UniRef[0-9]+_(\\w+)', 1), '') as accession, f.func, s.superclass, s.class, s.subclass, s.subsystem_name,
  h.n_aligned / coalesce(n.n, 1)::double as weight from fx_hits h
  left join fun f on f.accession = nullif(regexp_extract(h.uniref_id, '^UniRef[0-9]+_(\\w+)', 1), '')
  left join fx_subsystems s on s.func = f.func left join nsub n on n.func = s.func)"""
KEYS = {
    "class": "superclass",
    "level1": "class",
    "level2": "concat(class, '; ', subclass)",
    "subsystem": "subsystem_name",
    "all": "concat(superclass, '; ', class, '; ', subclass, '; ', subsystem_name)",
    "all_fn": "concat(superclass, '; ', class, '; ', subclass, '; ', subsystem_name, '; ', func)",
}


def _annotated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return an.annotate(*[view(spark, sf_dir, v) for v in HITS.split()])


def _functional(spark: SparkSession, sf_dir: str, level: str) -> DataFrame:
    return _rounded(profile.profile_of_hits(*[view(spark, sf_dir, v) for v in HITS.split()], [level]), "total", "norm_all", "norm_ss").drop("level")


_PROFILES = {}
for _level, _key in KEYS.items():
    _PROFILES[_level] = (
        ANNOTATED
        + f""", tot as (select sample_id, sum(weight) as a, sum(case when superclass <> '' then weight else 0 end) as s from ann group by sample_id)
 select ann.sample_id, {_key} as category, round(sum(weight), 6) as total, round(coalesce(sum(weight) / nullif(max(a), 0) * 1e6, 0), 6) as norm_all,
 round(coalesce(sum(weight) / nullif(max(s), 0) * 1e6, 0), 6) as norm_ss from ann join tot on tot.sample_id = ann.sample_id where superclass <> '' group by ann.sample_id, {_key}"""
    )
    _register(f"functional_profile_{_level}", partial(_functional, level=_level), HITS, _PROFILES[_level])


def _annotate_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = an.annotate(*[view(spark, sf_dir, v) for v in HITS.split()], view(spark, sf_dir, "fx_lineage"), digits=6)
    return rows.select("sample_id", "uniref_id", "n_aligned", "taxid", "func", *an.HIERARCHY, "weight", "lineage")


_register(
    "annotate_hits",
    _annotate_hits,
    HITS + " fx_lineage",
    ANNOTATED + f" select sample_id, uniref_id, n_aligned, ann.taxid, func, superclass, class, subclass, subsystem_name, round(weight, 6) as weight, coalesce(lineage, '{an.NO_LINEAGE}') as lineage from ann left join fx_lineage l on l.taxid = ann.taxid",
)


def _excluding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = profile.profile_of_hits_excluding(*[view(spark, sf_dir, v) for v in HITS.split()], view(spark, sf_dir, "fx_lineage"), EXCLUDED_TAXA)
    return _rounded(rows, "total", "norm_all", "norm_ss")


_EXCLUDE = " or ".join(f"contains(coalesce(lineage, ''), '{t}')" for t in EXCLUDED_TAXA)
_register(
    "functional_profile_excluding",
    _excluding,
    HITS + " fx_lineage",
    ANNOTATED
    + f""", lin as (select ann.*, lineage from ann left join fx_lineage l on l.taxid = ann.taxid),
 tot as (select sample_id, sum(weight) as a, sum(case when superclass <> '' and not ({_EXCLUDE}) then weight else 0 end) as s from lin group by sample_id),
 lev as ({" union all ".join(f"select sample_id, '{x}' as level, {k} as category, weight from lin where superclass <> '' and not ({_EXCLUDE})" for x, k in KEYS.items())})
 select lev.sample_id, level, category, round(sum(weight), 6) as total, round(coalesce(sum(weight) / nullif(max(a), 0) * 1e6, 0), 6) as norm_all,
 round(coalesce(sum(weight) / nullif(max(s), 0) * 1e6, 0), 6) as norm_ss from lev join tot on tot.sample_id = lev.sample_id group by lev.sample_id, level, category""",
)

# --- taxonomy ----------------------------------------------------------------------------------------------

LCA = "fx_lca fx_lineage"
PLACED = """with placed as (select sample_id, dna_id, string_split(lineage, ';') as t from fx_lca join fx_lineage on fx_lineage.taxid = fx_lca.taxid
 where fx_lca.taxid >= 3 and fx_lca.taxid <> 131567 and name <> 'unclassified'),
 path as (select sample_id, dna_id, r.i as i, array_to_string(t[1:r.i], ';') as taxon from placed, (select unnest([1, 2, 3, 4, 5, 6, 7]) as i) r),
 ranked as (select sample_id, dna_id, taxon, ['kingdom', 'phylum', 'class', 'order', 'family', 'genus', 'species'][i] as rank from path)"""
COUNTED = PLACED + """, tot as (select sample_id, count(*) as total from placed group by sample_id),
 counted as (select ranked.sample_id, rank, taxon, count(*) as count, round(count(*) / max(total) * 1e6, 6) as rpm from ranked join tot on tot.sample_id = ranked.sample_id group by ranked.sample_id, rank, taxon)"""


def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(taxonomy.taxonomy_counts(view(spark, sf_dir, "fx_lca"), view(spark, sf_dir, "fx_lineage")), "rpm")


_register("taxonomy_counts", _counts, LCA, COUNTED + " select * from counted")
_register("taxonomy_excluding", lambda s, d: taxonomy.without_taxa(_counts(s, d), EXCLUDED_TAXA), LCA, COUNTED + " select * from counted where not (" + " or ".join(f"contains(taxon, '{t}')" for t in EXCLUDED_TAXA) + ")")


SAMPLES = [f"S{i}" for i in range(8)]


def _matrix(spark: SparkSession, sf_dir: str, rank: str, value: str = "count") -> DataFrame:
    from mudlark.sources.sinks import matrix

    return matrix(_counts(spark, sf_dir).where(F.col("rank") == rank), value, "taxon", samples=SAMPLES)


def _wide(value: str, kind: str) -> str:
    return ", ".join(f"cast(sum(case when sample_id = '{s}' then {value} else 0 end) as {kind}) as {s}" for s in SAMPLES)


for _rank in taxonomy.RANKS:
    for _value, _kind, _name in (("count", "bigint", "taxonomy_matrix"), ("rpm", "double", "taxonomy_matrix_rpm")):
        _register(f"{_name}_{_rank}", partial(_matrix, rank=_rank, value=_value), LCA, COUNTED + f" select taxon, {_wide(_value, _kind)} from counted where rank = '{_rank}' group by taxon order by taxon")


def _functional_matrix(spark: SparkSession, sf_dir: str, level: str, value: str) -> DataFrame:
    from mudlark.sources.sinks import matrix

    return matrix(_functional(spark, sf_dir, level), value, samples=SAMPLES)


for _level in KEYS:
    for _value in ("total", "norm_all", "norm_ss"):
        _register(
            f"functional_matrix_{_level}_{_value}",
            partial(_functional_matrix, level=_level, value=_value),
            HITS,
            f"select category, {_wide(_value, 'double')} from ({_PROFILES[_level]}) p group by category order by category",
        )


def _from_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = view(spark, sf_dir, "fx_nodes")
    return taxonomy.lineages(nodes.select("taxid"), nodes)


_slot = lambda letter, *ranks: f"'{letter}__', coalesce(max(case when rank in ({', '.join(repr(r) for r in ranks)}) then name end), '')"
_register(
    "lineage_from_tree",
    _from_tree,
    "fx_nodes",
    f"""select taxid, concat({_slot("k", "domain", "acellular root", "superkingdom")}, ';', {_slot("p", "phylum")}, ';', {_slot("c", "class")}, ';', {_slot("o", "order")}, ';', {_slot("f", "family")}, ';', {_slot("g", "genus")}, ';', {_slot("s", "species")}) as lineage from up group by taxid""",
)
_SQL["lineage_from_tree"] = _SQL["lineage_from_tree"].replace("with fx_nodes as", "with recursive fx_nodes as").replace(
    ") select taxid, concat(",
    """), up as (select taxid, taxid as at, parent, rank, name from fx_nodes union all
 select u.taxid, n.taxid, n.parent, n.rank, n.name from up u join fx_nodes n on n.taxid = u.parent where u.parent <> u.at) select taxid, concat(""",
)

CONSENSUS = PLACED + """, frames as (select sample_id, regexp_extract(dna_id, '^(.*)-(orf[0-9]+)', 1) as contig, rank, taxon, count(*) as n from ranked group by 1, 2, 3, 4),
 consensus as (select sample_id, contig, rank, taxon, n, round(n / total, 6) as fraction from (select *, row_number() over (partition by sample_id, contig, rank order by n desc, taxon) as p,
 sum(n) over (partition by sample_id, contig, rank) as total from frames where contig <> '') where p = 1),
 per as (select sample_id, rank, taxon, count(*) as n from consensus group by 1, 2, 3)"""


def _consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxonomy.contig_consensus(view(spark, sf_dir, "fx_lca"), view(spark, sf_dir, "fx_lineage"))


_register("contig_consensus", lambda s, d: _rounded(_consensus(s, d), "fraction"), LCA, CONSENSUS + " select * from consensus")
_register(
    "dominant_taxon",
    lambda s, d: _rounded(taxonomy.dominant_taxon(_consensus(s, d)), "fraction"),
    LCA,
    CONSENSUS + " select sample_id, rank, taxon, round(n / total, 6) as fraction from (select *, row_number() over (partition by sample_id, rank order by n desc, taxon) as p, sum(n) over (partition by sample_id, rank) as total from per) where p = 1",
)
_register("contig_taxon_rpm", lambda s, d: _rounded(taxonomy.contig_taxon_rpm(_consensus(s, d)), "rpm"), LCA, CONSENSUS + " select sample_id, rank, taxon, n, round(n / sum(n) over (partition by sample_id, rank) * 1e6, 6) as rpm from per")

# --- reads -------------------------------------------------------------------------------------------------

_MASKS = " union all ".join(f"select '{o}' as output, {x} as x, {r} as r" for o, (x, r) in reads.FLAG_MASKS.items())
_register("host_split", lambda s, d: reads.host_split(view(s, d, "fx_align")).groupBy("sample_id", "output").agg(F.count("*").alias("n"), F.sum("read_id").alias("ids")), "fx_align", f"select sample_id, output, count(*) as n, cast(sum(read_id) as bigint) as ids from fx_align, ({_MASKS}) m where flag & x = 0 and flag & r = r group by 1, 2")
_register("host_split_rows", lambda s, d: reads.host_split(view(s, d, "fx_align"), ("host_r1", "nonhost_r1", "nonhost_r2")), "fx_align", f"select sample_id, read_id, flag, output from fx_align, ({_MASKS}) m where flag & x = 0 and flag & r = r and output in ('host_r1', 'nonhost_r1', 'nonhost_r2')")
_register("flagstat", lambda s, d: _rounded(reads.flagstat(view(s, d, "fx_align")), "mapped_pct"), "fx_align", "select sample_id, count(*) filter (flag & 4 = 0) as mapped, count(*) as total, round(count(*) filter (flag & 4 = 0) / count(*) * 100, 6) as mapped_pct from fx_align group by 1")


def _empty_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "fx_align").withColumn("sample_id", F.concat_ws("_", "sample_id", F.col("read_id").cast("string")))
    return reads.empty_samples(rows)


_register("empty_samples", _empty_samples, "fx_align", "select concat(sample_id, '_', cast(read_id as string)) as sample_id, count(*) as total from fx_align group by 1 having count(*) filter (flag & 4 = 0) = 0")
_register(
    "empty_samples_whole",
    lambda s, d: reads.empty_samples(view(s, d, "fx_align").withColumn("sample_id", F.concat_ws("_", "sample_id", F.col("read_id").cast("string")))),
    "fx_align",
    "select concat(sample_id, '_', cast(read_id as string)) as sample_id, count(*) as total from fx_align group by 1 having count(*) filter (flag & 4 = 0) = 0",
)
_register("read_qc", lambda s, d: view(s, d, "fx_reads").where(reads.passes_qc(40, 200, "n")).select("sample_id", "read_id"), "fx_reads", "select sample_id, read_id from fx_reads where length(seq) >= 200 and length(seq) - length(replace(seq, 'n', '')) <= 40")


def _reads_by_taxon(spark: SparkSession, sf_dir: str) -> DataFrame:
    lca = an.with_lineage(view(spark, sf_dir, "fx_lca"), view(spark, sf_dir, "fx_lineage"))
    found = view(spark, sf_dir, "fx_lca").select("sample_id", F.col("dna_id").alias("read_id"), "taxid")
    return reads.reads_by_taxon(found, lca, "g__G5;")


_register("reads_by_taxon", _reads_by_taxon, LCA, "select sample_id, dna_id as read_id, taxid from fx_lca a where exists (select 1 from fx_lca b join fx_lineage l on l.taxid = b.taxid where b.sample_id = a.sample_id and b.dna_id = a.dna_id and contains(lineage, 'g__G5;'))")
FATE = "case when not in_qc then 'failed fastp' when in_host then 'human' when in_nonhost and in_hit then 'uniref' when in_nonhost then 'unknown' else 'not sure' end"
_register("read_fate", lambda s, d: reads.fates(view(s, d, "fx_stage")).select("sample_id", "read_id", "fate"), "fx_stage", f"select sample_id, read_id, {FATE} as fate from fx_stage")


def _staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages as separate tables, put together again by their ids."""
    x = view(spark, sf_dir, "fx_stage")
    return reads.staged(raw=x, qc=x.where("in_qc"), host=x.where("in_host"), nonhost=x.where("in_nonhost"), hit=x.where("in_hit"))


_register("read_fate_staged", lambda s, d: reads.fates(_staged(s, d)), "fx_stage", f"select *, {FATE} as fate from fx_stage")
_register(
    "read_fate_summary",
    lambda s, d: reads.fate_summary(view(s, d, "fx_stage")),
    "fx_stage",
    f"select sample_id, count(*) as raw, count(*) filter (in_qc) as qc, count(*) filter (in_host) as host, count(*) filter (in_nonhost) as nonhost, count(*) filter (in_hit) as hit, count(*) filter ({FATE} = 'unknown') as unknown_reads, count(*) filter (in_nonhost) - count(*) filter (in_hit) as unknown from fx_stage group by 1",
)
_register("unknown_reads", lambda s, d: reads.unknown_reads(view(s, d, "fx_stage").select("sample_id", "read_id"), view(s, d, "fx_stage")), "fx_stage", f"select sample_id, read_id from fx_stage where {FATE} = 'unknown'")
STAGES = "select sample_id, 'raw' as stage from fx_stage union all select sample_id, 'trimmed' from fx_stage where in_qc union all select sample_id, 'host' from fx_stage where in_host union all select sample_id, 'nonhost' from fx_stage where in_nonhost"
_register("stage_counts", lambda s, d: flow.stage_counts(view(s, d, "fx_stage")), "fx_stage", f"select sample_id, stage, count(*) as n from ({STAGES}) group by 1, 2")
DOMAINS = ("AFRICA", "AMERICA", "ASIA", "EUROPE")


def _domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions stand for domains."""
    counts = taxonomy.taxonomy_counts(view(spark, sf_dir, "fx_lca"), view(spark, sf_dir, "fx_lineage")).where("rank = 'kingdom'")
    names = dict(zip(DOMAINS, flow.DOMAINS, strict=True))
    taxon = F.col("taxon")
    for a, b in names.items():
        taxon = F.replace(taxon, F.lit(a), F.lit(b))
    return flow.domain_totals(counts.withColumn("taxon", taxon))


_DOMAIN = "case " + " ".join(f"when contains(taxon, '{a}') then '{b}'" for a, b in zip(DOMAINS, flow.DOMAINS, strict=True)) + " else 'Multidomain' end"
_register("domain_totals", _domains, LCA, COUNTED + f" select {_DOMAIN} as domain, cast(sum(count) as bigint) as n from counted where rank = 'kingdom' group by 1")
_EDGES = (
    COUNTED
    + f""", d as (select {_DOMAIN} as domain, sum(count) as n from counted where rank = 'kingdom' group by 1),
 st as (select count(*) as raw, count(*) filter (in_qc) as trimmed, count(*) filter (in_host) as host, count(*) filter (in_nonhost) as nonhost from fx_stage),
 dd as (select coalesce(sum(n), 0) as sim, {", ".join(f"coalesce(sum(n) filter (domain = '{x}'), 0) as {x}" for x in (*flow.DOMAINS, "Multidomain"))} from d)
 select source, cast(n as bigint) as n, target from (
 select 'fastq' as source, trimmed as n, 'fastp' as target from st union all select 'fastq', raw - trimmed, 'low quality' from st union all
 select 'fastp', host, 'human' from st union all select 'fastp', nonhost, 'not human' from st union all select 'not human', sim, 'sequence similarity' from dd union all
 select 'not human', 100, '16S' union all select 'not human', nonhost - sim - 100, 'unknown' from st, dd union all select 'sequence similarity', Eukaryota, 'Eukaryote' from dd union all
 select 'sequence similarity', Bacteria, 'Bacteria' from dd union all select 'sequence similarity', Archaea, 'Archaea' from dd union all
 select 'sequence similarity', Virus, 'Virus' from dd union all select 'sequence similarity', Multidomain, 'Multiclass' from dd)"""
)
_register("flow_edges", lambda s, d: flow.flow_edges(flow.stage_counts(view(s, d, "fx_stage")), _domains(s, d), 100), LCA + " fx_stage", _EDGES)

_register(
    "flow_document",
    lambda s, d: flow.summary_document(flow.stage_counts(view(s, d, "fx_stage")), _domains(s, d), view(s, d, "fx_flagstat").groupBy("sample_id").agg(F.coalesce(F.sum("mapped"), F.lit(0)).alias("n")), "P"),
    LCA + " fx_stage fx_flagstat",
    COUNTED
    + f""", d as (select {_DOMAIN} as domain, sum(count) as n from counted where rank = 'kingdom' group by 1),
 per as (select sample_id, count(*) as fastq, count(*) filter (in_qc) as trimmed, count(*) filter (in_host) as host, count(*) filter (in_nonhost) as no_host from fx_stage group by 1),
 six as (select sample_id, cast(coalesce(sum(mapped), 0) as bigint) as n from fx_flagstat group by 1),
 st as (select cast(sum(fastq) as bigint) as fastq, cast(sum(trimmed) as bigint) as trimmed, cast(sum(host) as bigint) as host, cast(sum(no_host) as bigint) as no_host,
  string_agg(concat('"', sample_id, '":{{"fastq":', fastq, ',"trimmed":', trimmed, ',"host":', host, ',"no_host":', no_host, '}}'), ',' order by sample_id) as j from per),
 sx as (select cast(sum(n) as bigint) as n, string_agg(concat('"', sample_id, '":', n), ',' order by sample_id) as j from six),
 dd as (select cast(coalesce(sum(n), 0) as bigint) as sim, {", ".join(f"cast(coalesce(sum(n) filter (domain = '{x}'), 0) as bigint) as {x}" for x in (*flow.DOMAINS, "Multidomain"))} from d)
 select concat('{{"project":"P","raw_fastq":', fastq, ',"trimmed_fastq":', trimmed, ',"low_quality":', fastq - trimmed, ',"host":', host, ',"no_host":', no_host, ',"sixteen_s":', sx.n, ',"totalsims":', sim,
  ',"nosims":', no_host - sim - sx.n, ',"tax":{{"Bacteria":', Bacteria, ',"Archaea":', Archaea, ',"Eukaryota":', Eukaryota, ',"Viruses":', Virus, ',"Multidomain":', Multidomain, '}},"six_counts":{{', sx.j, '}},"count_data":{{', st.j, '}}}}') as value from st, sx, dd""",
)
_register(
    "flow_lines",
    lambda s, d: flow.flow_text(flow.flow_edges(flow.stage_counts(view(s, d, "fx_stage")), _domains(s, d), 100)),
    LCA + " fx_stage",
    _EDGES.replace("select source, cast(n as bigint) as n, target from (", "select concat(source, ' [', cast(n as bigint), '] ', target) as value from ("),
)

# --- top hits ----------------------------------------------------------------------------------------------

TOP = "fx_tophit fx_trembl fx_subsystems"
TOP_ROWS = """with fun as (select uniprot as accession, min(func) as func from fx_trembl group by uniprot),
 hit as (select t.sample_id, t.dna_id, t.uniref_id, t.row_no, f.func, s.superclass, s.class, s.subclass, s.subsystem_name from fx_tophit t
  left join fun f on f.accession = regexp_extract(t.uniref_id, '^UniRef[0-9]+_(\\w+)', 1) left join fx_subsystems s on s.func = f.func)"""
TOP_COLUMNS = ("sample_id", "dna_id", "uniref_id", "row_no", "func", *an.HIERARCHY)


def _top(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    return an.top_hits(*[view(spark, sf_dir, v) for v in TOP.split()], mode=mode).select(*TOP_COLUMNS)


_ORDER = "row_no, subsystem_name nulls first, superclass nulls first, class nulls first, subclass nulls first"
_PICK = " select " + ", ".join(TOP_COLUMNS) + " from (select *, row_number() over (partition by sample_id, dna_id order by {order}) as p from hit) where p = 1"
_register("top_hit_first", partial(_top, mode="f"), TOP, TOP_ROWS + _PICK.format(order=_ORDER).replace("from hit)", "from hit where superclass <> '')"))
_register("top_hit_top", partial(_top, mode="t"), TOP, TOP_ROWS + _PICK.format(order=_ORDER))
_register("top_hit_all", partial(_top, mode="a"), TOP, TOP_ROWS + " select * from hit")
_register("top_hit_subsystems", partial(_top, mode="s"), TOP, TOP_ROWS + " select * from hit where superclass <> ''")
_DRAW = "md5(concat_ws('|', '0', dna_id, uniref_id, cast(row_no as varchar), coalesce(superclass, ''), coalesce(class, ''), coalesce(subclass, ''), coalesce(subsystem_name, '')))"
_register("top_hit_random", partial(_top, mode="r"), TOP, TOP_ROWS + _PICK.format(order=_DRAW))

# --- 16S ---------------------------------------------------------------------------------------------------


def _flagstat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "fx_flagstat")
    return flow.sixteen_s_summary(rows.select("sample_id", F.coalesce("mapped", F.lit(0)).alias("mapped"), (F.coalesce("mapped", F.lit(0)) + 50).alias("total")))


SIXTEEN = "with s as (select sample_id, cast(sum(coalesce(mapped, 0)) as bigint) as mapped, cast(sum(coalesce(mapped, 0) + 50) as bigint) as total, round(sum(coalesce(mapped, 0)) / sum(coalesce(mapped, 0) + 50) * 100, 6) as mapped_pct from fx_flagstat group by 1)"
_register("sixteen_s_summary", lambda s, d: _rounded(_flagstat(s, d), "mapped_pct"), "fx_flagstat", SIXTEEN + " select * from s")
_register(
    "mapped_extremes",
    lambda s, d: flow.extremes(_rounded(_flagstat(s, d), "mapped_pct"), 3),
    "fx_flagstat",
    SIXTEEN + " select *, 'lowest' as side from (select * from s order by mapped_pct, sample_id limit 3) union all select *, 'highest' as side from (select * from s order by mapped_pct desc, sample_id limit 3)",
)

_register(
    "mapped_mean",
    lambda s, d: _rounded(flow.mean_mapped(_flagstat(s, d)), "mean_mapped_pct"),
    "fx_flagstat",
    SIXTEEN + " select count(*) as samples, round(avg(mapped / total * 100), 6) as mean_mapped_pct from s",
)

# --- reference tables --------------------------------------------------------------------------------------

STAR = "fx_linkout fx_trembl fx_subsystems"
STAR_ROWS = """with role as (select role, cast(dense_rank() over (order by role) as int) as role_id from (select distinct func as role from fx_subsystems)),
 sys as (select subsystem_name, h.superclass as superclass, h.class as class, h.subclass as subclass, cast(dense_rank() over (order by subsystem_name) as int) as subsystem_id from
  (select subsystem_name, min({'superclass': superclass, 'class': class, 'subclass': subclass}) as h from fx_subsystems group by 1)),
 pair as (select distinct role_id, subsystem_id from fx_subsystems f join role r on r.role = f.func join sys s on s.subsystem_name = f.subsystem_name),
 upr as (select distinct l.uniprot_id, l.patric_id, role_id from fx_linkout l join fx_linkout g on g.patric_id = l.patric_id join fx_trembl t on t.uniprot = g.uniprot_id join role r on r.role = t.func),
 acc as (select distinct subsystem_name, uniprot_id from sys join pair on pair.subsystem_id = sys.subsystem_id join upr on upr.role_id = pair.role_id)"""


_STORED: dict[tuple[str, str], str] = {}


def _star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The star of a directory's tables, stored once by a session in the shared folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STORED:
        prefix = f"star_{uuid.uuid4().hex}"
        sinks.store_star(_new_star(spark, sf_dir), prefix, shared_folder(spark))
        _STORED[key] = prefix
    return sinks.stored_star(spark, _STORED[key])


def _new_star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    linkout, trembl, subsystems = (view(spark, sf_dir, v) for v in STAR.split())
    tasks = tasks_for(linkout)
    named = left_join_spread(linkout, trembl.withColumnRenamed("uniprot", "uniprot_id"), "uniprot_id", tasks=tasks).where("func is not null")
    return refdb.star_schema(subsystems, linkout, named.select("patric_id", F.col("func").alias("role")), tasks)


def _hierarchy_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = _star(spark, sf_dir)
    return star["subsystems"].join(star["role_subsystems"], "subsystem_id").join(star["roles"], "role_id").select("superclass", "class", "subclass", "subsystem_name", "role").distinct()


def _whole_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = _star(spark, sf_dir)
    return star["role_subsystems"].join(star["roles"], "role_id").join(star["subsystems"], "subsystem_id")


_register("build_star_schema", _whole_star, STAR, STAR_ROWS + " select pair.role_id, pair.subsystem_id, role, subsystem_name, superclass, class, subclass from pair join role on role.role_id = pair.role_id join sys on sys.subsystem_id = pair.subsystem_id")
_register("accession_roles", lambda s, d: refdb.roles_of_accession(_star(s, d), "P77"), STAR, STAR_ROWS + " select u.uniprot_id, role, superclass, class, subclass, subsystem_name from (select distinct uniprot_id, role_id from upr where uniprot_id = 'P77') u join role on role.role_id = u.role_id join pair on pair.role_id = u.role_id join sys on sys.subsystem_id = pair.subsystem_id")
_register("subsystem_accessions", lambda s, d: refdb.accessions_of_subsystem(_star(s, d)), STAR, STAR_ROWS + " select * from acc")
_register("hierarchy_roles", _hierarchy_roles, STAR, STAR_ROWS + " select distinct superclass, class, subclass, subsystem_name, role from sys join pair on pair.subsystem_id = sys.subsystem_id join role on role.role_id = pair.role_id")
_register("roles_of_hierarchy", lambda s, d: refdb.roles_of_hierarchy(_star(s, d), "ECONOMY", "L1_0", "L2_8"), STAR, STAR_ROWS + " select distinct subsystem_name, role from sys join pair on pair.subsystem_id = sys.subsystem_id join role on role.role_id = pair.role_id where superclass = 'ECONOMY' and class = 'L1_0' and subclass = 'L2_8'")
_register("accessions_per_subsystem", lambda s, d: refdb.accessions_per_subsystem(_star(s, d)), STAR, STAR_ROWS + " select subsystem_name, count(*) as n_accessions from acc group by 1 order by 2 desc, 1")
_register("star_row_counts", lambda s, d: refdb.row_counts(_star(s, d)), STAR, STAR_ROWS + " select 'roles' as \"table\", count(*) as n from role union all select 'subsystems', count(*) from sys union all select 'role_subsystems', count(*) from pair union all select 'uniprot_patric_role', count(*) from upr")


def _merge_linkout_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    linkout, trembl = view(spark, sf_dir, "fx_linkout"), view(spark, sf_dir, "fx_trembl")
    annotation = linkout.join(trembl, F.col("uniprot_id") == F.col("uniprot")).select("patric_id", F.col("func").alias("role"))
    return refdb.merge_linkout(linkout, annotation)


for _name in ("merge_linkout", "merge_linkout_whole"):
    _register(_name, _merge_linkout_whole, "fx_linkout fx_trembl", "select a.patric_id, uniprot_id, role from (select patric_id, max(uniprot_id) as uniprot_id from fx_linkout group by 1) a join (select patric_id, max(func) as role from fx_linkout join fx_trembl on uniprot = uniprot_id group by 1) b on a.patric_id = b.patric_id order by 1")


def _pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    genomes = view(spark, sf_dir, "fx_linkout").withColumn("genome", refdb.genome_of())
    return refdb.pending(genomes.select("genome").distinct(), genomes.where("uniprot_id = 'P11'"), ["genome"])


_register("pending_genomes", _pending, "fx_linkout", "with g as (select regexp_extract(patric_id, '^fig\\|(.*?)\\.peg\\.', 1) as genome, uniprot_id from fx_linkout) select distinct genome from g where genome not in (select genome from g where uniprot_id = 'P11')")



def _resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Genomes of the first proteins are done; the work on the others counts their genes."""
    genes = view(spark, sf_dir, "fx_linkout").select(refdb.genome_of().alias("genome"), "patric_id").distinct()
    count = lambda todo: todo.join(genes, "genome").groupBy("genome").agg(F.count("*").alias("n_genes"), F.lit("new").alias("run"))
    done = count(genes.where("patric_id like '%.peg.7'").select("genome").distinct()).withColumn("run", F.lit("kept"))
    return refdb.resumed(genes.select("genome").distinct(), done, ["genome"], count)


_register(
    "resumed_genomes",
    _resumed,
    "fx_linkout",
    """with g as (select distinct regexp_extract(patric_id, '^fig\\|(.*?)\\.peg\\.', 1) as genome, patric_id from fx_linkout)
 select genome, count(*) as n_genes, case when count(*) filter (patric_id like '%.peg.7') > 0 then 'kept' else 'new' end as run from g group by 1""",
)

# --- contigs -----------------------------------------------------------------------------------------------

CLUSTERED = "with one as (select contig_id, max(cluster_id) as cluster_id from fx_contigs group by 1), c as (select f.sample_id, f.contig_id, f.len, one.cluster_id from fx_contigs f join one on one.contig_id = f.contig_id), l as (select cluster_id, count(*) as n_contigs, cast(sum(len) as bigint) as length from c group by 1)"


def _clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "fx_contigs")
    return bins.clustered(rows.drop("cluster_id"), rows.select("contig_id", "cluster_id"))


_register("concat_contigs", lambda s, d: bins.concatenated(view(s, d, "fx_contigs"), 2000).select("sample_id", "name", "len"), "fx_contigs", "select sample_id, concat('S', cast(dense_rank as string), 'C', contig_id) as name, len from (select *, dense_rank() over (order by sample_id) as dense_rank from fx_contigs) where len >= 2000")
_register("cluster_lengths", lambda s, d: bins.cluster_lengths(_clustered(s, d)), "fx_contigs", CLUSTERED + " select * from l")
_register("cluster_length_histogram", lambda s, d: bins.length_histogram(bins.cluster_lengths(_clustered(s, d))), "fx_contigs", CLUSTERED + " select length, count(*) as n from l group by 1")
_register("bins_min_size", lambda s, d: bins.long_clusters(_clustered(s, d), 750_000).select("sample_id", "contig_id", "cluster_id", "len"), "fx_contigs", CLUSTERED + " select sample_id, contig_id, cluster_id, len from c where cluster_id in (select cluster_id from l where length >= 750000)")
_register("cluster_lengths_by_sample", lambda s, d: bins.cluster_lengths(_clustered(s, d), ("sample_id", "cluster_id")), "fx_contigs", CLUSTERED + " select sample_id, cluster_id, count(*) as n_contigs, cast(sum(len) as bigint) as length from c group by 1, 2")

# --- reports, headers, names, graphs -----------------------------------------------------------------------

REPORT = """with seen as (select *, max(case when rank = 'phylum' then row_no end) over o as prow, max(case when rank = 'genus' then row_no end) over o as grow from fx_report
  window o as (partition by sample_id order by row_no)),
 clade as (select seen.sample_id, seen.row_no, concat(';p__', p.name, ';;;;', case when grow > prow then concat('g__', g.name) else '' end, ';s__', seen.name) as lineage, seen.clade_count from seen
  join fx_report p on p.sample_id = seen.sample_id and p.row_no = prow left join fx_report g on g.sample_id = seen.sample_id and g.row_no = grow where seen.rank = 'species')"""
_register("clade_table", lambda s, d: taxonomy.clade_table(view(s, d, "fx_report")), "fx_report", REPORT + " select * from clade")
_register(
    "report_counts",
    lambda s, d: taxonomy.report_counts(view(s, d, "fx_report")),
    "fx_report",
    REPORT + """ select sample_id, rank, concat(substr(rank, 1, 1), '__', name) as taxon, cast(sum(clade_count) as bigint) as count from fx_report group by 1, 2, 3
 union all select sample_id, 'all_levels', lineage, cast(sum(clade_count) as bigint) from clade group by 1, 2, 3""",
)
_register("mate_parity", lambda s, d: reads.mates_even(view(s, d, "fx_mates").withColumn("mate", reads.mate_of())), "fx_mates", "select sample_id, count(*) filter (right(read_id, 1) = '1') as r1, count(*) filter (right(read_id, 1) <> '1') as r2, count(*) filter (right(read_id, 1) = '1') * 2 = count(*) as even from fx_mates group by 1")
_register("bare_read_ids", lambda s, d: view(s, d, "fx_mates").groupBy("sample_id", reads.bare_id().alias("read")).agg(F.count("*").alias("n")), "fx_mates", "select sample_id, split_part(read_id, '/', 1) as read, count(*) as n from fx_mates group by 1, 2")
_register("header_parity", lambda s, d: reads.headers_even(view(s, d, "fx_align")), "fx_align", "select *, (select min(c) = max(c) from (select count(*) as c from fx_align group by sample_id)) as even from (select sample_id, count(*) as n from fx_align group by 1)")
_register(
    "header_rewrite",
    lambda s, d: view(s, d, "fx_headers").select("header", reads.fasta_header(mate="mate").alias("with_mate"), reads.fasta_header(underscores=True).alias("joined")),
    "fx_headers",
    "select header, concat(split_part(header, ' ', 1), '/', mate, substr(header, length(split_part(header, ' ', 1)) + 1)) as with_mate, replace(header, ' ', '_') as joined from fx_headers",
)
_register(
    "renamed_samples",
    lambda s, d: profile.renamed(view(s, d, "fx_runs"), view(s, d, "fx_metadata")).groupBy("sample_id").agg(F.count("*").alias("n")),
    "fx_runs fx_metadata",
    "select coalesce(new, split_part(sample_id, '_', 1)) as sample_id, count(*) as n from fx_runs left join fx_metadata on split_part(old, '_', 1) = split_part(fx_runs.sample_id, '_', 1) group by 1",
)
_register(
    "named_by_prefix",
    lambda s, d: bins.named_by_prefix(view(s, d, "fx_runs").select(F.col("sample_id").alias("folder")).distinct(), view(s, d, "fx_metadata").select(F.split("old", "S")[0].alias("key"), "new")),
    "fx_runs fx_metadata",
    "select folder, split_part(old, 'S', 1) as key, new from (select distinct sample_id as folder from fx_runs) join fx_metadata on left(folder, length(split_part(old, 'S', 1))) = split_part(old, 'S', 1)",
)
_register(
    "grouped_files",
    lambda s, d: bins.grouped_samples(view(s, d, "fx_files"), view(s, d, "fx_groups").withColumnRenamed("bin_group", "group")).withColumnRenamed("group", "bin_group"),
    "fx_files fx_groups",
    "select file, bin_group from fx_files join fx_groups on contains(file, pattern)",
)
_register(
    "graph_links",
    lambda s, d: bins.graph(view(s, d, "fx_fastg"))[1],
    "fx_fastg",
    """with h as (select string_split(replace(replace(header, '>', ''), ';', ''), ':') as p from fx_fastg), l as (select p[1] as a, unnest(string_split(p[2], ',')) as b from h)
 select replace(a, chr(39), '') as src, case when right(a, 1) = chr(39) then '-' else '+' end as src_strand, replace(b, chr(39), '') as dst, case when right(b, 1) = chr(39) then '-' else '+' end as dst_strand from l""",
)
_register("graph_segments", lambda s, d: bins.graph(view(s, d, "fx_fastg"))[0], "fx_fastg", "select substr(split_part(header, ':', 1), 2) as id, seq, cast(length(seq) as int) as len from fx_fastg where not contains(split_part(header, ':', 1), chr(39))")

# --- files -------------------------------------------------------------------------------------------------

for _file_query in files.FILES:
    _register(*_file_query)
_register("ingest_hits", files.ingested, HITS, ANNOTATED + files.INGESTED)


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
