"""Views that give general tables the shapes of profiling tables.

Each is SQL text over tables in braces, so that the same text serves Spark and, as common table
expressions, any other engine.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "fx_hits": """select concat('S', cast(l_suppkey % 8 as string)) as sample_id,
 case when l_linenumber = 7 then concat('X_', cast(l_partkey as string)) else concat('UniRef50_P', cast(l_partkey as string)) end as uniref_id,
 cast(l_quantity as bigint) as n_aligned, l_suppkey as taxid from {lineitem}""",
    "fx_trembl": "select concat(case when p_partkey % 10 = 0 then 'Q' else 'P' end, cast(p_partkey as string)) as uniprot, concat(p_brand, ' ', p_type) as func from {part}",
    "fx_subsystems": """select distinct p_type as superclass, concat('L1_', cast(p_size % 4 as string)) as class,
 concat('L2_', cast(p_size % 12 as string)) as subclass, p_name as subsystem_name,
 concat(case when p_size <= 10 and p_brand <> 'Brand#3' then '' else 'other ' end, p_brand, ' ', p_type) as func from {part}""",
    "fx_lineage": """select s_suppkey as taxid, concat('k__', r_name, ';p__', n_name, ';c__C', cast(s_suppkey % 7 as string), ';o__O', cast(s_suppkey % 14 as string),
 ';f__F', cast(s_suppkey % 28 as string), ';g__G', cast(s_suppkey % 56 as string), ';s__', s_name) as lineage
 from {supplier} join {nation} on s_nationkey = n_nationkey join {region} on n_regionkey = r_regionkey""",
    "fx_nodes": """select 1 as taxid, 1 as parent, 'no rank' as rank, 'root' as name union all
 select r_regionkey + 100, 1, 'superkingdom', r_name from {region} union all
 select n_nationkey + 1000, n_regionkey + 100, 'phylum', n_name from {nation} union all
 select cast(s_suppkey + 10000 as int), s_nationkey + 1000, 'species', s_name from {supplier}""",
    "fx_lca": """select concat('S', cast(l_suppkey % 8 as string)) as sample_id, concat('r', cast(l_orderkey as string), '-orf', cast(l_linenumber as string)) as dna_id,
 l_suppkey as taxid, case when l_returnflag = 'R' and l_linestatus = 'O' then 'unclassified' else 'x' end as name from {lineitem}""",
    "fx_align": """select concat('S', cast(l_suppkey % 8 as string)) as sample_id, l_orderkey as read_id,
 cast(cast(l_orderkey * 37 + l_linenumber * 13 as bigint) % 4096 as int) as flag from {lineitem}""",
    "fx_reads": "select doc_id as read_id, lang as sample_id, text as seq from {documents}",
    "fx_stage": """select concat('S', cast(o_custkey % 8 as string)) as sample_id, o_orderkey as read_id,
 o_orderkey % 10 <> 0 as in_qc, o_orderstatus = 'F' as in_host, o_orderstatus = 'O' as in_nonhost, o_orderpriority in ('1-URGENT','2-HIGH') as in_hit from {orders}""",
    "fx_tophit": """select concat('S', cast(user_id % 4 as string)) as sample_id, concat('q', cast(user_id as string)) as dna_id,
 concat('UniRef50_P', cast(event_id % 2000 as string)) as uniref_id, event_id as row_no, value as bitscore from {events}""",
    "fx_contigs": """select concat('S', cast(l_suppkey % 8 as string)) as sample_id, concat('c', cast(l_orderkey as string), '_', cast(l_linenumber as string), '_', cast(l_partkey as string)) as contig_id,
 concat('b', cast(l_partkey % 200 as string)) as cluster_id, cast(l_quantity * 100 as bigint) as len from {lineitem}""",
    "fx_linkout": """select concat('P', cast(l_partkey as string)) as uniprot_id, concat('fig|', cast(l_suppkey as string), '.1.peg.', cast(l_orderkey % 500 as string)) as patric_id from {lineitem}""",
    "fx_flagstat": """select concat('S', cast(user_id % 8 as string)) as sample_id, cast(json_k as bigint) as mapped from (select user_id, get_json_object(props,'$.k') json_k from {events})""",
    "fx_report": """select concat('S', cast(n_regionkey as string)) as sample_id, cast(n_nationkey as bigint) * 1000000 as row_no, cast(0 as bigint) as clade_count, 'phylum' as rank, n_name as name from {nation} union all
 select concat('S', cast(n_regionkey as string)), cast(n_nationkey as bigint) * 1000000 + s_suppkey + 1, cast(s_suppkey % 7 + 1 as bigint), case when s_suppkey % 5 = 0 then 'genus' else 'species' end, s_name
 from {supplier} join {nation} on s_nationkey = n_nationkey""",
    "fx_mates": "select concat('S', cast(l_suppkey % 8 as string)) as sample_id, concat('r', cast(l_orderkey as string), '/', cast(l_linenumber % 2 + 1 as string)) as read_id from {lineitem}",
    "fx_headers": "select concat('r', cast(o_orderkey as string), ' ', o_orderpriority, ' x') as header, cast(o_orderkey % 2 + 1 as int) as mate from {orders}",
    "fx_runs": "select concat('M', cast(l_suppkey % 40 as string), '_S', cast(l_linenumber as string)) as sample_id from {lineitem}",
    "fx_metadata": "select concat('M', cast(n_nationkey as string), '_S1') as old, n_name as new from {nation}",
    "fx_files": "select distinct concat('S', cast(l_suppkey % 8 as string), '_', cast(l_orderkey as string), '_R1.fastq.gz') as file from {lineitem}",
    "fx_groups": "select r_name as bin_group, concat('S', cast(r_regionkey as string), '_') as pattern from {region}",
    "fx_fastg": """select concat('>', cast(l_orderkey as string), case when l_linenumber % 2 = 0 then chr(39) else '' end, ':', cast(l_partkey as string), chr(39), ',', cast(l_suppkey as string), ';') as header,
 repeat('acgt', cast(l_linenumber as int)) as seq from {lineitem}""",
    "fx_seqs": """select coalesce(lang, 'none') as sample_id, concat('d', cast(doc_id as string), ' ', coalesce(source, '')) as header,
 translate(coalesce(text, ''), concat(' >', chr(9), chr(10), chr(11), chr(12), chr(13)), '') as seq from {documents}""",
    "fx_sam": """select concat('S', cast(l_suppkey % 8 as string)) as sample_id, concat('r', cast(l_orderkey as string), '.', cast(l_linenumber as string)) as read_id,
 cast(cast(l_orderkey * 37 + l_linenumber * 13 as bigint) % 4096 as int) as flag, concat('c', cast(l_partkey as string)) as rname, cast(l_quantity * 10 as bigint) as pos,
 cast(l_linenumber as int) as mapq, repeat('acgt', cast(l_linenumber as int)) as seq, repeat('#', cast(l_linenumber * 4 as int)) as qual from {lineitem}""",
    "fx_report_rows": """select concat('S', cast(l_suppkey % 8 as string)) as sample_id, concat('UniRef50_P', cast(l_partkey as string)) as uniref_id, cast(l_quantity as bigint) as n_aligned,
 l_discount as unique_cov, l_tax as target_cov, l_extendedprice as identity, cast(l_suppkey as int) as taxid, 'species' as rank, concat('x "', l_returnflag, ' y') as name from {lineitem}""",
    "fx_aln_rows": """select concat('S', cast(user_id % 4 as string)) as sample_id, concat('q', cast(event_id as string)) as dna_id, concat('UniRef50_P', cast(user_id as string)) as uniref_id, value as percent_identity,
 cast(event_id % 300 as int) as alignment_length, cast(event_id % 7 as int) as gaps, cast(event_id % 5 as int) as bitscore from {events}""",
    "fx_annotated": """select concat('S', cast(l_suppkey % 8 as string)) as sample_id, concat('UniRef50_P', cast(l_partkey as string)) as uniref_id, cast(l_quantity as bigint) as n_aligned, cast(l_suppkey as int) as taxid,
 p_type as func, concat('M', cast(p_size % 3 as string)) as superclass, cast(p_size as string) as size, p_name as subsystem_name, l_quantity / 4 as weight,
 case when l_suppkey % 3 = 0 then '' else concat('k__', p_brand, ';p__;c__;o__;f__;g__;s__') end as lineage, l_linenumber as form from {lineitem} join {part} on l_partkey = p_partkey""",
    "fx_paths": """select distinct concat('run', cast(l_linenumber % 3 as string), '/S', cast(l_orderkey as string), '/S', cast(l_orderkey as string),
 case l_linenumber when 1 then '_tophit_report_subsystems.gz' when 2 then '_tophit_report_subsystems_taxa.gz' when 3 then '_tophit_report.gz' when 4 then '_tophit_aln.gz' when 5 then '_lca_taxonomy.tsv.gz'
 when 6 then '_lca.tsv.gz' else '_R1.fastq.gz' end) as path from {lineitem}""",
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the views over the Parquet tables in a directory."""
    text = VIEWS[name]
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in set(re.findall(r"\{(\w+)\}", text))}
    return spark.sql(text, **tables)


def with_views(names: str, body: str) -> str:
    """SQL that defines the named views (space-separated) and then runs ``body``."""
    parts = [f"{n} as ({VIEWS[n]})" for n in names.split()]
    text = re.sub(r"\{(\w+)\}", r"\1", ", ".join(parts)).replace("get_json_object(", "json_extract_string(")
    joint = " , " if body.lstrip().lower().startswith("with ") else " "
    body = body.lstrip()
    return f"with {text}{joint}{body[5:] if joint == ' , ' else body}"
