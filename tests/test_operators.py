"""Operators on hand-made rows: the cases that the fixture views don't hold."""

import pytest
from pyspark.sql import functions as F

from mudlark.operators import annotate as an
from mudlark.operators import bins, flow, profile, reads, refdb, taxonomy

LINEAGE = "k__Bacteria;p__A;c__B;o__C;f__D;g__E;s__F"


def hits(spark, rows):
    return spark.createDataFrame(rows, "sample_id string, uniref_id string, n_aligned long, taxid int")


@pytest.fixture(scope="module")
def tables(spark):
    trembl = spark.createDataFrame([("P1", "three"), ("P2", "none"), ("P3", "one"), ("P3", "zzz")], "uniprot string, func string")
    sub = spark.createDataFrame([("E", "c1", "s1", "x1", "three"), ("E", "c1", "s2", "x2", "three"), ("M", "c2", "s3", "x3", "three"), ("E", "c1", "s1", "x1", "one"), ("E", "c1", "s1", "x1", "one")], "superclass string, class string, subclass string, subsystem_name string, func string")
    return trembl, sub


def test_weights_sum_to_counts(spark, tables):
    rows = hits(spark, [("S1", "UniRef50_P1", 9, 5), ("S1", "UniRef50_P2", 4, 5), ("S1", "UniRef50_P9", 2, 5), ("S1", "odd", 1, 5), ("S1", "UniRef50_P3", 3, 5), ("S1", "UniRef50_P3", 3, 5)])
    out = an.annotate(rows, *tables)
    assert out.agg(F.sum("weight")).head()[0] == pytest.approx(22)
    assert sorted(r.weight for r in out.where("uniref_id = 'UniRef50_P1'").collect()) == [3, 3, 3]
    assert out.where("uniref_id = 'UniRef50_P3'").count() == 2
    assert out.where("uniref_id = 'odd'").head().func is None


def test_profile_norms(spark, tables):
    rows = hits(spark, [("S1", "UniRef50_P1", 9, 5), ("S1", "UniRef50_P2", 1, 5), ("S2", "UniRef50_P2", 4, 5)])
    got = profile.profile(an.annotate(rows, *tables), ["class", "all"])
    assert {r.sample_id for r in got.collect()} == {"S1"}
    assert got.where("level = 'all'").agg(F.sum("norm_ss")).head()[0] == pytest.approx(1e6)
    assert got.where("category = 'E'").head().norm_all == pytest.approx(6e5)


def test_excluded_hits_stay_in_total(spark, tables):
    lineage = spark.createDataFrame([(5, LINEAGE), (6, LINEAGE.replace("Bacteria", "Archaea"))], "taxid int, lineage string")
    rows = an.with_lineage(an.annotate(hits(spark, [("S1", "UniRef50_P1", 9, 5), ("S1", "UniRef50_P3", 3, 6)]), *tables), lineage)
    got = {r.category: r for r in profile.profile_excluding(rows, ["Archaea"], ["class"]).collect()}
    assert got["E"].total == pytest.approx(6) and got["E"].norm_all == pytest.approx(5e5) and got["E"].norm_ss == pytest.approx(6 / 9 * 1e6)


def test_renamed(spark):
    meta = spark.createDataFrame([("A_S1", "new_S3"), ("B", "plain")], "old string, new string")
    rows = spark.createDataFrame([("A_S1",), ("A_S7",), ("B_S2",), ("C_S4",)], "sample_id string")
    assert sorted(r.sample_id for r in profile.renamed(rows, meta).collect()) == ["C", "new_S3", "new_S3", "plain"]


def test_missing_lineage_fails(spark):
    rows = spark.createDataFrame([(LINEAGE,)], "lineage string")
    assert profile.check_lineages(rows).count() == 1
    with pytest.raises(Exception, match="no lineage"):
        profile.check_lineages(rows.union(spark.createDataFrame([("x",)], "lineage string"))).collect()


def test_unplaced_reads_go(spark):
    lca = spark.createDataFrame([("S", f"r{t}", t, "x") for t in (0, 1, 2, 3, 131567, 9)] + [("S", "u", 9, "unclassified")], "sample_id string, dna_id string, taxid int, name string")
    lineage = spark.createDataFrame([(3, LINEAGE), (9, LINEAGE)], "taxid int, lineage string")
    got = taxonomy.taxonomy_counts(lca, lineage).collect()
    assert len(got) == 7 and all(r["count"] == 2 and r.rpm == 1e6 for r in got)


def test_lineages_of_merged_and_deleted(spark):
    nodes = spark.createDataFrame([(1, 1, "no rank", "root"), (2, 1, "superkingdom", "Bacteria"), (3, 2, "phylum", "P"), *[(i, i - 1, "clade", "x") for i in range(4, 20)], (20, 19, "species", "S")], "taxid int, parent int, rank string, name string")
    taxa = spark.createDataFrame([(20,), (99,), (50,), (20,)], "taxid int")
    merged = spark.createDataFrame([(99, 3)], "old int, new int")
    deleted = spark.createDataFrame([(50,)], "taxid int")
    got = {r.taxid: r.lineage for r in taxonomy.lineages(taxa, nodes, merged, deleted).collect()}
    assert got == {20: "k__Bacteria;p__P;c__;o__;f__;g__;s__S", 99: "k__Bacteria;p__P;c__;o__;f__;g__;s__", 50: an.NO_LINEAGE}


NODES = "taxid int, parent int, rank string, name string"


def test_tree_of_any_depth(spark):
    """A chain of 1000 levels; the nearest of two names of a rank counts; a parent that is not there ends a chain."""
    nodes = [(1, 1, "no rank", "root"), (2, 1, "superkingdom", "Bacteria"), (3, 2, "phylum", "far"), (4, 3, "phylum", "near"), *[(i, i - 1, "clade", "x") for i in range(5, 1001)], (1001, 1000, "species", "S"), (5000, 4999, "genus", "G"), (5001, 5000, "species", None)]
    got = {r.taxid: r.lineage for r in taxonomy.lineages(spark.createDataFrame([(1001,), (4,), (5001,), (7777,), (1,)], "taxid int"), spark.createDataFrame(nodes, NODES)).collect()}
    assert got == {1001: "k__Bacteria;p__near;c__;o__;f__;g__;s__S", 4: "k__Bacteria;p__near;c__;o__;f__;g__;s__", 5001: "k__;p__;c__;o__;f__;g__G;s__", 7777: an.NO_LINEAGE, 1: an.NO_LINEAGE}


def test_tree_with_a_circle_fails(spark):
    nodes = spark.createDataFrame([(1, 1, "no rank", "root"), (2, 4, "genus", "a"), (3, 2, "genus", "b"), (4, 3, "genus", "c")], NODES)
    with pytest.raises(RuntimeError, match="circle"):
        taxonomy.lineages(spark.createDataFrame([(2,)], "taxid int"), nodes)


def test_domain_before_superkingdom(spark):
    nodes = spark.createDataFrame([(1, 1, "domain", "D"), (2, 1, "superkingdom", "K"), (2, 1, "superkingdom", "Z"), (3, 2, "phylum", "P")], NODES)
    assert taxonomy.lineages(spark.createDataFrame([(3,)], "taxid int"), nodes).head().lineage == "k__D;p__P;c__;o__;f__;g__;s__"


def test_consensus_tie(spark):
    lineage = spark.createDataFrame([(5, LINEAGE), (6, LINEAGE.replace("__A", "__0"))], "taxid int, lineage string")
    lca = spark.createDataFrame([("S", "c-orf1", 5, "x"), ("S", "c-orf2", 6, "x"), ("S", "noorf", 6, "x")], "sample_id string, dna_id string, taxid int, name string")
    got = {r["rank"]: r for r in taxonomy.contig_consensus(lca, lineage).collect()}
    assert got["phylum"].taxon == "k__Bacteria;p__0" and got["phylum"].fraction == 0.5 and got["kingdom"].fraction == 1


def test_clade_report(spark):
    rows = [("superkingdom", "Bacteria"), ("phylum", "P"), ("genus", "G"), ("species", "a b"), ("superkingdom", "Archaea"), ("genus", "H"), ("species", "c")]
    report = spark.createDataFrame([("S", i, 10 - i, r, f"  {n}") for i, (r, n) in enumerate(rows)], "sample_id string, row_no long, clade_count long, rank string, name string")
    got = [r.lineage for r in taxonomy.clade_table(report).orderBy("row_no").collect()]
    assert got == ["s__Bacteria;p__P;;;;g__G;s__a b", "s__Archaea;;;;;g__H;s__c"]
    assert taxonomy.report_counts(report).where("rank = 'all_levels'").count() == 2


def test_pair_with_one_mate_mapped(spark):
    rows = spark.createDataFrame([("S", "a", 77), ("S", "a", 141), ("S", "b", 73), ("S", "b", 133), ("S", "c", 99), ("S", "c", 147)], "sample_id string, read_id string, flag int")
    got = {(r.read_id, r.output) for r in reads.host_split(rows, ("host_r1", "host_r2", "nonhost_r1", "nonhost_r2")).collect()}
    assert got == {("a", "nonhost_r1"), ("a", "nonhost_r2"), ("b", "host_r1"), ("c", "host_r1"), ("c", "host_r2")}


def test_read_rules(spark):
    rows = spark.createDataFrame([("S", "r1", 1, "A" * 100), ("S", "r1", 2, "N" * 2 + "A" * 98), ("S", "r2", 1, "A" * 100), ("S", "r2", 2, "C" * 100)], "sample_id string, read_id string, mate int, seq string")
    assert {r.read_id for r in reads.pairs_passing(rows).collect()} == {"r2"}
    assert reads.mates_even(rows).head().even
    one = spark.createDataFrame([("x/1 more words", 1)], "header string, mate int")
    assert one.select(reads.bare_id("header")).head()[0] == "x"
    assert one.select(reads.fasta_header(underscores=True)).head()[0] == "x/1_more_words"
    assert one.select(reads.fasta_header(mate="mate")).head()[0] == "x/1/1 more words"
    assert one.select(reads.mate_of("header")).head()[0] == 2
    assert reads.headers_even(spark.createDataFrame([("a",), ("a",), ("b",)], "sample_id string")).head().even is False


def test_star_and_last_rows(spark):
    rows = spark.createDataFrame([("k", "a", 2), ("k", "b", 1)], "patric_id string, x string, o int")
    assert refdb.last_by(rows, ["patric_id"], "o").head().x == "a" and refdb.last_by(rows.drop("o"), ["patric_id"]).head().x == "b"
    assert rows.select(refdb.genome_of(F.lit("fig|511145.12.peg.380"))).head()[0] == "511145.12"
    done = rows.limit(1)
    assert refdb.resumed(rows, done, ["x"], lambda df: df).count() == 2


def test_groups_and_prefixes(spark):
    groups = spark.createDataFrame([("shark", "GSV"), ("ray", "RAY")], "group string, pattern string")
    files = spark.createDataFrame([("GSV317_R1.fq",), ("none.fq",)], "file string")
    assert [tuple(r) for r in bins.grouped_samples(files, groups).collect()] == [("GSV317_R1.fq", "shark")]
    with pytest.raises(Exception, match="several groups"):
        bins.grouped_samples(files.union(spark.createDataFrame([("GSV_RAY",)], "file string")), groups).collect()
    meta = spark.createDataFrame([("GSV3", "m")], "key string, v string")
    found = bins.named_by_prefix(files.withColumnRenamed("file", "folder"), meta)
    assert found.count() == 1 and "NestedLoop" not in found._jdf.queryExecution().toString()


def test_contigs_without_cluster_go(spark):
    contigs = spark.createDataFrame([("A", "c1", 10), ("B", "c2", 20), ("B", "c3", 30)], "sample_id string, contig_id string, len long")
    clusters = spark.createDataFrame([("k1", "c1"), ("k1", "c2"), ("k2", "c2")], "cluster_id string, contig_id string")
    got = bins.clustered(contigs, clusters)
    assert {(r.contig_id, r.cluster_id) for r in got.collect()} == {("c1", "k1"), ("c2", "k2")}
    assert {r.name for r in bins.concatenated(contigs, 20).collect()} == {"S2Cc2", "S2Cc3"}


def test_graph(spark):
    rows = spark.createDataFrame([("A:B,C';", "ACGT"), ("A':B;", "ACGT"), ("B;", "GG")], "header string, seq string")
    segments, links = bins.graph(rows)
    assert {(r.id, r.len) for r in segments.collect()} == {("A", 4), ("B", 2)}
    assert {tuple(r) for r in links.collect()} == {("A", "+", "B", "+"), ("A", "+", "C", "-"), ("A", "-", "B", "+")}
    assert bins.gfa(segments, links).count() == 5


def test_zero_total(spark):
    rows = spark.createDataFrame([("S", 0, 0)], "sample_id string, mapped long, total long")
    assert flow.sixteen_s_summary(rows).head().mapped_pct == 0
