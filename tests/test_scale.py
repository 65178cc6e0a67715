"""Skewed keys, joins without nested loops, loads by sample, stored stars, large clusters, summary documents."""

import json
import random
from statistics import median

import pytest
from pyspark.sql import functions as F

from mudlark.functions.skew import left_join_spread
from mudlark.operators import annotate as an
from mudlark.operators import bins, flow, refdb
from mudlark.sources import readers, sinks


@pytest.fixture
def wide(spark):
    """A session of 16 shuffle partitions without adaptive plans and broadcasts."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    for k, v in zip(before, ("16", "-1", "false"), strict=True):
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


HIT = "sample_id string, uniref_id string, n_aligned long, taxid int"


def test_half_of_all_hits_on_one_accession(wide):
    """The largest task has less than twice the rows of the median one; rows are those of a plain join."""
    name = F.when(F.col("id") % 2 == 0, "UniRef50_HOT").when(F.col("id") % 7 == 0, "odd").otherwise(F.concat(F.lit("UniRef50_P"), (F.col("id") % 5000).cast("string")))
    hits = wide.range(60_000).select(F.concat(F.lit("S"), (F.col("id") % 3).cast("string")).alias("sample_id"), name.alias("uniref_id"), F.col("id").alias("n_aligned"))
    trembl = wide.range(5000).select(F.concat(F.lit("P"), F.col("id").cast("string")).alias("uniprot"), F.concat(F.lit("f"), (F.col("id") % 50).cast("string")).alias("func")).union(wide.createDataFrame([("HOT", "f0")], "uniprot string, func string"))
    rows = an.with_function(hits, trembl)
    assert "BroadcastNestedLoopJoin" not in plan_of(rows) and "SortMergeJoin" in plan_of(rows)
    tasks = lambda df: [r["n"] for r in df.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.count("func")).collect()]
    sizes = tasks(rows)
    assert len(sizes) == 16 and max(sizes) <= 2 * median(sizes), sizes
    plain = an.with_accession(hits).join(an.functions_of(trembl), "accession", "left").select(*rows.columns)
    assert rows.exceptAll(plain).isEmpty() and plain.exceptAll(rows).isEmpty()
    alone = tasks(plain)
    assert max(alone) > 2 * median(alone)  # what a plain join does


def test_spread_join_of_small_and_empty_tables(wide):
    hits = wide.createDataFrame([("a", 1), ("a", 1), (None, 2), ("b", 3)], "k string, n int")
    one = wide.createDataFrame([("a", "x")], "k string, v string")
    for sample in (0.0, 1.0):
        got = left_join_spread(hits, one, "k", salts=3, sample=sample)
        assert got.columns == ["k", "n", "v"]
        assert sorted(map(str, got.collect())) == sorted(map(str, hits.join(one, "k", "left").collect()))
    assert left_join_spread(hits.where("false"), one, "k").collect() == []
    assert [r.v for r in left_join_spread(hits, one.where("false"), "k").collect()] == [None] * 4


def test_profiles_meet_an_accession_once_for_each_sample(wide):
    hits = wide.createDataFrame([("S1", "UniRef50_A", 1, 5)] * 50 + [("S1", "odd", 2, 5)] * 9 + [("S2", "UniRef50_B", 3, 5)], HIT)
    trembl = wide.createDataFrame([("A", "fa"), ("B", "fa")], "uniprot string, func string")
    got = {(r.sample_id, r.func): r.n_aligned for r in an.counted_functions(hits, trembl).collect()}
    assert got == {("S1", "fa"): 50, ("S1", None): 18, ("S2", "fa"): 3}


def test_prefixes_and_patterns_without_nested_loops(wide):
    rng = random.Random(0)
    keys = sorted({"".join(rng.choices("ABCD", k=rng.choice((4, 7, 9)))) for _ in range(100_000)})
    metadata = wide.createDataFrame([(k, f"n{i}") for i, k in enumerate(keys)], "key string, new string")
    names = ["".join(rng.choices("ABCD", k=9)) + "_S1" for _ in range(300)] + ["AB", ""]
    folders = wide.createDataFrame([(x,) for x in names], "folder string")
    rows = bins.named_by_prefix(folders, metadata)
    assert "NestedLoop" not in plan_of(rows) and "Cartesian" not in plan_of(rows)
    by_key = {k: f"n{i}" for i, k in enumerate(keys)}
    expected = sorted((x, x[:n], by_key[x[:n]]) for x in names for n in (4, 7, 9) if len(x) >= n and x[:n] in by_key)
    assert sorted(map(tuple, rows.collect())) == expected and expected
    files = [f"run_{x}_R1.fastq.gz" for x in sorted(set(names))]
    groups = wide.createDataFrame([(f"g{i % 3}", f"_{k}_") for i, k in enumerate(keys) if len(k) == 9], "group string, pattern string")
    found = bins.grouped_samples(wide.createDataFrame([(f,) for f in files], "file string"), groups.withColumn("pattern", F.concat("pattern", F.lit("S1_"))))
    assert "NestedLoop" not in plan_of(found)
    of = {f"_{k}_S1_": f"g{i % 3}" for i, k in enumerate(keys) if len(k) == 9}
    assert sorted(map(tuple, found.collect())) == sorted((f, of[f[3:-11]]) for f in files if f[3:-11] in of)
    with pytest.raises(Exception, match="several groups"):
        bins.grouped_samples(wide.createDataFrame([("xay",)], "file string"), wide.createDataFrame([("A", "a"), ("B", "xa")], "group string, pattern string")).collect()
    twice = bins.grouped_samples(wide.createDataFrame([("aaa",)], "file string"), wide.createDataFrame([("A", "a"), ("A", "aa"), ("B", "aaaa")], "group string, pattern string"))
    assert [tuple(r) for r in twice.collect()] == [("aaa", "A")]


def test_load_by_sample_equals_one_load(spark):
    rows = spark.createDataFrame([(s, f"r{i}", i) for s in ("S1", "S2", "S3") for i in range(4)], "sample_id string, dna_id string, n int")
    sinks.save(rows, "at_once")
    for s in ("S1", "S2", "S1", "S3"):
        sinks.save(rows.where(F.col("sample_id") == s).select("n", "sample_id", "dna_id"), "by_sample")
    read = lambda: sorted((r.sample_id, r.dna_id, r.n) for r in spark.table("by_sample").collect())
    assert read() == sorted((r.sample_id, r.dna_id, r.n) for r in spark.table("at_once").collect()) and len(read()) == 12
    sinks.save(rows.where("sample_id = 'S2' and n < 2"), "by_sample")  # a sample that has fewer rows now
    assert len(read()) == 10 and {x[0] for x in read()} == {"S1", "S2", "S3"}
    sinks.save(rows.where("false"), "by_sample")
    assert len(read()) == 10
    with pytest.raises(ValueError, match="has the columns"):
        sinks.save(rows.drop("n"), "by_sample")
    for t in ("at_once", "by_sample"):
        spark.sql(f"drop table {t}")


def test_stored_star_is_looked_up_without_a_shuffle(spark, tmp_path):
    subsystems = spark.createDataFrame([(f"s{i % 3}", "c", "d", f"sys{i % 5}", f"role{i}") for i in range(40)], "superclass string, class string, subclass string, subsystem_name string, func string")
    linkout = spark.createDataFrame([(f"P{i * i % 99991}", f"fig|{i % 7}.1.peg.{i}") for i in range(30_000)], "uniprot_id string, patric_id string")
    roles = spark.createDataFrame([(f"fig|{i % 7}.1.peg.{i}", f"role{i % 45}") for i in range(30_000)], "patric_id string, role string")
    fresh = refdb.star_schema(subsystems, linkout, roles)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold")}
    for k, v in zip(before, ("32", "30k"), strict=True):  # the proteins' table is larger than what is broadcast, as a real one is
        spark.conf.set(k, v)
    try:
        stored = sinks.store_star(fresh, "teststar", str(tmp_path), buckets=4)
        asked = [
            (refdb.roles_of_accession(stored, "P9"), refdb.roles_of_accession(fresh, "P9")),
            (refdb.accessions_of_subsystem(stored, "sys2"), refdb.accessions_of_subsystem(fresh, "sys2")),
            (refdb.accessions_of_subsystem(stored), refdb.accessions_of_subsystem(fresh)),
        ]
        for got, expected in asked:
            assert "Exchange hashpartitioning" not in plan_of(got) and "SinglePartition" not in plan_of(got), plan_of(got)
            assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect())) and not got.isEmpty()
        assert "SelectedBucketsCount: 1 out of 4" in plan_of(asked[0][0])
        assert refdb.row_counts(stored).collect() == refdb.row_counts(fresh).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
        for name in sinks.STAR_KEYS:
            spark.sql(f"drop table if exists teststar_{name}")


def test_large_cluster_is_written_by_several_tasks(spark, tmp_path):
    rng = random.Random(1)
    seqs = [("big" if i % 2 else f"k{i % 40}", f"c{i}", "".join(rng.choices("ACGT", k=2000))) for i in range(2000)]
    settings = {"spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200k", "spark.sql.shuffle.partitions": "64"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        sinks.write_by_cluster(spark.createDataFrame(seqs, "cluster_id string, seq_id string, seq string").repartition(8), str(tmp_path / "bins"))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    assert len(list((tmp_path / "bins/cluster_id=big").glob("*.gz"))) > 3
    # small ones are whole, but for those that are dealt to the same partition as the large one
    assert median(len(list((tmp_path / f"bins/cluster_id=k{i}").glob("*.gz"))) for i in range(0, 40, 2)) == 1
    got = readers.read_fasta(spark, str(tmp_path / "bins/cluster_id=big"))
    assert sorted((r.seq_id, r.seq) for r in got.collect()) == sorted(x[1:] for x in seqs if x[0] == "big")


def test_summary_document(spark):
    stages = spark.createDataFrame([("S1", "raw", 10), ("S1", "trimmed", 8), ("S1", "host", 1), ("S1", "nonhost", 7), ("S2", "raw", 5), ("S2", "trimmed", 5)], "sample_id string, stage string, n long")
    domains = spark.createDataFrame([("Bacteria", 3), ("Virus", 1), ("Multidomain", 1)], "domain string, n long")
    six = spark.createDataFrame([("S2", 1)], "sample_id string, n long")
    got = json.loads(flow.summary_document(stages, domains, six, "reef").head().value)
    assert got == {
        "project": "reef", "raw_fastq": 15, "trimmed_fastq": 13, "low_quality": 2, "host": 1, "no_host": 7, "sixteen_s": 1, "totalsims": 5, "nosims": 1,
        "tax": {"Bacteria": 3, "Archaea": 0, "Eukaryota": 0, "Viruses": 1, "Multidomain": 1}, "six_counts": {"S2": 1},
        "count_data": {"S1": {"fastq": 10, "trimmed": 8, "host": 1, "no_host": 7}, "S2": {"fastq": 5, "trimmed": 5, "host": 0, "no_host": 0}},
    }
    nothing = json.loads(flow.summary_document(stages.where("false"), domains.where("false"), six.where("false")).head().value)
    assert nothing["project"] == "unknown" and nothing["nosims"] == 0 and nothing["count_data"] == {} and nothing["tax"]["Viruses"] == 0


def test_flow_text(spark):
    stages = spark.createDataFrame([("S1", "raw", 10), ("S1", "trimmed", 8), ("S1", "host", 1), ("S1", "nonhost", 7)], "sample_id string, stage string, n long")
    domains = spark.createDataFrame([("Bacteria", 3), ("Virus", 1)], "domain string, n long")
    got = [r.value for r in flow.flow_text(flow.flow_edges(stages, domains, 2, "shark")).collect()]
    assert got == ["fastq [8] fastp", "fastq [2] low quality", "fastp [1] shark", "fastp [7] not shark", "not shark [4] sequence similarity", "not shark [2] 16S", "not shark [1] unknown", "sequence similarity [0] Eukaryote", "sequence similarity [3] Bacteria", "sequence similarity [0] Archaea", "sequence similarity [1] Virus", "sequence similarity [0] Multiclass"]


def test_annotated_of_a_known_form(spark, tmp_path):
    """A weight in the 14th column that is no weight where the form is known."""
    base = ["UniRef50_A", "2", "0.1", "0.2", "0.3", "5", "species", "x", "f", "M", "c", "s", "y"]
    path = tmp_path / "a.tsv"
    path.write_text("\n".join("\t".join(r) for r in ([*base, "7", "0.5", "k__A"], [*base, "4.0", "k__B"])) + "\n")
    rows = lambda form: [(r.weight, r.lineage) for r in readers.read_annotated(spark, str(path), form=form).collect()]
    assert rows("v1") == [(0.5, "k__A"), (None, None)] and rows("v2") == [(7.0, "0.5"), (4.0, "k__B")]


def test_resumed_rows_are_not_worked_on_again(spark):
    todo = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    done = spark.createDataFrame([("b", "kept")], "k string, run string")
    seen = []

    def work(left):
        seen.append(sorted(r.k for r in left.collect()))
        return left.withColumn("run", F.lit("new"))

    assert sorted(map(tuple, refdb.resumed(todo, done, ["k"], work).collect())) == [("a", "new"), ("b", "kept"), ("c", "new")] and seen == [["a", "c"]]


def test_random_top_hit_is_a_draw(spark):
    """One hit of each query, another with another seed, and no preferred place."""
    hits = spark.createDataFrame([("S", f"q{q}", f"UniRef50_P{i}", i) for q in range(300) for i in range(4)], "sample_id string, dna_id string, uniref_id string, row_no long")
    trembl = spark.createDataFrame([(f"P{i}", f"f{i}") for i in range(4)], "uniprot string, func string")
    subsystems = spark.createDataFrame([("x", "y", "z", "s", "f1")], "superclass string, class string, subclass string, subsystem_name string, func string")
    draw = lambda seed: {r.dna_id: r.row_no for r in an.top_hits(hits, trembl, subsystems, "r", seed).collect()}
    one, again, other = draw(0), draw(0), draw(1)
    assert len(one) == 300 and one == again and one != other
    assert all(40 < list(one.values()).count(i) < 115 for i in range(4))
