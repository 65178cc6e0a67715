"""Work on larger tables: hits are multiplied last, contigs are shuffled once, files and buckets follow the size of their tables."""

import random
import re
from statistics import median

import pytest
from pyspark.sql import functions as F

from mudlark.functions import skew
from mudlark.operators import annotate as an
from mudlark.operators import refdb, taxonomy
from mudlark.plans import catalog, files
from mudlark.sources import sinks
from mudlark.streaming import ingest

HIERARCHY = "superclass string, class string, subclass string, subsystem_name string, func string"


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


def tables(spark, n_functions=6, n_systems=40):
    """Hits of few functions with many subsystems each; every fourth function is unknown, every third superclass empty."""
    hits = spark.range(4000).select(
        F.lit("S1").alias("sample_id"), F.concat(F.lit("q"), (F.col("id") % 300).cast("string")).alias("dna_id"), F.concat(F.lit("UniRef50_P"), (F.col("id") % 90).cast("string")).alias("uniref_id"),
        F.col("id").alias("row_no"), F.col("id").alias("n_aligned"), (F.col("id") % 5).cast("int").alias("taxid"),
    )
    trembl = spark.createDataFrame([(f"P{i}", f"f{i % n_functions}") for i in range(90) if i % 4], "uniprot string, func string")
    subsystems = spark.createDataFrame([("" if j % 3 == 0 else f"c{j % 4}", "a", None, f"sys{j}", f"f{i}") for i in range(n_functions - 1) for j in range(n_systems)], HIERARCHY)
    lineage = spark.createDataFrame([(i, f"d__{i};p__;c__;o__;f__;g__;s__") for i in range(4)], "taxid int, lineage string")
    return hits, trembl, subsystems, lineage


def plain(hits, trembl, subsystems):
    return an.with_accession(hits).join(an.functions_of(trembl), "accession", "left").join(an.weighted_subsystems(subsystems), "func", "left")


def test_hits_are_multiplied_after_the_last_shuffle(wide):
    hits, trembl, subsystems, lineage = tables(wide)
    for rows in (an.annotate(hits, trembl, subsystems), an.annotate(hits, trembl, subsystems, lineage)):
        plan = plan_of(rows)
        assert "Exchange" in plan and "Generate inline" in plan and plan.index("Generate inline") < plan.index("Exchange"), plan[:400]
    names = ["row_no", "func", *an.HIERARCHY, "n_subsystems", "weight", "lineage"]
    expected = an.with_lineage(plain(hits, trembl, subsystems), lineage).withColumn("weight", F.col("n_aligned") / F.coalesce("n_subsystems", F.lit(1)))
    assert sorted(map(str, rows.select(names).collect())) == sorted(map(str, expected.select(names).collect()))
    # few functions have most hits, and still no task most rows
    tasks = [r["n"] for r in rows.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.count("superclass")).collect()]
    assert len(tasks) == 16 and max(tasks) <= 2 * median(tasks), tasks


@pytest.mark.parametrize("mode", ["a", "s"])
def test_all_top_hits_are_multiplied_after_the_last_shuffle(wide, mode):
    hits, trembl, subsystems, _ = tables(wide)
    rows = an.top_hits(hits, trembl, subsystems, mode)
    plan, names = plan_of(rows), ["row_no", "func", *an.HIERARCHY]
    assert plan.index("Generate inline") < plan.index("Exchange")
    expected = plain(hits, trembl, subsystems)
    expected = expected.where(an.has_subsystem()) if mode == "s" else expected
    assert sorted(map(str, rows.select(names).collect())) == sorted(map(str, expected.select(names).collect()))


def test_a_random_top_hit_is_drawn_from_one_row_of_each_hit(wide):
    hits, trembl, subsystems, _ = tables(wide)
    rows = an.top_hits(hits, trembl, subsystems, "r", 3)
    assert "Generate inline" not in plan_of(rows) and "array_min" in plan_of(rows)
    draw = F.md5(F.concat_ws("|", F.lit("3"), "dna_id", "uniref_id", "row_no", *[F.coalesce(c, F.lit("")) for c in an.HIERARCHY]))
    names = ["dna_id", "row_no", "func", *an.HIERARCHY]
    best = plain(hits, trembl, subsystems).groupBy("sample_id", "dna_id").agg(F.min_by(F.struct(*names[1:]), draw).alias("x")).select("dna_id", "x.*")
    assert sorted(map(str, rows.select(names).collect())) == sorted(map(str, best.collect())) and rows.count() == 300


def test_contigs_are_shuffled_and_sorted_once(wide):
    rng = random.Random(1)
    names = {9: "k__A;p__B;c__;o__O1;f__;g__;s__x", 10: "k__A;p__B;c__;o__O2;f__;g__;s__x", 11: "k__A;p__BB;c__C;o__;f__;g__;s__y", 12: "k__;p__;c__;o__;f__;g__;s__", 13: "k__short;p__"}
    reads = [(f"S{rng.randrange(2)}", f"c{rng.randrange(60)}-orf{i}", rng.choice([*names, 99]), rng.choice(["x", "x", "unclassified"])) for i in range(900)] + [("S0", "no frame", 9, "x")]
    lca = wide.createDataFrame(reads, "sample_id string, dna_id string, taxid int, name string")
    rows = taxonomy.contig_consensus(lca, wide.createDataFrame(list(names.items()), "taxid int, lineage string"))
    plan = plan_of(rows)
    assert plan.count("Exchange hashpartitioning(sample_id") == 1 and plan.index("Generate inline") < plan.index("Exchange") and plan.count("Sort [sample_id") == 1, plan[:400]
    counts = {}
    for sample, name, taxid, kind in reads:
        path = names.get(taxid, an.NO_LINEAGE).split(";")
        if kind == "x" and "-orf" in name and len(path) == 7:
            for i, rank in enumerate(taxonomy.RANKS):
                of = counts.setdefault((sample, name.split("-")[0], rank), {})
                of[";".join(path[: i + 1])] = of.get(";".join(path[: i + 1]), 0) + 1
    best = {k: min(v.items(), key=lambda x: (-x[1], x[0])) for k, v in counts.items()}
    got = {(r.sample_id, r.contig, r["rank"]): (r.taxon, r.n) for r in rows.collect()}
    assert got == best and rows.count() == len(best) and rows.where("fraction > 1 or fraction <= 0").isEmpty()


def test_lists_of_clusters_are_written_where_their_rows_lie(wide, monkeypatch):
    contigs = wide.createDataFrame([("S0", f"c{i}", f"b{i % 7}") for i in range(2000)], "sample_id string, contig_id string, cluster_id string").repartition(5).localCheckpoint()
    put, lines = files._put, []
    monkeypatch.setattr(files, "view", lambda spark, sf_dir, name: contigs)
    monkeypatch.setattr(files, "_put", lambda spark, rows, *more: lines.append(rows) or put(spark, rows, *more))
    got = {r.contig_id: r.cluster_id for r in files._cluster_lists(wide, "").collect()}
    assert got == {f"c{i}": f"b{i % 7}" for i in range(2000)}
    # a sample is not one task: its rows are not moved
    assert "Exchange" not in plan_of(lines[0]) and "Sort" not in plan_of(lines[0])


def test_buckets_of_a_star_follow_its_rows(spark, tmp_path, monkeypatch):
    subsystems = spark.createDataFrame([(f"s{i % 3}", "c", "d", f"sys{i % 5}", f"role{i}") for i in range(40)], HIERARCHY)
    linkout = spark.createDataFrame([(f"P{i}", f"fig|{i % 7}.1.peg.{i}") for i in range(5000)], "uniprot_id string, patric_id string")
    roles = spark.createDataFrame([(f"fig|{i % 7}.1.peg.{i}", f"role{i % 40}") for i in range(5000)], "patric_id string, role string")
    star = refdb.star_schema(subsystems, linkout, roles)
    buckets = lambda table: int(spark.sql(f"describe extended {table}").where("col_name = 'Num Buckets'").first().data_type)
    monkeypatch.setattr(sinks, "BUCKET_ROWS", 100)
    try:
        stored = sinks.store_star(star, "grown", str(tmp_path))
        assert buckets("grown_uniprot_patric_role") == 50 and buckets("grown_roles") == sinks.LEAST_BUCKETS
        for name, rows in star.items():
            assert sorted(map(tuple, stored[name].select(rows.columns).collect())) == sorted(map(tuple, rows.collect()))
        assert refdb.accessions_of_subsystem(stored).count() == refdb.accessions_of_subsystem(star).count() > 0
    finally:
        for name in star:
            spark.sql(f"drop table if exists grown_{name}")


def test_a_star_is_built_by_tasks_that_follow_its_rows(wide, monkeypatch):
    """Whatever the session's partitions: twice the rows are twice the tasks. Half of all genes are of one protein."""
    subsystems = wide.createDataFrame([(f"s{i % 3}", "c", "d", f"sys{i % 5}", f"role{i}") for i in range(40)], HIERARCHY)
    trembl = wide.createDataFrame([(f"P{i}", f"role{i % 45}" if i % 9 else None) for i in range(3000)], "uniprot string, func string")
    monkeypatch.setattr(skew, "TASK_ROWS", 200)
    for n in (8_000, 16_000):
        linkout = wide.createDataFrame([(None if i % 50 == 1 else f"P{i % 3500}" if i % 2 else "P7", f"fig|{i % 7}.1.peg.{i * 2 // 3}") for i in range(n)], "uniprot_id string, patric_id string").localCheckpoint()
        views = {"fx_linkout": linkout, "fx_trembl": trembl, "fx_subsystems": subsystems}
        monkeypatch.setattr(catalog, "view", lambda spark, sf_dir, name: views[name])
        got = catalog._new_star(wide, "")["uniprot_patric_role"]
        sizes = [r["n"] for r in got.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert len(sizes) == n // 200 and max(sizes) < 4 * 200, sizes
        assert plan_of(got).count(f", {n // 200}), REPARTITION_BY_NUM") == 4  # both sides of both joins
        roles = linkout.join(trembl, F.col("uniprot_id") == F.col("uniprot")).select("patric_id", F.col("func").alias("role"))
        expected = refdb.star_schema(subsystems, linkout, roles)["uniprot_patric_role"]
        assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect())) and got.count() > n / 2


def test_accessions_of_all_subsystems_take_a_task_for_each_bucket(spark, tmp_path, monkeypatch):
    subsystems = spark.createDataFrame([("s", "c", "d", f"sys{i % 5}", f"role{i}") for i in range(40)], HIERARCHY)
    linkout = spark.createDataFrame([(f"P{i}", f"fig|{i % 7}.1.peg.{i}") for i in range(4000)], "uniprot_id string, patric_id string")
    star = refdb.star_schema(subsystems, linkout, linkout.select("patric_id", F.concat(F.lit("role"), F.pmod(F.xxhash64("patric_id"), F.lit(40)).cast("string")).alias("role")))
    monkeypatch.setattr(sinks, "BUCKET_ROWS", 100)
    try:
        got = refdb.accessions_of_subsystem(sinks.store_star(star, "tasks", str(tmp_path)))
        assert "Exchange hashpartitioning" not in plan_of(got)
        sizes = [r["n"] for r in got.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert len(sizes) == 40 and max(sizes) < 200 and sum(sizes) == 4000, sizes
    finally:
        for name in star:
            spark.sql(f"drop table if exists tasks_{name}")


@pytest.fixture
def guessing(spark, tmp_path):
    """Gives tables as small, packed files, in a session of 8 shuffle partitions that broadcasts up to so many bytes by the planner's guess."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold")}

    def tables_of(threshold="10m", **sizes):
        for k, v in zip(before, ("8", threshold), strict=True):
            spark.conf.set(k, v)
        for i, table in enumerate(made := tables(spark, **sizes)):
            table.coalesce(1).write.parquet(f"{tmp_path}/{i}")
        return [spark.read.parquet(f"{tmp_path}/{i}") for i in range(len(made))]

    yield tables_of
    for k, v in before.items():
        spark.conf.set(k, v)


#: A join whose right side holds copies of heavy keys, and a shuffle of the rows that meet them.
COPIES_BROADCAST, DEALT = r"BroadcastHashJoin \[[^\]]*salt_", r"Exchange hashpartitioning\((\w+)#\d+, salt_"


@pytest.mark.parametrize("whole", [1 << 20, 0])
def test_ingest_broadcasts_no_copies_of_heavy_functions(guessing, spark, tmp_path, monkeypatch, whole):
    monkeypatch.setattr(skew, "WHOLE", whole, raising=False)
    hits, trembl, subsystems, _ = guessing()
    plans, made = [], lambda *of: (rows := an.annotate(*of), plans.append(plan_of(rows)))[0]
    monkeypatch.setattr(ingest, "annotate", made)
    line = F.concat_ws("\t", "uniref_id", "n_aligned", F.lit("0.5\t0.5\t0.5"), "taxid", F.lit("species\tx"))
    hits.select("sample_id", line.alias("value")).write.partitionBy("sample_id").text(f"{tmp_path}/in")
    ingest.ingest_hits(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/kept", trembl, subsystems).awaitTermination()
    assert plans and not any(re.search(COPIES_BROADCAST, p) for p in plans), plans
    assert all(("salt_" in p) == (not whole) for p in plans)
    names = ["uniref_id", "n_aligned", "func", *an.HIERARCHY, "n_subsystems"]
    got = spark.read.parquet(f"{tmp_path}/out").select(names)
    assert sorted(map(str, got.collect())) == sorted(map(str, plain(hits, trembl, subsystems).select(names).collect()))


@pytest.mark.parametrize("mode", ["a", "r", "s"])
@pytest.mark.parametrize("whole", [1 << 20, 0])
def test_top_hits_broadcast_no_copies_of_heavy_functions(guessing, monkeypatch, mode, whole):
    monkeypatch.setattr(skew, "WHOLE", whole, raising=False)
    hits, trembl, subsystems, _ = guessing()
    rows = an.top_hits(hits, trembl, subsystems, mode)
    plan = plan_of(rows)
    assert not re.search(COPIES_BROADCAST, plan) and ("salt_" in plan) == (not whole), plan
    names = ["dna_id", "row_no", "func", *an.HIERARCHY]
    expected = plain(hits, trembl, subsystems)
    expected = expected.where(an.has_subsystem()) if mode == "s" else expected
    if mode == "r":
        draw = F.md5(F.concat_ws("|", F.lit("0"), "dna_id", "uniref_id", "row_no", *[F.coalesce(c, F.lit("")) for c in an.HIERARCHY]))
        expected = expected.groupBy("sample_id", "dna_id").agg(F.min_by(F.struct(*names[1:]), draw).alias("x")).select("dna_id", "x.*")
    assert sorted(map(str, rows.select(names).collect())) == sorted(map(str, expected.select(names).collect()))


def test_hits_are_shuffled_for_large_tables_only(guessing, monkeypatch):
    """Lineages and subsystems are small by their bytes, whatever the planner would broadcast: hits are shuffled by accession, and not with their lineage."""
    monkeypatch.setattr(skew, "WHOLE", 1000, raising=False)
    hits, trembl, subsystems, lineage = guessing("1", n_systems=2)
    rows = an.annotate(hits, trembl, subsystems, lineage)
    assert re.findall(DEALT, plan_of(rows)) == ["accession"], plan_of(rows)
    names = ["row_no", "func", *an.HIERARCHY, "n_subsystems", "lineage"]
    expected = an.with_lineage(plain(hits, trembl, subsystems), lineage)
    assert sorted(map(str, rows.select(names).collect())) == sorted(map(str, expected.select(names).collect()))
