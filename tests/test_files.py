"""File formats, sinks and ingest on small files."""

import gzip
import json

import pytest

from mudlark.sources import readers, sinks
from mudlark.sources.splits import FastqReader, TextReader
from mudlark.streaming.ingest import ingest_hits


def put(path, text):
    with gzip.open(path, "wt") if str(path).endswith(".gz") else open(path, "w") as f:
        f.write(text)
    return str(path)


GOOD = "@r1 a b\nACGT\n+\n!!!!\n@r2\nAC\n+\n@@\n"


@pytest.mark.parametrize("by_spark", [False, True])
def test_fastq(spark, tmp_path, by_spark):
    for name in ("s1.fastq.gz", "s2.fastq"):
        rows = readers.read_fastq(spark, put(tmp_path / name, GOOD), by_spark=by_spark).orderBy("read_id").collect()
        assert [(r.read_id, r.header, r.seq, r.qual) for r in rows] == [("r1", "r1 a b", "ACGT", "!!!!"), ("r2", "r2", "AC", "@@")]
        assert rows[0].sample_id == name[:2]
    for bad in ("r1\nA\n+\n!\n", "@r1\nA\nx\n!\n", "@r1\nAC\n+\n!\n", "@r1\nAC\n"):
        with pytest.raises(Exception, match="in file"):
            readers.read_fastq(spark, put(tmp_path / "bad.fastq", bad), by_spark=by_spark).collect()


#: Qualities that look like headers and signs, a read of no bases, a repeated header, line ends of either kind, no last line end.
HARD = "@r1\nACGT\n+r1\n@@@+\n@r2 x\nAC\n+\n+@\n@r3\n\n+\n\n@r4\r\nA\r\n+\r\n@\r\n@@5\nG\n+\n@\n@r6\nTTTTTTTT\n+\n@+@+@+@+"
READ = [("@5", "G", "@"), ("r1", "ACGT", "@@@+"), ("r2 x", "AC", "+@"), ("r3", "", ""), ("r4", "A", "@"), ("r6", "TTTTTTTT", "@+@+@+@+")]


def test_fastq_cut_at_any_byte(tmp_path):
    """The ranges themselves, for every length of range."""
    path = tmp_path / "a.fastq"
    path.write_bytes(HARD.encode())
    for size in range(1, len(HARD) + 2):
        reader = FastqReader({"paths": json.dumps([str(path)]), "rangebytes": str(size)})
        parts = reader.partitions()
        assert len(parts) == -(-len(HARD) // size)
        rows = [tuple(r.values())[1:] for part in parts for batch in reader.read(part) for r in batch.to_pylist()]
        assert sorted(rows) == READ, size
        lines = TextReader({"paths": json.dumps([str(path)]), "rangebytes": str(size)})
        assert [r["value"] for part in lines.partitions() for batch in lines.read(part) for r in batch.to_pylist()] == HARD.replace("\r", "").split("\n"), size


def test_fastq_plan_has_no_shuffle(spark, tmp_path):
    (tmp_path / "in").mkdir()
    many = "".join(f"@r{i} x\n{'ACGT' * (i % 30)}\n+\n{'@+!I' * (i % 30)}\n" for i in range(3000))
    for name in ("s1.fastq", "s2.fq.gz", "_skipped"):
        put(tmp_path / "in" / name, many)
    rows = readers.read_fastq(spark, str(tmp_path / "in"), range_bytes=10_000)
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()
    assert rows.rdd.getNumPartitions() > 10
    got = rows.groupBy("sample_id").agg({"read_id": "count", "seq": "max"}).collect()
    assert {r["sample_id"]: r["count(read_id)"] for r in got} == {"s1": 3000, "s2": 3000}
    assert sorted(map(tuple, rows.where("sample_id = 's1'").collect())) == sorted(map(tuple, readers.read_fastq(spark, str(tmp_path / "in/s1.fastq"), by_spark=True).collect()))
    broken = many.replace("@r1500 x", "r1500 x")
    with pytest.raises(Exception, match="start with @"):
        readers.read_fastq(spark, put(tmp_path / "b.fastq", broken), range_bytes=10_000).collect()
    assert readers.read_fastq(spark, put(tmp_path / "empty.fastq", "")).collect() == []


def test_gzip_under_another_name(spark, tmp_path):
    """Refused with a clear error where Spark goes by the name; read by content; the other way round too."""
    texts = {
        "lca": ("r\t9\tclade\tn\t1\t1\t1\t1.0\tk__B;p__\n", readers.read_lca),
        "hit": ("UniRef50_A\t21\t0.9\t20.7\t0.4\t77\tspecies\tx \"y\n", readers.read_tophit_report),
        "aln": ("r1\tU\t0.2\t322\t36\t0\t0\t48\t0\t322\t1.2E-23\t100\n", readers.read_tophit_aln),
        "ann": ("\t".join(["U", "2", "0.1", "0.2", "0.3", "5", "species", "x", "f", "M", "c", "s", "y", "4.0", "k__B"]) + "\n", readers.read_annotated),
        "sam": ("r1\t77\t*\t0\t0\t*\t*\t0\t0\tAC\t!!\n", lambda *a, **k: readers.read_sam(*a, **k)[0]),
    }
    for name, (text, read) in texts.items():
        plain, packed = tmp_path / f"{name}.tsv", tmp_path / f"{name}.packed.tsv"
        plain.write_text(text)
        packed.write_bytes(gzip.compress(text.encode()))
        with pytest.raises(Exception, match="is gzip but its name"):
            read(spark, str(packed)).collect()
        expected = [tuple(r)[1:] for r in read(spark, str(plain)).collect()]
        false = tmp_path / f"{name}.gz"
        false.write_text(text)
        for path in (plain, packed, false):
            assert [tuple(r)[1:] for r in read(spark, str(path), by_content=True).collect()] == expected and expected
    (tmp_path / "reads.fastq").write_bytes(gzip.compress(GOOD.encode()))
    assert readers.read_fastq(spark, str(tmp_path / "reads.fastq"), range_bytes=7).count() == 2
    with pytest.raises(Exception, match="is gzip but its name"):
        readers.read_fasta(spark, str(tmp_path / "reads.fastq")).collect()


def test_split_file_is_numbered(spark, tmp_path):
    path = put(tmp_path / "long.txt", "".join(f"line {i}\n" for i in range(5000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000b")
    try:
        rows = readers.numbered_lines(spark, path)
        assert rows.rdd.getNumPartitions() > 1
        assert all(r.value == f"line {r.row_no}" for r in rows.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_fasta(spark, tmp_path):
    path = put(tmp_path / "c.fasta", ">c1 first\nAC\nGT\n>c2\nA\n")
    assert {(r.seq_id, r.seq) for r in readers.read_fasta(spark, path, whole_id=False).collect()} == {("c1", "ACGT"), ("c2", "A")}
    sinks.write_fasta(readers.read_fasta(spark, path), str(tmp_path / "out"))
    assert {(r.seq_id, r.seq) for r in readers.read_fasta(spark, str(tmp_path / "out")).collect()} == {("c1 first", "ACGT"), ("c2", "A")}


def test_sam(spark, tmp_path):
    rows, heads = readers.read_sam(spark, put(tmp_path / "a.sam", "@SQ\tSN:x\nr1\t77\t*\t0\t0\t*\t*\t0\t0\tAC\t!!\n"))
    assert rows.head().flag == 77 and heads.count() == 1


def test_annotated_formats(spark, tmp_path):
    base = ["UniRef50_A", "2", "0.1", "0.2", "0.3", "5", "species", "x", "f", "M", "c", "s", "y"]
    v1, v2, bare = [*base, "f", "0.5"], [*base, "4.0", "k__B;p__;c__;o__;f__;g__;s__"], [*base[:8], *[""] * 5, "2"]
    path = put(tmp_path / "s_tophit_report_subsystems_taxa.gz", "\n".join("\t".join(r) for r in (v1, v2, bare)) + "\nshort\n")
    rows = readers.read_annotated(spark, path).collect()
    assert [r.weight for r in rows] == [0.5, 4.0, 2.0] and rows[1].lineage.startswith("k__B") and rows[0].lineage is None
    assert rows[2].superclass is None and rows[0].sample_id == "s"


def test_annotated_form_is_given(spark, tmp_path):
    """With a given form a row is read in that form, whatever else could be read from it."""
    base = ["UniRef50_A", "2", "0.1", "0.2", "0.3", "5", "species", "x", "f", "M", "c", "s", "y"]
    path = put(tmp_path / "s_tophit_report_subsystems_taxa", "\n".join("\t".join(r) for r in ([*base, "4.0", "7.5", "k__B"], [*base, "word", "0.5", "k__A"])) + "\nshort\n")
    assert [(r.weight, r.lineage) for r in readers.read_annotated(spark, path, form="v2").collect()] == [(4.0, "7.5"), (None, "0.5")]
    assert [(r.weight, r.lineage) for r in readers.read_annotated(spark, path, form="v1").collect()] == [(7.5, "k__B"), (0.5, "k__A")]


def test_tables(spark, tmp_path):
    hit = "UniRef50_A\t21\t0.9\t20.7\t0.4\t77\tspecies\tx y\n"
    assert readers.read_tophit_report(spark, put(tmp_path / "q_tophit_report.gz", hit)).head().n_aligned == 21
    aln = "r1\tU\t0.2\t322\t36\t0\t0\t48\t0\t322\t1.2E-23\t100\n"
    assert readers.read_tophit_aln(spark, put(tmp_path / "q_tophit_aln.gz", aln)).head().bitscore == 100
    assert readers.read_lca(spark, put(tmp_path / "q_lca_taxonomy.tsv.gz", "r\t9\tclade\tn\t1\t1\t1\t1.0\tk__B;p__\n")).head().lineage == "k__B;p__"
    report = readers.read_report(spark, put(tmp_path / "q_report.gz", "1.0\t5\t2\tspecies\t9\t    a b\n")).head()
    assert report.row_no == 0 and report.name.strip() == "a b" and report.sample_id == "q"
    stat = json.dumps({"s": {"QC-passed reads": {"mapped": 3, "total": 4, "mapped %": 75.0}}})
    assert [tuple(r) for r in readers.read_flagstat(spark, put(tmp_path / "f.json", stat + "\nnot json\n")).collect()] == [("s", 3, 4, 75.0)]
    assert readers.read_linkout(spark, put(tmp_path / "l.tsv", "uniprot_id\tpatric_id\n P1 \tfig|1.2.peg.3\n\t\n")).head().uniprot_id == "P1"
    assert readers.read_genome_subsystems(spark, put(tmp_path / "g.tab", "\t".join("abcdefghijk") + "\nshort\n")).head().subsystem_name == "k"
    assert readers.read_intermediate(spark, put(tmp_path / "i.tsv", "#x\np\trole\t\tc\n")).head().superclass is None
    assert readers.read_clusters(spark, put(tmp_path / "k.tsv", "clustername\tcontig\n#c\n1\tc1\n")).count() == 1
    assert readers.read_groups(spark, put(tmp_path / "gr.tsv", "Group\tSample\nA\tGSV_\n")).head().pattern == "GSV_"


def test_taxonomy_dump(spark, tmp_path):
    put(tmp_path / "nodes.dmp", "1\t|\t1\t|\tno rank\t|\n2\t|\t1\t|\tsuperkingdom\t|\n")
    put(tmp_path / "names.dmp", "2\t|\tBacteria\t|\t\t|\tscientific name\t|\n2\t|\tgerms\t|\t\t|\tcommon name\t|\n")
    put(tmp_path / "merged.dmp", "9\t|\t2\t|\n")
    put(tmp_path / "delnodes.dmp", "7\t|\n")
    got = readers.read_taxonomy_dump(spark, str(tmp_path))
    assert got["nodes"].where("taxid = 2").head().name == "Bacteria" and got["merged"].head().new == 2 and got["delnodes"].head().taxid == 7


def test_matrix_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("S1", "b", 2.0), ("S2", "a", 3.0)], "sample_id string, category string, total double")
    wide = sinks.matrix(rows, "total")
    assert [tuple(r) for r in wide.collect()] == [("a", 0.0, 3.0), ("b", 2.0, 0.0)]
    sinks.write_matrix(wide, str(tmp_path / "m"))
    assert {tuple(r) for r in readers.read_matrix(spark, str(tmp_path / "m")).where("value > 0").collect()} == {("S1", "b", 2.0), ("S2", "a", 3.0)}
    sinks.write_matrix(wide, str(tmp_path / "c"), "made today")
    assert [r.value for r in spark.read.text(str(tmp_path / "c")).collect()] == ["# made today", "category\tS1\tS2", "a\t0.0\t3.0", "b\t2.0\t0.0"]
    assert [tuple(r) for r in sinks.transposed(rows, "total", ["a", "b"], "category").collect()] == [("S1", 0.0, 2.0), ("S2", 3.0, 0.0)]
    assert json.loads(sinks.as_document(rows, "category", "total").head().value) == {"a": 3.0, "b": 2.0}


def test_clusters_and_paths(spark, tmp_path):
    rows = spark.createDataFrame([("k1", "a", "AC"), ("k2", "b", "GT")], "cluster_id string, seq_id string, seq string")
    sinks.write_by_cluster(rows, str(tmp_path / "bins"))
    assert readers.read_fasta(spark, str(tmp_path / "bins/cluster_id=k1")).head().seq == "AC"
    files = spark.createDataFrame([("m/x/x_tophit_report_subsystems.gz",), ("m/x/x_tophit_report_subsystems_taxa.gz",), ("m/x/x_report.gz",)], "path string")
    assert readers.best_files(files).head().path.endswith("_taxa.gz")


def test_ingest_adds_each_file_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    trembl = spark.createDataFrame([("A", "f")], "uniprot string, func string")
    sub = spark.createDataFrame([("M", "c", "s", "x", "f")], "superclass string, class string, subclass string, subsystem_name string, func string")
    run = lambda: ingest_hits(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp"), trembl, sub).awaitTermination()
    for n in (1, 2):
        put(tmp_path / f"in/s{n}_tophit_report.gz", "UniRef50_A\t21\t0.9\t20.7\t0.4\t77\tspecies\tx\n")
        run()
        run()
        got = spark.read.parquet(str(tmp_path / "out")).collect()
        assert len(got) == n and {r.sample_id for r in got} == {f"s{i + 1}" for i in range(n)}


def test_fasta_without_header(spark, tmp_path):
    (tmp_path / "in").mkdir()
    put(tmp_path / "in/good.fasta", ">a\nAC\n")
    assert readers.read_fasta(spark, str(tmp_path / "in")).count() == 1
    put(tmp_path / "in/bad.fasta", "ACGT\nAC\n")
    with pytest.raises(Exception, match="no sequence header"):
        readers.read_fasta(spark, str(tmp_path / "in")).collect()


def test_rank_tables_round_trip(spark, tmp_path):
    rows = [("S1", "kingdom", "k__A", 3, 750000.0), ("S1", "phylum", "k__A;p__B", 1, 250000.0), ("S2", "kingdom", "k__A", 2, 1e6)]
    counts = spark.createDataFrame(rows, "sample_id string, rank string, taxon string, count long, rpm double")
    sinks.write_ranks(counts, str(tmp_path / "ranks"))
    got = readers.read_ranks(spark, str(tmp_path / "ranks")).select("sample_id", "rank", "taxon", "count", "rpm").collect()
    assert sorted(map(tuple, got)) == rows


def test_mate_and_fastq_lines(spark):
    names = spark.createDataFrame([("a_R1_R1.fastq.gz",), ("b.fastq",)], "n string")
    assert [r[0] for r in names.select(readers.mate_of(names["n"])).collect()] == ["a_R2_R1.fastq.gz", None]
    reads = spark.createDataFrame([("r1 x", "AC", "!!")], "header string, seq string, qual string")
    assert sinks.fastq_lines(reads).head().value == "@r1 x\nAC\n+\n!!"


def test_tables_and_star(spark, tmp_path):
    rows = spark.createDataFrame([("S1", "r1", "k__A;p__;c__;o__;f__;g__;s__x"), ("S1", "r2", "odd")], "sample_id string, dna_id string, lineage string")
    sinks.save(sinks.lineage_columns(rows), "lca_rows")
    assert [(r.sample_id, r.kingdom, r.species) for r in spark.table("lca_rows").collect()] == [("S1", "k__A", "s__x")]
    spark.sql("drop table lca_rows")
    sinks.save_star({"roles": rows.select("dna_id"), "subsystems": rows}, str(tmp_path / "star"))
    assert spark.read.parquet(str(tmp_path / "star/subsystems")).count() == 2


def test_top_hit_without_subsystem(spark):
    from mudlark.operators import annotate

    hits = spark.createDataFrame([("S", "q1", "UniRef50_A", 0), ("S", "q1", "UniRef50_B", 1), ("S", "q2", "UniRef50_A", 0)], "sample_id string, dna_id string, uniref_id string, row_no long")
    trembl = spark.createDataFrame([("A", "fa"), ("B", "fb")], "uniprot string, func string")
    subsystems = spark.createDataFrame([("x", "y", "z", "s", "fb")], "superclass string, class string, subclass string, subsystem_name string, func string")
    assert [(r.dna_id, r.uniref_id) for r in annotate.top_hits(hits, trembl, subsystems, "f").collect()] == [("q1", "UniRef50_B")]
    assert sorted((r.dna_id, r.uniref_id) for r in annotate.top_hits(hits, trembl, subsystems, "t").collect()) == [("q1", "UniRef50_A"), ("q2", "UniRef50_A")]


def test_samples_named_by_folders(spark, tmp_path):
    """What is written by sample is read with its sample again, by every kind of scan; hidden folders are left out."""
    reads = spark.createDataFrame([("S1", "r1 x", "AC", "!!"), ("S2", "r2", "GGT", "@@@")], "sample_id string, header string, seq string, qual string")
    sinks.write_fastq(reads, str(tmp_path / "q"), by="sample_id")
    (tmp_path / "q/.old=1").mkdir()
    put(tmp_path / "q/.old=1/a.fastq", "no record\n")
    for by_spark in (False, True):
        got = readers.read_fastq(spark, str(tmp_path / "q"), by_spark=by_spark).select(*reads.columns).collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, reads.collect()))
    sinks.write_fasta(reads, str(tmp_path / "a"), "header", by="sample_id")
    assert sorted((r.sample_id, r.seq) for r in readers.read_fasta(spark, str(tmp_path / "a")).collect()) == [("S1", "AC"), ("S2", "GGT")]
    hit = spark.createDataFrame([("S1", "UniRef50_A\t21\t0.9\t20.7\t0.4\t77\tspecies\tx")], "sample_id string, value string")
    sinks.write_lines(hit, str(tmp_path / "h"), "sample_id")
    for by_content in (False, True):
        rows = readers.read_tophit_report(spark, str(tmp_path / "h"), by_content=by_content)
        assert rows.columns[0] == "sample_id" and len(rows.columns) == 9 and (rows.head().sample_id, rows.head().taxid) == ("S1", 77)
    names = spark.createDataFrame([("x/y=1/z/s_report.gz",), ("sample_id=S/part-0.txt.gz",), ("a/sample_id=S/part-0.txt.gz",)], "p string")
    assert [r[0] for r in names.select(readers.sample_of(names["p"])).collect()] == ["s", "part-0", "S"]
