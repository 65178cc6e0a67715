"""Flow of reads through the stages: counts, domains and edges of the diagram."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: First name found in the lineage decides.
DOMAINS = ("Bacteria", "Archaea", "Eukaryota", "Virus")


def stage_counts(stage: DataFrame) -> DataFrame:
    """``sample_id, stage, n`` from staged reads."""
    names = {"raw": F.lit(True), "trimmed": F.col("in_qc"), "host": F.col("in_host"), "nonhost": F.col("in_nonhost")}
    rows = stage.select("sample_id", F.explode(F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in names.items()]), lambda x: x.isNotNull())).alias("stage"))
    return rows.groupBy("sample_id", "stage").agg(F.count("*").alias("n"))


def domain_of(taxon: str = "taxon"):
    when = reduce(lambda c, d: c.when(F.col(taxon).contains(d), d), DOMAINS[1:], F.when(F.col(taxon).contains(DOMAINS[0]), DOMAINS[0]))
    return when.otherwise("Multidomain")


def domain_totals(counts: DataFrame) -> DataFrame:
    """Reads of each domain over all samples, from counts at the highest rank."""
    return counts.groupBy(domain_of().alias("domain")).agg(F.sum("count").alias("n"))


def flow_edges(stages: DataFrame, domains: DataFrame, sixteen_s: int = 0, host: str = "human") -> DataFrame:
    """``source, n, target``: the twelve edges. Low quality is raw less trimmed, unknown what is non-host but neither
    similar to anything nor 16S."""
    n = {s: F.coalesce(F.sum(F.when(F.col("stage") == s, F.col("n"))), F.lit(0)) for s in ("raw", "trimmed", "host", "nonhost")}
    d = {x: F.coalesce(F.sum(F.when(F.col("domain") == x, F.col("n"))), F.lit(0)) for x in (*DOMAINS, "Multidomain")}
    # the few rows of both as one table, summed at once
    rows = stages.select("stage", F.lit(None).cast("string").alias("domain"), "n").unionByName(domains.select(F.lit(None).cast("string").alias("stage"), "domain", "n"))
    both = rows.agg(*[c.alias(x) for x, c in (n | d).items()])
    similar = reduce(lambda a, b: a + b, [F.col(x) for x in d])
    edges = [
        ("fastq", F.col("trimmed"), "fastp"),
        ("fastq", F.col("raw") - F.col("trimmed"), "low quality"),
        ("fastp", F.col("host"), host),
        ("fastp", F.col("nonhost"), f"not {host}"),
        (f"not {host}", similar, "sequence similarity"),
        (f"not {host}", F.lit(sixteen_s), "16S"),
        (f"not {host}", F.col("nonhost") - similar - F.lit(sixteen_s), "unknown"),
        ("sequence similarity", F.col("Eukaryota"), "Eukaryote"),
        ("sequence similarity", F.col("Bacteria"), "Bacteria"),
        ("sequence similarity", F.col("Archaea"), "Archaea"),
        ("sequence similarity", F.col("Virus"), "Virus"),
        ("sequence similarity", F.col("Multidomain"), "Multiclass"),
    ]
    return both.select(F.inline(F.array(*[F.struct(F.lit(a).alias("source"), n.cast("long").alias("n"), F.lit(b).alias("target")) for a, n, b in edges])))


def summary_document(stages: DataFrame, domains: DataFrame, sixteen_s: DataFrame, project: str = "unknown") -> DataFrame:
    """One row ``value``: the JSON summary of a project, totals first, then ``tax``, ``six_counts`` and ``count_data`` by sample.

    From ``stages(sample_id, stage, n)``, ``domains(domain, n)`` and ``sixteen_s(sample_id, n)``: all are put into one table of a row for
    each sample or domain, and that is summed and put together by one aggregate; nothing comes to the driver."""
    names = {"fastq": "raw", "trimmed": "trimmed", "host": "host", "no_host": "nonhost"}
    by_sample = stages.groupBy("sample_id").agg(*[F.coalesce(F.sum(F.when(F.col("stage") == s, F.col("n"))), F.lit(0)).alias(c) for c, s in names.items()])
    counts = F.struct(*names)
    kind = by_sample.select(counts).schema[0].dataType
    rows = by_sample.select(F.lit("count").alias("kind"), F.col("sample_id").alias("key"), F.lit(0).cast("long").alias("n"), counts.alias("counts"))
    for name, df, key in (("six", sixteen_s, "sample_id"), ("tax", domains, "domain")):
        sums = df.groupBy(key).agg(F.sum("n").alias("n"))
        rows = rows.unionByName(sums.select(F.lit(name).alias("kind"), F.col(key).alias("key"), F.col("n").cast("long").alias("n"), F.lit(None).cast(kind).alias("counts")))
    of = lambda name: F.col("kind") == name
    pairs = lambda name, x: F.map_from_entries(F.array_sort(F.collect_list(F.when(of(name), F.struct("key", x)))))
    total = {f"sum_{c}": F.coalesce(F.sum(F.col("counts")[c]), F.lit(0)) for c in names}
    tax = {"Bacteria": "Bacteria", "Archaea": "Archaea", "Eukaryota": "Eukaryota", "Viruses": "Virus", "Multidomain": "Multidomain"}
    total |= {f"tax_{k}": F.coalesce(F.sum(F.when(of("tax") & (F.col("key") == d), F.col("n"))), F.lit(0)) for k, d in tax.items()}
    total |= {"sixteen_s": F.coalesce(F.sum(F.when(of("six"), F.col("n"))), F.lit(0)), "six_counts": pairs("six", "n"), "count_data": pairs("count", "counts")}
    one = rows.agg(*[c.alias(k) for k, c in total.items()])
    similar = reduce(lambda a, b: a + b, [F.col(f"tax_{k}") for k in tax])
    fields = [
        F.lit(project).alias("project"),
        F.col("sum_fastq").alias("raw_fastq"),
        F.col("sum_trimmed").alias("trimmed_fastq"),
        (F.col("sum_fastq") - F.col("sum_trimmed")).alias("low_quality"),
        F.col("sum_host").alias("host"),
        F.col("sum_no_host").alias("no_host"),
        F.col("sixteen_s"),
        similar.alias("totalsims"),
        (F.col("sum_no_host") - similar - F.col("sixteen_s")).alias("nosims"),
        F.struct(*[F.col(f"tax_{k}").alias(k) for k in tax]).alias("tax"),
        "six_counts",
        "count_data",
    ]
    return one.select(F.to_json(F.struct(*fields)).alias("value"))


def flow_text(edges: DataFrame) -> DataFrame:
    return edges.select(F.format_string("%s [%d] %s", "source", "n", "target").alias("value"))


def sixteen_s_summary(stats: DataFrame) -> DataFrame:
    """Per sample mapped and total reads and their percentage from flag statistics."""
    return stats.groupBy("sample_id").agg(F.sum("mapped").alias("mapped"), F.sum("total").alias("total")).withColumn("mapped_pct", F.coalesce(F.try_divide(F.col("mapped"), F.col("total")) * 100, F.lit(0.0)))


def mean_mapped(summary: DataFrame) -> DataFrame:
    """Over all samples: how many there are and the mean of their percentages; without samples it is null."""
    return summary.agg(F.count("*").alias("samples"), F.avg("mapped_pct").alias("mean_mapped_pct"))


def extremes(summary: DataFrame, n: int = 10) -> DataFrame:
    """The samples of lowest and highest percentage; ties by name."""
    low = summary.orderBy("mapped_pct", "sample_id").limit(n).withColumn("side", F.lit("lowest"))
    high = summary.orderBy(F.desc("mapped_pct"), "sample_id").limit(n).withColumn("side", F.lit("highest"))
    return low.unionByName(high)
