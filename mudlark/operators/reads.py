"""Reads: quality rules, host removal by alignment flags, fate, selection by taxon, header rewriting."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Output -> (flag bits that must be absent, bits that must be present).
FLAG_MASKS = {
    "host_r1": (3588, 65),
    "host_r2": (3588, 129),
    "nonhost_r1": (3584, 77),
    "nonhost_r2": (3584, 141),
    "host_single": (3588, 0),
    "nonhost_single": (3584, 4),
    "singletons": (1, 4),
    "binning": (3584, 0),
}


def flagged(exclude: int, require: int, flag: str = "flag") -> Column:
    return (F.col(flag).bitwiseAND(F.lit(exclude)) == 0) & (F.col(flag).bitwiseAND(F.lit(require)) == require)


def host_split(alignments: DataFrame, outputs: tuple[str, ...] = tuple(FLAG_MASKS)) -> DataFrame:
    """Each alignment once for every output whose masks it meets. An unmapped mate of a mapped read meets neither
    paired non-host mask."""
    met = F.filter(F.array(*[F.when(flagged(*FLAG_MASKS[o]), F.lit(o)) for o in outputs]), lambda x: x.isNotNull())
    return alignments.withColumn("output", F.explode(met))


def flagstat(alignments: DataFrame) -> DataFrame:
    """Mapped, total and percentage per sample."""
    out = alignments.groupBy("sample_id").agg(F.count_if(F.col("flag").bitwiseAND(F.lit(4)) == 0).alias("mapped"), F.count("*").alias("total"))
    return out.withColumn("mapped_pct", F.col("mapped") / F.col("total") * 100)


def empty_samples(alignments: DataFrame) -> DataFrame:
    """Samples without a mapped read."""
    return flagstat(alignments).where("mapped = 0").select("sample_id", "total")


def without_empty(rows: DataFrame, alignments: DataFrame) -> DataFrame:
    return rows.join(empty_samples(alignments).select("sample_id"), "sample_id", "left_anti")


def passes_qc(most_n: int = 1, least_length: int = 100, letter: str = "N", seq: str = "seq") -> Column:
    """Long enough, with few enough unknown bases."""
    return (F.length(seq) >= least_length) & (F.length(seq) - F.length(F.replace(F.col(seq), F.lit(letter), F.lit(""))) <= most_n)


def pairs_passing(reads: DataFrame, most_n: int = 1, least_length: int = 100) -> DataFrame:
    """Read pairs of which both mates pass."""
    good = reads.groupBy("sample_id", "read_id").agg(F.bool_and(passes_qc(most_n, least_length)).alias("ok")).where("ok")
    return reads.join(good.drop("ok"), ["sample_id", "read_id"], "left_semi")


def bare_id(read_id: str = "read_id") -> Column:
    """A read's id without mate tags and what follows a space."""
    return F.split(F.replace(F.replace(F.col(read_id), F.lit("/1"), F.lit("")), F.lit("/2"), F.lit("")), " ")[0]


def reads_by_taxon(reads: DataFrame, lca: DataFrame, taxon: str) -> DataFrame:
    """Reads whose lineage holds the taxon."""
    return reads.join(lca.where(F.col("lineage").contains(taxon)).select("sample_id", F.col("dna_id").alias("read_id")), ["sample_id", "read_id"], "left_semi")


STAGES = ("raw", "qc", "host", "nonhost", "hit")
#: First that holds names the fate.
FATES = (("not in_qc", "failed fastp"), ("in_host", "human"), ("in_nonhost and in_hit", "uniref"), ("in_nonhost", "unknown"))


def staged(**stages: DataFrame) -> DataFrame:
    """One row per sample and raw read with flags ``in_qc, in_host, in_nonhost, in_hit``: the stages' ids tagged,
    united and grouped, in one shuffle."""
    rows = reduce(DataFrame.unionByName, [df.select("sample_id", "read_id", F.lit(name).alias("stage")) for name, df in stages.items()])
    flags = [F.coalesce(F.bool_or(F.col("stage") == s), F.lit(False)).alias(f"in_{s}") for s in STAGES]
    return rows.groupBy("sample_id", "read_id").agg(*flags).where("in_raw").drop("in_raw")


def fates(stage: DataFrame) -> DataFrame:
    """Adds ``fate`` to staged reads."""
    fate = reduce(lambda c, x: c.when(F.expr(x[0]), x[1]), FATES[1:], F.when(F.expr(FATES[0][0]), FATES[0][1]))
    return stage.withColumn("fate", fate.otherwise("not sure"))


def fate_summary(stage: DataFrame) -> DataFrame:
    """Per sample the reads of each stage; ``unknown`` as non-host less hits, ``unknown_reads`` as counted."""
    n = {c: F.count_if(c) for c in ("in_qc", "in_host", "in_nonhost", "in_hit")}
    out = stage.groupBy("sample_id").agg(F.count("*").alias("raw"), *[v.alias(k[3:]) for k, v in n.items()], F.count_if(F.col("in_qc") & ~F.col("in_host") & F.col("in_nonhost") & ~F.col("in_hit")).alias("unknown_reads"))
    return out.withColumn("unknown", F.col("nonhost") - F.col("hit"))


def unknown_reads(reads: DataFrame, stage: DataFrame) -> DataFrame:
    """The reads of fate unknown."""
    return reads.join(fates(stage).where("fate = 'unknown'").select("sample_id", "read_id"), ["sample_id", "read_id"], "left_semi")


def fasta_header(header: str = "header", mate: str | None = None, underscores: bool = False) -> Column:
    """A header rewritten: spaces to underscores, or ``/<mate>`` behind its id."""
    out = F.replace(F.col(header), F.lit(" "), F.lit("_")) if underscores else F.col(header)
    return F.regexp_replace(out, r"^(\S+)", F.concat(F.lit("$1/"), F.col(mate).cast("string"))) if mate else out


def mate_of(read_id: str = "read_id") -> Column:
    """Mate of interleaved reads by the id's last letter."""
    return F.when(F.right(F.col(read_id), F.lit(1)) == "1", 1).otherwise(2)


def mates_even(reads: DataFrame) -> DataFrame:
    """Per sample the reads of each mate and whether they are as many."""
    n = reads.groupBy("sample_id").agg(F.count_if(F.col("mate") == 1).alias("r1"), F.count_if(F.col("mate") == 2).alias("r2"))
    return n.withColumn("even", F.col("r1") == F.col("r2"))


def headers_even(headers: DataFrame) -> DataFrame:
    """Per sample the reference lines of alignment headers, and whether all samples have as many."""
    n = headers.groupBy("sample_id").agg(F.count("*").alias("n"))
    return n.withColumn("even", n.select(F.min("n") == F.max("n")).scalar())
