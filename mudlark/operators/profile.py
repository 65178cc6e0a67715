"""Functional profiles: weights summed at the levels of the subsystem hierarchy and normalised per million."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mudlark.operators.annotate import HIERARCHY, counted_functions, expanded, has_subsystem, with_lineage

#: Level -> columns of its key, joined by "; ".
LEVELS = {
    "class": ("superclass",),
    "level1": ("class",),
    "level2": ("class", "subclass"),
    "subsystem": ("subsystem_name",),
    "all": HIERARCHY,
    "all_fn": (*HIERARCHY, "func"),
}


def key_of(level: str) -> Column:
    return F.concat_ws("; ", *LEVELS[level])


def sample_totals(annotated: DataFrame) -> DataFrame:
    """Per sample the weight of all hits, and of those in a subsystem."""
    return annotated.groupBy("sample_id").agg(F.sum("weight").alias("total_all"), F.coalesce(F.sum(F.when(has_subsystem(), F.col("weight"))), F.lit(0.0)).alias("total_ss"))


def per_million(total: str, of: str) -> Column:
    return F.coalesce(F.try_divide(F.col(total), F.col(of)) * 1e6, F.lit(0.0))


def profile(annotated: DataFrame, levels: Sequence[str] = tuple(LEVELS), totals: DataFrame | None = None) -> DataFrame:
    """``sample_id, level, category, total, norm_all, norm_ss`` in long form, one pass for all levels.

    Every row is expanded to one for each level, and partial sums are taken before the shuffle. A sample
    without a subsystem hit has no rows; a zero denominator gives 0.
    """
    rows = annotated.where(has_subsystem()).select("sample_id", "weight", F.inline(F.array(*[F.struct(F.lit(x).alias("level"), key_of(x).alias("category")) for x in levels])))
    sums = rows.groupBy("sample_id", "level", "category").agg(F.sum("weight").alias("total"))
    out = sums.join(sample_totals(annotated) if totals is None else totals, "sample_id")
    return out.select("sample_id", "level", "category", "total", per_million("total", "total_all").alias("norm_all"), per_million("total", "total_ss").alias("norm_ss"))


def profile_of_hits(hits: DataFrame, trembl: DataFrame, subsystems: DataFrame, levels: Sequence[str] = tuple(LEVELS)) -> DataFrame:
    """The profile of unannotated hits: the same rows as that of ``annotate``, but hits are summed by sample and function
    before they are expanded, and the total of all hits needs no expansion."""
    counts = counted_functions(hits, trembl)
    return _profile_of_counts(counts, counts, subsystems, levels)


def profile_of_hits_excluding(hits: DataFrame, trembl: DataFrame, subsystems: DataFrame, lineage: DataFrame, names: Sequence[str], levels: Sequence[str] = tuple(LEVELS)) -> DataFrame:
    """The same for ``profile_excluding``: hits are summed by sample, function and taxon first."""
    counts = counted_functions(hits, trembl, "taxid")
    rest = with_lineage(counts, lineage).where(~listed("lineage", names)).groupBy("sample_id", "func").agg(F.sum("n_aligned").alias("n_aligned"))
    return _profile_of_counts(counts, rest, subsystems, levels)


def _profile_of_counts(counts: DataFrame, rest: DataFrame, subsystems: DataFrame, levels: Sequence[str]) -> DataFrame:
    rows = expanded(rest, subsystems).where(has_subsystem())
    totals = counts.groupBy("sample_id").agg(F.sum("n_aligned").cast("double").alias("total_all"))
    totals = totals.join(rows.groupBy("sample_id").agg(F.sum("weight").alias("total_ss")), "sample_id", "left").fillna(0.0, ["total_ss"])
    return profile(rows, levels, totals)


def listed(column: str, names: Sequence[str]) -> Column:
    """Whether any of the names occurs in the column."""
    return reduce(lambda a, b: a | b, [F.coalesce(F.col(column), F.lit("")).contains(n) for n in names], F.lit(False))


def profile_excluding(annotated: DataFrame, names: Sequence[str], levels: Sequence[str] = tuple(LEVELS)) -> DataFrame:
    """The profile without hits whose lineage holds one of the names. They stay in the total of all hits,
    and leave the level sums and the total of subsystem hits."""
    rest = annotated.where(~listed("lineage", names))
    totals = sample_totals(annotated).select("sample_id", "total_all").join(sample_totals(rest).select("sample_id", "total_ss"), "sample_id", "left").fillna(0.0, ["total_ss"])
    return profile(rest, levels, totals)


def check_lineages(annotated: DataFrame) -> DataFrame:
    """The rows; fails when one has no lineage of seven ranks."""
    shape = F.size(F.split(F.coalesce("lineage", F.lit("")), ";")) == 7
    return annotated.withColumn("lineage", F.when(shape, F.col("lineage")).otherwise(F.raise_error(F.lit("a row has no lineage"))))


def cleaned_sample(column: str = "sample_id") -> Column:
    """A sample's name without a sequencer's ``_S<n>`` at its end."""
    return F.regexp_replace(column, r"_S\d+$", "")


def renamed(rows: DataFrame, metadata: DataFrame) -> DataFrame:
    """Samples renamed by ``metadata(old, new)``: a cleaned name is looked up among the old names (giving the
    cleaned new one) and the cleaned old ones (giving the new one as it is, which wins). Others keep the cleaned name."""
    entries = metadata.select(F.col("old").alias("k"), cleaned_sample("new").alias("v"), F.lit(0).alias("o")).union(metadata.select(cleaned_sample("old"), F.col("new"), F.lit(1)))
    names = entries.groupBy("k").agg(F.max_by("v", F.struct("o", "v")).alias("v"))
    out = rows.withColumn("k", cleaned_sample())
    return out.join(names, "k", "left").withColumn("sample_id", F.coalesce("v", "k")).drop("k", "v")
