"""Hits to functions, subsystems and lineages."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mudlark.functions.checkpoints import checkpointed
from mudlark.functions.skew import SAMPLE, SEED, fits_whole, left_join_spread, sized

HIERARCHY = ("superclass", "class", "subclass", "subsystem_name")
#: Lineage of a hit whose taxon has none.
NO_LINEAGE = "k__;p__;c__;o__;f__;g__;s__"


def with_accession(hits: DataFrame, column: str = "uniref_id") -> DataFrame:
    """Adds ``accession``, the part of a cluster id after its prefix; null where the id has another form."""
    return hits.withColumn("accession", F.nullif(F.regexp_extract(column, r"^UniRef\d+_(\w+)", 1), F.lit("")))


def functions_of(trembl: DataFrame) -> DataFrame:
    """One function for each accession: the first in alphabetical order."""
    return trembl.groupBy(F.col("uniprot").alias("accession")).agg(F.min("func").alias("func"))


def weighted_subsystems(subsystems: DataFrame) -> DataFrame:
    """Distinct subsystem rows, each with how many its function has; counted here, not on the hits."""
    rows = subsystems.select(*HIERARCHY, "func").distinct()
    return rows.join(rows.groupBy("func").agg(F.count("*").alias("n_subsystems")), "func")


def _seen(hits: DataFrame, trembl: DataFrame, whole: bool) -> Callable[[], DataFrame]:
    """Gives a sample of the hits' keys, stored when it is first asked for: ``accession``, ``func`` and what else they have of ``taxid``."""

    @cache
    def stored() -> DataFrame:
        keys = with_accession(hits.sample(SAMPLE, SEED)).select("accession", *[c for c in hits.columns if c == "taxid"])
        return checkpointed(keys.join(sized(functions_of(trembl), whole), "accession", "left"))

    return stored


def with_function(hits: DataFrame, trembl: DataFrame, seen: Callable[[], DataFrame] | None = None, whole: bool = False) -> DataFrame:
    """Hits with the function of their accession, null where there is none. An accession may hold most hits, and so may none."""
    return left_join_spread(with_accession(hits), functions_of(trembl), "accession", seen=seen, whole=whole)


def counted_functions(hits: DataFrame, trembl: DataFrame, *keys: str) -> DataFrame:
    """``sample_id, func, <keys>, n_aligned``: hits summed before they are expanded to subsystems. Weights are shares of
    counts, so sums of weights stay the same, over far fewer rows; hits without a function are one row of a sample. They are
    summed by accession first, so that no accession is more than a row of a sample (and keys) in the join."""
    rows = with_accession(hits).groupBy("sample_id", "accession", *keys).agg(F.sum("n_aligned").alias("n_aligned"))
    return rows.join(functions_of(trembl), "accession", "left").groupBy("sample_id", "func", *keys).agg(F.sum("n_aligned").alias("n_aligned"))


def expanded(rows: DataFrame, subsystems: DataFrame) -> DataFrame:
    """Rows of ``func, n_aligned`` once for every subsystem row of their function, with ``weight``."""
    out = rows.join(weighted_subsystems(subsystems), "func", "left")
    return out.withColumn("weight", F.col("n_aligned") / F.coalesce("n_subsystems", F.lit(1)))


def grouped_subsystems(subsystems: DataFrame) -> DataFrame:
    """``func, systems``: a function's distinct subsystem rows, as an array of the reference table's size."""
    return subsystems.select(*HIERARCHY, "func").distinct().groupBy("func").agg(F.collect_list(F.struct(*HIERARCHY)).alias("systems"))


def annotate(hits: DataFrame, trembl: DataFrame, subsystems: DataFrame, lineage: DataFrame | None = None, digits: int | None = None) -> DataFrame:
    """Each hit once for every subsystem row of its function, with ``weight`` = count / number of these rows, and its ``lineage`` if these are given.

    Hits without accession, function or subsystem stay as one row with weight = count, so a sample's weights
    sum to its counts. A hit meets its function, lineage and subsystems as one row; it is multiplied last, where it
    lies, so that no shuffle moves more rows than there are hits. Tables that are small by their measured bytes are broadcast, so hits move
    for the others only. ``digits``: weights are rounded, before that too.
    """
    known = fits_whole(trembl)
    seen = _seen(hits, trembl, known)
    rows = with_function(hits, trembl, seen, known)
    rows = rows if lineage is None else with_lineage(rows, lineage, seen=seen)
    rows = left_join_spread(rows, grouped_subsystems(subsystems), "func", seen=seen, whole=fits_whole(subsystems))
    n = F.when(F.col("systems").isNotNull(), F.size("systems"))
    weight = F.col("n_aligned") / F.coalesce(n, F.lit(1))
    columns = [c for c in rows.columns if c not in ("systems", "lineage")]
    last = [] if lineage is None else ["lineage"]
    rows = rows.select(*columns, "systems", n.cast("long").alias("n_subsystems"), (weight if digits is None else F.round(weight, digits)).alias("weight"), *last)
    return rows.select(*columns, F.inline_outer("systems"), "n_subsystems", "weight", *last)


def with_lineage(rows: DataFrame, lineage: DataFrame, spread: bool = False, seen: Callable[[], DataFrame] | None = None) -> DataFrame:
    """Adds ``lineage`` by ``taxid``, the empty one where there is none; domain prefixes ``d__`` become ``k__``.

    ``spread``: for stored rows of which a few taxa may hold most; the sample that finds them computes the rows again, unless their taxa are
    ``seen`` in a stored one."""
    one = lineage.groupBy("taxid").agg(F.regexp_replace(F.min("lineage"), "^d__", "k__").alias("lineage"))
    both = left_join_spread(rows, one, "taxid", seen=seen, whole=fits_whole(lineage)) if spread or seen is not None else rows.join(one, "taxid", "left")
    return both.withColumn("lineage", F.coalesce("lineage", F.lit(NO_LINEAGE)))


def has_subsystem(column: str = "superclass"):
    return F.coalesce(F.col(column), F.lit("")) != ""


def top_hits(hits: DataFrame, trembl: DataFrame, subsystems: DataFrame, mode: str = "f", seed: int = 0) -> DataFrame:
    """A query's hits by mode: ``f`` the first that has a subsystem (a query without one has no row), ``t`` the first,
    ``r`` one at random (by a seeded MD5, which other engines have too), ``a`` all, ``s`` all with a subsystem. First is by ``row_no``, then subsystem."""
    known, whole = fits_whole(trembl), fits_whole(subsystems)
    seen = _seen(hits, trembl, known)
    found = with_function(hits, trembl, seen, known)
    if mode in "asr":
        # a query's hits meet their subsystems as arrays: they are multiplied where they lie, and for ``r`` not at all
        some = subsystems.where(has_subsystem()) if mode == "s" else subsystems
        found = found.where("func is not null") if mode == "s" else found
        rows = left_join_spread(found, grouped_subsystems(some), "func", seen=seen, whole=whole)
    if mode in "as":
        return rows.select(*found.columns, F.inline("systems") if mode == "s" else F.inline_outer("systems"))
    if mode == "r":
        none = F.array(F.struct(*[F.lit(None).cast("string").alias(c) for c in HIERARCHY]))
        draw = lambda x: F.struct(F.md5(F.concat_ws("|", F.lit(str(seed)), "dna_id", "uniref_id", "row_no", *[F.coalesce(x[c], F.lit("")) for c in HIERARCHY])).alias("draw"), x.alias("system"))
        drawn = F.array_min(F.transform(F.coalesce("systems", none), draw)).alias("x")
        rows = rows.select(*found.columns, drawn).select(*found.columns, "x.system.*", "x.draw")
        order = [F.col("draw")]
    else:
        # a function's first subsystem is found on the small table, so that hits are not multiplied before one is picked
        names = ("subsystem_name", "superclass", "class", "subclass")
        every = subsystems.where(has_subsystem()) if mode == "f" else subsystems
        first = every.groupBy("func").agg(F.min(F.struct(*names)).alias("x")).select("func", *[F.col(f"x.{c}").alias(c) for c in HIERARCHY])
        rows = left_join_spread(found, first, "func", seen=seen, whole=whole)
        rows = rows.where(has_subsystem()) if mode == "f" else rows
        order = [F.col(c) for c in ("row_no", *names)]
    # partial aggregates keep one hit of each query: nothing is sorted and no query's hits are gathered
    best = rows.groupBy("sample_id", "dna_id").agg(F.min_by(F.struct(*[c for c in rows.columns if c not in ("sample_id", "dna_id", "draw")]), F.struct(*order)).alias("x"))
    return best.select("sample_id", "dna_id", "x.*")
