"""Lineages from taxonomy trees, and taxonomic profiles at seven ranks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mudlark.functions.checkpoints import checkpointed
from mudlark.operators.annotate import with_lineage
from mudlark.operators.profile import listed

RANKS = ("kingdom", "phylum", "class", "order", "family", "genus", "species")
LETTERS = ("k", "p", "c", "o", "f", "g", "s")


def current_ids(taxa: DataFrame, merged: DataFrame | None = None, deleted: DataFrame | None = None) -> DataFrame:
    """Distinct ``taxid`` with ``current``: the id it was merged into, null where it was deleted."""
    out = taxa.select("taxid").distinct().withColumn("current", F.col("taxid"))
    if merged is not None:
        out = out.join(merged.select(F.col("old").alias("taxid"), "new"), "taxid", "left").withColumn("current", F.coalesce("new", "current")).drop("new")
    if deleted is not None:
        out = out.join(deleted.select("taxid", F.lit(True).alias("gone")), "taxid", "left").withColumn("current", F.when(F.col("gone").isNull(), F.col("current"))).drop("gone")
    return out


#: Ranks that a lineage's places are taken from: those of the first place in order of preference, then one for each other place.
PLACES = ("domain", "acellular root", "superkingdom", "phylum", "class", "order", "family", "genus", "species")


def lineages(taxa: DataFrame, nodes: DataFrame, merged: DataFrame | None = None, deleted: DataFrame | None = None) -> DataFrame:
    """``taxid, lineage`` of the distinct ids in ``taxa``, from ``nodes(taxid, parent, rank, name)``.

    By pointer doubling: every node knows the nearest name at each rank among its first 1, 2, 4, 8 ... ancestors, and where these end; a
    join with itself doubles them. So a tree of any depth takes as many joins as its depth has binary digits, and only nodes whose
    chain has not ended are joined. Each step is written to the checkpoint folder, so that plans stay short. Of several rows of an id
    the least is taken; unknown ids get empty ranks; parents in a circle are an error."""
    ids = current_ids(taxa, merged, deleted)
    one = nodes.groupBy("taxid").agg(F.min(F.struct("parent", "rank", "name")).alias("x")).select("taxid", "x.*")
    names = [F.when(F.col("rank") == r, F.coalesce("name", F.lit(""))).alias(f"at{i}") for i, r in enumerate(PLACES)]
    places = [f"at{i}" for i in range(len(PLACES))]
    ended = checkpointed(one.select("taxid", F.when(F.col("parent") != F.col("taxid"), F.col("parent")).alias("up"), *names))
    n_nodes, steps, going, ended = ended.count(), 0, ended.where("up is not null"), ended.where("up is null")
    while not going.isEmpty():
        if 2**steps > n_nodes:  # more steps up than there are nodes
            raise RuntimeError("lineages: parents form a circle")
        above = going.unionByName(ended).select(F.col("taxid").alias("up"), F.col("up").alias("further"), *[F.col(c).alias(f"far_{c}") for c in places])
        both = checkpointed(going.join(above, "up", "left").select("taxid", F.col("further").alias("up"), *[F.coalesce(c, f"far_{c}").alias(c) for c in places]))
        ended = ended.unionByName(both.where("up is null"))
        going, steps = both.where("up is not null"), steps + 1
    first = F.coalesce(*places[:3])
    parts = [F.concat(F.lit(f"{x}__"), F.coalesce(c, F.lit(""))) for x, c in zip(LETTERS, [first, *places[3:]], strict=True)]
    found = ids.join(ended.withColumnRenamed("taxid", "current"), "current", "left")
    return found.select("taxid", F.concat_ws(";", *parts).alias("lineage"))


def valid_lca(lca: DataFrame) -> DataFrame:
    """Without unplaced reads: taxid below 3 or 131567, or named unclassified."""
    return lca.where("taxid >= 3 and taxid <> 131567 and name <> 'unclassified'")


def with_ranks(rows: DataFrame) -> DataFrame:
    """Rows whose lineage has seven ranks, with a column ``k`` to ``s`` for each."""
    parts = F.split("lineage", ";")
    return rows.where(F.col("lineage").contains(";p") & (F.size(parts) == 7)).withColumns({x: parts[i] for i, x in enumerate(LETTERS)})


def taxonomy_counts(lca: DataFrame, lineage: DataFrame) -> DataFrame:
    """``sample_id, rank, taxon, count, rpm``: reads on each path at each of seven ranks, and per million valid
    reads of the sample. Reads are counted by taxon first; then one rollup gives all ranks and the totals."""
    taxa = valid_lca(lca).groupBy("sample_id", "taxid").agg(F.count("*").alias("n"))
    rows = with_ranks(with_lineage(taxa, lineage))
    counts = rows.rollup("sample_id", *LETTERS).agg(F.sum("n").alias("count"), F.grouping_id().alias("gid"))
    # grouping id: one bit for each column that is summed over, so 2**i - 1 when the last i are
    rank = F.when(F.col("gid") < 127, F.element_at(F.array(*map(F.lit, RANKS)), (7 - F.bit_count("gid")).cast("int")))
    taxon = F.concat_ws(";", *[F.when(F.col("gid") < 2 ** (6 - i), F.col(x)) for i, x in enumerate(LETTERS)])
    counts = counts.where("gid <= 127").select("sample_id", rank.alias("rank"), taxon.alias("taxon"), "count")
    totals = counts.where("rank is null").select("sample_id", F.col("count").alias("total"))
    return counts.where("rank is not null").join(totals, "sample_id").select("sample_id", "rank", "taxon", "count", (F.col("count") / F.col("total") * 1e6).alias("rpm"))


def without_taxa(counts: DataFrame, names: Sequence[str]) -> DataFrame:
    """Counts without taxa that hold one of the names; what was normalised before stays as it is."""
    return counts.where(~listed("taxon", names))


def contig_consensus(lca: DataFrame, lineage: DataFrame) -> DataFrame:
    """Per contig and rank the path most of its reading frames have; of equal ones the smallest.

    Frames are spread by contig once and sorted once, by their lineage from its top: so the frames of a path lie together at
    every rank, are counted in that order, and nothing is multiplied by ranks before each contig is one row."""
    rows = valid_lca(lca).withColumn("contig", F.nullif(F.regexp_extract("dna_id", r"^(.*)-(orf\d+)", 1), F.lit(""))).where("contig is not null")
    rows = with_lineage(rows.select("sample_id", "contig", "taxid"), lineage).select("sample_id", "contig", "lineage")
    rows = with_ranks(rows.repartition("sample_id", "contig")).drop("lineage").sortWithinPartitions("sample_id", "contig", *LETTERS)
    for i, r in reversed(list(enumerate(RANKS))):
        rows = rows.withColumn(f"n_{r}", F.count("*").over(Window.partitionBy("sample_id", "contig", *LETTERS[: i + 1])))
    best = [F.min(F.struct((-F.col(f"n_{r}")).alias("m"), F.concat_ws(";", *LETTERS[: i + 1]).alias("taxon"))).alias(r) for i, r in enumerate(RANKS)]
    one = rows.groupBy("sample_id", "contig").agg(F.count("*").alias("total"), *best)
    of_rank = lambda r: F.struct(F.lit(r).alias("rank"), F.col(r)["taxon"].alias("taxon"), (-F.col(r)["m"]).alias("n"), (-F.col(r)["m"] / F.col("total")).alias("fraction"))
    return one.select("sample_id", "contig", F.inline(F.array(*map(of_rank, RANKS))))


def dominant_taxon(consensus: DataFrame) -> DataFrame:
    """Per sample and rank the taxon of most contigs, and their share."""
    counts = consensus.groupBy("sample_id", "rank", "taxon").agg(F.count("*").alias("n"))
    best = counts.groupBy("sample_id", "rank").agg(F.min(F.struct((-F.col("n")).alias("m"), "taxon")).alias("best"), F.sum("n").alias("total"))
    return best.select("sample_id", "rank", F.col("best.taxon").alias("taxon"), (-F.col("best.m") / F.col("total")).alias("fraction"))


def contig_taxon_rpm(consensus: DataFrame) -> DataFrame:
    """Per sample, rank and taxon the contigs, and these per million of the sample's."""
    counts = consensus.groupBy("sample_id", "rank", "taxon").agg(F.count("*").alias("n"))
    totals = counts.groupBy("sample_id", "rank").agg(F.sum("n").alias("total"))
    return counts.join(totals, ["sample_id", "rank"]).select("sample_id", "rank", "taxon", "n", (F.col("n") / F.col("total") * 1e6).alias("rpm"))


#: Ranks of clade reports from high to low.
REPORT_RANKS = ("superkingdom", "phylum", "class", "order", "family", "genus", "species")


def clade_table(report: DataFrame) -> DataFrame:
    """Species of indented clade reports ``(sample_id, row_no, clade_count, rank, name)`` with their lineages.

    A row's rank holds until the next row of that or a higher rank: the last row of each rank is carried forward
    and blank where a higher rank came later."""
    order = Window.partitionBy("sample_id").orderBy("row_no").rowsBetween(Window.unboundedPreceding, 0)
    label = F.concat(F.substring("rank", 1, 1), F.lit("__"), F.trim("name"))
    rows = report.where(F.col("rank").isin(*REPORT_RANKS)).withColumn("label", label)
    for i, r in enumerate(REPORT_RANKS):
        rows = rows.withColumn(f"at{i}", F.last(F.when(F.col("rank") == r, F.struct("row_no", "label")), ignorenulls=True).over(order))
    parts = []
    for i in range(len(REPORT_RANKS)):
        above = [F.coalesce(F.col(f"at{j}.row_no") > F.col(f"at{i}.row_no"), F.lit(False)) for j in range(i)]
        later = above[0] if above else F.lit(False)
        for x in above[1:]:
            later = later | x
        parts.append(F.when(F.col(f"at{i}").isNull() | later, F.lit("")).otherwise(F.col(f"at{i}.label")))
    return rows.where("rank = 'species'").select("sample_id", "row_no", F.concat_ws(";", *parts).alias("lineage"), "clade_count")


def report_counts(report: DataFrame) -> DataFrame:
    """``sample_id, rank, taxon, count`` of clade reports: each rank's names, and ``all_levels``."""
    label = F.concat(F.substring("rank", 1, 1), F.lit("__"), F.trim("name"))
    rows = report.where(F.col("rank").isin(*REPORT_RANKS)).groupBy("sample_id", "rank", label.alias("taxon")).agg(F.sum("clade_count").alias("count"))
    whole = clade_table(report).groupBy("sample_id", F.lit("all_levels").alias("rank"), F.col("lineage").alias("taxon")).agg(F.sum("clade_count").alias("count"))
    return rows.unionByName(whole)
