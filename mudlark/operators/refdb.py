"""Reference tables: proteins, roles and subsystems."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def genome_of(patric_id: str = "patric_id") -> Column:
    """Genome of ``fig|<genome>.peg.<n>``; null where the id has another form."""
    return F.nullif(F.regexp_extract(patric_id, r"^fig\|(.*?)\.peg\.", 1), F.lit(""))


def last_by(rows: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """One row for each key: the last by ``order``, or without one the greatest."""
    rest = [c for c in rows.columns if c not in keys]
    pick = F.max_by(F.struct(*rest), F.col(order)) if order else F.max(F.struct(*rest))
    return rows.groupBy(*keys).agg(pick.alias("x")).select(*keys, *[F.col(f"x.`{c}`").alias(c) for c in rest])


def merge_linkout(linkout: DataFrame, annotation: DataFrame) -> DataFrame:
    """Proteins with their genes' annotation, one of each gene on either side, sorted by gene."""
    return last_by(linkout, ["patric_id"]).join(last_by(annotation, ["patric_id"]), "patric_id").orderBy("patric_id")


def accession_roles(linkout: DataFrame, roles: DataFrame, tasks: int | None = None, role: str = "role") -> DataFrame:
    """Distinct protein, gene and role; all pairs are kept. With ``tasks`` genes are dealt over as many and their rows moved once on either side."""
    rows = roles.select("patric_id", role)
    if tasks:
        linkout, rows = linkout.repartition(tasks, "patric_id"), rows.repartition(tasks, "patric_id").distinct().hint("merge")
    return linkout.join(rows, "patric_id").select("uniprot_id", "patric_id", role).distinct()


def numbered(rows: DataFrame, name: str, key: str) -> DataFrame:
    """Adds a key counted from 1 in order of ``name``. For tables of thousands of rows: the window is one task."""
    return rows.withColumn(key, F.dense_rank().over(Window.orderBy(name)))


def star_schema(subsystems: DataFrame, linkout: DataFrame | None = None, roles: DataFrame | None = None, tasks: int | None = None) -> dict[str, DataFrame]:
    """Tables ``roles``, ``subsystems``, ``role_subsystems`` and, with proteins given, ``uniprot_patric_role``.

    A subsystem's name is unique: of several hierarchies the least is taken. Empty names are null. ``tasks``: over how many the genes are dealt."""
    empty = lambda c: F.nullif(F.col(c), F.lit(""))
    rows = subsystems.select(empty("func").alias("role"), empty("superclass").alias("superclass"), empty("class").alias("class"), empty("subclass").alias("subclass"), empty("subsystem_name").alias("subsystem_name"))
    role = numbered(rows.where("role is not null").select("role").distinct(), "role", "role_id")
    best = rows.where("subsystem_name is not null").groupBy("subsystem_name").agg(F.min(F.struct("superclass", "class", "subclass")).alias("h")).select("subsystem_name", "h.*")
    system = numbered(best, "subsystem_name", "subsystem_id")
    pairs = rows.select("role", "subsystem_name").distinct().join(role, "role").join(system.select("subsystem_name", "subsystem_id"), "subsystem_name").select("role_id", "subsystem_id")
    out = {"roles": role, "subsystems": system, "role_subsystems": pairs}
    if linkout is not None and roles is not None:
        out["uniprot_patric_role"] = accession_roles(linkout, roles.select("patric_id", "role").join(role, "role"), tasks, "role_id")
    return out


def roles_of_accession(star: dict[str, DataFrame], accession: str | None = None) -> DataFrame:
    """Proteins with their roles and subsystems."""
    rows = star["uniprot_patric_role"]
    rows = rows.where(F.col("uniprot_id") == accession) if accession else rows
    # distinct by protein: where the table is bucketed by protein, no row moves
    return rows.select("uniprot_id", "role_id").distinct().join(star["roles"], "role_id").join(star["role_subsystems"], "role_id").join(star["subsystems"], "subsystem_id").select("uniprot_id", "role", "superclass", "class", "subclass", "subsystem_name")


def accessions_of_subsystem(star: dict[str, DataFrame], subsystem: str | None = None) -> DataFrame:
    """Distinct proteins of a subsystem, or of each. The proteins' table is the large one and the left one: its rows stay where they are
    if it is bucketed by protein and the others are small enough to be broadcast by their size."""
    systems = star["subsystems"]
    systems = systems.where(F.col("subsystem_name") == subsystem) if subsystem else systems
    rows = star["uniprot_patric_role"].select("uniprot_id", "role_id").distinct()
    return rows.join(star["role_subsystems"], "role_id").join(systems.select("subsystem_id", "subsystem_name"), "subsystem_id").select("subsystem_name", "uniprot_id").distinct()


def roles_of_hierarchy(star: dict[str, DataFrame], superclass: str, klass: str, subclass: str) -> DataFrame:
    """Distinct roles under a place of the hierarchy."""
    systems = star["subsystems"].where((F.col("superclass") == superclass) & (F.col("class") == klass) & (F.col("subclass") == subclass))
    return systems.join(star["role_subsystems"], "subsystem_id").join(star["roles"], "role_id").select("subsystem_name", "role").distinct()


def accessions_per_subsystem(star: dict[str, DataFrame]) -> DataFrame:
    """Distinct proteins of each subsystem, most first."""
    return accessions_of_subsystem(star).groupBy("subsystem_name").agg(F.count("*").alias("n_accessions")).orderBy(F.desc("n_accessions"), "subsystem_name")


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in tables.items():
        one = df.agg(F.lit(name).alias("table"), F.count("*").alias("n"))
        out = one if out is None else out.union(one)
    return out


def pending(todo: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """What is not done yet."""
    return todo.join(done.select(*keys).distinct(), keys, "left_anti")


def resumed(todo: DataFrame, done: DataFrame, keys: list[str], work) -> DataFrame:
    """Rows of earlier runs and the work on what is pending."""
    return done.unionByName(work(pending(todo, done, keys)))
