"""Line dedup by winnowing over line hashes.

A unit is a line with a word; its hash is that of the line without white space at its ends. Fingerprints are
the window minima over the hashes of ``GRAM`` consecutive units, so any run of ``GRAM + WINDOW - 1`` units
that stands in two places has a fingerprint in common; a unit of ``LONG`` words or more is a fingerprint by
itself. Every place of a fingerprint is joined to its first place (in order of doc_id and line), to the first that
has the same unit before it, and to the first that has the same unit behind it; the matches are extended both ways
along these diagonals, and their units are deleted from the later place where they form a run of ``GRAM`` units or are
long. So of every run of ``GRAM + WINDOW - 1`` units that stands earlier each unit goes: its fingerprint and the unit
beside it have their first place where the whole run stands. The first place of a line is never deleted.
A line of ``LONG`` words or more goes by itself, a shorter one only in a run: short lines repeat by chance.

Native: DataFrame functions only. What is shuffled are hashes; a fingerprint's places are aggregated to their
minimum and never gathered, so a line that stands in a third of all documents is one row of that aggregate.

Defined results: a null text stays null and has no units; an empty text stays; blank lines stay where they are
(but for a text all of whose units go: it becomes empty); rows with equal ids are separate documents in the
order they were read; null ids come last; an empty table gives no rows; columns of the input, whatever their
names, are passed through, with ``text`` (and ``n_chars``, if there) brought up to date.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mudlark.llm.common import WORD_BREAKS, materialise, read_table, words_of

GRAM, WINDOW, LONG = 2, 2, 20


def _bare(line: Column) -> Column:
    return F.trim(line, F.lit(WORD_BREAKS))


def _minima(grams: Column) -> Column:
    """Places of the window minima, the last of equal ones; of a sequence shorter than a window the one minimum."""
    width = F.least(F.lit(WINDOW), F.size(grams))

    def lowest(at: Column) -> Column:
        window = F.reverse(F.slice(grams, at + 1, width))
        return (at + width - F.array_position(window, F.array_min(window))).cast("int")

    return F.when(F.size(grams) > 0, F.array_distinct(F.transform(F.sequence(F.lit(0), F.size(grams) - width), lowest))).otherwise(F.array().cast("array<int>"))


def _units(docs: DataFrame) -> DataFrame:
    """Unit hashes of every row, which of them are long, and their grams."""
    out = docs.select("row", F.col("doc.doc_id").cast("long").alias("id"), F.filter(F.split(F.coalesce("doc.text", F.lit("")), "\n"), lambda x: _bare(x) != "").alias("lines"))
    out = out.select("row", "id", F.transform("lines", lambda x: F.xxhash64(_bare(x))).alias("h"), F.transform("lines", lambda x: F.size(words_of(x)) >= LONG).alias("long"))
    gram = F.transform(F.sequence(F.lit(1), F.size("h") - (GRAM - 1)), lambda i: F.xxhash64(*[F.element_at("h", (i + k).cast("int")) for k in range(GRAM)]))
    return out.withColumn("grams", F.when(F.size("h") >= GRAM, gram).otherwise(F.array().cast("array<bigint>")))


def _places(units: DataFrame) -> DataFrame:
    """``fp, row, id, u, left, right``: the fingerprints, where they stand, and the units beside them."""
    beside = lambda i: (F.when(i > 0, F.get("h", i - 1)).alias("left"), F.get("h", i + GRAM).alias("right"))
    picked = F.transform(_minima(F.col("grams")), lambda i: F.struct(F.get("grams", i).alias("fp"), i.alias("u"), *beside(i)))
    nothing = (F.lit(None).cast("long").alias("left"), F.lit(None).cast("long").alias("right"))
    long = F.filter(F.transform("h", lambda h, i: F.struct(F.xxhash64(F.lit("long"), h).alias("fp"), i.alias("u"), *nothing)), lambda x: F.get("long", x["u"]))
    return units.select("row", "id", F.explode(F.concat(picked, long)).alias("p")).select("p.fp", "row", "id", "p.u", "p.left", "p.right")


def _repeated(units: DataFrame) -> DataFrame:
    """``row, gone``: the units of a row that go."""
    places = _places(units)
    order = F.struct(F.col("id").isNull().alias("last"), F.col("id"), F.col("row"), F.col("u"))
    first = places.groupBy("fp").agg(F.min(order).alias("first"), F.count("*").alias("n")).where("n > 1")
    twice = materialise(places.join(first.select("fp", "first"), "fp"), "places")
    links = [twice.select("row", "u", "first")]
    for side in ("left", "right"):
        keyed = twice.where(F.col(side).isNotNull()).select("row", "id", "u", F.xxhash64(F.lit(side), "fp", side).alias("key"))
        links.append(keyed.join(keyed.groupBy("key").agg(F.min(order).alias("first")), "key").select("row", "u", "first"))
    links = links[0].union(links[1]).union(links[2]).where((F.col("row") != F.col("first.row")) | (F.col("u") != F.col("first.u")))
    lines = links.select("row", F.col("first.row").alias("src"), (F.col("u") - F.col("first.u")).alias("shift")).distinct()
    own, other = units.select("row", "h", "long"), units.select(F.col("row").alias("src"), F.col("h").alias("h_src"))
    both = lines.join(own, "row").join(other, "src")
    at, at_src = F.greatest("shift", F.lit(0)), F.greatest(-F.col("shift"), F.lit(0))
    n = F.least(F.size("h") - at, F.size("h_src") - at_src)
    both = both.select("row", "long", at.alias("at"), F.zip_with(F.slice("h", at + 1, n), F.slice("h_src", at_src + 1, n), lambda a, b: a == b).alias("same"))
    whole = lambda i, o: F.forall(F.slice("same", F.greatest(i - o, F.lit(0)) + 1, GRAM), lambda x: x) & (i >= o) & (i - o + GRAM <= F.size("same"))
    runs = lambda i: F.exists(F.array(*[F.lit(o) for o in range(GRAM)]), lambda o: whole(i, o))
    goes = F.filter(F.sequence(F.lit(0), F.size("same") - 1), lambda i: F.get("same", i) & (F.get("long", i + F.col("at")) | runs(i)))
    gone = both.where(F.size("same") > 0).select("row", F.explode(F.transform(goes, lambda i: i + F.col("at"))).alias("u"))
    return gone.distinct().groupBy("row").agg(F.collect_list("u").alias("gone"))


def line_deduplicated(docs: DataFrame) -> DataFrame:
    """Each input row as ``doc`` (a struct of its columns), ``text`` (what stays of it), ``n_units``, ``n_removed``."""
    held = materialise(docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("row")), "documents")
    units = materialise(_units(held), "units")
    out = held.join(_repeated(units), "row", "left").withColumn("lines", F.split(F.coalesce("doc.text", F.lit("")), "\n"))
    out = out.withColumn("at", F.filter(F.sequence(F.lit(0), F.size("lines") - 1), lambda i: _bare(F.get("lines", i)) != ""))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.transform("gone", lambda u: F.get("at", u)))
    text = F.when(F.col("gone").isNull(), F.col("doc.text")).when(F.size("gone") == F.size("at"), F.lit("")).otherwise(F.array_join(F.transform(stay, lambda i: F.get("lines", i)), "\n"))
    return out.select("doc", text.alias("text"), F.size("at").cast("long").alias("n_units"), F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"))


def without_repeats(docs: DataFrame, drop_emptied: bool = True) -> DataFrame:
    """The input's columns with the repeated lines gone; a document of which nothing stays is dropped."""
    out = line_deduplicated(docs)
    if drop_emptied:
        out = out.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_units")))
    new = {"text": F.col("text"), "n_chars": F.length("text").cast(dict(docs.dtypes).get("n_chars", "long"))}
    return out.select(*[new.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with what line dedup leaves of it."""
    out = line_deduplicated(read_table(spark, sf_dir, "documents"))
    return out.select("doc.doc_id", "n_units", "n_removed", F.length("text").cast("long").alias("n_chars"), F.sha2("text", 256).alias("kept_sha256"), "text")


QUERIES = {"op1_line_dedup": op1_line_dedup}
