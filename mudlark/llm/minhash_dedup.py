"""Near-duplicate documents: SuperMinHash signatures, banding, verification on full sets, union-find grouping.

1. Every text gives its set of 5-word shingles (64-bit hashes), a digest of that set and a SuperMinHash
   signature. Equal sets are one class, represented by its smallest id, so copies cost nothing further.
2. Bands of the signatures are buckets. The hub of a bucket is its most central class: the one whose bands stand in
   the most crowded buckets, so of copies of one text the one nearest to their common form. Every class is paired
   with the hubs of its buckets; pairs whose signatures agree are verified on their full sets, and components are
   formed. So a large group of near copies becomes one component at a few pairs for each member.
3. Classes of buckets that still hold several components are joined exactly, on shingles. A class's shingles are put
   in order of how many of these classes hold them, the rarest first; two sets of the similarity share one among the
   first quarter of each, and not so far back that too few can follow. Only links between different components are
   looked for: in the list of a shingle, classes outside its largest component meet those of fitting size, so
   copies whose own changes rule the similarity out meet nobody. Candidates are verified on their full sets.

A pair of similarity 0.75 shares no band with probability (1 - 0.75**4)**32 = 5e-6 under independent ranks; all that
follows is exact.

Defined results: null and empty texts and texts without words have an empty set and are linked with nothing;
texts of fewer than five words have one shingle, their whole sequence; rows with equal ids are nodes of one
name; a row with a null id can have links only through its class, whose name is then its smallest other id, or
null (kept); an empty table gives no rows; extra columns are not carried.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mudlark.llm.common import materialise, read_table
from mudlark.llm.components import components
from mudlark.llm.shingles import byte_slices, mixed, shingle_sets

RANKS, ROWS = 128, 4
BANDS = RANKS // ROWS
SHINGLE = 5
#: Ranks that must agree before a class is verified with a hub; a link that this misses is left to the exact join.
AGREE = 80
#: Ratio of the sizes that end a size class of the exact join.
STEP = 1.05


def superminhash(hashes: np.ndarray, counts: np.ndarray, ranks: int = RANKS) -> np.ndarray:
    """Signatures of many sets: one row of 16-bit values for each.

    Every element deals out the ranks 0, 1, 2, ... to the places of the signature in an order of its own (a
    Fisher-Yates shuffle); place k keeps the least rank plus a random fraction. Ranks are dealt round by round
    for all elements at once, and a set leaves as soon as no place holds more than the round's rank.
    """
    sets = len(counts)
    sig = np.full(sets * ranks, np.inf)
    doc = np.repeat(np.arange(sets), counts)
    for begin in range(0, len(hashes), 400_000):
        _deal(hashes[begin : begin + 400_000], doc[begin : begin + 400_000], sig, ranks, 0, 1)
    full = sig.reshape(sets, ranks)
    open_sets = np.flatnonzero((counts > 0) & (full.max(axis=1) > 1))
    which = np.isin(doc, open_sets)
    h, d = hashes[which], doc[which]
    for begin in range(0, len(h), 100_000):
        _deal(h[begin : begin + 100_000], d[begin : begin + 100_000], sig, ranks, 1, ranks)
    return (mixed(full.view(np.uint64)) >> np.uint64(48)).astype("<u2")


def _deal(h: np.ndarray, doc: np.ndarray, sig: np.ndarray, ranks: int, first: int, last: int) -> None:
    place = None
    if first:
        # later rounds need the shuffles so far: start again from round 0
        place = np.tile(np.arange(ranks, dtype=np.uint8 if ranks <= 256 else np.uint16), (len(h), 1))
    for j in range(0, last):
        u = mixed(h + np.uint64(0x9E3779B97F4A7C15 * (j + 1) % 2**64))
        k = j + (((u & np.uint64(0xFFFFFFFF)) * np.uint64(ranks - j)) >> np.uint64(32)).astype(np.int64)
        if place is None:
            at = k
        else:
            rows = np.arange(len(h))
            at = place[rows, k].astype(np.int64)
            place[rows, k] = place[:, j]
        if j >= first:
            np.minimum.at(sig, doc * ranks + at, j + (u >> np.uint64(11)).astype(np.float64) * 2.0**-53)
            if j + 1 < last and j % 4 == 0:
                alive = sig.reshape(-1, ranks)[doc].max(axis=1) > j + 1 if len(h) < 20_000 else _unfilled(sig, doc, ranks, j + 1)
                if not alive.all():
                    h, doc, place = h[alive], doc[alive], place[alive]
                    if not len(h):
                        return


def _unfilled(sig: np.ndarray, doc: np.ndarray, ranks: int, most: float) -> np.ndarray:
    sets, back = np.unique(doc, return_inverse=True)
    return (sig.reshape(-1, ranks)[sets].max(axis=1) > most)[back]


def _digests(hashes: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """128-bit digests of the sets."""
    ends = np.cumsum(counts)
    out = []
    for salt in (0x632BE59BD9B4E019, 0xA0761D6478BD642F):
        s = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(mixed(hashes ^ np.uint64(salt)))])
        out.append(mixed(s[ends] - s[ends - counts] + counts.astype(np.uint64)))
    both = np.stack(out, axis=1).astype("<u8")
    return [r.tobytes() for r in both]


def _signed(batches: Iterator[pa.RecordBatch], size: int, ranks: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin, texts in byte_slices(batch.column(1)):
            hashes, counts = shingle_sets(texts, size)
            sig = superminhash(hashes, counts, ranks)
            some = counts > 0
            keys = [k if s else None for k, s in zip(_digests(hashes, counts), some.tolist(), strict=True)]
            columns = [batch.column(0).slice(begin, len(texts)), pa.array(counts.astype(np.int64)), pa.array(keys, type=pa.binary()), pa.array([r.tobytes() if s else None for r, s in zip(sig, some, strict=True)], type=pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_shingles", "set_key", "signature"])


def _sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, texts in byte_slices(batch.column(0)):
            hashes, counts = shingle_sets(texts, size)
            sets = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(hashes.view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(_digests(hashes, counts), type=pa.binary()), sets], names=["set_key", "hashes"])


def _agreeing(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Pairs of which so many ranks agree."""
    for batch in batches:
        if batch.num_rows:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype="<u2").reshape(batch.num_rows, -1) for c in (2, 3))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array((a == b).sum(axis=1) >= least))


def _similar(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs whose full sets have the similarity."""
    for batch in batches:
        keep = []
        for i in range(batch.num_rows):
            p, q = (batch.column(c)[i].values.to_numpy() for c in (2, 3))
            both = np.concatenate([p, q])
            both.sort()
            shared = int((both[1:] == both[:-1]).sum())
            keep.append(100 * shared >= percent * (len(p) + len(q) - shared))
        yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(keep, type=pa.bool_()))


def _near_size(a: str, b: str, percent: int) -> Column:
    """Sets of these sizes can have the similarity at all."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _likely(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """``pairs(a, b)`` of classes: those whose signatures agree."""
    sig = classes.select("cid", "signature")
    both = pairs.join(sig.toDF("a", "sa"), "a").join(sig.toDF("b", "sb"), "b")
    return both.select("a", "b", "sa", "sb").mapInArrow(partial(_agreeing, least=AGREE), "a long, b long")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``pairs(a, b)`` of classes, no pair twice: those whose full sets have the similarity."""
    own = sets.select("cid", "hashes")
    both = pairs.join(own.toDF("b", "hb"), "b").join(own.toDF("a", "ha"), "a").select("a", "b", "ha", "hb")
    return materialise(both.mapInArrow(partial(_similar, percent=percent), "a long, b long"), "linked")


def _bands() -> Column:
    """The buckets of a signature's bands."""
    return F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.xxhash64(i, F.substring("signature", i * (2 * ROWS) + 1, 2 * ROWS)))


def _stars(shared: DataFrame, percent: int) -> DataFrame:
    """Every class of ``shared(bucket, cid, n, crowd)`` with the most central one of each of its buckets, as ``a, b``."""
    central = shared.groupBy("cid").agg(F.sum("crowd").alias("central"))
    hubs = shared.join(central, "cid").groupBy("bucket").agg(F.max(F.struct("central", "cid", "n")).alias("hub"))
    stars = shared.join(hubs, "bucket").where((F.col("cid") != F.col("hub.cid")) & _near_size("n", "hub.n", percent))
    return stars.select(F.least("cid", "hub.cid").alias("a"), F.greatest("cid", "hub.cid").alias("b")).distinct()


def _size_class(n: Column) -> Column:
    return F.floor(F.log(n) / F.lit(math.log(STEP))).cast("int")


def _entries(classes: DataFrame, percent: int) -> DataFrame:
    """``s, cid, n, component, at``: of every class of ``classes(cid, n, component, hashes)`` the shingles in its prefix
    that other classes hold too, with their places in the class's order, the rarest first."""
    each = classes.select("cid", F.explode("hashes").alias("s"))
    held = each.groupBy("s").agg(F.count("*").alias("df")).where("df > 1")
    order = each.join(held, "s").groupBy("cid").agg(F.array_sort(F.collect_list(F.struct("df", "s"))).alias("order"))
    own = F.col("n") - F.size("order")
    # the last place that the first common shingle can have, and still the similarity be reached
    last = F.floor(F.col("n") * (100 - percent) / 100).cast("int")
    order = classes.select("cid", "n", "component").join(order, "cid").where(last >= own)
    prefix = F.transform(F.slice("order", 1, last - own + 1), lambda e, k: F.struct(e["s"].alias("s"), (k + own).cast("int").alias("at")))
    return order.select("cid", "n", "component", F.explode(prefix).alias("e")).select("e.s", "cid", "n", "component", "e.at")


def _joined_on_shingles(classes: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` of different components that can have the similarity, and no pair is left out that has it."""
    entries = materialise(_entries(classes, percent), "prefixes")
    size = entries.select("cid", "component").distinct().groupBy("component").agg(F.count("*").alias("size"))
    lists = entries.join(size, "component").groupBy("s").agg(F.max(F.struct("size", "component")).alias("top"), F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi")
    entries = entries.join(lists.select("s", F.col("top.component").alias("top")), "s").withColumn("main", F.col("component") == F.col("top"))
    of = lambda side: [F.col(c).alias(f"{c}_{side}") for c in ("cid", "n", "component", "at", "main")]
    # sizes that fit: 100 o >= percent * (n_x + n_y - o) for an overlap o of all that can follow
    most = ((100 + percent) * (F.col("n") - F.col("at")) - percent * F.col("n")) / percent
    sizes = F.sequence(_size_class(F.greatest(F.lit(1), F.col("n") * percent / 100)), _size_class(F.greatest(F.lit(1), F.least(most, F.col("n") * 100 / percent))))
    outside = entries.where(~F.col("main") & (most >= F.greatest(F.lit(1), F.col("n") * percent / 100))).select("s", F.explode(sizes).alias("size_class"), *of("x"))
    every = entries.select("s", _size_class(F.col("n")).alias("size_class"), *of("y"))
    reach = F.least(F.col("n_x") - F.col("at_x"), F.col("n_y") - F.col("at_y"))
    fits = (F.col("component_x") != F.col("component_y")) & (F.col("main_y") | (F.col("cid_x") < F.col("cid_y"))) & _near_size("n_x", "n_y", percent) & ((100 + percent) * reach >= percent * (F.col("n_x") + F.col("n_y")))
    pairs = outside.join(every, ["s", "size_class"]).where(fits)
    return pairs.select(F.least("cid_x", "cid_y").alias("a"), F.greatest("cid_x", "cid_y").alias("b")).distinct()


def _labelled(classes: DataFrame, labels: DataFrame) -> DataFrame:
    return classes.join(labels.toDF("cid", "component"), "cid", "left").withColumn("component", F.coalesce("component", "cid"))


def near_duplicates(docs: DataFrame, percent: int = 75, size: int = SHINGLE) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row of ``docs(doc_id, text)``."""
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    cid = F.when(F.col("set_key").isNotNull(), F.xxhash64("set_key"))
    signed = docs.mapInArrow(partial(_signed, size=size, ranks=RANKS), "doc_id long, n_shingles long, set_key binary, signature binary")
    signed = materialise(signed.select("doc_id", "n_shingles", cid.alias("cid"), "signature"), "signed")
    classes = signed.where("cid is not null").groupBy("cid").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("signature").alias("signature"))
    classes = materialise(classes, "classes")

    rows = classes.where("rep is not null").select("cid", "n", F.explode(_bands()).alias("bucket"))
    crowds = rows.groupBy("bucket").agg(F.count("*").alias("crowd")).where("crowd > 1")
    shared = materialise(rows.join(crowds, "bucket"), "shared")
    wanted = classes.join(shared.select("cid").distinct(), "cid", "left_semi").select(F.col("rep").alias("doc_id")).distinct()
    sets = docs.join(wanted, "doc_id", "left_semi").select("text").mapInArrow(partial(_sets, size=size), "set_key binary, hashes array<long>")
    sets = materialise(sets.where("size(hashes) > 0").select(cid.alias("cid"), "hashes").dropDuplicates(["cid"]), "sets")

    labels = components(_verified(materialise(_likely(_stars(shared, percent), classes), "likely"), sets, percent).toDF("src", "dst"))
    labels = materialise(labels, "labels")
    rows = _labelled(shared.select("bucket", "cid"), labels)
    mixed_buckets = rows.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("bucket")
    open_ = rows.join(mixed_buckets, "bucket", "left_semi").select("cid", "component").distinct()
    open_ = materialise(open_.join(sets, "cid").select("cid", F.size("hashes").alias("n"), "component", "hashes"), "open")
    found = _verified(materialise(_joined_on_shingles(open_, percent), "candidates"), sets, percent)
    # the links found by now, between the components so far
    named = found.join(labels.toDF("a", "ca"), "a", "left").join(labels.toDF("b", "cb"), "b", "left")
    links = named.select(F.coalesce("ca", "a").alias("src"), F.coalesce("cb", "b").alias("dst")).distinct()
    upper = materialise(components(links), "labels")
    labels = labels.toDF("cid", "component").union(upper.select("node", "node")).distinct()
    labels = labels.join(upper.toDF("component", "upper"), "component", "left").select("cid", F.coalesce("upper", "component").alias("component"))

    named = labels.join(classes.select("cid", "rep"), "cid")
    named = named.join(named.groupBy("component").agg(F.min("rep").alias("component_id")), "component").select("cid", "component_id")
    names = classes.select("cid", "rep").join(named, "cid", "left").select("cid", F.coalesce("component_id", "rep").alias("component_id"))
    out = signed.select("doc_id", "n_shingles", "cid").join(names, "cid", "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def op4_minhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))


QUERIES = {"op4_minhash_near_dedup": op4_minhash_near_dedup}
