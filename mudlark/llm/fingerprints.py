"""Document fingerprints: threshold-scaled sketches. Every shingle whose 64-bit hash lies below a fixed
fraction of the hash range is retained, so sketches of any two documents sample the same shingles: they can
be merged by union, and containment can be estimated between documents of very unequal length.

A fingerprint is text: the number of retained hashes, then each as 16 hex digits, ascending, then after a
colon a digest of the whole shingle set, which tells equal texts apart from such that merely share a sketch.

Defined results: null and empty texts have no shingle and an empty sketch; two fingerprints that are equal
have likeness 1, else sketches of which one is empty have likeness 0; in a table of one row the next document
is the row itself; rows with equal ids are ordered by their text; a null id comes last in descending order.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mudlark.llm.common import read_table
from mudlark.llm.shingles import in_slices, mixed, shingle_sets

#: Share of the hash range that is retained.
FRACTION = 0.25
SHINGLE = 5
#: Bytes of text in a range, about.
RANGE = 16 << 20


def sketches(texts: list[bytes], fraction: float = FRACTION, size: int = SHINGLE) -> list[tuple[np.ndarray, str]]:
    """Each text's retained hashes, and its fingerprint."""
    limit, out = np.uint64(int(fraction * 2**64)), []
    for part in in_slices(texts):
        hashes, counts = shingle_sets(texts[part], size)
        ends = np.cumsum(counts)
        starts = ends - counts
        sums = np.concatenate([[np.uint64(0)], np.cumsum(mixed(hashes + np.uint64(0x632BE59BD9B4E019)))])
        digests = (sums[ends] - sums[starts]).tolist()
        kept = hashes < limit
        at = np.concatenate([[0], np.cumsum(kept)])
        low = hashes[kept]
        for a, b, n, d in zip(at[starts].tolist(), at[ends].tolist(), counts.tolist(), digests, strict=True):
            own = low[a:b]
            out.append((own, f"{b - a}:{own.astype('>u8').tobytes().hex()}:{d:016x}{n:x}"))
    return out


def likeness(a: tuple[np.ndarray, str], b: tuple[np.ndarray, str]) -> tuple[float, float, float]:
    """Estimated resemblance of two documents, and the containment of each in the other."""
    if a[1] == b[1]:
        return 1.0, 1.0, 1.0
    if not len(a[0]) or not len(b[0]):
        return 0.0, 0.0, 0.0
    both = len(np.intersect1d(a[0], b[0], assume_unique=True))
    return both / (len(a[0]) + len(b[0]) - both), both / len(a[0]), both / len(b[0])


def hashes_of(fingerprint: str) -> list[str]:
    """The retained hashes of a fingerprint, each as 16 hexadecimal digits, in ascending order."""
    kept = fingerprint.split(":")[1]
    return [kept[k : k + 16] for k in range(0, len(kept), 16)]


def merge(fingerprints: list[str]) -> str:
    """The fingerprint of the joined set of shingles: the union of the retained hashes. Which shingles were not retained
    is not known any more, so it has no digest behind the hashes; it merges and compares on."""
    kept = sorted(set().union(*map(hashes_of, fingerprints)))
    return f"{len(kept)}:{''.join(kept)}:"


def merged(rows: DataFrame, key: str) -> DataFrame:
    """``key, hash``: the joined sketch of all rows of ``rows(key, fingerprint)`` with a key (null is one), as a table,
    so that a group of any size has one. Distinct per task before the shuffle; fingerprints without hashes give no rows."""
    kept = F.element_at(F.split("fingerprint", ":"), 2)
    hashes = F.transform(F.sequence(F.lit(0), (F.length(kept) / 16).cast("int") - 1), lambda i: F.substring(kept, i * 16 + 1, F.lit(16)))
    return rows.where(F.length(kept) > 0).select(F.col(key).alias("key"), F.explode(hashes).alias("hash")).distinct()


def containments(sketches_: DataFrame, others: DataFrame) -> DataFrame:
    """``key, other, contained``: which share of each joined sketch of ``sketches_(key, hash)`` lies in each of ``others``
    that it shares a hash with."""
    size = sketches_.groupBy("key").agg(F.count("*").alias("n"))
    both = sketches_.join(others.select(F.col("key").alias("other"), "hash"), "hash").groupBy("key", "other").agg(F.count("*").alias("both"))
    on = both["key"].eqNullSafe(size["key"])
    return both.join(size, on).select(both["key"], "other", (F.col("both") / F.col("n")).alias("contained"))


def _plain(batches: Iterator[pa.RecordBatch], fraction: float, size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [(t or "").encode() for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([s[1] for s in sketches(texts, fraction, size)], type=pa.string())], names=["doc_id", "fingerprint"])


def fingerprints(docs: DataFrame, fraction: float = FRACTION, size: int = SHINGLE) -> DataFrame:
    """``doc_id`` and ``fingerprint`` of every document; needs no shuffle."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(partial(_plain, fraction=fraction, size=size), "doc_id long, fingerprint string")


def edited(text: str, other: str) -> str:
    """The last floor(n/2) code points replaced by the first as many of the other text."""
    half = len(text) // 2
    return text[: len(text) - half] + other[:half]


OUT = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()), ("contained_in_next", pa.float64())])


def _compared(rows: list[tuple[int | None, str]]) -> pa.RecordBatch:
    """All rows but the last, each compared with its edited text and with the row that follows it."""
    texts = [t for _, t in rows]
    new = [edited(a, b) for a, b in zip(texts, texts[1:], strict=False)]
    data = [t.encode() for t in new]
    own, changed = sketches([t.encode() for t in texts]), sketches(data)
    out = []
    for k, (doc_id, text) in enumerate(rows[:-1]):
        after = likeness(own[k], own[k + 1])
        out.append((doc_id, len(text), hashlib.sha256(data[k]).hexdigest(), own[k][1], changed[k][1], likeness(own[k], changed[k])[0], after[0], after[1]))
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], type=f.type) for i, f in enumerate(OUT)], schema=OUT)


def _along(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Goes along ranges of documents in order. The rows marked as following come after the range's own: the
    first of them is the document that its last one is compared with; without any that is the range's first."""
    at: int | None = None
    rows: list[tuple[int | None, str]] = []
    first, size, closed = (None, ""), 0, False
    for batch in batches:
        for doc_id, text, part, after in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if part != at:
                if rows and not closed:
                    yield _compared([*rows, first])
                at, rows, first, size, closed = part, [], (doc_id, text), 0, False
            if closed:
                continue
            rows.append((doc_id, text))
            size += len(text)
            if after:
                closed = True
                yield _compared(rows)
            elif size > 1_000_000 and len(rows) > 1:
                yield _compared(rows)
                rows, size = rows[-1:], len(rows[-1][1])
    if rows and not closed:
        yield _compared([*rows, first])


def in_ranges(docs: DataFrame, parts: int) -> DataFrame:
    """``doc_id, text, part, after``: ranges of documents in descending order, each with the first row of the
    next one marked ``after``. The limits are ids of the table, so only ids (one for each range) reach the driver."""
    ids = F.percentile_approx("doc_id", [i / parts for i in range(1, parts + 1)], 20 * parts)
    some, top = docs.agg(ids, F.max("doc_id")).head()
    limits = np.unique(np.array([*(some or []), *([] if top is None else [top])], dtype=np.int64))

    def ranges(doc_id: pd.Series) -> pd.Series:
        """The range of an id, and that before it (of the first: the last) if it opens the range."""
        own = doc_id.to_numpy()
        known = ~np.isnan(own.astype(float)) if own.dtype == object or own.dtype.kind == "f" else np.ones(len(own), dtype=bool)
        own = np.where(known, own, 0).astype(np.int64)
        # ascending limits; range r, counted from the top, ends at the limit that many from the end
        k = np.searchsorted(limits, own)
        part = np.where(known, len(limits) - 1 - k, len(limits) - 1)
        opens = known & (limits[np.minimum(k, len(limits) - 1)] == own) & (len(limits) > 1)
        return pd.Series([[p, (p - 1) % len(limits)] if o else [p] for p, o in zip(part.tolist(), opens.tolist(), strict=True)])

    if not len(limits):
        return docs.select("doc_id", "text", F.lit(0).alias("part"), F.lit(False).alias("after"))
    at = F.pandas_udf(ranges, "array<int>")
    return docs.select("doc_id", "text", F.posexplode(at("doc_id"))).select("doc_id", "text", F.col("col").alias("part"), (F.col("pos") > 0).alias("after"))


def next_compared(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """Every document's fingerprint, that of its edited text, and how alike it is to that and to the next document.

    Whole texts are shuffled once, into ranges of ids; inside a range they stream by in order.
    """
    if not parts:
        size = docs.agg(F.sum(F.octet_length("text"))).head()[0] or 0
        parts = max(2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / RANGE))
    rows = in_ranges(docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).alias("text")), parts)
    rows = rows.repartition("part").sortWithinPartitions("part", "after", F.col("doc_id").desc_nulls_last(), "text")
    kind = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, contained_in_next double"
    return rows.mapInArrow(_along, kind)


def op9_document_fingerprints(spark, sf_dir: str) -> DataFrame:
    return next_compared(read_table(spark, sf_dir, "documents"))


QUERIES = {"op9_document_fingerprints": op9_document_fingerprints}
