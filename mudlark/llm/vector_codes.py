"""Compression of vectors to codes of their parts, with equal-average search for the nearest codebook entry.

A vector of integers is cut into PARTS equal parts; every part position has a codebook of at most ENTRIES. The nearest entry of a part
is found among the entries sorted by the sum of their components: from the part's own sum the search goes outward, to the nearer side
first, and ends once the squared gap of the sums over the dimension strictly exceeds the least distance met. By
Cauchy-Schwarz no entry further out can be as near, so the result is exact; as the comparison is strict, entries of equal distance are
met too and the one of lower index is taken. All parts of a batch search at once, in vector steps over those that go on.

Rows stay where they are: a round is one pass that gives, for each task, counts and sums of the parts by entry; Spark adds these up, and
only codebooks (a fixed size) reach the driver and the tasks. Errors are summed by label with Spark's partial
aggregation; the sums come back by a join in which a label that holds many rows is spread over SALTS keys.

Defined results: rows whose vector is null or holds null, NaN or infinite components are dropped; fewer vectors than ENTRIES give as
many entries; of equal ids the vector that comes first in order starts an entry first, null ids come last; vectors of
different lengths, or of a length that is no multiple of PARTS, are an error; rows of equal ids are rows of their own; null labels are
one label; an empty table gives no rows; further columns are not carried.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mudlark.llm.common import materialise, read_table

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256.0
#: Keys that a label is spread over; rows that are searched at once.
SALTS, AT_ONCE = 32, 4096


def whole_vectors(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """``vec_id, label, x`` of the rows whose vector is there and has finite components only."""
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))
    v = F.col(column).cast("array<double>")
    rows = vectors.where(F.col(column).isNotNull() & F.forall(v, finite))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.transform(v, lambda c: F.floor(c * SCALE)).alias("x"))


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Index of the nearest entry of each part, its squared distance, and how many distances were computed."""
    n, m = parts.shape
    order = np.argsort(entries.sum(axis=1), kind="stable")
    ranked, sums = entries[order], entries.sum(axis=1)[order]
    own = parts.sum(axis=1)
    right = np.searchsorted(sums, own)
    left = right - 1
    best, index = np.full(n, np.iinfo(np.int64).max), np.full(n, len(entries))
    going, far, seen = np.arange(n), np.iinfo(np.int64).max, 0
    while len(going):
        l, r = left[going], right[going]
        gap_l = np.where(l >= 0, own[going] - sums[np.maximum(l, 0)], far)
        gap_r = np.where(r < len(sums), sums[np.minimum(r, len(sums) - 1)] - own[going], far)
        gap, on_left = np.minimum(gap_l, gap_r), gap_l <= gap_r
        least = best[going]
        # a gap of `far` means that no entry is left; its square is not taken
        on = (gap != far) & ((least == far) | (np.where(gap != far, gap, 0) ** 2 <= np.where(least == far, 0, least) * m))
        going, l, r, on_left = going[on], l[on], r[on], on_left[on]
        at = np.where(on_left, l, r)
        distance = ((parts[going] - ranked[at]) ** 2).sum(axis=1)
        seen += len(going)
        better = (distance < best[going]) | ((distance == best[going]) & (order[at] < index[going]))
        best[going[better]], index[going[better]] = distance[better], order[at][better]
        left[going[on_left]] -= 1
        right[going[~on_left]] += 1
    return index, best, seen


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches of bounded size with their vectors cut to parts."""
    for whole in batches:
        for start in range(0, len(whole), AT_ONCE):
            b = whole.slice(start, AT_ONCE)
            yield b, b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(len(b), PARTS, -1)


def _counted(batches: Iterator[pa.RecordBatch], books: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The task's counts and sums by part, entry and place (the count at the last)."""
    parts, entries, m = books.shape
    total = np.zeros((parts, entries, m + 1), dtype=np.int64)
    for _, x in _slices(batches):
        for p in range(parts):
            code = nearest(x[:, p], books[p])[0]
            order = np.argsort(code, kind="stable")
            some, first = np.unique(code[order], return_index=True)
            total[p, some, :m] += np.add.reduceat(x[order, p], first, axis=0)
            total[p, :, m] += np.bincount(code, minlength=entries)
    flat = total.ravel()
    at = np.flatnonzero(flat)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(flat[at])], names=["place", "s"])


def codebooks(rows: DataFrame, rounds: int = ROUNDS) -> np.ndarray | None:
    """Codebooks as (part, entry, component) of written ``rows(vec_id, x)``; None where there are none."""
    size = rows.agg(F.min(F.size("x")).alias("least"), F.max(F.size("x")).alias("most")).head()
    if size["most"] is None:
        return None
    if size["least"] != size["most"] or size["most"] % PARTS or not size["most"]:
        raise ValueError(f"vectors have from {size['least']} to {size['most']} components; {PARTS} equal parts are wanted")
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "x").select("x").limit(ENTRIES).collect()
    books = np.array([r["x"] for r in first], dtype=np.int64).reshape(len(first), PARTS, -1).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        sums = rows.select("x").mapInArrow(partial(_counted, books=books), "place long, s long").groupBy("place").agg(F.sum("s").alias("s")).toPandas()  # as many rows as the codebooks have numbers
        total = np.zeros(books.shape[0] * books.shape[1] * (books.shape[2] + 1), dtype=np.int64)
        total[sums["place"].to_numpy()] = sums["s"].to_numpy()
        total = total.reshape(*books.shape[:2], -1)
        used = total[:, :, -1] > 0
        books[used] = total[used][:, :-1] // total[used][:, -1:]
    return books


def digest(books: np.ndarray) -> str:
    """SHA-256 of all numbers of the codebooks in order."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


CODED = "vec_id long, label long, code string, error long"


def _coded(batches: Iterator[pa.RecordBatch], books: np.ndarray) -> Iterator[pa.RecordBatch]:
    for b, x in _slices(batches):
        codes, error = np.empty((len(b), len(books)), dtype=np.uint8), np.zeros(len(b), dtype=np.int64)
        for p in range(len(books)):
            codes[:, p], distance, _ = nearest(x[:, p], books[p])
            error += distance
        text = [c.tobytes().hex() for c in codes]
        yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("label"), pa.array(text), pa.array(error)], names=["vec_id", "label", "code", "error"])


def decoded(codes: DataFrame, books: np.ndarray) -> DataFrame:
    """``vec_id, x``: the integers that the codes of ``codes(vec_id, code)`` stand for."""

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = np.array([list(bytes.fromhex(c)) for c in b.column(1).to_pylist()], dtype=np.int64).reshape(len(b), len(books))
            x = books[np.arange(len(books)), at].reshape(len(b), books.shape[0] * books.shape[2])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(list(x), type=pa.list_(pa.int64()))], names=["vec_id", "x"])

    return codes.select("vec_id", "code").mapInArrow(back, "vec_id long, x array<bigint>")


def with_label_error(rows: DataFrame) -> DataFrame:
    """Adds ``label_error``, the errors summed over equal labels: a label's rows are dealt over SALTS keys, each of which gets the sum."""
    sums = rows.groupBy("label").agg(F.sum("error").alias("label_error"))
    sums = sums.select(F.col("label").alias("of_label"), "label_error", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("of_salt"))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)).cast("int"))
    return salted.join(sums, F.col("label").eqNullSafe(F.col("of_label")) & (F.col("salt") == F.col("of_salt"))).drop("of_label", "of_salt", "salt")


def compressed(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of every vector that is whole."""
    rows = materialise(whole_vectors(vectors, column), "vectors")
    books = codebooks(rows)
    if books is None:
        return vectors.sparkSession.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    coded = materialise(rows.mapInArrow(partial(_coded, books=books), CODED), "codes")
    return with_label_error(coded).select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compressed(read_table(spark, sf_dir, "embeddings"))


def _assigned(n: int) -> str:
    """Nearest entries of codebook ``c<n>``, as ``a<n>(rid, p, entry, distance)``."""
    return f""" d{n} as (select rid, x.p, entry, sum((x.v - c.v) * (x.v - c.v)) as distance from x join c{n} c on c.p = x.p and c.j = x.j group by 1, 2, 3),
 a{n} as (select rid, p, arg_min(entry, distance * {ENTRIES} + entry) as entry, min(distance) as distance from d{n} group by 1, 2)"""


def _moved(n: int) -> str:
    """Codebook ``c<n + 1>`` from the parts assigned to ``c<n>``."""
    return f""" m{n} as (select x.p, a.entry, x.j, floor(sum(x.v) / count(*)) as v from x join a{n} a on a.rid = x.rid and a.p = x.p group by 1, 2, 3),
 c{n + 1} as (select c.p, c.entry, c.j, cast(coalesce(m.v, c.v) as bigint) as v from c{n} c left join m{n} m on m.p = c.p and m.entry = c.entry and m.j = c.j)"""


ORACLE_SQL = {
    "op13_vector_codes": f"""with kept as (select row_number() over (order by vec_id nulls last) as rid, vec_id, label, embedding from embeddings
  where embedding is not null and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0),
 x as (select rid, (i - 1) // (n // {PARTS}) as p, (i - 1) % (n // {PARTS}) as j, cast(floor({int(SCALE)} * cast(e as double)) as bigint) as v from (select rid, len(embedding) as n, unnest(embedding) as e, generate_subscripts(embedding, 1) as i from kept)),
 c0 as (select p, rid - 1 as entry, j, v from x where rid <= {ENTRIES}),"""
    + ",".join(_assigned(n) + "," + _moved(n) for n in range(ROUNDS))
    + ","
    + _assigned(ROUNDS)
    + f""", codes as (select rid, string_agg(printf('%02x', entry), '' order by p) as code, cast(sum(distance) as bigint) as error from a{ROUNDS} group by 1),
 books as (select sha256(string_agg(cast(v as varchar), ',' order by p, entry, j)) as codebooks_sha256 from c{ROUNDS}),
 sums as (select label, cast(sum(error) as bigint) as label_error from codes join kept on kept.rid = codes.rid group by 1)
 select vec_id, code, error, label_error, codebooks_sha256 from codes join kept on kept.rid = codes.rid join sums on sums.label is not distinct from kept.label, books"""
}
QUERIES = {"op13_vector_codes": op13_vector_codes}
