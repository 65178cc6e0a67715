"""Suffix-array dedup: byte strings of a fixed length that repeat, found as groups with all their occurrences.

Suffixes are sampled so that no repeat is missed: in every stretch of LENGTH bytes the K-byte string of the least
hash (the last of equal ones) is its anchor. Equal stretches have equal anchors at equal places, so all
occurrences of a repeat meet in the bucket of its anchor: an interval of the corpus' common-prefix tree.

The suffixes that start at an anchor are sorted, and a stack goes along their common prefixes. That gives the
tree's intervals: the groups of all occurrences that share a right side of some length. In an interval the left
sides are sorted and scanned alike: where they differ the group is split (left-extension diversity), and what
comes out are repeats that can be extended neither way, each with all its occurrences. All but the first
occurrence (in order of doc_id and place) are marked. Contexts are cut where another anchor takes over, so a
longer repeat is marked piece by piece.

An anchor's occurrences are first scanned among the documents of one task; what is marked whole there goes no
further. So an anchor that stands in a third of all documents meets with a few occurrences from each task. There
they come sorted by their sides: of equal sides only the first are held, the others are marked as they pass. Copies
of a text are one text. Texts are written once, bucketed by document, and joined without a shuffle from there.

Defined results: null and empty texts have 0 bytes, nothing removed; documents of equal id and text are one
document in different rows, with equal results; equal ids with different texts are ordered by place and text; null
ids come last; texts shorter than LENGTH keep all; an empty table gives no rows; extra columns are not carried.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mudlark.functions.skew import left_join_spread
from mudlark.llm.common import materialise, read_table, shared_dir
from mudlark.llm.shingles import _powers, in_slices, mixed

LENGTH, K = 100, 24
#: Stands for a null id, after all others.
LAST = (1 << 63) - 1
Occurrence = tuple[int, int, int, bytes, bytes]  # id, key of the text, place, left side reversed, right side


def anchors(texts: list[bytes], length: int = LENGTH, k: int = K) -> tuple[np.ndarray, ...]:
    """For all texts the anchors: text's number, hash, place, and first and last start of the stretches it stands for."""
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    lens = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
    ends = np.cumsum(lens)
    w, n = length - k + 1, len(data) - length + 1
    if n <= 0:
        return (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64), *[np.zeros(0, dtype=np.int64)] * 3)
    power, inverse = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=total[1:])
    h = mixed((total[k:] - total[:-k]) * inverse[: len(data) - k + 1])
    # the last least of w neighbours, by doubling
    value, at = (h >> np.uint64(32)).astype(np.uint32), np.arange(len(h), dtype=np.int32)
    span = 1
    while span < w:
        step = min(span, w - span)
        right = value[step:] <= value[:-step]
        at = np.where(right, at[step:], at[:-step])
        value = np.minimum(value[step:], value[:-step])
        span += step
    # stretches that lie in one text
    text = np.repeat(np.arange(len(texts)), lens)[:n]
    inside = np.flatnonzero(np.arange(n) + length <= ends[text])
    at, text = at[inside].astype(np.int64), text[inside]
    if not len(at):
        return (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64), *[np.zeros(0, dtype=np.int64)] * 3)
    new = np.flatnonzero(np.diff(at, prepend=-1) | np.diff(text, prepend=-1))
    last = np.append(new[1:], len(at)) - 1
    begin = (ends - lens)[text[new]]
    return text[new], h[at[new]], at[new] - begin, inside[new] - begin, inside[last] - begin


PACK = pa.schema([("bucket", pa.int32()), *[(c, pa.binary()) for c in ("hash", "key", "id", "place", "lo", "hi")]])
PACK_KIND = "bucket int, hash binary, key binary, id binary, place binary, lo binary, hi binary"
KINDS = ("<u8", "<i8", "<i8", "<u4", "<u1", "<u1")


def _anchored(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Anchors of ``id, key, text`` in packs by bucket; ``lo`` and ``hi`` are how far before the anchor its
    stretches start."""
    for batch in batches:
        ids, keys = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        texts = [(t or "").encode() for t in batch.column(2).to_pylist()]
        for part in in_slices(texts):
            text, h, place, first, last = anchors(texts[part])
            columns = (h, keys[part][text], ids[part][text], place, place - last, place - first)
            bucket = (h % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            columns = [c[order].astype(kind) for c, kind in zip(columns, KINDS, strict=True)]
            bucket = bucket[order]
            edges = np.flatnonzero(np.diff(bucket, prepend=-1))
            rows = [(int(bucket[a]), *[c[a:b].tobytes() for c in columns]) for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(bucket)], strict=True)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), PACK, strict=True)], schema=PACK)


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows sorted by their first column, those of one value together."""
    at, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[0] != at:
                if rows:
                    yield rows
                at, rows = row[0], []
            rows.append(row)
    if rows:
        yield rows


REPEATED = "id long, key long, hash long, place int, lo int, hi int"


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each bucket the anchors that stand in two places at least; copies of a text count as its first document."""
    for rows in _gathered(batches):
        h, key, doc, place, lo, hi = (np.frombuffer(b"".join([r[i + 1] for r in rows]), dtype=kind) for i, kind in enumerate(KINDS))
        order = np.lexsort((doc, place, key, h))
        h, key, doc, place, lo, hi = (c[order] for c in (h, key, doc, place, lo, hi))
        new = np.ones(len(h), dtype=bool)
        new[1:] = (h[1:] != h[:-1]) | (key[1:] != key[:-1]) | (place[1:] != place[:-1])
        h, key, doc, place, lo, hi = (c[new] for c in (h, key, doc, place, lo, hi))
        twice = np.zeros(len(h), dtype=bool)
        same = h[1:] == h[:-1]
        twice[1:] |= same
        twice[:-1] |= same
        columns = [doc, key, h.view(np.int64), place.astype(np.int32), lo.astype(np.int32), hi.astype(np.int32)]
        yield pa.RecordBatch.from_arrays([pa.array(c[twice]) for c in columns], names=["id", "key", "hash", "place", "lo", "hi"])


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


def intervals(heights: list[int]) -> Iterator[tuple[int, int, int]]:
    """Common-prefix intervals ``height, first, last`` of a sorted list, from the heights between neighbours: a
    stack of open intervals, each closed when a lower height comes."""
    stack = [(0, 0)]
    for i, height in enumerate([*heights, 0], start=1):
        left = i - 1
        while stack[-1][0] > height:
            top, left = stack.pop()
            yield top, left, i - 1
        if stack[-1][0] < height:
            stack.append((height, left))


def repeats(group: list[Occurrence], length: int = LENGTH) -> Iterator[tuple[int, int, list[int]]]:
    """Repeats of an anchor's occurrences that are ``length`` bytes at least: bytes to the left, to the right, and
    the places in ``group`` of all occurrences."""
    by_right = sorted(range(len(group)), key=lambda i: group[i][4])
    for right, a, b in intervals([common(group[i][4], group[j][4]) for i, j in zip(by_right, by_right[1:], strict=False)]):
        members = sorted(by_right[a : b + 1], key=lambda i: group[i][3])
        for left, c, d in intervals([common(group[i][3], group[j][3]) for i, j in zip(members, members[1:], strict=False)]):
            if left + right >= length:
                yield left, right, members[c : d + 1]
        if right >= length:
            yield 0, right, members


def marks(group: list[Occurrence], length: int = LENGTH) -> list[list[tuple[int, int]]]:
    """For every occurrence the byte ranges in which it repeats an earlier one."""
    out: list[list[tuple[int, int]]] = [[] for _ in group]
    if len(group) == 2:
        x, y = group
        right, left = common(x[4], y[4]), common(x[3], y[3])
        if left + right >= length:
            later = 1 if (x[0], x[2], x[1]) < (y[0], y[2], y[1]) else 0
            out[later].append((group[later][2] - left, group[later][2] + right))
        return out
    for left, right, members in repeats(group, length):
        first = min(members, key=lambda i: (group[i][0], group[i][2], group[i][1]))
        for i in members:
            if i != first:
                out[i].append((group[i][2] - left, group[i][2] + right))
    return out


ROUND = pa.schema([("hash", pa.int64()), ("id", pa.int64()), ("key", pa.int64()), ("place", pa.int32()), ("left", pa.binary()), ("right", pa.binary()), ("begin", pa.int32()), ("end", pa.int32())])
ROUND_KIND = "hash long, id long, key long, place int, left binary, right binary, begin int, end int"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], type=f.type) for i, f in enumerate(ROUND)], schema=ROUND)


def _locally(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Rows ``id, key, text, found`` with a document's repeated anchors to marks (with begin and end) and occurrences
    that go on (with their sides)."""
    groups: dict[int, list[Occurrence]] = {}
    size = 0

    def scanned():
        rows = []
        for h, group in groups.items():
            for x, spans in zip(group, marks(group, length) if len(group) > 1 else [[]], strict=True):
                rows += [(None, x[0], x[1], None, None, None, a, b) for a, b in _merged(spans)]
                if not any(a <= x[2] - len(x[3]) and b >= x[2] + len(x[4]) for a, b in spans):
                    rows.append((h, x[0], x[1], x[2], x[3], x[4], None, None))
            if len(rows) > 20_000:
                yield _batch(rows)
                rows = []
        yield _batch(rows)

    for batch in batches:
        for doc, key, text, found in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            data = text.encode()
            for x in found:
                place = x["place"]
                begin, end = place - x["hi"], place - x["lo"] + length
                groups.setdefault(x["hash"], []).append((doc, key, place, data[begin:place][::-1], data[place:end]))
                size += 1
        if size > 200_000:
            yield from scanned()
            groups, size = {}, 0
    yield from scanned()


def _finally(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Occurrences sorted by hash, sides and place to marks. Of occurrences with equal sides the first stands for all, and
    the others repeat it whole, so what is held of an anchor is its distinct sides."""
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
    rows: list[tuple[int, int, int, int]] = []
    held: list[Occurrence] = []
    at = None

    def out():
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], type=t) for i, t in enumerate(kinds)], names=["id", "key", "begin", "end"])

    def scanned():
        if len(held) > 1:
            for x, spans in zip(held, marks(held, length), strict=True):
                rows.extend((x[0], x[1], a, b) for a, b in _merged(spans))

    for batch in batches:
        for h, *x in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if h != at:
                scanned()
                at, held = h, []
            if held and held[-1][3:] == tuple(x[3:]):
                rows.append((x[0], x[1], x[2] - len(x[3]), x[2] + len(x[4])))
            else:
                held.append(tuple(x))
            if len(rows) > 20_000:
                yield out()
                rows = []
    scanned()
    yield out()


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching ranges as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc, key, text, spans in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            data, at, rest = text.encode(), 0, []
            whole = _merged([(s["begin"], s["end"]) for s in spans])
            for a, b in whole:
                rest.append(data[at:a])
                at = b
            kept = b"".join([*rest, data[at:]])
            rows.append((doc, key, len(data) - len(kept), len(whole), hashlib.sha256(kept).hexdigest(), kept))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], type=t) for i, t in enumerate(kinds)], names=["id", "key", "n_removed", "n_spans", "kept_sha256", "kept"])


def bucketed(docs: DataFrame, parts: int) -> DataFrame:
    """``id, key, more, doc_id, text`` as a table bucketed by id and key, in the shared folder; ``key`` and ``more`` are 128 bits
    that stand for the text."""
    name = f"mudlark_texts_{uuid.uuid4().hex}"
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("id"), F.xxhash64(text).alias("key"), F.xxhash64(text, F.lit("more")).alias("more"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    rows.write.option("compression", "zstd").option("path", f"{shared_dir(docs.sparkSession)}/{name}").bucketBy(parts, "id", "key").saveAsTable(name)
    return docs.sparkSession.table(name)


def _found(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The bucketed table, its distinct ``id, key, text``, and for each with repeated anchors these as ``found``."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    table = bucketed(docs, parts)
    packs = table.select("id", "key", "text").mapInArrow(partial(_anchored, buckets=4 * parts), PACK_KIND)
    found = packs.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_repeated, REPEATED)
    found = found.groupBy("id", "key").agg(F.collect_list(F.struct("hash", "place", "lo", "hi")).alias("found"))
    return table, table.select("id", "key", "text").dropDuplicates(["id", "key"]), found


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`` of every row; ``kept`` is null where nothing goes."""
    table, texts, found = _found(docs)
    local = materialise(texts.join(found, ["id", "key"]).select("id", "key", "text", "found").mapInArrow(partial(_locally, length=length), ROUND_KIND), "occurrences")
    left = local.where("hash is not null").select("hash", "id", "key", "place", "left", "right")
    more = left.repartition("hash").sortWithinPartitions("hash", "left", "right", "id", "place", "key").mapInArrow(partial(_finally, length=length), "id long, key long, begin int, end int")
    spans = local.where("hash is null").select("id", "key", "begin", "end").union(more).groupBy("id", "key").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))
    cut = texts.join(spans, ["id", "key"]).select("id", "key", "text", "spans").mapInArrow(_cut, "id long, key long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    rows = table.select("id", "key", "more", "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha"))
    first = table.groupBy("key", "more").agg(F.min("id").alias("first"))
    out = rows.join(first, ["key", "more"]).join(cut, ["id", "key"], "left")
    copy = (F.col("id") > F.col("first")) & (F.col("n_bytes") >= length)
    return out.select(
        "doc_id",
        "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(copy, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copy, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
        F.when(copy, F.lit(b"")).otherwise(F.col("kept")).alias("kept"),
    )


def maximal(group: list[Occurrence], length: int = LENGTH) -> Iterator[tuple[int, int, list[int]]]:
    """Those of the ``repeats`` whose members differ on both sides of what they share: each set of occurrences once, with
    the longest string that they have in common."""
    for left, right, members in repeats(group, length):
        sides = ([group[i][side] for i in members] for side in (3, 4))
        if (left, right) == tuple(common(min(x), max(x)) for x in sides):
            yield left, right, members


SIDES = pa.schema([("hash", pa.int64()), ("context", pa.binary()), ("id", pa.int64()), ("place", pa.int32()), ("left", pa.binary()), ("right", pa.binary())])
SIDES_KIND = "hash long, context binary, id long, place int, left binary, right binary"


def _sides(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Every occurrence of a document's repeated anchors with its sides, and a digest of these as ``context``."""
    for batch in batches:
        rows = []
        for doc, text, found in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            data = text.encode()
            for x in found:
                place = x["place"]
                left, right = data[place - x["hi"] : place][::-1], data[place : place - x["lo"] + length]
                rows.append((x["hash"], hashlib.md5(b"%d " % len(left) + left + right).digest(), doc, place, left, right))
            if len(rows) > 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), SIDES, strict=True)], schema=SIDES)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), SIDES, strict=True)], schema=SIDES)


MEMBERS = pa.schema([("context", pa.binary()), ("repeat", pa.binary()), ("length", pa.int32()), ("before", pa.int32())])


def _members(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Distinct sides sorted by anchor (with how often they stand) to the maximal repeats that they belong to."""
    rows = []
    for found in _gathered(batches):
        group = [(0, 0, 0, left, right) for _, _, left, right, _ in found]
        whole = set()
        for left, right, members in maximal(group, length) if len(group) > 1 else ():
            one = group[members[0]]
            repeat = hashlib.md5(one[3][:left][::-1] + one[4][:right]).digest()
            rows += [(found[i][1], repeat, left + right, left) for i in members]
            whole.update(i for i in members if (left, right) == (len(group[i][3]), len(group[i][4])))
        for i, (_, context, left, right, n) in enumerate(found):
            # equal sides that no other holds are a group of their own
            if n > 1 and i not in whole:
                rows.append((context, hashlib.md5(left[::-1] + right).digest(), len(left) + len(right), len(left)))
        if len(rows) > 20_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), MEMBERS, strict=True)], schema=MEMBERS)
            rows = []
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), MEMBERS, strict=True)], schema=MEMBERS)


def repeat_groups(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``repeat, length, doc_id, start``: a row for each occurrence of each maximal repeat; ``repeat`` is the MD5 of its bytes.

    The tree is scanned over the distinct sides of an anchor, counted before they are shuffled, and the occurrences are
    joined to the groups afterwards, with heavy sides dealt over salts: a passage that a third of the documents hold is
    one entry of the scan. A repeat that goes over several anchors' stretches comes as overlapping pieces. Copies of a
    text are one: occurrences are those in the first of equal texts, so a text that only stands in copies has no group."""
    _, texts, found = _found(docs)
    sides = texts.join(found, ["id", "key"]).select("id", "text", "found").mapInArrow(partial(_sides, length=length), SIDES_KIND)
    sides = materialise(sides, "sides")
    distinct = sides.groupBy("hash", "context").agg(F.first("left").alias("left"), F.first("right").alias("right"), F.count("*").alias("n"))
    members = distinct.repartition("hash").sortWithinPartitions("hash").mapInArrow(partial(_members, length=length), "context binary, repeat binary, length int, before int")
    rows = left_join_spread(sides.select("context", "id", "place"), materialise(members, "members"), "context").where("repeat is not null")
    return rows.select(F.lower(F.hex("repeat")).alias("repeat"), "length", F.nullif("id", F.lit(LAST)).alias("doc_id"), (F.col("place") - F.col("before")).cast("long").alias("start"))


def repeat_groups_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_groups(read_table(spark, sf_dir, "documents"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(read_table(spark, sf_dir, "documents")).drop("kept")


QUERIES = {"op10_suffix_dedup": op10_suffix_dedup, "repeat_groups_documents": repeat_groups_documents}
