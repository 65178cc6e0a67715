"""Language-model scoring by context-tree weighting over binary-decomposed bytes.

A text is its bytes (A-Z lower-cased) and an end sign. Each byte is eight binary decisions; every decision has a
context tree over the preceding bytes. A node of a tree holds how often the decision was 0 and 1 after its
context, its Krichevsky-Trofimov estimate, and the weighted mixture of that with its children's. A byte's
probability is the product of its decisions' mixtures over all depths, from the root to the deepest
context seen in training.

How it runs: documents are dealt into blocks by a hash of id and text. A block gives its distinct n-grams (context
and byte) with their training counts, in packs by bucket; a bucket holds all n-grams whose contexts end in the same
bytes, so whole subtrees. A bucket's packs are merged a few at a time; of the merged table the trees' lower levels are
built, and the few levels above are grouped sums over all buckets. Then the packs pass by their bucket's table one by
one, and the scores go back to the blocks that asked, where each text is read off. Nothing is broadcast or sent to the
driver; a block's table is bounded by its bytes, a bucket's by the number of contexts that share an ending, however
many blocks hold them.

Defined results: a null text counts as empty: its score is that of the end sign at the start of a text; rows with
equal or null ids are scored on their own (a null id is training data); an empty table gives no rows; without
training rows every decision has probability 1/2; extra columns are not carried.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mudlark.llm.common import materialise, read_table
from mudlark.llm.shingles import _LOWER, in_slices, mixed, word_hashes

#: Bytes of context.
DEPTH = 5
#: Sign of the end of a text, and of what is before its start: a byte that UTF-8 never has.
END = 0xFF
#: Bytes of text in a block, about, and in one of a small table.
BLOCK, LEAST_BLOCK = 16 << 20, 4 << 20


def grams(texts: list[bytes], depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """For every byte and end sign of the texts its context and itself as one number (the byte lowest), and the
    number of them in each text."""
    edge = bytes([END])
    data = _LOWER[np.frombuffer(edge * depth + b"".join(t + edge * (depth + 1) for t in texts), dtype=np.uint8)]
    n = len(data) - depth
    out = np.zeros(n, dtype=np.int64)
    for k in range(depth + 1):
        out = (out << 8) | data[k : k + n]
    # the signs before the next text's start are context only
    lens = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    keep = np.ones(n, dtype=bool)
    begin = np.cumsum(lens + depth)
    for k in range(1, depth + 1):
        keep[begin - k] = False
    return out[keep], lens


#: Kinds of keys of a block's table: n-grams of bytes, and words.
GRAM, WORD = 0, 1
PACK = pa.schema([("block", pa.int32()), ("kind", pa.int32()), ("bucket", pa.int32()), ("keys", pa.binary()), ("train", pa.binary())])
PACK_KIND = "block int, kind int, bucket int, keys binary, train binary"
#: Bytes of context that the subtrees of a bucket share: the levels above are summed over all buckets.
TOP = 3


def _bucket(kind: int, keys: np.ndarray, depth: int, buckets: int) -> np.ndarray:
    """The bucket of a gram is that of its last TOP context bytes, so that whole subtrees meet."""
    if kind == GRAM:
        keys = (keys >> 8) & ((1 << (8 * min(TOP, depth))) - 1)
    return (mixed(keys.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def _tables(texts: list[bytes], depth: int) -> dict[int, np.ndarray]:
    return {GRAM: grams(texts, depth)[0], WORD: word_hashes(texts)[0].view(np.int64)}


def _counted(batches: Iterator[pa.RecordBatch], depth: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Packs of the distinct grams and words of each block's texts, with their training counts; rows come sorted
    by block. Keys are in ascending order inside a pack."""
    at, held, size = None, {GRAM: [], WORD: []}, 0

    def merged(kind):
        key, back = np.unique(np.concatenate([p[0] for p in held[kind]]), return_inverse=True)
        return key, np.bincount(back, weights=np.concatenate([p[1] for p in held[kind]])).astype(np.int64)

    def flush():
        for kind in (GRAM, WORD):
            key, n = merged(kind)
            where = _bucket(kind, key, depth, buckets)
            order = np.argsort(where, kind="stable")
            key, n, where = key[order], n[order], where[order]
            edges = np.flatnonzero(np.diff(where, prepend=-1))
            rows = [(at, kind, int(where[a]), key[a:b].tobytes(), _count_bytes(n[a:b])) for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(key)])]  # none of a block without words
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), PACK, strict=True)], schema=PACK)

    for batch in batches:
        block, held_out = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
        texts = [(t or "").encode() for t in batch.column(2).to_pylist()]
        for b in np.unique(block).tolist():
            if b != at:
                if at is not None:
                    yield from flush()
                at, held, size = b, {GRAM: [], WORD: []}, 0
            for out in (False, True):
                own = [texts[i] for i in np.flatnonzero((block == b) & (held_out == out))]
                for part in in_slices(own):
                    for kind, keys in _tables(own[part], depth).items():
                        key, n = np.unique(keys, return_counts=True)
                        held[kind].append((key, n * (not out)))
                        size += len(key)
                    if size > 3_000_000:
                        for kind in (GRAM, WORD):
                            held[kind] = [merged(kind)]
                        size = sum(len(held[k][0][0]) for k in held) // 2
    if at is not None:
        yield from flush()


def _unpacked(keys: bytes, train: bytes) -> tuple[np.ndarray, np.ndarray]:
    k = np.frombuffer(keys, dtype=np.int64)
    return k, np.frombuffer(train, dtype="<u4" if len(train) == 4 * len(k) else "<u8").astype(np.int64)


def _log_gamma_array(x: np.ndarray) -> np.ndarray:
    """Natural logarithm of gamma for x >= 1/2: Stirling's series seven steps up."""
    y = x + 7
    low = np.log(x * (x + 1) * (x + 2) * (x + 3)) + np.log((x + 4) * (x + 5) * (x + 6))
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - low


def _subtrees(gram: np.ndarray, n: np.ndarray, depth: int, top: int) -> list[tuple]:
    """The levels from ``depth`` up to ``top`` of the trees over these grams (all below their ``top`` contexts): per
    level the nodes, their counts, log mixture, share of their own estimate, that estimate, and each node's place
    in the level above. A node's number is its context's bytes, then the byte's decisions so far behind a 1.
    Grams of count 0 are nodes of probability 1/2, which change no mixture."""
    byte = gram & 255
    step = np.arange(8)
    path = ((byte | 256)[:, None] >> (8 - step)).ravel()
    bit = ((byte[:, None] >> (7 - step)) & 1).ravel()
    node, back = np.unique(((gram >> 8) << 8).repeat(8) | path, return_inverse=True)
    each = n.repeat(8)
    total, ones = np.bincount(back, weights=each), np.bincount(back, weights=each * bit)
    levels, below, first = [], None, back
    for d in range(depth, top - 1, -1):
        zeros = total - ones
        kt = _log_gamma_array(zeros + 0.5) + _log_gamma_array(ones + 0.5) - _log_gamma_array(total + 1) - math.log(math.pi)
        if below is None:
            mix, own = kt, np.ones(len(kt))
        else:
            mix = np.logaddexp(kt, below) - math.log(2)
            own = np.exp(kt - mix - math.log(2))
        up, back = np.unique(node & ((1 << (8 * d)) - 1), return_inverse=True) if d > top else (None, None)
        levels.append((node, total, ones, mix, own, (ones + 0.5) / (total + 1), back))
        if d > top:
            node, below = up, np.bincount(back, weights=mix)
            total, ones = np.bincount(back, weights=total), np.bincount(back, weights=ones)
    return [(first, bit), *levels]


def _merged_grams(packs: list[tuple[bytes, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    if len(packs) == 1:
        return _unpacked(*packs[0])
    both = [_unpacked(k, t) for k, t in packs]
    key, n = np.concatenate([k for k, _ in both]), np.concatenate([t for _, t in both])
    order = np.argsort(key)
    key = key[order]
    new = np.flatnonzero(np.diff(key, prepend=key[0] - 1))
    return key[new], np.add.reduceat(n[order], new)


def _count_bytes(n: np.ndarray) -> bytes:
    return n.astype("<u8" if n.max() >> 32 else "<u4").tobytes()


#: Blocks of the rows of a bucket's merged table and of what the levels above have said of its nodes.
MERGED, HANDED = -2, -1


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One pack for each bucket of rows sorted by kind and bucket: its distinct keys with their counts. What is held is
    merged whenever it is twice the last merged table."""
    at, held, size, last = None, [], 0, 0

    def pack():
        key, n = _merged_grams(held)
        return pa.RecordBatch.from_arrays([*[pa.array([x], type=pa.int32()) for x in (MERGED, *at)], pa.array([key.tobytes()], type=pa.binary()), pa.array([_count_bytes(n)], type=pa.binary())], schema=PACK)

    for batch in batches:
        for _, kind, bucket, keys, train in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (kind, bucket) != at:
                if held:
                    yield pack()
                at, held, size, last = (kind, bucket), [], 0, 0
            held.append((keys, train))
            size += len(keys)
            if size > max(16 << 20, 2 * last) and len(held) > 1:
                key, n = _merged_grams(held)
                held = [(key.tobytes(), _count_bytes(n))]
                size = last = 8 * len(key)
    if held:
        yield pack()


def _tops(batches: Iterator[pa.RecordBatch], depth: int, top: int) -> Iterator[pa.RecordBatch]:
    """The ``top`` level of a bucket's subtrees; of words, how many are known and their training tokens."""
    names = ["kind", "bucket", "node", "n", "n1", "mix", "own", "p"]
    for batch in batches:
        for _, kind, bucket, keys, train in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            key, n = _unpacked(keys, train)
            if kind == GRAM:
                node, total, ones, mix, own, p, _ = _subtrees(key, n, depth, top)[-1]
            else:
                node, total, ones = np.zeros(1, dtype=np.int64), np.array([n.sum()], dtype=float), np.array([(n > 0).sum()], dtype=float)
                mix = own = p = np.zeros(1)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(node), kind, dtype=np.int32)), pa.array(np.full(len(node), bucket, dtype=np.int32)), pa.array(node), pa.array(total.astype(np.int64)), pa.array(ones.astype(np.int64)), pa.array(mix), pa.array(own), pa.array(p)], names=names)


def _values(kind: int, key: np.ndarray, n: np.ndarray, handed: list[tuple[bytes, bytes]], depth: int, top: int) -> np.ndarray:
    """Of a bucket's grams the log10 probability, of words the count."""
    if kind == WORD:
        return n.astype("<f8")
    (place, bit), *levels = _subtrees(key, n, depth, top)
    said, rest = np.zeros(len(levels[-1][0])), np.zeros(len(levels[-1][0]))
    for node, values in handed:
        k = np.searchsorted(levels[-1][0], np.frombuffer(node, dtype=np.int64))
        said[k], rest[k] = np.frombuffer(values, dtype=np.float64).reshape(2, -1)
    for _, _, _, _, own, p, back in reversed(levels[:-1]):
        said, rest = said[back] + rest[back] * own * p, rest[back] * (1 - own)
    p1 = said[place]  # the leaves' own share is 1: nothing rests
    return np.log10(np.where(bit == 1, p1, 1 - p1)).reshape(-1, 8).sum(axis=1).astype("<f4")


def _answers(batches: Iterator[pa.RecordBatch], depth: int, top: int) -> Iterator[pa.RecordBatch]:
    """For every pack the values of its keys in their order. Rows come sorted by kind, bucket and block, so a bucket's
    merged table and what was handed down to it before the packs."""
    at = key = n = value = None
    handed: list[tuple[bytes, bytes]] = []
    for batch in batches:
        for block, kind, bucket, keys, train in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (kind, bucket) != at:
                at, value, handed = (kind, bucket), None, []
            if block == MERGED:
                key, n = _unpacked(keys, train)
            elif block == HANDED:
                handed.append((keys, train))
            else:
                if value is None:
                    value = _values(kind, key, n, handed, depth, top)
                out = value[np.searchsorted(key, np.frombuffer(keys, dtype=np.int64))].tobytes()
                yield pa.RecordBatch.from_arrays([*[pa.array([x], type=pa.int32()) for x in (block, kind, bucket)], pa.array([out], type=pa.binary())], names=["block", "kind", "bucket", "value"])


def _log_gamma(x: Column) -> Column:
    """Natural logarithm of gamma for x >= 1/2: Stirling's series seven steps up."""
    y = x + 7
    low = F.log(x * (x + 1) * (x + 2) * (x + 3)) + F.log((x + 4) * (x + 5) * (x + 6))
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * F.pow(y, F.lit(3))) + 1 / (1260 * F.pow(y, F.lit(5))) - low


def _log_sum(a: Column, b: Column) -> Column:
    """log(exp(a) + exp(b))."""
    return F.greatest(a, b) + F.log1p(F.exp(-F.abs(a - b)))


def _handed(tops: DataFrame, top: int) -> DataFrame:
    """``bucket, node, said, rest`` at depth ``top``: the part of a decision's probability that the levels down to
    there have said, and the weight that rests for those below. Sums over the contexts above, level by level."""
    levels, level = [tops], tops
    for d in range(top, 0, -1):
        # the parent's context lacks the first byte
        level = level.groupBy(F.col("node").bitwiseAND(F.lit((1 << (8 * d)) - 1)).alias("node")).agg(F.sum("n").alias("n"), F.sum("n1").alias("n1"), F.sum("mix").alias("below"))
        n0, n1 = (F.col("n") - F.col("n1")).cast("double"), F.col("n1").cast("double")
        kt = _log_gamma(n0 + 0.5) + _log_gamma(n1 + 0.5) - _log_gamma(n0 + n1 + 1) - math.log(math.pi)
        level = level.withColumn("kt", kt).withColumn("mix", _log_sum(F.col("kt"), F.col("below")) - math.log(2))
        level = level.select("node", "n", "n1", "mix", F.exp(F.col("kt") - F.col("mix") - math.log(2)).alias("own"), ((n1 + 0.5) / (n0 + n1 + 1)).alias("p"))
        level = materialise(level, "level")
        levels.append(level)
    above = None
    for d, level in enumerate(reversed(levels)):
        if above is None:
            level = level.withColumns({"said": F.lit(0.0), "rest": F.lit(1.0)})
        else:
            level = level.withColumn("up", F.col("node").bitwiseAND(F.lit((1 << (8 * d)) - 1))).join(above.select(F.col("node").alias("up"), "said", "rest"), "up")
        said, rest = F.col("said") + F.col("rest") * F.col("own") * F.col("p"), F.col("rest") * (1 - F.col("own"))
        above = level.select(*(["bucket"] if "bucket" in level.columns else []), "node", said.alias("said"), rest.alias("rest"))
    return above


SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, n_bytes long"


def _read_off(docs: pd.DataFrame, table: pd.DataFrame, depth: int, buckets: int, end_count: int) -> pd.DataFrame:
    """A block's texts read off the answers: the score of each, and the baseline's sum of log10(count + 1/2). The
    answers of a bucket are in the order of the block's keys, which the texts give again."""
    texts = [(t or "").encode() for t in docs["text"]]
    # of every part its distinct keys, and which of them stands where
    found = {GRAM: [], WORD: []}
    sizes = {GRAM: [], WORD: []}
    for part in in_slices(texts):
        for kind, (keys, lens) in {GRAM: grams(texts[part], depth), WORD: word_hashes(texts[part])}.items():
            keys, where = np.unique(keys.view(np.int64), return_inverse=True)
            found[kind].append((keys, where.astype(np.int32)))
            sizes[kind].append(lens)
    values = {}
    for kind in (GRAM, WORD):
        keys = np.unique(np.concatenate([k for k, _ in found[kind]]))
        bucket = _bucket(kind, keys, depth, buckets)
        own = table[table["kind"] == kind].sort_values("bucket")
        value = np.empty(len(keys))
        value[np.argsort(bucket, kind="stable")] = np.frombuffer(b"".join(own["value"]), dtype="<f4" if kind == GRAM else "<f8")
        values[kind] = [value[np.searchsorted(keys, k)] for k, _ in found[kind]]
    score, base, known, tokens = ([np.zeros(0)] for _ in range(4))
    for value, (_, where), lens in zip(values[GRAM], found[GRAM], sizes[GRAM], strict=True):
        score.append(np.add.reduceat(value[where], np.cumsum(lens) - lens))
    for value, (_, where), lens in zip(values[WORD], found[WORD], sizes[WORD], strict=True):
        count = value[where]
        begin, total = np.cumsum(lens) - lens, np.concatenate([[0.0], np.cumsum(np.log10(value + 0.5)[where])])
        seen = np.concatenate([[0], np.cumsum(count > 0)])
        base.append(total[begin + lens] - total[begin] + math.log10(end_count + 0.5))
        known.append(seen[begin + lens] - seen[begin] + (end_count > 0))
        tokens.append(lens + 1)
    cat = lambda x, kind: np.concatenate(x).astype(kind)
    return pd.DataFrame({"doc_id": docs["doc_id"].astype("Int64"), "held_out": docs["held_out"], "n_tokens": cat(tokens, np.int64), "n_known": cat(known, np.int64), "base": cat(base, float), "score": cat(score, float), "n_bytes": np.array([len(t) for t in texts], dtype=np.int64)})


def dealt(docs: DataFrame, blocks: int) -> DataFrame:
    """Documents with their ``block``; only rows of equal id and text are always in one."""
    return docs.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int"))


def scored(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """Scores of ``docs(doc_id, text, held_out)``; the models are trained on the rows that are not held out.

    ``score`` is the tree model's log10 probability of the text, ``base_score`` that of the unigram baseline over
    words and an end token, ``bits_per_byte`` the tree model's code length."""
    size = docs.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    # blocks of BLOCK bytes, or smaller ones if there are cores for more
    spark = docs.sparkSession
    blocks = max(1, math.ceil(size / BLOCK), min(2 * spark.sparkContext.defaultParallelism, math.ceil(size / LEAST_BLOCK)))
    buckets, top = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / LEAST_BLOCK)), min(TOP, depth)
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce("held_out", F.lit(False)).alias("held_out"), F.col("text").cast("string"))
    docs = dealt(docs, blocks)
    shuffled = docs.select("block", "held_out", "text").repartition("block").sortWithinPartitions("block")
    packs = materialise(shuffled.mapInArrow(partial(_counted, depth=depth, buckets=buckets), PACK_KIND), "packs")

    def gathered(rows: DataFrame) -> DataFrame:
        return rows.repartition("kind", "bucket").sortWithinPartitions("kind", "bucket", "block")

    table = materialise(gathered(packs).mapInArrow(_merged, PACK_KIND), "merged")
    tops = materialise(table.mapInArrow(partial(_tops, depth=depth, top=top), "kind int, bucket int, node long, n long, n1 long, mix double, own double, p double"), "tops")
    word = tops.where(f"kind = {WORD}").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("n1"), F.lit(0)).alias("v")).head()
    trained = docs.where(~F.col("held_out")).count()
    total, distinct = word["n"] + trained, word["v"] + (trained > 0)
    handed = _handed(tops.where(f"kind = {GRAM}").drop("kind"), top)
    handed = handed.mapInArrow(_handed_packs, PACK_KIND)
    answers = gathered(packs.union(table).union(handed)).mapInArrow(partial(_answers, depth=depth, top=top), "block int, kind int, bucket int, value binary")
    out = docs.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(lambda d, t: _read_off(d, t, depth, buckets, trained), SCORED)
    return out.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * math.log10(total + 0.5 * (distinct + 1))).alias("base_score"),
        "score",
        (-F.col("score") / math.log10(2) / F.greatest("n_bytes", F.lit(1))).alias("bits_per_byte"),
    )


def _handed_packs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of nodes as packs of block HANDED, one for each bucket in a batch."""
    for batch in batches:
        bucket, node, said, rest = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        rows = []
        for b in np.unique(bucket).tolist():
            own = bucket == b
            rows.append((HANDED, GRAM, b, node[own].tobytes(), np.stack([said[own], rest[own]]).tobytes()))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), PACK, strict=True)], schema=PACK)


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 1
    return scored(docs.select("doc_id", "text", held_out.alias("held_out")))


QUERIES = {"op2_lm_scoring": op2_lm_scoring}
