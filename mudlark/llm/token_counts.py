"""Token counts without ids: the pieces of every distinct pre-token are counted once, joined to the documents'
pre-token frequencies, and summed.

The frequencies are kept as postings: for each pre-token of a task's documents a list of the documents and how
often each holds it. The postings are dealt out by buckets of pre-tokens; there each distinct one is counted once
and joined to all its postings. A pre-token that stands in every document has one list for each task; a bucket of
more than EVEN times the mean bytes is dealt over several tasks, each of which counts its pre-tokens once. Texts
are never shuffled.

Defined results: a null text counts as empty (0 tokens); every input row is counted on its own, also rows with
equal or null ids; an empty table gives no rows; extra columns are not carried; texts are counted whole.
"""

from __future__ import annotations

import threading
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mudlark.llm.common import materialise, read_table

#: Documents whose sums a task holds before it passes them on, and characters of text behind one set of postings.
HELD, POSTED = 500_000, 24_000_000
MOST = 65_535
#: Times the mean bytes of a bucket that one task takes.
EVEN = 2
_SPACE = r"\t\n\x0b\x0c\r \x85\xa0  -     　"
#: Fixed value: the pre-token pattern of byte-level vocabularies, with white space spelt out.
PRE_TOKEN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
_LOCAL = threading.local()

PACKS = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("special", pa.int64()), ("bucket", pa.int32()), *[(c, pa.binary()) for c in ("text", "lens", "holders", "docs", "counts")]])
PACKS_KIND = "row long, doc_id long, n_bytes long, special long, bucket int, text binary, lens binary, holders binary, docs binary, counts binary"


def load(tokenizer_name: str):
    """The tokenizer, read once for each worker."""
    import public_tokenizers
    from tokenizers import Tokenizer

    if getattr(_LOCAL, "name", None) != tokenizer_name:
        _LOCAL.name, _LOCAL.tokenizer = tokenizer_name, Tokenizer.from_file(public_tokenizers.path(tokenizer_name))
    return _LOCAL.tokenizer


def _frequencies(text: str, find, cut, specials: tuple[str, ...]) -> tuple[Counter, int]:
    """A text's pre-tokens and how often each stands in it, and its special strings."""
    if cut and any(s in text for s in specials):
        counts: Counter = Counter()
        for part in cut.split(text):
            counts.update(find(part))
        return counts, len(cut.findall(text))
    return Counter(find(text)), 0


def _packed(base: int, held: dict[str, list[int]], buckets: int) -> pa.RecordBatch:
    """A row for each bucket of pre-tokens: their bytes end to end and lengths, how many postings each has, and the
    postings: places of documents after ``base`` and counts up to 255 (a larger one is several postings; a pre-token of
    more than MOST postings stands there several times)."""
    packs = defaultdict(lambda: ([], [], []))
    for token, postings in held.items():
        data = token.encode()
        tokens, docs, counts = packs[zlib.crc32(data) % buckets]
        n = len(postings) // 2
        tokens += [(data, min(n - k, MOST)) for k in range(0, n, MOST)]
        docs += postings[0::2]
        counts += postings[1::2]
    rows = []
    for bucket, (tokens, docs, counts) in packs.items():
        rows.append((bucket, b"".join([t for t, _ in tokens]), np.array([len(t) for t, _ in tokens], dtype="<u4").tobytes(), np.array([n for _, n in tokens], dtype="<u2").tobytes(), np.array(docs, dtype="<u2").tobytes(), bytes(counts)))
    nothing = pa.nulls(len(rows), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array([base] * len(rows), type=pa.int64()), nothing, nothing, nothing, *[pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), list(PACKS)[4:], strict=True)]], schema=PACKS)


def _postings(batches: Iterator[pa.RecordBatch], specials: tuple[str, ...], buckets: int) -> Iterator[pa.RecordBatch]:
    """Rows of two kinds: one for each document, and packs of the pre-tokens of up to POSTED characters of documents."""
    import regex

    find, cut = regex.compile(PRE_TOKEN).findall, regex.compile("|".join(map(regex.escape, specials))) if specials else None
    row = TaskContext.get().partitionId() << 33

    def flush(docs, held):
        yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in docs], type=pa.int64()) for i in range(4)] + [pa.nulls(len(docs), f.type) for f in list(PACKS)[4:]], schema=PACKS)
        if held:
            yield _packed(docs[0][0], held, buckets)

    docs, held, size = [], defaultdict(list), 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            text = text or ""
            counts, special = _frequencies(text, find, cut, specials)
            place = len(docs)
            for token, n in counts.items():
                while n > 255:
                    held[token] += (place, 255)
                    n -= 255
                held[token] += (place, n)
            docs.append((row, doc_id, len(text.encode()), special))
            row, size = row + 1, size + len(text)
            if size > POSTED or len(docs) >= 60_000:
                yield from flush(docs, held)
                docs, held, size = [], defaultdict(list), 0
    if docs:
        yield from flush(docs, held)


def _sums(batches: Iterator[pa.RecordBatch], tokenizer_name: str) -> Iterator[pa.RecordBatch]:
    """Tokens of each document, from packs sorted by bucket: the pieces of each distinct pre-token of a bucket are
    counted once, by the merges applied to its byte letters, and joined to its postings."""
    from mudlark.llm.best_fit_packing import byte_letters

    visible, merge = byte_letters(), load(tokenizer_name).model.tokenize
    held: dict[int, np.ndarray] = {}
    bucket, known, size = None, {}, 0

    def flush():
        for base, total in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([base], type=pa.int64()), pa.array([total.astype("<u8" if total.max(initial=0) >> 32 else "<u4").tobytes()], type=pa.binary()), pa.array([len(total)], type=pa.int64())], names=["row", "sums", "n"])

    for batch in batches:
        for base, own, text, lens, holders, docs, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if own != bucket:
                bucket, known = own, {}
            pieces, at = [], 0
            for n in np.frombuffer(lens, dtype="<u4").tolist():
                token = text[at : at + n]
                at += n
                if (k := known.get(token)) is None:
                    k = known[token] = len(merge(token.decode("latin-1").translate(visible)))
                pieces.append(k)
            weight = np.repeat(np.array(pieces), np.frombuffer(holders, dtype="<u2")) * np.frombuffer(counts, dtype=np.uint8)
            got = np.bincount(np.frombuffer(docs, dtype="<u2"), weights=weight).astype(np.int64)
            if (old := held.get(base)) is None or len(old) < len(got):
                grown = np.zeros(len(got), dtype=np.int64)
                if old is not None:
                    grown[: len(old)] = old
                size += len(got) - (0 if old is None else len(old))
                held[base] = old = grown
            old[: len(got)] += got
        if size > HELD:
            yield from flush()
            held, size = {}, 0
    yield from flush()


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the same documents from different tasks (sorted by their first row) added up."""
    at, total = None, np.zeros(0, dtype=np.int64)

    def out():
        return pa.RecordBatch.from_arrays([pa.array(at + np.arange(len(total), dtype=np.int64)), pa.array(total)], names=["row", "n"])

    for batch in batches:
        for base, sums, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            own = np.frombuffer(sums, dtype="<u4" if len(sums) == 4 * n else "<u8").astype(np.int64)
            if base != at:
                if at is not None:
                    yield out()
                at, total = base, np.zeros(0, dtype=np.int64)
            if len(total) < len(own):
                total = np.concatenate([total, np.zeros(len(own) - len(total), dtype=np.int64)])
            total[: len(own)] += own
    if at is not None:
        yield out()


def spread(packs: DataFrame) -> DataFrame:
    """Packs with the ``share`` of their bucket that they belong to: a bucket of many bytes has several. The table of shares
    has a row for each bucket, so it is broadcast."""
    size = F.octet_length("text") + F.octet_length("lens") + F.octet_length("docs") + F.octet_length("counts")
    sizes = packs.groupBy("bucket").agg(F.sum(size).alias("size"))
    mean = sizes.select(F.avg("size")).scalar()
    shares = sizes.select("bucket", F.ceil(F.col("size") / (EVEN * mean)).alias("shares"))
    return packs.join(F.broadcast(shares), "bucket").withColumn("share", F.pmod(F.xxhash64("row"), F.col("shares")).cast("int"))


def token_counts(docs: DataFrame, tokenizer_name: str = "byte_bpe_50k.json", specials: tuple[str, ...] = ("<|endoftext|>",), limit: int = 1024) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row. ``specials`` are the vocabulary's special strings,
    each one token wherever it stands in a text."""
    buckets = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = materialise(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(partial(_postings, specials=specials, buckets=buckets), PACKS_KIND), "postings")
    packs = rows.where("bucket is not null").select("row", "bucket", "text", "lens", "holders", "docs", "counts")
    dealt = spread(packs).repartition("bucket", "share").sortWithinPartitions("bucket")
    sums = dealt.select("row", "bucket", "text", "lens", "holders", "docs", "counts").mapInArrow(partial(_sums, tokenizer_name=tokenizer_name), "row long, sums binary, n long")
    sums = sums.repartition("row").sortWithinPartitions("row").mapInArrow(_added, "row long, n long")
    documents = rows.where("bucket is null").select("row", "doc_id", "n_bytes", "special")
    n = F.coalesce("n", F.lit(0)) + F.col("special")
    return documents.join(sums, "row", "left").select("doc_id", "n_bytes", n.alias("n_tokens"), (n > limit).alias("over_limit"))


def op5_token_counts(spark, sf_dir: str) -> DataFrame:
    return token_counts(read_table(spark, sf_dir, "documents"))


QUERIES = {"op5_token_counts": op5_token_counts}
