"""Language identification by Bayesian fusion of evidence.

For each row and language the logarithms are added of: the text's likelihood under hashed byte trigrams, tempered
because neighbouring trigrams repeat each other; the probability that a page in the language declares what it
declares; and the prior of its host, smoothed towards the prior of its address suffix, and that towards the overall
one. So a suffix counts once, through the priors; of a row without host it is the prior itself. Text counts,
reliabilities and priors are grouped sums over all rows, and a row's own share is taken off them before it is judged
(but for the trigram counts, where labelled texts count themselves).

Texts go through Python once: what comes out, the row with its likelihoods, is written and read from then on.

Every label is a language, however few rows it has. The model is BUCKETS log-probabilities for each, 128 KB,
on the driver and in every worker; a task that counts holds the counts of HELD languages at a time.

Defined results: null and empty texts, and such without a letter, have language null, confidence 0 and are not
kept; a missing declaration, suffix or host is no evidence; rows with equal or null ids are judged on their own; an
empty table gives no rows; without any label nothing is kept; columns pass through whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from mudlark.llm.common import materialise, read_table
from mudlark.llm.shingles import _LOWER, byte_slices

BUCKETS = 1 << 15
HELD = 64
#: Numbers of the model looked up at once.
AT_ONCE = 4_000_000
#: Power of the text's likelihood; pseudo-counts of the trigrams, the reliabilities and the priors.
TEMPER, ALPHA, BETA, KAPPA = 0.1, 0.5, 1.0, 20.0
#: Least confidence of a language that is kept.
SURE = 0.5


def _buckets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Trigram buckets of texts with a space at either end, and where each text's begin."""
    data = _LOWER[np.frombuffer(b"".join(b" " + t + b"  " for t in texts), dtype=np.uint8)].astype(np.uint32)
    h = (data[:-2] * np.uint32(0x9E3779B1) + data[1:-1] * np.uint32(0x85EBCA6B) + data[2:] * np.uint32(0xC2B2AE35)) >> np.uint32(17)
    lens = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    inside = np.ones(len(h), dtype=bool)
    ends = np.cumsum(lens + 2)[:-1]
    inside[ends - 1] = inside[ends - 2] = False  # those that reach into the next text
    return h[inside].astype(np.int64), np.cumsum(lens) - lens


def _counted(batches: Iterator[pa.RecordBatch], languages: list[str]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    at = {x: i for i, x in enumerate(languages)}

    def summed():
        for k, n in total.items():
            bucket = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(bucket), k, dtype=np.int32)), pa.array(bucket.astype(np.int32)), pa.array(n[bucket])], names=["k", "bucket", "n"])

    for batch in batches:
        labels = batch.column(0).to_pylist()
        for begin, texts in byte_slices(batch.column(1)):
            own: dict[int, list[bytes]] = {}
            for x, t in zip(labels[begin : begin + len(texts)], texts, strict=True):
                own.setdefault(at[x], []).append(t)
            for k, some in own.items():
                if k not in total:
                    if len(total) == HELD:
                        yield from summed()
                        total.clear()
                    total[k] = np.zeros(BUCKETS, dtype=np.int64)
                total[k] += np.bincount(_buckets(some)[0], minlength=BUCKETS)
    yield from summed()


def train(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages and their trigram log-probabilities, from all rows of ``docs(text, lang)`` with a label."""
    labelled = docs.where("lang is not null").select(F.col("lang").cast("string"), F.col("text").cast("string"))
    languages = sorted(r["lang"] for r in labelled.select("lang").distinct().collect())
    counts = np.zeros((len(languages), BUCKETS))
    if languages:
        sums = labelled.mapInArrow(partial(_counted, languages=languages), "k int, bucket int, n long").groupBy("k", "bucket").agg(F.sum("n").alias("n"))
        got = sums.toPandas()  # at most BUCKETS rows for each language
        counts[got["k"].to_numpy(), got["bucket"].to_numpy()] = got["n"].to_numpy()
    p = np.log((counts + ALPHA) / (counts.sum(axis=1, keepdims=True) + ALPHA * BUCKETS))
    return languages, p.astype(np.float32)


def _summed(model: np.ndarray, h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the log-probabilities of each text's trigrams by language, a bounded number of numbers at a time."""
    out = np.empty((len(first), len(model)))
    some = max(1, AT_ONCE // max(len(h), 1))
    for k in range(0, len(model), some):
        out[:, k : k + some] = np.add.reduceat(model[k : k + some][:, h].astype(np.float64), first, axis=1).T
    return out


def _scored(batches: Iterator[pa.RecordBatch], model: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows with ``lik``, the tempered log-likelihood of each language, and ``own``, these as probabilities, in place of ``text``;
    null for texts without a letter."""
    for batch in batches:
        at = batch.schema.get_field_index("text")
        text = batch.column(at)
        letters = pc.fill_null(pc.match_substring_regex(text, r"\pL"), False).to_numpy(zero_copy_only=False)
        for begin, texts in byte_slices(text):
            h, first = _buckets(texts)
            sums = _summed(model, h, first) * TEMPER
            rows = batch.slice(begin, len(texts))
            own = np.exp(sums - sums.max(axis=1, keepdims=True))
            own /= own.sum(axis=1, keepdims=True)
            edges, none = pa.array(np.arange(len(texts) + 1, dtype=np.int32) * len(model)), pa.array(~letters[begin : begin + len(texts)])
            lists = [pa.ListArray.from_arrays(edges, pa.array(x.ravel()), mask=none) for x in (sums, own)]
            columns = [c for i, c in enumerate(rows.columns) if i != at]
            yield pa.RecordBatch.from_arrays([*columns, *lists], names=[*[n for n in batch.schema.names if n != "text"], "lik", "own"])


def _sums(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Per value of the keys, none null but the last, the rows and the expected rows of each language: one sum of vectors."""
    held = rows.where(F.col(keys[0]).isNotNull()).groupBy(*[F.col(k).alias(f"of_{name}_{k}") for k in keys])
    return held.agg(vector_to_array(Summarizer.sum(array_to_vector("own"))).alias(f"n_{name}"), F.count("*").alias(f"all_{name}"))


def _posterior(total: list[float]) -> Column:
    """Logarithms of each language's posterior, up to a constant, from ``lik`` and ``own`` and the sums by declaration, suffix and host.

    Every step is one pass over the languages: what the lambdas refer to besides their arguments are plain columns."""
    everything, own = F.array(*map(F.lit, total)), F.col("own")
    rest = lambda n: F.zip_with(n, own, lambda a, b: F.greatest(a - b, F.lit(0.0)))

    def smoothed(name: str, prior: Column) -> Column:
        """The other rows' share of a language, as if KAPPA more rows had the prior's; without such rows the prior."""
        others = F.greatest(F.col(f"all_{name}") - 1, F.lit(0)) + KAPPA
        return F.when(F.col(f"n_{name}").isNull(), prior).otherwise(F.zip_with(rest(f"n_{name}"), prior, lambda r, q: (r + KAPPA * q) / others))

    prior = F.zip_with(everything, own, lambda t, o: (t - o + 1.0) / (sum(total) - 1.0 + len(total)))
    prior = smoothed("host", smoothed("suffix", prior))
    logs = F.zip_with("lik", prior, lambda x, p: x + F.log(p))
    of = F.zip_with(everything, own, lambda t, o: t - o + 10 * BETA)
    says = F.zip_with(rest("n_declared"), of, lambda r, t: F.log((r + BETA) / t))
    return F.when(F.col("n_declared").isNull(), logs).otherwise(F.zip_with(logs, says, lambda a, b: a + b))


def identified(rows: DataFrame, languages: list[str], model: np.ndarray) -> DataFrame:
    """``rows(doc, text, declared, suffix, host)``, but for the text, with ``language``, ``confidence`` and ``kept``."""
    n = len(languages)
    if not n:
        return rows.drop("text").select("*", F.lit(None).cast("string").alias("language"), F.lit(0.0).alias("confidence"), F.lit(False).alias("kept"))
    numbers = ArrayType(DoubleType())
    kinds = StructType([*[f for f in rows.schema.fields if f.name != "text"], StructField("lik", numbers), StructField("own", numbers)])
    held = materialise(rows.mapInArrow(partial(_scored, model=model), kinds), "likelihoods")
    small = held.select("declared", "suffix", "host", "own").where("own is not null")
    overall = _sums(small.withColumn("one", F.lit(1)), ["one"], "overall").head()
    total = list(overall["n_overall"]) if overall else [0.0] * n
    declared, suffixes, hosts = (materialise(_sums(small, keys, name), "evidence") for keys, name in ((["declared"], "declared"), (["suffix"], "suffix"), (["host", "suffix"], "host")))
    out = held.join(declared, F.col("declared") == F.col("of_declared_declared"), "left").join(suffixes, F.col("suffix") == F.col("of_suffix_suffix"), "left")
    out = out.join(hosts, (F.col("host") == F.col("of_host_host")) & F.col("suffix").eqNullSafe(F.col("of_host_suffix")), "left")
    # generators keep what a step gives from being written out again in the places that use it
    step = lambda df, **columns: df.select("*", F.inline(F.array(F.struct(*[c.alias(k) for k, c in columns.items()]))))
    out = step(out, logs_=F.when(F.col("lik").isNotNull(), _posterior(total)))
    out = step(out, top_=F.array_max("logs_"))
    over = F.aggregate("logs_", F.lit(0.0), lambda z, x: z + F.exp(x - F.col("top_")))  # the greatest is 1 part of so many
    out = step(out, confidence=F.coalesce(1 / over, F.lit(0.0)), language=F.get(F.array(*map(F.lit, languages)), (F.array_position("logs_", F.col("top_")) - 1).cast("int")))
    return out.withColumn("kept", F.col("confidence") >= SURE).select(*[c for c in rows.columns if c != "text"], "language", "confidence", "kept")


def of_documents(docs: DataFrame) -> DataFrame:
    """Documents as rows of evidence: ``lang`` is what they declare, ``source`` their host; no address."""
    return docs.select(F.struct("*").alias("doc"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("declared"), F.lit(None).cast("string").alias("suffix"), F.col("source").cast("string").alias("host"))


def of_pages(pages: DataFrame) -> DataFrame:
    """Web pages as rows of evidence: the markup's language, the address's last label, its host, the visible text."""
    host = F.lower(F.regexp_extract("url", r"^[a-z]+://([^/:?#]+)", 1))
    text = F.regexp_replace(F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1>", " "), r"(?s)<[^>]*>", " ")
    declared = F.lower(F.regexp_extract("html", r"(?i)<html[^>]*\blang=[\"']?([a-z]+)", 1))
    return pages.select(F.struct("*").alias("doc"), text.alias("text"), F.nullif(declared, F.lit("")).alias("declared"), F.nullif(F.regexp_extract(host, r"\.([a-z]+)$", 1), F.lit("")).alias("suffix"), F.nullif(host, F.lit("")).alias("host"))


def accepted(docs: DataFrame) -> DataFrame:
    """The documents whose language is sure, with the input's columns."""
    return identified(of_documents(docs), *train(docs)).where("kept").select("doc.*")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    out = identified(of_documents(docs), *train(docs))
    return out.select("doc.doc_id", "declared", "language", F.round("confidence", 9).alias("confidence"), "kept")


def language_id_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages, with the text model of the documents."""
    out = identified(of_pages(read_table(spark, sf_dir, "pages")), *train(read_table(spark, sf_dir, "documents")))
    return out.select("doc.page_id", "declared", "suffix", "host", "language", F.round("confidence", 9).alias("confidence"), "kept")


QUERIES = {"op3_language_id": op3_language_id, "language_id_pages": language_id_pages}
