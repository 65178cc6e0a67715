"""A corpus pipeline of five operators: each stage's output is written as Parquet and is the next one's input.

The first four return the columns they are given, whatever their names and number; the last returns the packed pieces.

Defined results: null and empty texts have no language and go in the first stage; null ids are an id of their own; rows
of equal id and text stay together or go together in the near-duplicate stage; an empty table passes every stage
empty. No stage looks at more of a row than the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mudlark.llm import best_fit_packing, language_id, line_dedup, minhash_dedup, source_mixing
from mudlark.llm.common import materialise, read_table

#: The stages' results depend on 64-bit hashes and trained models, which SQL can't express.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is sure. Texts that are null, empty or without a letter go; a missing label or source is no
    evidence; equal rows are judged each on its own."""
    return language_id.accepted(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that stand earlier; a document of which nothing stays goes. Equal ids are separate
    documents; null ids come last; a null text stays."""
    return line_dedup.without_repeats(docs)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the first, of each group of near-duplicates; rows of equal id stay together."""
    kept = minhash_dedup.near_duplicates(docs).where("kept").select("doc_id").distinct().alias("kept")
    return docs.alias("docs").join(kept, F.col("docs.doc_id").eqNullSafe(F.col("kept.doc_id")), "left_semi")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn so that sources, languages and topics come near their target weights; a missing source or language
    is a value of its own."""
    return source_mixing.sampled(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces, packed into sequences; an empty text is one piece."""
    return best_fit_packing.pack(docs)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("minhash_near_dedup", dedup_near),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
