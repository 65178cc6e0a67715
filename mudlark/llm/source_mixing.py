"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells of (source, language, topic). The cells' token totals are raked in turn to the target
marginals of each of the three until all agree, or come as near as they can; the ratio of a cell's fitted to its actual tokens, times one
constant for the wanted total, is the probability with which its documents are kept (1 at most). The draw is a
hash of the document, so it is the same on every run and in every task.

Native: DataFrame functions only. All fitting is done on the table of cells with grouped sums and joins.

Defined results: null sources and languages are values of their own; null and empty texts have no tokens and are
kept if the probability of their cell (1 if it has no tokens) says so; equal rows are drawn alike; an
empty table gives no rows; further columns pass through untouched, whatever their names.
"""

from __future__ import annotations

import warnings
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mudlark.llm.common import materialise, read_table, words_of

DIMENSIONS = ("source", "lang", "topic")
#: Default targets: shares of the tokens to this power, made to sum to 1. Below 1 it lifts small values.
TEMPER = {"source": 0.6, "lang": 0.7, "topic": 0.8}
#: Share of all tokens that the mix should have.
BUDGET = 0.6
ROUNDS, CLOSE = 40, 1e-6
SEED = 7


def topic_of(text: Column) -> Column:
    """What kind of text it is, by what is written in it: fixed rules, first match."""
    text = F.coalesce(text, F.lit(""))
    return (
        F.when(text.rlike(r"(?i)licen[sc]e|copyright|rights reserved"), "legal")
        .when(text.contains(" | "), "table")
        .when(text.rlike(r"[#*$%&]{3}"), "markup")
        .when(F.length(text) < 600, "note")
        .when(F.length(text) < 6000, "article")
        .otherwise("long")
    )


def described(docs: DataFrame, topic: Column | None = None) -> DataFrame:
    """The input's row as ``doc``, with its cell and tokens (words). ``topic``: what tells it where the documents have one."""
    return docs.select(
        F.struct("*").alias("doc"),
        F.col("source").cast("string").alias("source"),
        F.col("lang").cast("string").alias("lang"),
        (topic_of(F.col("text")) if topic is None else topic.cast("string")).alias("topic"),
        F.size(words_of(F.col("text"))).cast("long").alias("n_tokens"),
    )


def _joined(left: DataFrame, right: DataFrame, keys: tuple[str, ...], how: str = "inner") -> DataFrame:
    """Join on keys of which null is a value like others; the keys are the left's."""
    on = reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"r_{k}"]) for k in keys])
    return left.join(right, on, how).drop(*[f"r_{k}" for k in keys])


def tempered(cells: DataFrame, dim: str, power: float) -> DataFrame:
    """Default target of a dimension: ``r_<dim>, share``."""
    sums = cells.groupBy(F.col(dim).alias(f"r_{dim}")).agg(F.sum("tokens").alias("t")).select(f"r_{dim}", F.pow(F.col("t").cast("double"), power).alias("p"))
    total = sums.agg(F.sum("p").alias("all")).head()["all"] or 1.0
    return sums.select(f"r_{dim}", (F.col("p") / F.lit(float(total))).alias("share"))


def raked(cells: DataFrame, targets: dict[str, DataFrame]) -> DataFrame:
    """Cells with ``weight``: their tokens fitted to the target shares. Values without a target get weight 0.

    One round scales to each dimension in turn; it ends when the largest step of a round is below CLOSE. ``distance``, the same in every
    row, is how far a share is from its target at most: 0 to rounding, but where targets are not compatible (a source of one language
    alone, say, whose targets differ). Where the steps are not small after ROUNDS, a warning says so too."""
    total = float(cells.agg(F.sum("tokens")).head()[0] or 0)
    fitted = cells.withColumn("weight", F.col("tokens").cast("double"))
    for dim, target in targets.items():
        fitted = _joined(fitted, target.withColumnRenamed("share", f"share_{dim}"), (dim,), "left").fillna(0.0, [f"share_{dim}"])
    fitted, moved = materialise(fitted, "cells"), 0.0
    for _ in range(ROUNDS):
        step = fitted.withColumn("before", F.col("weight"))
        for dim in targets:
            sums = step.groupBy(F.col(dim).alias(f"r_{dim}")).agg(F.sum("weight").alias("s"))
            step = _joined(step, sums, (dim,)).withColumn("weight", F.when(F.col("s") > 0, F.col("weight") * F.col(f"share_{dim}") * total / F.col("s")).otherwise(0.0)).drop("s")
        fitted = materialise(step, "cells")
        moved = fitted.agg(F.max(F.abs(F.col("weight") - F.col("before"))).alias("m")).head()["m"] or 0.0
        if moved <= CLOSE * max(total, 1.0):
            break
    far = 0.0
    for dim in targets:
        sums = fitted.groupBy(dim).agg(F.sum("weight").alias("s"), F.first(f"share_{dim}").alias("share"))
        far = max(far, sums.agg(F.max(F.abs(F.col("s") / F.lit(max(total, 1.0)) - F.col("share"))).alias("m")).head()["m"] or 0.0)
    if moved > CLOSE * max(total, 1.0):
        warnings.warn(f"raked: after {ROUNDS} rounds a cell still moved by {moved:.6g} tokens; a share differs by {far:.6g} from its target", RuntimeWarning, stacklevel=2)
    return fitted.select(*DIMENSIONS, "tokens", "weight", F.lit(far).alias("distance"))


def calibrated(cells: DataFrame, budget: float) -> DataFrame:
    """Cells with ``p = least(1, c * weight / tokens)``, with c such that the expected tokens are the share
    ``budget`` of all (or all that have weight).

    Expected tokens grow with c in straight pieces that get flatter as cells are used up. From 0 on, c steps to where the
    piece it is on would meet the target; a step never goes too far, and when no further cell is used up c is exact. A step
    is one sum over the cells."""
    full = F.when((F.col("tokens") > 0) & (F.col("weight") > 0), F.col("tokens") / F.col("weight"))  # the c that uses a cell up
    target = budget * float(cells.agg(F.sum("tokens")).head()[0] or 0)
    c, used = 0.0, -1
    while True:
        on = cells.agg(F.sum(F.when(full <= c, F.col("tokens"))).alias("gone"), F.sum(F.when(full > c, F.col("weight"))).alias("weight"), F.count_if(full <= c).alias("used"), F.max(full).alias("most")).head()
        if not on["weight"]:
            c = on["most"] or 0.0  # all that has weight is wanted, or more
            break
        if on["used"] <= used:
            break
        c, used = max(target - float(on["gone"] or 0), 0.0) / on["weight"], on["used"]
    p = F.when(F.col("tokens") > 0, F.when(full <= c, 1.0).otherwise(F.least(F.lit(1.0), F.lit(c) * F.col("weight") / F.col("tokens"))))
    return cells.withColumn("p", F.coalesce(p, F.lit(1.0)))


def mixed(docs: DataFrame, budget: float = BUDGET, targets: dict[str, DataFrame] | None = None, seed: int = SEED, topic: Column | None = None) -> DataFrame:
    """Every row as ``doc`` with its cell, ``n_tokens``, probability ``p``, ``distance`` of the mix from its targets and whether it is ``kept``.

    ``targets``: for any of the dimensions a DataFrame ``r_<dimension>, share``; the others are tempered."""
    rows = described(docs, topic)
    cells = materialise(rows.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("tokens")), "cells")
    aims = {d: (targets or {}).get(d) if d in (targets or {}) else tempered(cells, d, TEMPER[d]) for d in DIMENSIONS}
    known = materialise(calibrated(raked(cells, aims), budget), "cells").select(*[F.col(d).alias(f"r_{d}") for d in DIMENSIONS], "p", "distance")
    draw = F.pmod(F.xxhash64(F.lit(seed), F.col("doc.doc_id"), F.col("doc.text")), F.lit(1 << 52)) / F.lit(float(1 << 52))
    return _joined(rows, known, DIMENSIONS).withColumn("kept", draw < F.col("p"))


def sampled(docs: DataFrame, budget: float = BUDGET, targets: dict[str, DataFrame] | None = None) -> DataFrame:
    """The rows that are kept, with the input's columns."""
    return mixed(docs, budget, targets).where("kept").select("doc.*")


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixed(read_table(spark, sf_dir, "documents"))
    return out.select("doc.doc_id", "source", "lang", "topic", "n_tokens", F.round("p", 9).alias("p"), F.round("distance", 9).alias("distance"), "kept")


QUERIES = {"op6_source_mixing": op6_source_mixing}
