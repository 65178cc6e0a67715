"""The packing program and its gap, calibration and draws of the mix, language posteriors for many languages."""

import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from mudlark.llm import best_fit_packing, language_id, source_mixing

#: Histograms whose volume says little of the sequences they need, with what is known of the best packing.
HARD = {
    "a long and a short": ({**{x: 30 for x in range(1030, 1300, 10)}, **{x: 30 for x in range(700, 760, 5)}}, 810),
    "triples": ({900: 300, 700: 300, 448: 300, 1148: 100}, 363),
    "alone": ({1100: 50}, 50),
    "few": ({1500: 7, 600: 3, 500: 9, 48: 5}, 9),
    "threes": ({700: 100, 690: 100, 680: 100, 1025: 37}, 153),
    "thirds": ({683: 1000, 1024: 11, 1366: 90}, 597),
}


def packed(h):
    patterns, bound = best_fit_packing.solve(h)
    used = Counter()
    for pattern, count in patterns:
        assert sum(x * a for x, a in pattern.items()) <= 2048 and count > 0
        for x, a in pattern.items():
            used[x] += a * count
    assert used == h
    return sum(count for _, count in patterns), bound


@pytest.mark.parametrize("name", HARD)
def test_program_is_solved_to_a_gap(name, monkeypatch):
    h, most = HARD[name]
    used, bound = packed(h)
    assert bound <= used + 1e-6 and used <= most
    assert used <= np.ceil(bound * 1.01)
    monkeypatch.setattr(best_fit_packing, "RATE", 0.0)
    without, loose = packed(h)
    assert without >= used and loose <= bound + 1e-6


def test_weights_have_an_effect(monkeypatch):
    with_weights = {k: packed(h) for k, (h, _) in HARD.items()}
    monkeypatch.setattr(best_fit_packing, "RATE", 0.0)
    without = {k: packed(h) for k, (h, _) in HARD.items()}
    assert without["triples"][0] > with_weights["triples"][0]
    assert without["a long and a short"][1] < 0.8 * with_weights["a long and a short"][1]


def cells(spark, rows):
    return spark.createDataFrame([(f"s{i}", "x", "t", t, float(w)) for i, (t, w) in enumerate(rows)], "source string, lang string, topic string, tokens long, weight double")


@pytest.mark.parametrize("rows, budget", [([(10**6, 1999999), (10**6, 1)], 0.3), ([(10**6, 1999999), (10**6, 1)], 0.6), ([(5, 1), (70, 30), (900, 2), (0, 3), (13, 400), (44, 44)], 0.5), ([(10, 1), (10**9, 1e-9)], 1e-6), ([(7, 7)], 1.0)])
def test_calibration_is_exact(spark, rows, budget):
    got = source_mixing.calibrated(cells(spark, rows), budget).collect()
    total = sum(t for t, _ in rows)
    assert sum(r.tokens * r.p for r in got) == pytest.approx(budget * total, rel=1e-12)
    assert all(0 <= r.p <= 1 for r in got) and all(r.p == 1 for r in got if r.tokens == 0)
    part = [r for r in got if r.tokens and r.p < 1]
    ratios = [r.p * r.tokens / r.weight for r in part]
    assert not part or max(ratios) == pytest.approx(min(ratios), rel=1e-12)


def test_calibration_beyond_what_has_weight(spark):
    got = source_mixing.calibrated(cells(spark, [(10, 0), (10, 5)]), 0.9).collect()
    assert sorted((r.weight, r.p) for r in got if r.weight) == [(5.0, 1.0)]


MIX = "doc_id long, text string, lang string, source string, n_chars long"


def test_draws_follow_their_probabilities(spark):
    docs = spark.range(12_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("a b c d "), F.col("id").cast("string")).alias("text"), F.lit("x").alias("lang"), F.when(F.col("id") % 3 == 0, "rare").otherwise("common").alias("source"), F.lit(9).cast("long").alias("n_chars"))
    out = source_mixing.mixed(docs, 0.4)
    for r in out.groupBy("source").agg(F.avg(F.col("kept").cast("double")).alias("share"), F.max("p").alias("p"), F.count("*").alias("n")).collect():
        assert abs(r.share - r.p) < 4 * (r.p * (1 - r.p) / r.n) ** 0.5 + 1e-9
    assert out.agg(F.max("distance")).head()[0] < 1e-6


def test_equal_rows_are_drawn_alike_and_topics_may_be_given(spark):
    docs = spark.createDataFrame([(i % 50, f"w {i % 50}", "x", None if i % 2 else "s", 3) for i in range(400)], MIX).withColumn("kind", F.col("doc_id") % 2)
    out = source_mixing.mixed(docs, 0.5, topic=F.col("kind"))
    assert {r.topic for r in out.select("topic").distinct().collect()} == {"0", "1"}
    assert out.groupBy("doc.doc_id", "doc.text").agg(F.count_distinct("kept").alias("n")).where("n > 1").isEmpty()


def test_targets_that_do_not_agree_are_told(spark):
    """Every source has a language of its own, and their targets differ."""
    docs = spark.createDataFrame([(i, "a b c", "l1" if i % 4 else "l2", "s1" if i % 4 else "s2", 3) for i in range(40)], MIX)
    share = lambda d, a, b: spark.createDataFrame([(f"{d[0]}1", a), (f"{d[0]}2", b)], f"r_{d} string, share double")
    out = source_mixing.mixed(docs, 0.5, {"source": share("source", 0.5, 0.5), "lang": share("lang", 0.9, 0.1)})
    assert out.head().distance == pytest.approx(0.4, abs=1e-6)


def many(spark, n, rows=600):
    rng = np.random.default_rng(n)
    texts = [" ".join("".join(rng.choice(list("abcdefghijklmnop"), 5)) for _ in range(12)) for _ in range(rows)]
    return spark.createDataFrame([(i, t, f"l{i % n}", f"s{i % 7}", 60) for i, t in enumerate(texts)], MIX)


def test_many_languages(spark):
    """200 languages take less than twice the time of 4, and confidences are probabilities."""
    took = {}
    for n in (4, 4, 200):  # the first run starts the engine
        docs = many(spark, n)
        model = language_id.train(docs)
        began = time.time()
        got = language_id.identified(language_id.of_documents(docs), *model).collect()
        took[n] = time.time() - began
        assert len(got) == 600 and all(0 < r.confidence <= 1 and r.language in model[0] for r in got)
    assert took[200] < 2 * took[4] + 1, took
