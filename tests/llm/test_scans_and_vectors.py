"""License scans, whitening and vector codes: brute force, SQL, odd rows."""

import hashlib
import os
import re

import duckdb
import numpy as np
import pytest

from mudlark.llm import license_scan, vector_codes, whitening

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row long, label string, hits string"


def docs(spark, texts, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    return spark.createDataFrame([(i, t, "x", "s", 1, 5, "mine", "h") for i, t in zip(ids, texts, strict=True)], DOCS)


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def scanned(text):
    """One text by plain loops over templates, diagonals and words."""
    w = words(text)
    base = [(i, label) for i in range(len(w)) for phrase, label in license_scan.BASE.items() if w[i : i + len(phrase.split())] == phrase.split()]
    labels, score, g = {label for _, label in base}, 0.0, license_scan.GRAM
    for t in license_scan.TEMPLATES:
        tw, named = words(t.text), words(t.named)
        at = next(j for j in range(len(tw)) if tw[j : j + len(named)] == named)
        hits = [(i - j, j) for i in range(len(w) - g + 1) for j in range(len(tw) - g + 1) if w[i : i + g] == tw[j : j + g]]
        for d in {d for d, _ in hits}:
            covered = {k for e, j in hits if abs(e - d) <= license_scan.SHIFT for k in range(j, j + g)}
            if len(covered) / len(tw) >= license_scan.COVERED and covered >= set(range(at, at + len(named))):
                labels.add(t.label)
                score = max(score, len(covered) / len(tw))
    places = [i for i, _ in base]
    return (len(w), len(base), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in base})), ",".join(sorted(labels)), round(score, 9))


TEXTS = [
    "Nothing here.",
    "Released under the MIT License.",
    "Intro. RELEASED under the MIT license, and: Licensed under the Apache License, Version 2.0; Licensed under CC BY-NC 4.0",
    "Licensed under the Educational Community License, Version 2.0",
    "This work is licensed under the GNU General Public License, version 3. All rights reserved. All  rights\nreserved",
    "This work is now licensed under the GNU General Public License, version 2",
    "cc by cc by cc",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this fine software and associated documentation files, to deal in the Software without restriction, including without limitation rights to use, copy, modify, merge, publish, distribute, sublicense, and sell copies of the Software",
    "released under the released under the mit mit license",
    "Ünder the MIT Lizenz, released ünder the mit license",
    None,
    "",
    " \n\t ",
    "!?.",
    "Released under the MIT License. " * 3000,
    "the " * 70000 + "all rights reserved",
    "Released under the MIT License.",
]


def test_license_scan_by_brute_force(spark):
    got = license_scan.scanned(docs(spark, TEXTS)).collect()
    assert len(got) == len(TEXTS)
    for r in got:
        # the long repetition is known without the loops, which would take the square of its length
        expected = (15000, 0, None, None, "", "mit", 1.0) if r.doc_id == 14 else scanned(TEXTS[r.doc_id])
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, round(r.score, 9)) == expected, TEXTS[r.doc_id]
    by_id = {r.doc_id: r for r in got}
    assert by_id[1].labels == "mit" and by_id[3].labels == "" and by_id[5].labels == "gpl,gpl-2.0" and by_id[7].labels == "mit"
    assert by_id[2].labels == "apache-2.0,cc-by,cc-by-nc,mit"


def test_license_scan_of_odd_rows(spark):
    got = license_scan.scanned(docs(spark, ["all rights reserved", "x", None, "all rights reserved"], [None, 7, 7, None])).collect()
    assert sorted((str(r.doc_id), r.n_words, r.labels) for r in got) == [("7", 0, ""), ("7", 1, ""), ("None", 3, "reserved"), ("None", 3, "reserved")]
    assert license_scan.scanned(docs(spark, TEXTS).where("false")).collect() == []


def test_license_scan_sql(spark):
    rows = docs(spark, TEXTS)
    con = duckdb.connect()
    frame = rows.select("doc_id", "text").toPandas()
    con.register("documents", frame)
    expected = con.execute(license_scan.ORACLE_SQL["op11_license_scan"]).fetchall()
    assert sorted(map(str, expected)) == sorted(str(tuple(r)) for r in license_scan.scanned(rows).collect())


def test_license_spans_lie_where_the_words_are(spark):
    text = "a b c Released under the MIT License d e"
    found = license_scan.places(docs(spark, [text, "x"]))
    assert [(r.label, r.first_word, r.last_word, r.coverage) for r in license_scan.spans(found).collect()] == [("mit", 3, 7, 1.0)]


def test_license_plan_is_native_and_shuffles_no_text(spark):
    plan = license_scan.places(docs(spark, ["x"]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def vectors(spark, matrix, ids=None, labels=None):
    rows = [(int(i), None if v is None else [None if x is None else float(x) for x in v], lab, "mine", 3) for i, v, lab in zip(range(len(matrix)) if ids is None else ids, matrix, labels or [None] * len(matrix), strict=True)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, x string, n int").repartition(3)


def reference_whitening(matrix):
    x = np.floor(64 * np.asarray(matrix, dtype=np.float32).astype(np.float64)) + 1_000_000
    c = x - x.mean(axis=0)
    e, v = np.linalg.eigh(c.T @ c / len(c))
    return c, e[::-1], v[:, ::-1].T


@pytest.mark.parametrize("d, n", [(6, 50), (40, 300)])
def test_whitening_against_a_dense_solver(spark, d, n):
    rng = np.random.default_rng(d)
    matrix = rng.normal(size=(n, d)) @ np.diag(np.linspace(1, 4, d)) + 2
    got = whitening.whitened(vectors(spark, matrix)).collect()
    c, e, v = reference_whitening(matrix)
    k = min(d, 32)
    assert len(got) == n * k and len({(r.vec_id, r.component) for r in got}) == n * k
    w = np.zeros((n, k))
    for r in got:
        w[r.vec_id, r.component - 1] = r.whitened
    expected = c @ v[:k].T / np.sqrt(e[:k])
    signs = np.sign((w * expected).sum(axis=0))
    assert np.abs(w * signs - expected).max() < 1e-9
    x = (np.floor(64 * matrix.astype(np.float32).astype(np.float64)) + 1_000_000).astype(int)
    deviation = ((n * x - x.sum(axis=0)) ** 2).sum(axis=1)
    assert all(r.deviation == deviation[r.vec_id] and r.n == n for r in got)
    assert all(abs(r.explained - e[r.component - 1] / e.sum()) < 1e-12 for r in got)
    error = np.abs(np.cov(w.T, bias=True) - np.eye(k)).max()
    assert len({r.identity_error for r in got}) == 1 and abs(got[0].identity_error - error) < 1e-9 and got[0].identity_error < 1e-9


def test_whitening_of_few_directions_and_equal_values(spark):
    """Rank 2 in 8 dimensions; the covariance of four axes has one eigenvalue four times."""
    rng = np.random.default_rng(1)
    flat = np.floor(rng.normal(size=(60, 2)) * 64) / 64 @ np.array([[1, 2, 0, 1, 0, 0, 1, 3], [0, 1, 1, 0, 2, 0, 0, 1]])
    got = whitening.whitened(vectors(spark, flat)).collect()
    assert {r.component for r in got} == {1, 2} and got[0].identity_error < 1e-9
    axes = np.vstack([np.eye(4), -np.eye(4)])
    got = whitening.whitened(vectors(spark, axes)).collect()
    assert {r.component for r in got} == {1, 2, 3, 4} and got[0].identity_error < 1e-9 and all(abs(r.explained - 0.25) < 1e-12 for r in got)


def test_whitening_of_odd_rows(spark):
    bad = [None, [1.0, None], [float("nan"), 1.0], [float("inf"), 0.0]]
    good = [[0.5, 1.0], [0.25, -1.0], [0.5, 1.0], [-1.0, 0.0]]
    got = whitening.whitened(vectors(spark, bad + good, ids=[1, 2, 3, 4, 9, 9, 9, 5])).collect()
    assert len(got) == 8 and {r.vec_id for r in got} == {5, 9} and {r.n for r in got} == {4} and got[0].identity_error < 1e-9
    assert whitening.whitened(vectors(spark, bad)).collect() == []
    assert whitening.whitened(vectors(spark, [[1.0, 2.0]] * 5)).collect() == []
    assert whitening.whitened(vectors(spark, [[], []])).collect() == []
    with pytest.raises(ValueError, match="entries"):
        whitening.whitened(vectors(spark, [[1.0], [1.0, 2.0]])).collect()


def test_whitening_gives_an_error_where_a_deviation_overflows(spark):
    with pytest.raises(Exception, match="greater than a 64-bit"):
        whitening.whitened(vectors(spark, [[3e7], [-3e7]] * 2)).collect()


def test_nearest_entry_by_brute_force():
    rng = np.random.default_rng(0)
    for m, spread in ((1, 5), (3, 4), (4, 200)):
        parts, entries = rng.integers(-spread, spread, size=(500, m)), rng.integers(-spread, spread, size=(64, m))
        index, best, seen = vector_codes.nearest(parts, entries)
        distance = ((parts[:, None] - entries[None]) ** 2).sum(axis=2)
        assert (index == distance.argmin(axis=1)).all() and (best == distance.min(axis=1)).all()
        assert seen < distance.size  # the search ends before all are met


def reference_codes(x):
    """Codes, errors and codebooks of integer vectors (n, d) in order of their ids."""
    parts = x.reshape(len(x), 16, -1)
    books = [parts[:64, p].copy() for p in range(16)]
    assign = lambda: [((parts[:, p][:, None] - books[p][None]) ** 2).sum(axis=2) for p in range(16)]
    for _ in range(2):
        for p, distance in enumerate(assign()):
            code = distance.argmin(axis=1)
            for k in set(code.tolist()):
                some = parts[code == k, p]
                books[p][k] = some.sum(axis=0) // len(some)
    distance = assign()
    codes = ["".join(f"{d[i].argmin():02x}" for d in distance) for i in range(len(x))]
    error = [int(sum(d[i].min() for d in distance)) for i in range(len(x))]
    return codes, error, hashlib.sha256(",".join(str(v) for b in books for v in b.ravel()).encode()).hexdigest()


@pytest.mark.parametrize("n", [5, 400])
def test_vector_codes_by_brute_force(spark, n):
    rng = np.random.default_rng(n)
    matrix = np.round(rng.normal(size=(n, 32)), 1 if n > 5 else 3).astype(np.float32)
    labels = [None if i % 5 == 0 else 1 if i % 5 < 4 else i for i in range(n)]
    codes, error, sha = reference_codes(np.floor(256 * matrix.astype(np.float64)).astype(int))
    got = vector_codes.compressed(vectors(spark, matrix, labels=labels)).collect()
    assert sorted((r.vec_id, r.code, r.error) for r in got) == list(zip(range(n), codes, error, strict=True))
    assert {r.codebooks_sha256 for r in got} == {sha}
    assert all(r.label_error == sum(e for e, lab in zip(error, labels, strict=True) if lab == labels[r.vec_id]) for r in got)


def test_vector_codes_sql_and_odd_rows(spark):
    rng = np.random.default_rng(3)
    matrix = [*np.round(rng.normal(size=(150, 16)), 1).tolist(), None, [None] + [0.0] * 15, [float("nan")] + [0.0] * 15, [float("-inf")] * 16]
    rows = vectors(spark, matrix, labels=[i % 3 or None for i in range(154)])
    con = duckdb.connect()
    con.register("embeddings", rows.select("vec_id", "embedding", "label").toArrow())
    expected = con.execute(vector_codes.ORACLE_SQL["op13_vector_codes"]).fetchall()
    got = vector_codes.compressed(rows).collect()
    assert sorted(map(str, expected)) == sorted(str(tuple(r)) for r in got) and len(got) == 150
    twice = vector_codes.compressed(vectors(spark, [[0.5] * 16, [0.5] * 16, [-1.0] * 16], ids=[4, 4, 1], labels=[1, 1, 1])).collect()
    assert sorted((r.vec_id, r.code, r.error, r.label_error) for r in twice) == [(1, "00" * 16, 0, 0), (4, "01" * 16, 0, 0), (4, "01" * 16, 0, 0)]
    assert vector_codes.compressed(rows.where("false")).collect() == []
    for bad in ([[1.0] * 15], [[1.0] * 16, [1.0] * 32]):
        with pytest.raises(ValueError, match="components"):
            vector_codes.compressed(vectors(spark, bad))


def test_codes_are_decoded_to_their_entries(spark):
    matrix = np.round(np.random.default_rng(5).normal(size=(100, 16)), 1)
    rows = vector_codes.materialise(vector_codes.whole_vectors(vectors(spark, matrix)), "vectors")
    books = vector_codes.codebooks(rows)
    codes = vector_codes.compressed(vectors(spark, matrix))
    back = {r.vec_id: np.array(r.x) for r in vector_codes.decoded(codes, books).collect()}
    own = {r.vec_id: np.array(r.x) for r in rows.collect()}
    assert all(((back[r.vec_id] - own[r.vec_id]) ** 2).sum() == r.error for r in codes.collect())


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no tables")
def test_queries_over_whole_tables(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    for module in (license_scan, vector_codes):
        for name, query in module.QUERIES.items():
            expected = con.execute(module.ORACLE_SQL[name]).fetchall()
            assert sorted(map(str, expected)) == sorted(str(tuple(r)) for r in query(spark, sf).collect())
    n = con.execute("select count(*) from embeddings").fetchall()[0][0]
    assert whitening.op12_embedding_whitening(spark, sf).count() == 32 * n
