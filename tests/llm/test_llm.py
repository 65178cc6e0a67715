"""The text operators against brute force on small tables and odd rows."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from mudlark.llm import best_fit_packing, context_tree, fingerprints, language_id, line_dedup, minhash_dedup, quality_rules, registry, source_mixing, suffix_dedup, token_counts
from mudlark.llm.components import components

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


@pytest.fixture(scope="module")
def documents(spark):
    """A small table with the cases that real ones lack."""
    odd = [(900001, None), (900002, ""), (900003, " \n\t"), (900004, "a b"), (900005, "A B"), (900006, "a b c d e"), (900007, "a b c d e"), (900008, "é" * 300), (900009, "<|endoftext|> x<|endoftext|>"), (900010, "x y z " * 3000), (900011, "p\nq\nr\n\ns"), (900012, "o\np\nq\nr\n\ns")]
    rows = spark.createDataFrame([(i, t, "en", "src1", 0, "extra", 1) for i, t in odd], "doc_id long, text string, lang string, source string, n_chars long, row string, bucket int")
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("*", F.lit("extra").alias("row"), F.lit(1).alias("bucket"))
    return docs.unionByName(rows).cache()


@pytest.fixture(scope="module")
def texts(documents):
    return {r.doc_id: r.text or "" for r in documents.collect()}


def without_rows(documents):
    return documents.where("false")


def test_quality(documents, texts):
    def brute(t):
        w = WORD.findall(t)
        c = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        twice = {j for i in range(len(w) - 2) if c[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        return len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in t), len(lines) - len(set(lines)), len(twice)

    rows = quality_rules.ledger(documents)
    for r in rows.collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(texts[r.doc_id])
        assert bool(r.fail_bits & 1) == (r.n_words < 50)
    kept = quality_rules.applied(rows, "v1")
    one = {(r.policy, r.rule): r for r in quality_rules.ablations(rows).collect()}
    assert one["v1", "too_few_words"].n_rejected == kept.where("not kept").count()
    assert quality_rules.ledger(without_rows(documents)).count() == 0


def test_quality_sql(spark, documents):
    """The query's rows by its SQL, over a table with odd rows too."""
    import duckdb

    con = duckdb.connect()
    con.register("documents", documents.select("doc_id", "text").toArrow())
    expected = con.sql(quality_rules.ORACLE_SQL["op7_quality_rules"])
    got = quality_rules.answer(documents)
    assert got.columns == expected.columns
    assert sorted(map(tuple, got.collect())) == sorted(expected.fetchall())


def test_packing(documents, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {i: [*t.encode(x, add_special_tokens=False).ids, 0] for i, x in texts.items()}
    got = best_fit_packing.pack(documents).collect()
    places = defaultdict(list)
    for r in got:
        own = ids[r.doc_id][r.start : r.start + r.length]
        assert r.start == 2048 * r.piece and len(own) == r.length
        assert r.ids_crc32 == zlib.crc32(np.array(own, dtype="<u4").tobytes())
        places[r.sequence_id].append((r.offset, r.length))
    assert sum(r.length for r in got) == sum(map(len, ids.values()))
    for p in places.values():
        at = 0
        for offset, length in sorted(p):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(places) <= 1.02 * sum(map(len, ids.values())) / 2048 + 1
    assert best_fit_packing.pack(without_rows(documents)).count() == 0


def test_packing_covers_any_histogram():
    for h in ({2048: 3}, {1: 1}, {1500: 7, 600: 3, 500: 9, 48: 5}, {x: x % 5 + 1 for x in range(1, 2048, 7)}):
        used = Counter()
        patterns, bound = best_fit_packing.solve(h)
        assert bound <= sum(count for _, count in patterns) + 1e-6
        for pattern, count in patterns:
            assert sum(x * a for x, a in pattern.items()) <= 2048 and count > 0
            for x, a in pattern.items():
                used[x] += a * count
        assert used == h


def test_token_counts_of_a_pre_token_with_many_postings(spark, monkeypatch):
    import public_tokenizers
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_counts, "MOST", 3)
    texts_ = [" the" * 2000 + " end", "the the", None, " the"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts_)], "doc_id long, text string").coalesce(1)
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert {r.doc_id: r.n_tokens for r in token_counts.token_counts(rows).collect()} == {i: len(t.encode(x or "").ids) for i, x in enumerate(texts_)}
    held = {"a": [0, 255] * 70_000}
    got = token_counts._packed(0, held, 4).to_pylist()[0]
    monkeypatch.undo()
    wide = token_counts._packed(0, held, 4).to_pylist()[0]
    assert len(got["docs"]) == len(wide["docs"]) == 140_000 and len(wide["holders"]) == 4


def test_token_counts_of_a_bucket_with_most_postings(spark, monkeypatch):
    """Half of all postings are of one pre-token: its bucket is dealt over several tasks, sums stay."""
    import public_tokenizers
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_counts, "POSTED", 400)
    texts_ = [" the" * (1 + i % 300) + f" a{i}" for i in range(200)]
    rows = spark.createDataFrame([(i if i % 3 else None, t) for i, t in enumerate(texts_)], "doc_id long, text string").repartition(3)
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = sorted((r.doc_id or -1, r.n_tokens) for r in token_counts.token_counts(rows).collect())
    assert got == sorted((i if i % 3 else -1, len(t.encode(x).ids)) for i, x in enumerate(texts_))
    packs = spark.createDataFrame([(row, 0 if row % 2 else 1 + row % 50, bytes(100), b"", b"", b"", b"") for row in range(2000)], "row long, bucket int, text binary, lens binary, holders binary, docs binary, counts binary")
    shares = Counter((r.bucket, r.share) for r in token_counts.spread(packs).collect())
    assert len([s for s in shares if s[0] == 0]) > 5 and max(shares.values()) < 250 and sum(shares.values()) == 2000


def test_packing_comes_near_its_bound():
    """Every sequence is a pattern of the program, and their number lies by its own bound."""
    rng = np.random.default_rng(2)
    for n in (300, 4000):
        h = Counter(np.minimum(2047, 1 + rng.gamma(1.2, 500, n).astype(int)).tolist())
        patterns, bound = best_fit_packing.solve(h)
        assert bound <= sum(count for _, count in patterns) <= np.ceil(bound) * 1.001 + 1
    # two prices of which no pattern holds more than one: the bound sees it, the mean length does not
    patterns, bound = best_fit_packing.solve({1100: 50})
    assert sum(count for _, count in patterns) == 50 and bound > 49


def test_packing_ids_of_odd_parts():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    odd = ["Éa ßtraße ÀÉ.  \n\n x y don't I'll ａ İstanbul ŒUVRE #tag a--b <|endoftext|> 1234", "", None, "a", "ÿ.Ÿ é Å", "e\u0301 \u00a0x (y) \"z\" ;; .", "Ĳ ŉ ǆ ſ µ"]
    ids, ends = best_fit_packing.Ids("word_bpe_49k.json").of(pa.array(odd, type=pa.large_string()))
    assert [p.tolist() for p in np.split(ids, ends[:-1])] == [t.encode(x or "", add_special_tokens=False).ids for x in odd]


def test_token_counts(documents, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for r in token_counts.token_counts(documents).collect():
        n = len(t.encode(texts[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 1024)
    assert token_counts.token_counts(without_rows(documents)).count() == 0


def test_fingerprints(documents, texts):
    order = sorted(texts, reverse=True)
    got = {r.doc_id: r for r in fingerprints.next_compared(documents, 5).collect()}
    off = []
    for i, after in zip(order, [*order[1:], order[0]], strict=True):
        t, o, r = texts[i], texts[after], got[i]
        new = t[: len(t) - len(t) // 2] + o[: len(t) // 2]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(new.encode()).hexdigest())
        a, b = shingles(t), shingles(new)
        off.append(abs(r.near_edited - (len(a & b) / len(a | b) if a | b else 1)))
    assert len(got) == len(texts) and np.mean(off) < 0.08
    assert got[900006].fingerprint == got[900007].fingerprint != got[900004].fingerprint
    plain = {r.doc_id: r.fingerprint for r in fingerprints.fingerprints(documents).collect()}
    assert all(plain[i] == got[i].fingerprint for i in got)
    assert fingerprints.next_compared(without_rows(documents)).count() == 0


def test_fingerprints_next(spark):
    """Likeness to the next document, with null and equal ids; merged sketches; all in one range or in many."""
    base = [f"w{i}" for i in range(3000)]
    texts_ = [(9, " ".join(base)), (7, " ".join(base[:2000])), (7, " ".join(base[:2000])), (5, " ".join(base[1000:])), (None, "q r s"), (None, None), (1, "")]
    rows = spark.createDataFrame(texts_, "doc_id long, text string")
    order = [texts_[0], texts_[1], texts_[2], texts_[3], texts_[6], texts_[5], texts_[4]]
    jaccard = lambda a, b: 1.0 if a == b else len(a & b) / len(a | b)
    for parts in (1, 4):
        got = sorted(((r.doc_id or 0, r.n_chars, r.near_next, r.contained_in_next) for r in fingerprints.next_compared(rows, parts).collect()), key=lambda r: (-r[0], r[1]))
        for (doc_id, n_chars, near, part), (i, t), (_, u) in zip(got, order, [*order[1:], order[0]], strict=True):
            a, b = shingles(t), shingles(u)
            assert (doc_id, n_chars) == (i or 0, len(t or ""))
            assert abs(near - jaccard(a, b)) < 0.06
            assert part is None or not a or abs(part - len(a & b) / len(a)) < 0.06
    some = [" ".join(base[k : k + 500]) for k in range(0, 2000, 400)]
    own = [fingerprints.sketches([t.encode()])[0][1] for t in some]
    whole = fingerprints.sketches([" ".join(base[:2100]).encode()])[0][1]
    assert fingerprints.hashes_of(fingerprints.merge(own)) == fingerprints.hashes_of(whole)
    assert fingerprints.merge([fingerprints.merge(own[:2]), *own[2:]]) == fingerprints.merge(own)
    table = fingerprints.merged(spark.createDataFrame([("a", f) for f in own] + [(None, own[0]), ("b", "0::1")], "source string, fingerprint string"), "source")
    assert sorted(r.hash for r in table.where("key = 'a'").collect()) == fingerprints.hashes_of(whole)
    part = {r.key: r.contained for r in fingerprints.containments(table, table.where("key = 'a'")).collect()}
    assert part == {"a": 1.0, None: 1.0}


def near_brute(sets):
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i in sorted(sets):
        shared = Counter(j for s in sets[i] for j in holders[s])
        for j, m in shared.items():
            if 100 * m >= 75 * (len(sets[i]) + len(sets[j]) - m):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
        for s in sets[i]:
            holders[s].append(i)
    return {i: root(i) for i in sets}


def copies(first, changed, of=250):
    """Copies of an absent text of 400 words, in each of which some words are replaced by words of its own."""
    rng, base, out = np.random.default_rng(first), [f"{first}w{i}" for i in range(400)], {}
    for k in range(of):
        w = list(base)
        for at in rng.choice(80, changed, replace=False):
            w[5 * at] = f"{first}x{k}x{at}"
        out[first + k] = " ".join(w)
    return out


def test_near_duplicates(spark, documents, texts):
    """Also: groups of copies all of whose pairs are above, just below and further below the similarity."""
    base = [f"w{i}" for i in range(60)]
    near = {800000 + k: " ".join(base[:k] + [f"v{k}"] + base[k + 1 :]) for k in range(0, 60, 3)}
    near |= copies(810000, 4) | copies(820000, 9, 60) | copies(830000, 14)
    rows = documents.select("doc_id", "text").union(spark.createDataFrame(list(near.items()), "doc_id long, text string"))
    truth = {i: shingles(t) for i, t in (texts | near).items()}
    roots = near_brute(truth)
    assert roots[810249] == 810000 and all(roots[i] == i for i in [*range(820000, 820060), *range(830000, 830250)])
    got = minhash_dedup.near_duplicates(rows).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == {i: (len(truth[i]), roots[i], roots[i] == i) for i in truth}
    assert minhash_dedup.near_duplicates(without_rows(documents)).count() == 0


def test_copies_that_cannot_reach_the_similarity_meet_nobody(spark):
    sets = [(i, len(shingles(t)), i, [hash(s) for s in shingles(t)]) for i, t in copies(830000, 14).items()]
    assert minhash_dedup._joined_on_shingles(spark.createDataFrame(sets, "cid long, n int, component long, hashes array<long>"), 75).count() == 0


def test_exact_join_loses_no_link(spark):
    """Sets of all sizes over few elements, one large component: every link between components is a candidate."""
    rng = np.random.default_rng(4)
    sets, component = {}, {}
    for i in range(400):
        kind = int(rng.integers(0, 12))
        pool = np.arange(100 * kind, 100 * kind + 5 + 6 * kind)
        sets[i] = set(pool[rng.random(len(pool)) < rng.choice([0.95, 0.85, 0.6])].tolist()) or {int(pool[0])}
        component[i] = 0 if kind == 11 and i % 2 else i
    classes = spark.createDataFrame([(i, len(s), component[i], sorted(s)) for i, s in sets.items()], "cid long, n int, component long, hashes array<long>")
    got = [(r.a, r.b) for r in minhash_dedup._joined_on_shingles(classes, 75).collect()]
    truth = {(i, j) for i in sets for j in sets if i < j and component[i] != component[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])}
    assert len(got) == len(set(got)) and truth <= set(got) and len(truth) > 300
    assert all(component[i] != component[j] for i, j in got)


def test_near_duplicates_null_and_equal_ids(spark):
    one, two = " ".join(f"a{i}" for i in range(40)), " ".join(f"a{i}" for i in range(39))
    rows = [(None, one), (None, one), (7, two), (7, "other words that stand alone here today"), (9, one), (None, "p q r s t u"), (3, None)]
    got = minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0, r.kept) for r in got) == sorted([(0, 36, 7, False), (0, 36, 7, False), (7, 35, 7, True), (7, 3, 7, True), (9, 36, 7, False), (0, 2, 0, True), (3, 0, 3, True)])


def test_superminhash_estimates():
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 2**63, 900).astype(np.uint64)
    for n in (3, 30, 600):
        a, b = pool[:n], np.concatenate([pool[n // 4 : n], pool[600 : 600 + n // 4]])
        sig = minhash_dedup.superminhash(np.concatenate([a, b]), np.array([len(a), len(b)]))
        same = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs((sig[0] == sig[1]).mean() - same) < 0.17
        alone = minhash_dedup.superminhash(b, np.array([len(b)]))
        assert (alone[0] == sig[1]).all()


def test_components(spark):
    links = [(1, 2), (2, 3), (5, 6), (9, 8), (8, 7), (7, 6), (4, 4), *[(100 + i, 101 + i) for i in range(12)]]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "src long, dst long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, **{i: 5 for i in range(5, 10)}, **{100 + i: 100 for i in range(13)}}


def test_limits_are_not_silent(spark, monkeypatch):
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)], "src long, dst long")
    with pytest.raises(RuntimeError, match="after 2 rounds"):
        components(chain, most_rounds=2)
    monkeypatch.setattr(source_mixing, "ROUNDS", 1)
    cells = spark.createDataFrame([("a", "x", "t", 5), ("a", "y", "t", 90), ("b", "x", "t", 40), ("b", "y", "t", 7)], "source string, lang string, topic string, tokens long")
    aims = {d: source_mixing.tempered(cells, d, 0.3) for d in ("source", "lang")}
    with pytest.warns(RuntimeWarning, match="after 1 rounds"):
        source_mixing.raked(cells, aims)


def test_lines_against_brute_force(spark):
    """What goes stood before, in a run or as a long line; and of every run of three lines that stood before all goes."""
    rng = np.random.default_rng(8)
    long = " ".join("w" * 25)
    pool = [*"abcdefgh", long, long + " x"]
    docs = [["A", "B", "X"], ["A", "B", "C"], ["A", "B", "C"], ["X", "Y"], ["X", "Y", "Z"], ["X", "Y", "Z"]]
    docs += [[str(x) for x in rng.choice(pool, int(rng.integers(0, 9)))] for _ in range(150)]
    ids = [None if i % 40 == 39 else i // 2 if i >= 100 else i for i in range(len(docs))]
    rows = spark.createDataFrame([(i, "\n".join(d), 5) for i, d in zip(ids, docs, strict=True)], "doc_id long, text string, row int").coalesce(1)
    order = sorted(range(len(docs)), key=lambda k: (ids[k] is None, ids[k] or 0, k))
    rank = {k: n for n, k in enumerate(order)}
    kept = {}
    for r in line_dedup.line_deduplicated(rows).collect():
        kept.setdefault((r.doc.doc_id, r.doc.text), []).append(r.text)
    places = defaultdict(list)
    for k in order:
        for n in (1, 2, 3):
            for u in range(len(docs[k]) - n + 1):
                places[tuple(docs[k][u : u + n])].append((rank[k], u))
    for k, d in enumerate(docs):
        before = lambda n, u: 0 <= u <= len(d) - n and places[tuple(d[u : u + n])][0] < (rank[k], u)
        must = {u + j for u in range(len(d) - 2) if before(3, u) for j in range(3)} | {u for u in range(len(d)) if len(d[u].split()) >= 20 and before(1, u)}
        may = must | {u + j for u in range(len(d) - 1) if before(2, u) for j in range(2)}
        options = set()
        for own in kept[ids[k], "\n".join(d)]:
            stay, gone = own.split("\n") if own else [], []
            options.add(tuple(stay))
        least, most = [x for u, x in enumerate(d) if u not in may], [x for u, x in enumerate(d) if u not in must]
        within = lambda small, large: not (rest := iter(large)) or all(x in rest for x in small)
        assert any(within(least, o) and within(o, most) for o in options), (d, options)


def test_lines(documents):
    got = {r.doc.doc_id: r for r in line_dedup.line_deduplicated(documents).collect()}
    assert got[900012].text == "o\n" and got[900012].n_removed == 4
    assert got[900011].text == "p\nq\nr\n\ns" and got[900001].text is None and got[900003].text == " \n\t"
    kept = line_dedup.without_repeats(documents)
    assert kept.columns == documents.columns
    assert kept.where("length(text) <> n_chars and doc_id < 900000").count() == 0
    assert line_dedup.line_deduplicated(without_rows(documents)).count() == 0
    # a line goes only if it stands before
    seen = set()
    for i in sorted(got):
        lines = [x.strip() for x in (got[i].doc.text or "").split("\n") if x.strip()]
        left = Counter(x.strip() for x in (got[i].text or "").split("\n") if x.strip())
        gone = Counter(lines) - left
        assert all(x in seen or Counter(lines)[x] > 1 for x in gone) and sum(gone.values()) == got[i].n_removed
        seen |= set(lines)


def test_suffixes(spark, documents, texts):
    part = "".join(chr(97 + i % 7 + (i * i) % 11) for i in range(150))
    more = {800001: "ab" * 300, 800002: "x" * 99, 800003: "x" * 99, 800004: "qq" + part + "zz" + part, 800005: part[:120] + "AAA" + part[90:], 800006: part}
    rows = documents.select("doc_id", "text").union(spark.createDataFrame(list(more.items()), "doc_id long, text string"))
    got = {r.doc_id: r for r in suffix_dedup.without_repeats(rows).collect()}
    seen = set()
    for i, t in sorted((texts | more).items()):
        data = t.encode()
        hit = bytearray(len(data))
        for s in range(len(data) - 99):
            if data[s : s + 100] in seen:
                hit[s : s + 100] = b"\1" * 100
            seen.add(data[s : s + 100])
        kept = bytes(b for b, x in zip(data, hit, strict=True) if not x)
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans, got[i].kept_sha256) == (len(data), sum(hit), len(re.findall(b"\1+", bytes(hit))), hashlib.sha256(kept).hexdigest()), i
    assert suffix_dedup.without_repeats(without_rows(documents)).count() == 0


def test_repeat_groups():
    group = [(i, i, 50, left[::-1], right) for i, (left, right) in enumerate([(b"abcXY", b"PQRST"), (b"zbcXY", b"PQRSU"), (b"zzcXY", b"PQRST")])]
    found = {(left, right, tuple(sorted(m))) for left, right, m in suffix_dedup.repeats(group, 6)}
    assert (3, 5, (0, 2)) in found and (3, 4, (0, 1, 2)) in found and (4, 4, (0, 1)) in found


def test_repeat_groups_of_documents(spark, documents):
    """Every group has all occurrences of its string, and every string of 100 bytes that repeats lies in a group of as many."""
    part = "".join(chr(97 + i % 7 + (i * i) % 11) for i in range(150))
    more = [(800001, "ab" * 300), (800002, "x" * 99), (800004, "qq" + part + "zz" + part), (800005, part[:120] + "AAA" + part[30:]), (800006, part), (800007, part), (None, "new " + part[:110]), (None, None)]
    more += [(800100 + i, f"{i} {part[:125]} {i}") for i in range(30)]
    rows = documents.where("doc_id < 60").select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string"))
    first = {}
    for i, t in sorted(((r.doc_id, r.text) for r in rows.collect()), key=lambda r: (r[0] is None, r[0] or 0)):
        first.setdefault((t or "").encode(), i)
    got = defaultdict(set)
    for r in suffix_dedup.repeat_groups(rows).collect():
        assert (r.doc_id, r.start) not in got[r.repeat, r.length]
        got[r.repeat, r.length].add((r.doc_id, r.start))
    owner = {i: data for data, i in first.items() if data}
    strings = {}
    for (repeat, n), places in got.items():
        i, start = next(iter(places))
        strings[repeat] = s = owner[i][start : start + n]
        assert hashlib.md5(s).hexdigest() == repeat and n >= 100 and len(places) > 1
        assert places == {(i, k) for data, i in first.items() for k in range(len(data) - n + 1) if data[k : k + n] == s}
    windows = defaultdict(set)
    for data, i in first.items():
        for k in range(len(data) - 99):
            windows[data[k : k + 100]].add((i, k))
    covered = {(strings[repeat][k : k + 100], len(places)) for (repeat, n), places in got.items() for k in range(n - 99)}
    repeated = {(s, len(places)) for s, places in windows.items() if len(places) > 1}
    assert len(repeated) > 100 and repeated <= covered
    assert suffix_dedup.repeat_groups(without_rows(documents)).count() == 0


def test_a_hot_anchor_is_held_by_its_sides(spark):
    """Half of all occurrences have equal sides: they pass one by one, and what is marked is the same."""
    part = "".join(chr(97 + i % 7 + (i * i) % 11) for i in range(150))
    rows = [(7, i, 1, 40, part[:40].encode()[::-1], part[40:].encode()) for i in range(50)] + [(7, 100, 2, 60, b"zz", part[40:].encode()), (8, 3, 3, 0, b"", b"p" * 120), (8, 4, 4, 0, b"", b"p" * 120)]
    batches = [pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows[k : k + 20]]) for i in range(6)], names=["hash", "id", "key", "place", "left", "right"]) for k in range(0, len(rows), 20)]
    got = sorted(tuple(r.values()) for b in suffix_dedup._finally(iter(batches), 100) for r in b.to_pylist())
    assert got == sorted([(i, 1, 0, 150) for i in range(1, 50)] + [(100, 2, 60, 170), (4, 4, 0, 120)])


def tree_brute(docs, depth):
    n = defaultdict(lambda: [0, 0])

    def seq(t):
        return b"\xff" * depth + re.sub(b"[A-Z]", lambda m: m[0].lower(), (t or "").encode()) + b"\xff"

    def decisions(b):
        p = 1
        for k in range(7, -1, -1):
            yield p, b >> k & 1
            p = 2 * p + (b >> k & 1)

    for t, held_out in docs:
        s = seq(t)
        for i in range(depth, len(s)) if not held_out else ():
            for p, b in decisions(s[i]):
                for d in range(depth + 1):
                    n[d, s[i - d : i], p][b] += 1
    kids = defaultdict(list)
    for d, c, p in list(n):
        if d:
            kids[d - 1, c[1:], p].append((d, c, p))
    kt = lambda a, b: math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)
    mix = {}
    for key in sorted(n, key=lambda k: -k[0]):
        own = kt(*n[key])
        mix[key] = own if key[0] == depth else np.logaddexp(own, sum(mix[x] for x in kids[key])) - math.log(2)

    def p1(context, p, d=0):
        key = (d, context[len(context) - d :], p)
        if key not in n:
            return 0.5
        own = (n[key][1] + 0.5) / (sum(n[key]) + 1)
        if d == depth:
            return own
        w = 0.5 * math.exp(kt(*n[key]) - mix[key])
        return w * own + (1 - w) * p1(context, p, d + 1)

    out = []
    for t, _ in docs:
        s = seq(t)
        out.append(sum(math.log10(p1(s[i - depth : i], p) if b else 1 - p1(s[i - depth : i], p)) for i in range(depth, len(s)) for p, b in decisions(s[i])))
    return out


def test_context_tree(spark, documents, monkeypatch):
    """At the shipped depth, over several blocks, with rows that repeat."""
    monkeypatch.setattr(context_tree, "BLOCK", 24)
    docs = [("The cat sat on the mat. The cat.", False), ("the dog sat", True), ("", False), (None, True), ("ééé the cat\nñ", False), ("zzzz", True), ("The cat sat on the mat. The cat.", False), ("one more line", False)]
    rows = spark.createDataFrame([(i, t, h, 1) for i, (t, h) in enumerate(docs)], "doc_id long, text string, held_out boolean, block int")
    got = sorted(context_tree.scored(rows).collect())
    assert [r.score for r in got] == pytest.approx(tree_brute(docs, context_tree.DEPTH), abs=1e-4)
    counts = Counter(w for t, h in docs if not h for w in [*words(t), None])
    n, v = sum(counts.values()), len(counts)
    for r in got:
        own = [*words(docs[r.doc_id][0]), None]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(counts[w] > 0 for w in own), n)
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own))
    assert context_tree.scored(rows.where("false")).count() == 0


def test_blocks_of_rows_without_id(spark):
    """Rows without id and of one id are dealt over the blocks by their texts."""
    rows = spark.createDataFrame([(None if i % 2 else 7, f"text {i:04d}", False) for i in range(400)], "doc_id long, text string, held_out boolean")
    blocks = context_tree.dealt(rows, 8).groupBy("block").count().collect()
    assert len(blocks) == 8 and max(r["count"] for r in blocks) < 100


def test_mixing(spark, documents):
    out = source_mixing.mixed(documents, 0.5)
    cells = out.groupBy("source", "lang", "topic").agg(F.sum("n_tokens").alias("t"), F.max("p").alias("p")).toPandas().fillna("?")
    aim = {}
    for d in source_mixing.DIMENSIONS:
        s = cells.groupby(d)["t"].sum() ** source_mixing.TEMPER[d]
        aim[d] = s / s.sum() * cells["t"].sum()
    w = cells["t"].astype(float)
    for _ in range(200):
        for d in source_mixing.DIMENSIONS:
            w = w * cells[d].map(aim[d]) / w.groupby(cells[d]).transform("sum")
    ratio = (w / cells["t"]).where(cells["t"] > 0)
    lo, hi = 0.0, float(1 / ratio[ratio > 0].min())
    for _ in range(100):
        c = (lo + hi) / 2
        lo, hi = (c, hi) if (cells["t"] * np.minimum(1, c * ratio.fillna(0))).sum() < 0.5 * cells["t"].sum() else (lo, c)
    assert np.allclose(np.minimum(1, hi * ratio.fillna(9e9)), cells["p"], atol=1e-3)
    kept = source_mixing.sampled(documents)
    assert kept.columns == documents.columns and 0 < kept.count() < documents.count()
    assert source_mixing.sampled(without_rows(documents)).count() == 0
    fixed = source_mixing.mixed(documents, 0.2, {"lang": spark.createDataFrame([("en", 1.0)], "r_lang string, share double")})
    assert fixed.where("p > 0 and n_tokens > 0 and lang <> 'en'").count() == 0


def test_language(spark, documents):
    known = documents.where("doc_id < 900000")
    held_out = F.pmod(F.col("doc_id"), F.lit(5)) == 0
    model = language_id.train(known.where(~held_out))
    rows = language_id.of_documents(known.where(held_out)).withColumn("declared", F.lit(None).cast("string"))
    got = language_id.identified(rows, *model)
    assert got.where("language = doc.lang").count() >= 0.95 * got.count() and got.where("not kept").count() == 0
    odd = {r.doc.doc_id: r for r in language_id.identified(language_id.of_documents(documents), *model).collect()}
    assert len(odd) == documents.count() and not odd[900001].kept and odd[900002].language is None and not odd[900003].kept
    assert language_id.accepted(documents).columns == documents.columns
    assert language_id.accepted(without_rows(documents)).count() == 0
    page = spark.createDataFrame([(1, "http://a.example.de/x", "<html lang=de><script>the the</script><p>der und die nicht eine</p></html>"), (2, None, None)], "page_id long, url string, html string")
    one = {r.doc.page_id: r for r in language_id.identified(language_id.of_pages(page), *model).collect()}
    assert one[1].language == "de" and one[1].suffix == "de" and not one[2].kept


def fused_brute(rows, labelled):
    """Posteriors row by row: rows of (text, declared, suffix, host), labelled rows of (text, language)."""
    def buckets(text):
        data = b" " + re.sub(b"[A-Z]", lambda m: m[0].lower(), text.encode()) + b"  "
        return [((a * 0x9E3779B1 + b * 0x85EBCA6B + c * 0xC2B2AE35) % 2**32) >> 17 for a, b, c in zip(data, data[1:], data[2:])]

    names = sorted({x for _, x in labelled})
    counts = {x: Counter() for x in names}
    for text, x in labelled:
        counts[x].update(buckets(text))
    size = {x: sum(counts[x].values()) for x in names}
    log_p = lambda x, h: math.log((counts[x][h] + language_id.ALPHA) / (size[x] + language_id.ALPHA * language_id.BUCKETS))
    normal = lambda logs: [math.exp(v - max(logs)) / sum(math.exp(u - max(logs)) for u in logs) for v in logs]
    lik = [[language_id.TEMPER * sum(log_p(x, h) for h in buckets(r[0])) for x in names] if r[0] and any(map(str.isalpha, r[0])) else None for r in rows]
    own = [normal(v) if v else None for v in lik]

    def others(i, where):
        got = [own[j] for j in range(len(rows)) if j != i and own[j] and where(rows[j])]
        return [sum(v[k] for v in got) for k in range(len(names))], len(got)

    out = []
    for i, (_, declared, suffix, host) in enumerate(rows):
        if not lik[i]:
            out.append((None, 0.0))
            continue
        of, n = others(i, lambda r: True)
        prior = [(v + 1) / (n + len(names)) for v in of]
        for there, where in ((suffix, lambda r: r[2] == suffix), (host, lambda r: r[2:] == (suffix, host))):
            if there is not None:
                more, m = others(i, where)
                prior = [(v + language_id.KAPPA * q) / (m + language_id.KAPPA) for v, q in zip(more, prior)]
        says = [0.0] * len(names)
        if declared is not None:
            d, _ = others(i, lambda r: r[1] == declared)
            says = [math.log((a + language_id.BETA) / (b + 10 * language_id.BETA)) for a, b in zip(d, of)]
        post = normal([a + math.log(b) + c for a, b, c in zip(lik[i], prior, says)])
        out.append((names[post.index(max(post))], max(post)))
    return out


def test_fused_evidence(spark):
    rng = np.random.default_rng(6)
    pools = {"aa": "ka ta ma na pa", "bb": "ka ri mi ni pi", "cc": "zo to mo no po"}
    say = lambda x, n: " ".join(rng.choice(pools[x].split(), n)).capitalize()
    labelled = [(say(x, 12), x) for x in pools for _ in range(5)]
    rows = []
    for _ in range(60):
        x = str(rng.choice(list(pools)))
        rows.append((say(x, int(rng.integers(1, 4))), *(None if rng.random() < 0.3 else v for v in (x if rng.random() < 0.8 else "bb", "s" + x[0], f"h{rng.integers(0, 4)}"))))
    rows += [(None, "aa", "sa", "h1"), ("", None, None, None), ("12 34", "bb", None, "h2"), rows[0], rows[0]]
    docs = spark.createDataFrame(labelled, "text string, lang string")
    table = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "n long, text string, declared string, suffix string, host string")
    table = table.select(F.struct("n", F.lit(1).alias("own"), F.lit(2).alias("lik")).alias("doc"), "text", "declared", "suffix", "host")
    got = {r.doc.n: (r.language, r.confidence) for r in language_id.identified(table, *language_id.train(docs)).collect()}
    want = fused_brute(rows, labelled)
    assert [got[i][0] for i in range(len(rows))] == [w[0] for w in want]
    assert [got[i][1] for i in range(len(rows))] == pytest.approx([w[1] for w in want], abs=1e-4)
    none = language_id.identified(table, *language_id.train(docs.where("false"))).collect()
    assert len(none) == len(rows) and not any(r.kept or r.language for r in none)


def test_rare_languages(spark, monkeypatch):
    monkeypatch.setattr(language_id, "HELD", 2, raising=False)
    common = "the cat sat with the other animals and then went home again "
    rare = {f"q{i}": f"zu{i}x wo{i}v qy{i}k jj{i}b " * 12 for i in range(4)}
    rows = [(i, common * (1 + i % 3), "en", "a") for i in range(6000)] + [(9000 + i, t, name, "b") for i, (name, t) in enumerate(rare.items())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    languages, model = language_id.train(docs)
    assert languages == ["en", *rare]
    got = {r.doc.doc_id: r for r in language_id.identified(language_id.of_documents(docs), languages, model).where("doc.doc_id >= 9000").collect()}
    assert [(got[9000 + i].language, got[9000 + i].kept) for i in range(4)] == [(name, True) for name in rare]


def test_pipeline(spark):
    """Every stage on rows with nulls, empty texts, repeated rows and columns of clashing names; and on no rows."""
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    line = "a line that stands in several documents and is long enough to be one by itself, with more than twenty words in all of it"
    odd = [(None, line, "en", "src1"), (900001, None, "en", "src1"), (900002, "", None, None), (900003, f"{line}\n{line}", "en", None), (900004, "x " * 9000, "en", "src1"), (900003, f"{line}\n{line}", "en", None)]
    odd = spark.createDataFrame([(i, t, x, s, 0) for i, t, x, s in odd], "doc_id long, text string, lang string, source string, n_chars long")
    clashing = ["kept_id", "cid", "row", "lik", "own", "language", "kept", "component", "p", "tokens", "part", "doc", "host"]
    docs = docs.unionByName(odd).select("*", *[F.lit(i).alias(c) for i, c in enumerate(clashing)])
    none, ids = docs.where("false"), {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES:
        before, docs, none = docs, stage(spark, docs, SF), stage(spark, none, SF)
        docs = docs.cache()
        own = {r.doc_id for r in docs.select("doc_id").collect()}
        assert own and own <= ids and none.count() == 0, name
        if name != "best_fit_packing":
            assert docs.columns == before.columns and docs.where("kept_id <> 0 or host <> 12").count() == 0
            none = none.select(docs.columns)
        ids = own
    assert {"sequence_id", "offset", "piece"} <= set(docs.columns)


def test_names():
    names = registry.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
