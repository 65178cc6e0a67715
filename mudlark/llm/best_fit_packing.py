"""Best-fit packing of documents into fixed-length sequences by a configuration linear program.

The pieces' lengths form a histogram of at most ``capacity`` bins: the only thing that goes to the driver,
whatever the size of the corpus. There the configuration program (how many sequences of each pattern of
lengths) is solved by multiplicative weights: every length has a weight, which falls by a factor as its demand gets
covered; the weights are the dual prices, and a bounded-knapsack dynamic program finds the pattern of greatest
price. A first pass uses each step's pattern a whole number of times, on what is left, until all is placed; its prices bound from below
what any packing needs. Where the pass is not within GAP of the bound, the weights run on over the whole demand in ever finer
steps: the patterns' averaged uses are a fractional solution and the averaged weights its dual, and steps end when their values are
within GAP. Its whole parts are taken and the rest is packed by the pass again. Every piece then finds
its sequence from its rank among the pieces of its length, so no sequence is built in one place.

Defined results: a null or empty text is one piece holding the end id alone; equal ids and equal rows are
separate pieces; an empty table gives no rows; extra columns are not carried; a text of any length is cut
into full pieces and one shorter one.
"""

from __future__ import annotations

import json
import logging
import os
import zlib
from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mudlark.llm.common import materialise, read_table

CAPACITY = 2048
#: Steps of multiplicative weights that a first pass deals the sequences over; their rate (0: weights without effect).
STEPS, RATE = 256, 0.05
#: Gap between value and bound at which the program counts as solved; phases of the weights beyond the first pass: parts of a demand that a step
#: covers, and how many times RATE they move by; steps of a phase, and every how many the knapsack is asked.
GAP, PHASES = 0.005, tuple((10 << k, 20 << k) for k in range(7))
PHASE_STEPS, LOOK = 6000, 20
#: Every so many steps all demand is priced, which gives a bound. Of patterns as full as each other one of longer pieces
#: is worth more by this power: short pieces are easier to place later.
BOUNDED, TILT = 128, 1.001
#: Lengths that a step prices, about; the steps take turns over all.
PRICED = 600
#: Bytes of text whose parts are looked up at once.
SLICE = 4_000_000
#: Parts of an unusual kind whose ids a worker remembers before it starts afresh.
REMEMBERED = 400_000
#: Signs that are a token of the pre-tokenizer when they end a part, and runs of Latin letters with at most one of them
#: behind: normalisation changes nothing but the case of these.
SIGNS = ".,!?;:|*$%&#\"()-"
RUN = r"^[A-Za-zÀ-ÖØ-öø-ÿ]+[.,!?;:|*$%&#\"()\-]?$"
_WORDS: dict[str, dict[str, bytes]] = {}
_IDS: dict[str, "Ids"] = {}


def _gathered(pool: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches of ``pool`` that begin at ``first``, one behind the other."""
    ends = np.cumsum(size)
    return pool[np.repeat(first - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)]


class Ids:
    """The ids of texts.

    The tokenizer drops white space and its merges never cross it, so the ids of a text are those of its
    space- and newline-separated parts; those of a distinct part are computed once for a slice of the texts.
    Parts of Latin letters with at most one sign behind are runs that the pre-tokenizer leaves as they are: the
    distinct ones are merged together, in lower case, and a run ends where an id ends a word. Any other part is
    encoded by itself, and remembered up to a bound.
    """

    def __init__(self, tokenizer_name: str):
        import public_tokenizers
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(tokenizer_name))
        # the same merges for runs that are already normalised, split and written in byte letters
        kind = json.loads(self.tokenizer.to_str()) | {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}}
        self.merges = Tokenizer.from_str(json.dumps(kind))
        self.known = _WORDS.setdefault(tokenizer_name, {})
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.letters = {b: x for b, x in byte_letters().items() if b != 0x20}

    def merged(self, runs: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct runs, one behind the other, and where each run's end."""
        out = [np.zeros(0, dtype="<u4")]
        for begin in range(0, len(runs), 20_000):
            some = runs.slice(begin, 20_000)
            edges = np.append(np.arange(0, len(some), 500), len(some)).astype(np.int32)
            lines = pc.binary_join(pa.ListArray.from_arrays(pa.array(edges), some.cast(pa.string())), " ").to_pylist()
            lines = [x if x.isascii() else x.encode().decode("latin-1").translate(self.letters) for x in lines]
            out += [np.asarray(x.ids, dtype="<u4") for x in self.merges.encode_batch_fast(lines, add_special_tokens=False)]
        ids = np.concatenate(out)
        return ids, np.flatnonzero(self.ends[ids]) + 1

    def others(self, words: list[str]) -> list[bytes]:
        """Ids of parts of any kind."""
        if len(self.known) + len(words) > REMEMBERED:
            self.known.clear()
        new = [w for w in words if w not in self.known]
        got = self.tokenizer.encode_batch_fast(new, add_special_tokens=False)
        self.known.update((w, np.asarray(x.ids, dtype="<u4").tobytes()) for w, x in zip(new, got, strict=True))
        return [self.known[w] for w in words]

    def of_distinct(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct parts, one behind the other, and how many each has."""
        plain = pc.match_substring_regex(words, RUN)
        low = pc.utf8_lower(words.filter(plain))
        core = pc.utf8_rtrim(low, characters=SIGNS)
        runs = core.dictionary_encode()
        ids, stop = self.merged(runs.dictionary)
        first, size = np.append(0, stop[:-1]), np.diff(stop, prepend=0)
        signs = pc.if_else(pc.equal(core, low), "", pc.utf8_slice_codeunits(low, start=-1)).dictionary_encode()
        sign_ids = [b"" if x == "" else np.asarray(self.tokenizer.encode(x, add_special_tokens=False).ids, dtype="<u4").tobytes() for x in signs.dictionary.to_pylist()]
        odd = self.others(words.filter(pc.invert(plain)).to_pylist())
        rest = np.frombuffer(b"".join([*sign_ids, *odd]), dtype="<u4")
        rest_size = np.fromiter(map(len, [*sign_ids, *odd]), dtype=np.int64, count=len(sign_ids) + len(odd)) // 4
        rest_first = len(ids) + np.cumsum(rest_size) - rest_size
        # every part is two stretches of the pool: a run and a sign, or one of another kind and nothing
        where, of_run, of_sign = plain.to_numpy(zero_copy_only=False), runs.indices.to_numpy(), signs.indices.to_numpy()
        begin, length = (np.zeros((len(words), 2), dtype=np.int64) for _ in range(2))
        begin[where, 0], length[where, 0] = first[of_run], size[of_run]
        begin[where, 1], length[where, 1] = rest_first[of_sign], rest_size[of_sign]
        begin[~where, 0], length[~where, 0] = rest_first[len(sign_ids) :], rest_size[len(sign_ids) :]
        return _gathered(np.concatenate([ids, rest]), begin.ravel(), length.ravel()), length.sum(axis=1)

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one behind the other, and where each text's end."""
        parts = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
        edges = parts.offsets.to_numpy()
        coded = parts.values.slice(edges[0], edges[-1] - edges[0]).dictionary_encode()
        pool, size = self.of_distinct(coded.dictionary)
        at, first = coded.indices.to_numpy(), np.cumsum(size) - size
        ids = _gathered(pool, first[at], size[at])
        return ids, np.append(0, np.cumsum(size[at]))[edges[1:] - edges[0]]


def ids_by(tokenizer_name: str) -> Ids:
    """The tokenizer's ``Ids``, read once for each worker and not for each of its tasks."""
    if tokenizer_name not in _IDS:
        _IDS.clear()
        _IDS[tokenizer_name] = Ids(tokenizer_name)
    return _IDS[tokenizer_name]


def byte_letters() -> dict[int, str]:
    """The visible letter that byte-level vocabularies write for each byte: a printable Latin-1 character stands
    for itself, the others follow from 256 on in order."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(256 + i) for i, b in enumerate(rest)}


PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("part", pa.int64()), ("part_rank", pa.int64())])


def _sliced(texts: pa.Array) -> list[tuple[int, int]]:
    """Ranges of texts of about SLICE bytes; a longer text stands alone."""
    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    edges, begin = [], 0
    while begin < len(size):
        before = size[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(size, before + SLICE, side="right")))
        edges.append((begin, end))
        begin = end
    return edges


def _cut(batches: Iterator[pa.RecordBatch], tokenizer_name: str, end_id: int, capacity: int) -> Iterator[pa.RecordBatch]:
    of = ids_by(tokenizer_name)
    end = np.asarray([end_id], dtype="<u4").tobytes()
    part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, dtype=np.int64)
    for batch in batches:
        rows = []
        doc_ids, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.large_string())
        for begin, stop in _sliced(texts):
            ids, ends = of.of(texts.slice(begin, stop - begin))
            data, ends = ids.tobytes(), ends.tolist()
            for doc_id, first, last in zip(doc_ids[begin:stop], [0, *ends], ends):
                buffer = data[4 * first : 4 * last] + end
                n = last - first + 1
                for piece, start in enumerate(range(0, n, capacity)):
                    length = min(capacity, n - start)
                    rows.append((doc_id, piece, start, length, zlib.crc32(buffer[4 * start : 4 * (start + length)]), part, int(seen[length])))
                    seen[length] += 1
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), PIECES, strict=True)], schema=PIECES)


def pieces_of(docs: DataFrame, tokenizer_name: str = "word_bpe_49k.json", end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of all documents; ``part_rank`` counts the pieces of a length inside a task."""
    kind = "doc_id long, piece int, start long, length long, ids_crc32 long, part long, part_rank long"
    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(partial(_cut, tokenizer_name=tokenizer_name, end_id=end_id, capacity=capacity), kind)


def best_pattern(lengths: np.ndarray, prices: np.ndarray, bound: np.ndarray, capacity: int) -> np.ndarray:
    """Bounded knapsack: how many of each length to take for the greatest price within the capacity.

    A length's bound is split into powers of two; each such item is one vector step over the capacities.
    """
    items = []
    for k in np.flatnonzero(bound).tolist():
        left, size = int(min(bound[k], capacity // lengths[k])), 1
        while left > 0:
            q = min(size, left)
            items.append((k, q, int(lengths[k]) * q, float(prices[k] * q)))
            left, size = left - q, size * 2
    best, with_it = np.zeros(capacity + 1, dtype=np.float32), np.empty(capacity + 1, dtype=np.float32)
    took = np.zeros((len(items), capacity + 1), dtype=bool)
    for i, (_, _, w, price) in enumerate(items):
        np.add(best[: capacity + 1 - w], price, out=with_it[w:])
        np.greater(with_it[w:], best[w:], out=took[i, w:])
        np.maximum(with_it[w:], best[w:], out=best[w:])
    pattern, at = np.zeros(len(lengths), dtype=np.int64), capacity
    for i in range(len(items) - 1, -1, -1):
        if took[i, at]:
            k, q, w, _ = items[i]
            pattern[k] += q
            at -= w
    return pattern


class Program(NamedTuple):
    """The configuration program's fractional solution (patterns by row, how often each) and its dual: a price of each length at which no
    pattern is worth more than 1, and what the demand is worth at it, which no packing can do with less than."""

    patterns: np.ndarray
    uses: np.ndarray
    prices: np.ndarray
    bound: float


def exhausted(lengths: np.ndarray, demand: np.ndarray, capacity: int, prices: np.ndarray, steps: int) -> tuple[list[tuple[np.ndarray, int]], float, np.ndarray]:
    """Patterns, each used a whole number of times, that cover the demand exactly; the best bound met and its prices.

    A length's price falls with its share covered, compared with the share that all have covered; the pattern worth most
    of what is left takes its share of all sequences, rounded down, or one."""
    rest, total, step, out = demand.copy(), max(float(lengths @ demand) / capacity, 1e-9), 0, []
    bound, best_prices = 0.0, prices
    while rest.any():
        gone = 1 - float(lengths @ rest) / capacity / total
        weight = prices**TILT * np.exp(-RATE * ((demand - rest) / np.maximum(demand, 1) - gone))
        if step % BOUNDED == 0:
            worth = float(weight @ best_pattern(lengths, weight, demand, capacity))
            if float(weight @ demand) > bound * worth:
                bound, best_prices = float(weight @ demand) / worth, weight / worth
        left = np.flatnonzero(rest)
        left = left[(left + step) % (len(left) // PRICED + 1) == 0] if len(left) > PRICED else left
        pattern = np.zeros_like(rest)
        pattern[left] = best_pattern(lengths[left], weight[left], rest[left], capacity)
        on = pattern > 0
        count = min(max(1, int(total / steps)), int((rest[on] // pattern[on]).min()))
        out.append((pattern, count))
        rest -= count * pattern
        step += 1
    return out, bound, best_prices


def program(lengths: np.ndarray, demand: np.ndarray, capacity: int, patterns: np.ndarray, prices: np.ndarray, bound: float, gap: float = GAP) -> Program:
    """The program solved by multiplicative weights until its value is within ``gap`` of a dual bound, or PHASES end.

    A step takes the pattern worth most and covers one part in ``parts`` of the demand that it is nearest to meeting; the weight of each
    length falls exponentially in its share covered. The uses, scaled until all is covered, are the solution; the mean of the weights is the
    dual. Phases take finer steps at higher rates, from where the last one's mean weights left off. Patterns come from a growing pool; the
    knapsack adds to it now and then, and always tells what a price proves."""
    known = {tuple(r) for r in patterns.tolist()}
    pool, share = patterns.astype(np.float64), demand.astype(np.float64)
    best, uses, at = np.inf, np.zeros(len(pool)), prices

    def look(price: np.ndarray) -> None:
        nonlocal pool, bound, prices
        pattern = best_pattern(lengths, price, demand, capacity)
        worth = float(price @ pattern)
        if float(price @ share) > bound * worth:
            bound, prices = float(price @ share) / worth, price / worth
        if tuple(pattern.tolist()) not in known:
            known.add(tuple(pattern.tolist()))
            pool = np.vstack([pool, pattern])

    look(at)
    for parts, rate in PHASES:
        x, covered, mean = np.zeros(len(pool)), np.zeros(len(share)), np.zeros(len(share))
        for step in range(1, PHASE_STEPS + 1):
            price = at * np.exp(-rate * RATE * (covered - covered.mean()))
            price /= price @ share
            mean = mean + price if step != PHASE_STEPS // 2 else price  # the way to a price is left out of its mean
            if step % LOOK == 0:
                look(price)
                if step % (5 * LOOK) == 0:
                    look(mean)
                    if covered.min() > 0 and x.sum() / covered.min() < best:
                        best, uses = x.sum() / covered.min(), x / covered.min()
                    if best <= bound * (1 + gap):
                        return Program(pool[: len(uses)].astype(np.int64), uses, prices, bound)
                x = np.append(x, np.zeros(len(pool) - len(x)))
            k = int(np.argmax(pool[: len(x)] @ price))
            on = pool[k] > 0
            amount = float((share[on] / pool[k][on]).min()) / parts
            x[k] += amount
            covered += amount * pool[k] / share
        at = mean / mean.max()
    return Program(pool[: len(uses)].astype(np.int64), uses, prices, bound)


def rounded(found: Program, lengths: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """The solution's whole parts, most used patterns first, without pieces beyond the demand; the rest is covered by ``exhausted``, at the
    dual prices or at the lengths, whichever takes fewer."""
    rest, out = demand.copy(), []
    for k in np.argsort(-found.uses, kind="stable"):
        count = int(found.uses[k] + 1e-9)
        if not count:
            break
        pattern = np.minimum(found.patterns[k], rest // count)
        if pattern.any():
            out.append((pattern, count))
            rest -= count * pattern
    some = np.flatnonzero(rest)
    ends = []
    for prices in (found.prices, lengths / capacity):
        price = np.maximum(prices[some], 1e-9)
        more = exhausted(lengths[some], rest[some], capacity, price, 1 << 30)[0] if len(some) else []
        ends.append([(np.bincount(some, p, len(lengths)).astype(np.int64), c) for p, c in more])
    return out + min(ends, key=lambda e: sum(c for _, c in e))


def solve(histogram: dict[int, int], capacity: int = CAPACITY, steps: int = STEPS) -> tuple[list[tuple[dict[int, int], int]], float]:
    """Patterns (length -> how many) with how many sequences use each, covering the histogram exactly, and the greatest
    lower bound met of the number of sequences of any packing.

    A first pass of whole steps is a solution, and mostly within GAP of its bound: then the program is solved. Where it is not,
    multiplicative weights run on, and the better of both is taken."""
    full = histogram.get(capacity, 0)
    out = [({capacity: 1}, full)] if full else []
    lengths = np.array(sorted((x for x in histogram if x < capacity), reverse=True), dtype=np.int64)
    demand = np.array([histogram[x] for x in lengths], dtype=np.int64)
    if not len(lengths):
        return out, float(full)
    # a length's share of a sequence is a feasible price of the dual program: no pattern is worth more than 1
    found, bound, prices = exhausted(lengths, demand, capacity, lengths / capacity, steps)
    if float(lengths @ demand) / capacity > bound:
        bound, prices = float(lengths @ demand) / capacity, lengths / capacity
    used = sum(c for _, c in found)
    if used > np.ceil(bound - 1e-6) and used > bound * (1 + GAP):
        better = program(lengths, demand, capacity, np.array([p for p, _ in found]), prices, bound)
        bound = better.bound
        whole = rounded(better, lengths, demand, capacity)
        found = min((found, whole), key=lambda f: sum(c for _, c in f))
    for pattern, count in found:
        on = pattern > 0
        out.append((dict(zip(lengths[on].tolist(), pattern[on].tolist(), strict=True)), count))
    return out, full + bound


def slots(patterns: list[tuple[dict[int, int], int]]) -> dict[str, np.ndarray]:
    """Where the pieces of a length go, as runs of ranks: a bounded table, some rows for each pattern."""
    rank: dict[int, int] = {}
    rows, base = [], 0
    for pattern, count in patterns:
        offset = 0
        for length, each in sorted(pattern.items(), reverse=True):
            first = rank.get(length, 0)
            rows.append((length, first, each, base, offset))
            rank[length] = first + each * count
            offset += length * each
        base += count
    rows.sort()
    names = ("length", "first", "each", "base", "offset")
    return {n: np.array([r[i] for r in rows], dtype=np.int64) for i, n in enumerate(names)}


PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def _place(batches: Iterator[pa.RecordBatch], table: dict[str, np.ndarray], capacity: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by part, and in a part those (without ``piece``) that say how many pieces of a length are in the parts before."""
    key = (table["length"] << 48) + table["first"]
    at, before = None, np.zeros(capacity + 1, dtype=np.int64)
    for batch in batches:
        part, length, rank = (batch.column(c).to_numpy() for c in ("part", "length", "part_rank"))
        head = batch.column("head").to_numpy(zero_copy_only=False)
        edges = np.flatnonzero(np.diff(part, prepend=-1)) if len(part) else []
        for a, b in zip(edges, [*edges[1:], len(part)], strict=True):
            if part[a] != at:
                at, before = part[a], np.zeros(capacity + 1, dtype=np.int64)
            own = head[a:b]
            before[length[a:b][own]] = rank[a:b][own]
            rows = batch.slice(a, b - a).filter(pa.array(~own))
            n = length[a:b][~own]
            r = rank[a:b][~own] + before[n]
            k = np.searchsorted(key, (n << 48) + r, side="right") - 1
            turn, place = np.divmod(r - table["first"][k], table["each"][k])
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([*[rows.column(c) for c in names], pa.array(table["base"][k] + turn), pa.array(table["offset"][k] + place * n)], names=[*names, "sequence_id", "offset"])


def pack(docs: DataFrame, tokenizer_name: str = "word_bpe_49k.json", end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """Every piece with its sequence and place there."""
    pieces = materialise(pieces_of(docs, tokenizer_name, end_id, capacity), "pieces")
    counts = materialise(pieces.groupBy("length", "part").count(), "piece-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("count").alias("n")).collect()}  # at most `capacity` rows
    patterns, bound = solve(histogram, capacity)
    used = sum(count for _, count in patterns)
    logging.getLogger(__name__).info("%d sequences in %d patterns; no packing has fewer than %.1f", used, len(patterns), bound)
    table = slots(patterns)
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("part", "length", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("part_rank"), F.lit(True).alias("head"))
    # a part's counts meet its pieces, and nothing of all parts is sent to every task
    both = pieces.withColumn("head", F.lit(False)).unionByName(starts, allowMissingColumns=True)
    both = both.repartition("part").sortWithinPartitions("part", F.desc("head"))
    return both.mapInArrow(partial(_place, table=table, capacity=capacity), PLACED)


def op8_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"))


QUERIES = {"op8_best_fit_packing": op8_best_fit_packing}
