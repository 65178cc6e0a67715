"""Quality rules: every rule is evaluated once into a ledger of failure bits and measurements;
versioned policies are masks over the bits, so applying or ablating one never reads a text again.

Native: DataFrame functions only.

Defined results: a null text counts as an empty one (all measurements 0); rows with equal
or null ids are each judged on their own; further columns of the input are not carried, so
they can't clash; an empty table gives an empty ledger; texts of any length are judged whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mudlark.llm.common import WORD_BREAKS, words_of

#: Fixed value of the contract.
SYMBOLS = "#*$%&|<>"
#: Up to so many different repeated windows are looked up in a list; more are found by sorting. Both are exact.
FEW = 8
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_bullet_lines")


@dataclass(frozen=True)
class Rule:
    """A bit of the ledger. ``fails`` is SQL over the measurements."""

    bit: int
    name: str
    fails: str


#: Bits are never reused: a changed rule gets a new one, so that old ledgers keep their meaning.
RULES = (
    Rule(0, "too_few_words", "n_words < 50"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "symbol_heavy", "10 * n_symbols > word_chars"),
    Rule(3, "duplicate_lines", "n_dup_lines * 10 > n_lines * 3 AND n_dup_lines >= 2"),
    Rule(4, "word_length", "word_chars < 2 * n_words OR word_chars > 14 * n_words"),
    Rule(5, "shouting", "2 * n_upper > word_chars AND n_words > 0"),
    Rule(6, "bullet_lines", "10 * n_bullet_lines > 9 * n_lines AND n_lines > 0"),
    Rule(7, "symbol_per_word", "10 * n_symbols > 3 * n_words"),
    Rule(8, "no_words", "n_words = 0"),
)
BASE_RULES = ("too_few_words", "repeated_windows")


def mask_of(*names: str) -> int:
    bits = {r.name: 1 << r.bit for r in RULES}
    return sum(bits[n] for n in set(names))


#: Version -> mask of the rules that reject.
POLICIES = {
    "v1": mask_of(*BASE_RULES),
    "v2": mask_of(*BASE_RULES, "symbol_heavy", "duplicate_lines", "word_length"),
    "v3": mask_of(*(r.name for r in RULES)),
}


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text's measurements. Word and line arrays live for one row only; nothing is shuffled.

    Repeated windows: the three-word windows' 64-bit hashes are sorted inside the row; a hash equal to
    its neighbour marks its windows, and the gaps between marked places give the words covered.
    """
    out = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    out = out.withColumn("_w", words_of(F.col("_t")))
    out = out.withColumn("_n", F.size("_w")).withColumn("_h", F.transform("_w", lambda w: F.xxhash64(w)))
    n = F.greatest(F.col("_n") - 2, F.lit(0))
    out = out.withColumn(
        "_g",
        F.zip_with(
            F.zip_with(F.slice("_h", F.lit(1), n), F.slice("_h", F.lit(2), n), lambda x, y: F.xxhash64(x, y)),
            F.slice("_h", F.lit(3), n),
            lambda x, y: F.xxhash64(x, y),
        ),
    )
    out = out.withColumn("_s", F.sort_array("_g"))
    out = out.withColumn("_d", F.array_distinct(F.filter("_s", lambda x, k: (k > 0) & (x == F.get("_s", k - 1)))))
    few = F.array_remove(F.transform("_g", lambda h, i: F.when(F.array_contains("_d", h), i).otherwise(-1)), -1)
    out = out.withColumn("_m", F.when(F.size("_d") > FEW, F.sort_array(F.transform("_g", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    near = lambda k: F.get("_m", k)["h"]
    many = F.sort_array(
        F.transform(
            F.filter("_m", lambda x, k: ((k > 0) & (near(k - 1) == x["h"])) | ((k + 1 < F.size("_m")) & (near(k + 1) == x["h"]))),
            lambda x: x["i"],
        )
    )
    out = out.withColumn("_p", F.when(F.size("_d") == 0, F.array().cast("array<int>")).when(F.size("_d") <= FEW, few).otherwise(many))
    covered = F.aggregate(
        F.col("_p"),
        F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(p - a["last"], F.lit(3))).alias("n")),
        lambda a: a["n"],
    )
    lines = F.filter(F.split(F.col("_t"), "\n"), lambda x: F.trim(x, F.lit(WORD_BREAKS)) != "")
    out = out.withColumn("_l", lines)
    upper = F.length("_t") - F.length(F.regexp_replace("_t", "[A-Z]+", ""))
    plain = F.col("_t")
    for c in SYMBOLS:
        plain = F.replace(plain, F.lit(c), F.lit(""))
    measures = F.struct(
        F.col("_n").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        (F.length("_t") - F.length(plain)).cast("long").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("_l").cast("long").alias("n_lines"),
        upper.cast("long").alias("n_upper"),
        F.size(F.filter("_l", lambda x: F.ltrim(x).rlike(r"^[-*•]"))).cast("long").alias("n_bullet_lines"),
    )
    # as the output of a generator: a filter on a measurement is then not pushed down as its whole expression
    return out.select(F.col(id_col), F.inline(F.array(measures)))


def fail_bits() -> Column:
    """Failure bits of all rules, from the measurements."""
    bits = F.lit(0).cast("long")
    for r in RULES:
        bits = bits.bitwiseOR(F.when(F.expr(r.fails), F.lit(1 << r.bit)).otherwise(F.lit(0)).cast("long"))
    return bits


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, measurements and ``fail_bits``: all that policies and ablations need."""
    return measured(docs, id_col, text_col).withColumn("fail_bits", fail_bits())


def applied(rows: DataFrame, policy: str = "v3") -> DataFrame:
    """A ledger with ``kept`` under a policy version."""
    return rows.withColumn("kept", F.col("fail_bits").bitwiseAND(F.lit(POLICIES[policy]).cast("long")) == 0)


def ablations(rows: DataFrame) -> DataFrame:
    """For each policy and rule: how many rows fail the rule, how many only this rule rejects, and how many
    the policy rejects. One aggregation over the ledger's bits, with partial sums before the shuffle."""
    sums, out = [], []
    for version, mask in POLICIES.items():
        bits = F.col("fail_bits").bitwiseAND(F.lit(mask).cast("long"))
        sums.append(F.count_if(bits != 0).alias(f"{version}_all"))
        for r in RULES:
            if mask >> r.bit & 1:
                bit = F.lit(1 << r.bit).cast("long")
                sums += [F.count_if(bits.bitwiseAND(bit) != 0).alias(f"{version}_{r.bit}"), F.count_if(bits == bit).alias(f"{version}_{r.bit}_only")]
                out.append(F.struct(F.lit(version).alias("policy"), F.lit(r.name).alias("rule"), F.col(f"{version}_{r.bit}").alias("n_failed"), F.col(f"{version}_{r.bit}_only").alias("n_only"), F.col(f"{version}_all").alias("n_rejected")))
    return rows.agg(*sums).select(F.inline(F.array(*out)))


def answer(docs: DataFrame) -> DataFrame:
    """Ledger rows under the current policy, and whether the base rules fail."""
    base = F.lit(mask_of(*BASE_RULES)).cast("long")
    return applied(ledger(docs), "v3").select("doc_id", *MEASURES[:5], (F.col("fail_bits").bitwiseAND(base) != 0).alias("base_failed"), "kept", "fail_bits")


def op7_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Every document's ledger row under the current policy."""
    from mudlark.llm.common import read_table

    return answer(read_table(spark, sf_dir, "documents"))


QUERIES = {"op7_quality_rules": op7_quality_rules}

#: The same rows by another way: words and windows as rows, counted by window functions and grouping.
_WORD = r"[^\x20\x09-\x0D]"
_BITS = " + ".join(f"case when {r.fails} then {1 << r.bit} else 0 end" for r in RULES)
ORACLE_SQL = {
    "op7_quality_rules": f"""with d as (select row_number() over () as row_id, doc_id, coalesce(text, '') as t from documents),
 lists as (select *, regexp_extract_all(t, '{_WORD}+') as w, [x for x in string_split(t, chr(10)) if regexp_matches(x, '{_WORD}')] as l from d),
 words as (select row_id, unnest(w) as a, generate_subscripts(w, 1) as i from lists),
 windows as (select row_id, i, a, lead(a) over o as b, lead(a, 2) over o as c from words window o as (partition by row_id order by i)),
 found as (select row_id, i, count(*) over (partition by row_id, a, b, c) as n from windows where c is not null),
 covered as (select row_id, count(distinct i + k) as n from found, (select unnest([0, 1, 2]) as k) where found.n > 1 group by row_id),
 m as (select doc_id, cast(len(w) as bigint) as n_words, cast(length(array_to_string(w, '')) as bigint) as word_chars,
  cast(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols, cast(len(l) - len(list_distinct(l)) as bigint) as n_dup_lines,
  cast(coalesce(covered.n, 0) as bigint) as n_repeat_words, len(l) as n_lines, length(regexp_replace(t, '[^A-Z]', '', 'g')) as n_upper,
  len([x for x in l if regexp_matches(ltrim(x, ' '), '^[-*•]')]) as n_bullet_lines from lists left join covered on covered.row_id = lists.row_id),
 bits as (select *, cast({_BITS} as bigint) as fail_bits from m)
 select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed, fail_bits = 0 as kept, fail_bits from bits"""
}
