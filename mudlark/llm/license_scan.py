"""License scans by diagonal voting.

Every rolling gram of GRAM words of a text is joined, by its hash and then word by word, to the places of the same gram in the
license templates. A match at word i of the text and word t of a template votes for the diagonal i - t, on which all words of
an undisturbed copy lie. Votes are grouped by text, template and diagonal; a diagonal is merged with its neighbours up
to SHIFT words away, where what follows an added or a left-out word lies. A merged span is verified: the template's
words that its matches cover (each an equal word, as the join compares words) must be COVERED of all, and the words that
name the license must be among them.

Native: DataFrame functions only. Texts are read once and never shuffled; what goes on is a row for each text, for each base
phrase and for each match. The templates are a fixed list of the library, so that they are broadcast. Rows are numbered when they are
read and written with their number, so a text's key is its row and copies of a text don't meet.

Defined results: null and empty texts, and such without a word, have no words, empty labels, null places and score 0; rows of
equal or null ids are scanned each on its own; an empty table gives no rows; further columns are not carried, whatever
their names; texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mudlark.llm.common import lower_ascii, materialise, read_table

#: Words of a gram; words that a merged diagonal may lie away; share of a template that has to be covered.
GRAM, SHIFT, COVERED = 3, 3, 0.75

#: Fixed value of the contract: a word is a maximal run of other characters than these, after lower-casing A-Z.
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Fixed values of the contract: phrases that are labels wherever they stand.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


class Template(NamedTuple):
    """A license's wording; ``named`` are words in it that must be covered ("" if the wording is long enough to tell)."""

    label: str
    text: str
    named: str = ""


#: Public wordings of license notices and grants.
TEMPLATES = (
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0", "apache license version 2"),
    Template("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", "apache org licenses"),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    Template("bsd", "Released under the BSD License", "bsd license"),
    Template("cc-by-nc", "Licensed under CC BY-NC 4.0", "cc by nc"),
    Template("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License", "attribution noncommercial 4"),
    Template("cc-by-nd", "Licensed under CC BY-ND 4.0", "cc by nd"),
    Template("cc-by-sa", "Licensed under CC BY-SA 4.0", "cc by sa"),
    Template("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", "attribution sharealike 4"),
    Template("gpl-2.0", "This work is licensed under the GNU General Public License, version 2", "general public license version 2"),
    Template("gpl-3.0", "This work is licensed under the GNU General Public License, version 3", "general public license version 3"),
    Template("gpl-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version", "gnu general public license"),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    Template("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation", "lesser general public license"),
    Template("mit", "Released under the MIT License", "mit license"),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    Template("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "mozilla public license"),
    Template("unlicense", "This is free and unencumbered software released into the public domain"),
)


def license_words(text: Column) -> Column:
    """Words of a text as an array; null texts have none."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text.cast("string"), F.lit(""))), BREAKS), "")


def template_grams(spark: SparkSession, templates: Sequence[Template] = TEMPLATES, gram: int = GRAM) -> DataFrame:
    """``gram_hash, t_words, hits``: the distinct grams of all templates, each with its places ``(template, t_pos)``; a fixed list."""
    rows = spark.createDataFrame([(i, t.text) for i, t in enumerate(templates)], "template int, text string")
    rows = rows.select("template", license_words(F.col("text")).alias("w")).select("template", "w", F.explode(F.sequence(F.lit(0), F.size("w") - gram)).alias("t_pos"))
    words = [F.get("w", F.col("t_pos") + i) for i in range(gram)]
    return rows.groupBy(F.xxhash64(*words).alias("gram_hash"), F.array(*words).alias("t_words")).agg(F.collect_list(F.struct("template", "t_pos")).alias("hits"))


def template_facts(templates: Sequence[Template] = TEMPLATES) -> list[tuple[int, str, int, list[int]]]:
    """Number, label, words and the places of the naming words of each template."""
    import re

    out = []
    for i, t in enumerate(templates):
        words, named = (re.sub(BREAKS, " ", x.lower()).split() for x in (t.text, t.named))
        at = next(j for j in range(len(words)) if words[j : j + len(named)] == named)
        out.append((i, t.label, len(words), list(range(at, at + len(named)))))
    return out


def places(docs: DataFrame, templates: Sequence[Template] = TEMPLATES, gram: int = GRAM) -> DataFrame:
    """Written rows ``row, doc_id, n_words, pos, base, hits``: for every text one with ``pos`` -1, and one for each word where a base phrase
    begins, or a gram that templates have too."""
    texts = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", license_words(F.col("text")).alias("w"))
    # one row for each word, and one before them; the words stay beside it and are not copied inside a stage
    rows = texts.select("row", "doc_id", "w", F.explode(F.sequence(F.lit(-1), F.size("w") - 1)).alias("pos"))
    at = lambda i: F.get("w", F.when(F.col("pos") >= 0, F.col("pos") + i))
    base = F.lit(None).cast("string")
    for phrase, label in BASE.items():
        same = F.lit(True)
        for i, word in enumerate(phrase.split()):
            same = same & (at(i) == word)
        base = F.when(same, label).otherwise(base)
    rows = rows.select("row", "doc_id", F.when(F.col("pos") < 0, F.size("w")).cast("long").alias("n_words"), "pos", base.alias("base"), *[at(i).alias(f"w{i}") for i in range(gram)])
    grams = F.broadcast(template_grams(docs.sparkSession, templates, gram))  # a fixed list of some hundred rows
    equal = F.xxhash64(*[f"w{i}" for i in range(gram)]) == F.col("gram_hash")
    for i in range(gram):
        equal = equal & (F.col(f"w{i}") == F.get("t_words", F.lit(i)))
    found = rows.join(grams, equal, "left").where("pos < 0 or base is not null or hits is not null")
    return materialise(found.select("row", "doc_id", "n_words", "pos", "base", "hits"), "license-places")


def spans(found: DataFrame, templates: Sequence[Template] = TEMPLATES, gram: int = GRAM) -> DataFrame:
    """Verified spans ``row, label, first_word, last_word, coverage`` from ``places``.

    A diagonal has as many places as its template has words at most, and is merged with 2 * SHIFT others at most: no array grows
    with the text."""
    facts = found.sparkSession.createDataFrame(template_facts(templates), "template int, label string, size int, named array<int>")
    # dealt by text once: grouping, window and the sums after it need no further shuffle
    votes = found.where("hits is not null").repartition("row").select("row", "pos", F.inline("hits")).withColumn("diagonal", F.col("pos") - F.col("t_pos"))
    lines = votes.groupBy("row", "template", "diagonal").agg(F.collect_set("t_pos").alias("hit"), F.min("pos").alias("first_word"), F.max("pos").alias("last_word"))
    near = Window.partitionBy("row", "template").orderBy("diagonal").rangeBetween(-SHIFT, SHIFT)
    merged = lines.select("row", "template", F.array_distinct(F.flatten(F.collect_list("hit").over(near))).alias("hit"), F.min("first_word").over(near).alias("first_word"), (F.max("last_word").over(near) + gram - 1).alias("last_word"))
    words = F.array_distinct(F.flatten(F.transform("hit", lambda t: F.sequence(t, t + gram - 1))))
    merged = merged.join(F.broadcast(facts), "template").select("row", "label", "first_word", "last_word", words.alias("covered"), "size", "named")
    merged = merged.withColumn("coverage", F.size("covered") / F.col("size"))
    return merged.where((F.col("coverage") >= COVERED) & (F.size(F.array_except("named", "covered")) == 0)).select("row", "label", "first_word", "last_word", "coverage").distinct()


def scanned(docs: DataFrame, templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """Every row of ``docs(doc_id, text)`` with its base phrases, its labels and ``score``, the greatest share of a
    template that a verified span covers."""
    found = places(docs, templates)
    head = "struct<doc_id:bigint,n_words:bigint>"
    none = {"head": head, "at": "int", "base": "string"}
    own = found.select("row", F.when(F.col("pos") < 0, F.struct(F.col("doc_id").cast("long"), "n_words")).cast(head).alias("head"), F.when(F.col("base").isNotNull(), F.col("pos")).alias("at"), "base", F.lit(None).cast("string").alias("label"), F.lit(0.0).alias("coverage"))
    more = spans(found, templates).select("row", *[F.lit(None).cast(none[c]).alias(c) for c in ("head", "at", "base")], "label", "coverage")
    both = own.unionByName(more)
    sums = both.groupBy("row").agg(
        F.max("head").alias("head"),
        F.count("at").alias("n_base"),
        F.min("at").cast("long").alias("first_word"),
        F.max("at").cast("long").alias("last_word"),
        F.collect_set("base").alias("base_set"),
        F.collect_set("label").alias("label_set"),
        F.max("coverage").alias("score"),
    )
    joined = lambda c: F.array_join(F.array_sort(c), ",")
    return sums.select("head.doc_id", "head.n_words", "n_base", "first_word", "last_word", joined("base_set").alias("base_labels"), joined(F.array_union("base_set", "label_set")).alias("labels"), "score")


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scanned(read_table(spark, sf_dir, "documents"))


def _oracle() -> str:
    """The same rows as SQL: grams are compared as words."""
    import re

    facts = ", ".join(f"({i}, '{label}', {size}, {named or '[]::integer[]'})" for i, label, size, named in template_facts())
    words = {i: re.sub(BREAKS, " ", t.text.lower()).split() for i, t in enumerate(TEMPLATES)}
    grams = ", ".join(f"({i}, {t}, {', '.join(repr(x) for x in w[t : t + GRAM])})" for i, w in words.items() for t in range(len(w) - GRAM + 1))
    base = "case " + " ".join("when " + " and ".join(f"w{i} = '{x}'" for i, x in enumerate(phrase.split())) + f" then '{label}'" for phrase, label in BASE.items()) + " end"
    return f"""with facts(template, label, size, named) as (values {facts}), grams(template, t_pos, g0, g1, g2) as (values {grams}),
 texts as (select row_number() over () as rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from documents),
 places as (select rid, w, unnest(range(len(w))) as pos from texts),
 words as (select rid, pos, w[pos + 1] as w0, w[pos + 2] as w1, w[pos + 3] as w2 from places),
 based as (select rid, pos, {base} as base from words),
 votes as (select rid, template, pos - t_pos as diagonal, pos, t_pos from words join grams on w0 = g0 and w1 = g1 and w2 = g2),
 diagonals as (select distinct rid, template, diagonal from votes),
 merged as (select distinct d.rid, d.template, d.diagonal, v.t_pos from diagonals d join votes v on v.rid = d.rid and v.template = d.template and v.diagonal between d.diagonal - {SHIFT} and d.diagonal + {SHIFT}),
 covered as (select rid, template, diagonal, list(distinct t) as c from (select rid, template, diagonal, unnest(range(t_pos, t_pos + {GRAM})) as t from merged) group by 1, 2, 3),
 verified as (select rid, label, len(c) / size as coverage from covered join facts on facts.template = covered.template where len(c) / size >= {COVERED} and len(list_filter(named, lambda x: not list_contains(c, x))) = 0),
 bases as (select rid, count(base) as n_base, min(case when base is not null then pos end) as first_word, max(case when base is not null then pos end) as last_word,
  string_agg(distinct base, ',' order by base) as base_labels from based group by 1),
 labelled as (select rid, string_agg(distinct label, ',' order by label) as labels from (select rid, label from verified union all select rid, base from based where base is not null) group by 1),
 scores as (select rid, max(coverage) as score from verified group by 1)
 select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_base, 0) as n_base, first_word, last_word, coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels, coalesce(score, 0.0) as score
 from texts left join bases on bases.rid = texts.rid left join labelled on labelled.rid = texts.rid left join scores on scores.rid = texts.rid"""


QUERIES = {"op11_license_scan": op11_license_scan}
ORACLE_SQL = {"op11_license_scan": _oracle()}
