"""Licence scans: parts of a text compared to licence templates by Dice coefficient.

Only DataFrame functions.  A unit (line, sentence of a line, paragraph of several lines, or
run of neighbouring paragraphs up to the whole text) and a template are bags of word
bigrams after normalising (ASCII lower case, runs of other characters than letters and
digits as one space).  Two bags of sizes a and b can reach a coefficient t only if b lies
between a*t/(2-t) and a*(2-t)/t, and only if they share t/(2-t) of b; so a text without any
of a few words that touch more than the rest of every template goes first, and the number of
words prunes the templates of a unit before any bigram is made.  Nothing is shuffled.  The
templates are literals of the plan; their number is checked.
"""

from __future__ import annotations

import re
from collections import Counter
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mcrunstat.llm.common import ascii_lower
from mcrunstat.llm.licence_texts import BODIES, NOTICES

# Usual notices and whole texts of public licences, by SPDX name.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met:"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    *NOTICES,
    *BODIES,
)
UNITS = ("line", "sentence", "paragraph", "run")
_BLANK = r"\n[\x20\t\r]*\n"
#: The end of a sentence and what follows it on the line.
_STOP = r"([.!?])[\x20\t]+([^0-9\x20\t])"


def words_of(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", text.translate({i: i + 32 for i in range(65, 91)}))


def _normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(ascii_lower(text), "[^a-z0-9]+", " "))


def _pairs(normal: Column) -> Column:
    w = F.split(normal, " ")
    n = F.size(w) - 1
    return F.zip_with(F.slice(w, F.lit(1), n), F.slice(w, F.lit(2), n), lambda a, b: F.concat(a, F.lit(" "), b))


def _overlap(grams: Column, levels: Column) -> Column:
    """Size of the common part of two bags: ``grams`` in order, and for every k from 0 the
    template's bigrams that occur more than k times."""
    # in an array of its own, so that the bag is made once and not for every bigram
    return F.element_at(F.transform(F.array(grams), lambda own: F.aggregate(F.transform(levels, lambda level, k: F.size(
        F.array_intersect(F.filter(own, lambda g, i: (i >= k) & (F.get(own, i - k) == g)), level))),
        F.lit(0), lambda a, b: a + b)), 1)


def _once(df: DataFrame) -> DataFrame:
    """``df`` behind a generator, so that a later filter is not moved below what it was made
    from and does not make costly columns once more (inside lambdas: once for every element)."""
    return df.select(F.explode_outer(F.array(F.struct(*df.columns))).alias("_row")).select("_row.*")


def _sums(numbers: Column) -> Column:
    return F.aggregate(numbers, F.array(F.lit(0)), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))


def clue_words(bags: list[Counter], share: float) -> list[str]:
    """Words without any of which a text shares less than ``share`` of the bigrams with each
    of the bags."""
    words: set[str] = set()
    for bag in sorted(bags, key=lambda b: sum(b.values())):
        most = sum(bag.values()) * share - 1e-9
        while (left := {g: c for g, c in bag.items() if not words & set(g)}) and sum(left.values()) >= most:
            times = Counter()
            for g, c in left.items():
                for w in set(g):
                    times[w] += c
            words.add(max(times, key=lambda w: (len(w) >= 6, times[w], w)))
    return sorted(words)


def clue(bags: list[Counter], share: float) -> str:
    """A pattern that finds one of the ``clue_words``, branching letter by letter, so that a
    word of the text is left at its first letter that fits none of them."""
    def branches(words: list[str]) -> str:
        out = []
        for letter, group in groupby(words, key=lambda w: w[:1]):
            rest = [w[1:] for w in group]
            if letter:
                out.append(letter + (branches(rest) if rest != [""] else ""))
        whole = "(?:" + "|".join(out) + ")" if len(out) > 1 else "".join(out)
        return f"(?:{whole})?" if "" in words else whole

    return "(?<![a-z0-9])" + branches(clue_words(bags, share)) + "(?![a-z0-9])"


def scan(docs: DataFrame, templates=TEMPLATES, threshold: float = 0.8, key: str = "doc_id",
         max_templates: int = 1000, units: tuple[str, ...] = ("line", "paragraph", "run")) -> DataFrame:
    """A row for every unit and template with a coefficient of ``threshold`` or more: ``key``,
    ``unit`` (of ``units``), ``position`` (of the line, also of a sentence's line, or of the
    first paragraph, from 0), ``license``, ``template`` (its place in the list), ``overlap``,
    ``n_bigrams``, ``dice``.

    Every run that can reach the threshold is compared; of those that reach it, a run is
    given if no run that begins with the same paragraph is better for the template, and of these
    if none that ends with the same paragraph is (of equal ones the shorter, then the later).
    Null and empty texts have no units with bigrams and give no row; templates of fewer
    than two words match nothing; a paragraph or sentence that is its line is that line, a run
    has two paragraphs or more; repeated rows are scanned each on its own; an empty table
    gives an empty result.
    """
    if not set(units) <= set(UNITS):
        raise ValueError(f"units are {UNITS}")
    bags = [(k, name, Counter(zip(w, w[1:]))) for k, (name, text) in enumerate(templates) for w in [words_of(text)]]
    bags = [b for b in bags if b[2]]
    if len(bags) > max_templates:
        raise ValueError(f"more than {max_templates} templates: scan them in blocks")
    share = threshold / (2 - threshold)
    least = min((sum(b.values()) for *_, b in bags), default=1) * share
    most = max((sum(b.values()) for *_, b in bags), default=0) / share
    known = F.array(*[F.struct(
        F.lit(k).alias("template"), F.lit(name).alias("license"), F.lit(sum(b.values())).alias("size"),
        F.split(F.lit(" ".join(clue_words([b], share))), " ").alias("clue"),
        F.transform(F.split(F.lit("|".join(",".join(" ".join(g) for g, c in b.items() if c > x) for x in range(max(b.values())))),
                            "[|]"), lambda level: F.split(level, ",")).alias("levels")) for k, name, b in bags])
    if not bags:
        known = F.lit(None).cast("array<struct<template:int,license:string,size:int,clue:array<string>,levels:array<array<string>>>>")
    text = F.coalesce(F.col("text"), F.lit(""))
    hint = clue([b for *_, b in bags], share) if bags else r"\z\A."
    able = docs.select(F.col(f"`{key}`").alias("_key"), text.alias("text")).filter(F.col("text").rlike("(?i)" + hint))

    def unit(name: str, i: Column, normal: Column) -> Column:
        return F.struct(F.lit(name).alias("unit"), i.cast("long").alias("position"), normal.alias("normal"))

    lines = F.transform(F.split("text", "\n"), lambda x, i: unit("line", i, _normal(x)))
    # a sentence is not its line where another one has words; no line is normalised once more for each of its sentences
    sentences = F.flatten(F.flatten(F.transform(F.split("text", "\n"), lambda x, i: F.transform(
        F.array(F.when(x.rlike(_STOP), F.filter(F.transform(
            F.split(F.regexp_replace(x, _STOP, "$1\n$2"), "\n"), _normal), lambda y: y != "")).otherwise(F.array())),
        lambda own: F.when(F.size(own) >= 2, F.transform(own, lambda y: unit("sentence", i, y))).otherwise(F.array())))))
    paragraphs = F.filter(F.transform(F.split("text", _BLANK), lambda x, i: unit(
        "paragraph", i, F.when(F.instr(F.btrim(x, F.lit(" \t\r\n")), "\n") > 0, _normal(x)).otherwise(""))),
        lambda u: u["normal"] != "")
    made = [c for name, c in (("line", lines), ("sentence", sentences), ("paragraph", paragraphs)) if name in units]
    n_bigrams = F.length("normal") - F.length(F.translate("normal", " ", ""))
    fits = F.filter(known, lambda t: (t["size"] >= F.col("n") * share) & (t["size"] <= F.col("n") / share)
                    & F.arrays_overlap(t["clue"], F.split("normal", " ")))
    # a bag can share no more than the different bigrams in common and the template's repeats
    near = F.element_at(F.transform(F.array(_pairs(F.col("normal"))), lambda own: F.filter(fits, lambda t: F.size(
        F.array_intersect(own, F.get(t["levels"], F.lit(0)))) + t["size"] - F.size(F.get(t["levels"], F.lit(0)))
        >= (F.col("n") + t["size"]) * (threshold / 2) - 1e-6)), 1)
    rows = (able.select("_key", F.explode_outer(F.concat(*made) if made else F.array(unit("line", F.lit(0), F.lit("")))).alias("u"))
            .select("_key", "u.*").withColumn("n", n_bigrams)
            .filter((F.col("n") >= 1) & (F.col("n") >= least) & (F.col("n") <= most) & F.col("normal").rlike(hint))
            .select("_key", "unit", "position", "normal", "n", F.explode_outer(near).alias("t"))
            .filter("t is not null"))
    if "run" in units:
        rows = rows.unionByName(_runs(able, known, threshold).withColumn("n", n_bigrams))
    scored = (_once(rows.withColumn("overlap", _overlap(F.sort_array(_pairs(F.col("normal"))), F.col("t.levels")).cast("long"))
                    .drop("normal"))
              .withColumn("dice", 2.0 * F.col("overlap") / (F.col("n") + F.col("t.size"))))
    return scored.filter(F.col("dice") >= threshold).select(
        F.col("_key").alias(key), "unit", "position", F.col("t.license").alias("license"),
        F.col("t.template").cast("long").alias("template"), "overlap", F.col("n").cast("long").alias("n_bigrams"), "dice")


def _runs(able: DataFrame, known: Column, threshold: float) -> DataFrame:
    """Runs of two or more paragraphs whose bags, with one more bigram for every border
    between them, would reach the threshold for a template."""
    share = threshold / (2 - threshold)
    parts = F.filter(F.transform(F.split("text", _BLANK), lambda x, i: F.struct(
        i.cast("long").alias("position"), _normal(x).alias("normal"))), lambda p: p["normal"] != "")
    texts = able.filter(F.col("text").rlike(_BLANK)).select("_key", parts.alias("parts")).filter(F.size("parts") >= 2)
    words = F.transform("parts", lambda p: F.size(F.split(p["normal"], " ")))
    total = F.aggregate(words, F.lit(0), lambda a, b: a + b)
    own = F.array_distinct(F.flatten(F.transform("parts", lambda p: F.split(p["normal"], " "))))
    texts = _once(texts.withColumn("words", words).withColumn("total", total).withColumn("known", own))
    pairs = texts.select("_key", "parts", "words", F.explode_outer(F.filter(known, lambda t: (
        t["size"] * share <= F.col("total")) & F.arrays_overlap(t["clue"], F.col("known")))).alias("t")).filter("t is not null")
    cases = (pairs.withColumn("own", F.transform("parts", lambda p: F.size(F.array_intersect(
                 _pairs(p["normal"]), F.get("t.levels", F.lit(0))))))
             # few texts hold enough different bigrams of a template; only these are counted in full
             .filter(F.aggregate("own", F.lit(0), lambda a, b: a + b) + F.size("parts") - 1
                     >= F.col("t.size") * share - F.col("t.size") + F.size(F.get("t.levels", F.lit(0))))
             .withColumn("bags", F.transform("parts", lambda p: _overlap(F.sort_array(_pairs(p["normal"])), F.col("t.levels")) + 1))
             .filter(F.aggregate("bags", F.lit(0), lambda a, b: a + b) >= F.col("t.size") * share)
             .withColumn("w", _sums(F.col("words"))).withColumn("o", _sums(F.col("bags")))
             .select("_key", "parts", "t", "w", "o"))
    last = F.size("parts")
    # a paragraph has a word or more, so the template's size bounds how far a run can reach
    furthest = F.floor(F.col("t.size") / share).cast("int") + 1

    def bound(i: Column, j: Column) -> Column:
        n = F.get("w", j) - F.get("w", i) - 1
        return 2.0 * F.least(F.get("o", j) - F.get("o", i) - 1, F.col("t.size")) / (n + F.col("t.size"))

    def normal(r: Column) -> Column:
        return F.concat_ws(" ", F.transform(F.slice("parts", r["begin"] + 1, r["end"] - r["begin"]), lambda p: p["normal"]))

    def best(column: str, at: str) -> Column:
        return F.filter(column, lambda r: ~F.exists(column, lambda x: (x[at] == r[at]) & (
            (x["dice"] > r["dice"]) | ((x["dice"] == r["dice"]) & ((x["end"] - x["begin"]) < (r["end"] - r["begin"]))))))

    able_runs = F.flatten(F.transform(F.sequence(F.lit(0), last - 2), lambda i: F.filter(F.transform(
        F.sequence(i + 2, F.greatest(i + 2, F.least(last, i + furthest))), lambda j: F.struct(i.alias("begin"), j.alias("end"), bound(i, j).alias("c"))),
        lambda r: r["c"] >= threshold)))
    exact = F.transform("able", lambda r: F.struct(
        r["begin"].alias("begin"), r["end"].alias("end"),
        (2.0 * _overlap(F.sort_array(_pairs(normal(r))), F.col("t.levels"))
         / (F.get("w", r["end"]) - F.get("w", r["begin"]) - 1 + F.col("t.size"))).alias("dice")))
    found = (_once(_once(cases).withColumn("able", able_runs))
             .withColumn("hits", F.filter(exact, lambda r: r["dice"] >= threshold)))
    found = _once(_once(found.drop("able")).withColumn("hits", best("hits", "begin"))).withColumn("hits", best("hits", "end"))
    return found.select("_key", "parts", "t", F.explode_outer("hits").alias("r")).filter("r is not null").select(
        "_key", F.lit("run").alias("unit"), F.get("parts.position", F.col("r.begin")).alias("position"),
        normal(F.col("r")).alias("normal"), "t")


def oracle(templates=TEMPLATES, threshold: float = 0.8) -> str:
    """DuckDB SQL of ``scan`` over ``documents``."""
    values = ", ".join("({}, '{}', '{}')".format(k, name, text.replace("'", "''")) for k, (name, text) in enumerate(templates))
    bag = r"""
        SELECT {key}, gram, count(*) AS c FROM (
            SELECT {key}, unnest([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) AS gram FROM {words}
        ) GROUP BY ALL"""
    normal = (r"string_split(trim(regexp_replace(translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
              r"'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9]+', ' ', 'g')), ' ')")
    blank, stop = r"\n[ \t\r]*\n", r"([.!?])[ \t]+([^0-9 \t])"
    share = threshold / (2 - threshold)
    return f"""
        WITH t AS (SELECT * FROM (VALUES {values}) AS v(template, license, body)),
        tw AS (SELECT template, license, {normal.format(x="body")} AS w FROM t),
        tg AS ({bag.format(key="template, license", words="tw")}),
        ts AS (SELECT template, license, sum(c) AS size FROM tg GROUP BY ALL),
        d AS (SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text FROM documents),
        l AS (SELECT id, doc_id, unnest(string_split(text, chr(10))) AS x,
                     generate_subscripts(string_split(text, chr(10)), 1) - 1 AS position FROM d),
        s AS (SELECT id, doc_id, position, x, unnest(string_split(regexp_replace(x, '{stop}', '\\1' || chr(10) || '\\2', 'g'), chr(10))) AS y
              FROM l WHERE regexp_matches(x, '{stop}')),
        p AS (SELECT id, doc_id, unnest(regexp_split_to_array(text, '{blank}')) AS x,
                     generate_subscripts(regexp_split_to_array(text, '{blank}'), 1) - 1 AS position FROM d),
        -- paragraphs with words, numbered, for the runs
        q AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY position) AS k, sum(len(w)) OVER (PARTITION BY id ORDER BY position) AS upto
              FROM (SELECT id, doc_id, position, {normal.format(x="x")} AS w FROM p) WHERE w <> ['']),
        r AS (SELECT a.id, a.doc_id, a.position, a.k AS first, b.k AS last, b.upto - a.upto + len(a.w) AS n_words
              FROM q a JOIN q b ON a.id = b.id AND a.k < b.k
              WHERE b.upto - a.upto + len(a.w) <= (SELECT max(size) / {share} + 1 FROM ts)),
        rw AS (SELECT r.id, r.doc_id, r.position, r.first, r.last, flatten(list(q.w ORDER BY q.k)) AS w
               FROM r JOIN q ON q.id = r.id AND q.k BETWEEN r.first AND r.last GROUP BY ALL),
        u AS (SELECT id, doc_id, 'line' AS unit, position, 0 AS first, 0 AS last, {normal.format(x="x")} AS w FROM l
              UNION ALL
              SELECT id, doc_id, 'sentence', position, row_number() OVER (), 0, {normal.format(x="y")} AS w FROM s
              WHERE {normal.format(x="y")} <> {normal.format(x="x")}
              UNION ALL
              SELECT id, doc_id, 'paragraph', position, 0, 0, {normal.format(x="x")} FROM p
              WHERE contains(trim(x, ' ' || chr(9) || chr(10) || chr(13)), chr(10))
              UNION ALL
              SELECT id, doc_id, 'run', position, first, last, w FROM rw),
        m AS (SELECT * FROM u WHERE len(w) > 1),
        ug AS (SELECT id, doc_id, unit, position, first, last, n, gram, count(*) AS c FROM (
                   SELECT id, doc_id, unit, position, first, last, len(w) - 1 AS n,
                          unnest([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) AS gram FROM m) GROUP BY ALL),
        o AS (SELECT id, doc_id, unit, position, first, last, n, template, license, sum(least(ug.c, tg.c)) AS overlap
              FROM ug JOIN tg USING (gram) GROUP BY ALL),
        c AS (SELECT o.*, 2.0::DOUBLE * overlap / (n + size) AS dice FROM o JOIN ts USING (template)
              WHERE 2.0::DOUBLE * overlap / (n + size) >= {threshold}),
        c1 AS (SELECT * FROM c QUALIFY unit <> 'run' OR (
                   dice = max(dice) OVER (PARTITION BY id, unit, template, first)
                   AND last = min(last) OVER (PARTITION BY id, unit, template, first, dice))),
        c2 AS (SELECT * FROM c1 QUALIFY unit <> 'run' OR (
                   dice = max(dice) OVER (PARTITION BY id, unit, template, last)
                   AND first = max(first) OVER (PARTITION BY id, unit, template, last, dice)))
        SELECT doc_id, unit, position::BIGINT AS position, license, template::BIGINT AS template,
               overlap::BIGINT AS overlap, n::BIGINT AS n_bigrams, dice
        FROM c2
    """
