"""Licence notices in documents, found by the Dice coefficient over word bigrams.

A text is normalised to lower-case words. Its segments - each line, each block of several lines between lines
without words, and the text if it has several blocks - are compared, as bags of word bigrams, with the notices of
known licences. A Dice coefficient of t needs sizes within a factor of t / (2 - t) of each other, so each template
has the bigram counts it can match written out, and segments meet templates in an equal join on their count: a
segment of another size meets none. Everything is built-in functions.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

THRESHOLD = 0.8
# Templates up to this many bytes, written out per count, are sent to every task; more are joined by a shuffle.
MOST_SENT_BYTES = 32 << 20

# Short notices as licensors word them.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "BSD-3-Clause": [
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Licensed under the BSD 3-Clause License.",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC0-1.0": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring "
        "rights to this work.",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation; either version 2 of the License, "
        "or (at your option) any later version.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, "
        "or (at your option) any later version.",
    ],
    "LGPL-3.0": ["This library is licensed under the GNU Lesser General Public License, version 3."],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
        "MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "all-rights-reserved": ["All rights reserved."],
}


# All of ASCII but letters, digits and the end of a line.
MARKS = "[\\x00-\\x09\\x0b-/:-@\\[-`{-\\x7f]+"


def clean(text: Column) -> Column:
    """Lower-case words (ASCII letters, digits, whatever is beyond ASCII) with single spaces; lines stay."""
    return F.regexp_replace(F.lower(text), MARKS, " ")


def on_one_line(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, "[ \n]+", " "))


def count(text: Column, *of: str) -> Column:
    rest = text
    for char in of:
        rest = F.replace(rest, F.lit(char), F.lit(""))
    return F.length(text) - F.length(rest)


def pairs_of(line: Column) -> Column:
    """Adjacent word pairs, in order."""
    words = F.split(line, " ")
    return F.transform(
        F.slice(words, 1, F.size(words) - 1), lambda w, i: F.concat_ws(" ", w, F.get(words, i + 1))
    )


def numbered(pairs: Column) -> Column:
    """A bag of pairs as a set: each repeat carries its number."""
    return F.transform(
        pairs,
        lambda pair, i: F.concat_ws(
            " ", pair, F.size(F.filter(F.slice(pairs, 1, i), lambda earlier: earlier == pair))
        ),
    )


def template_frame(spark: SparkSession, templates: dict[str, list[str]] = TEMPLATES) -> DataFrame:
    rows = [(name, text) for name, texts in templates.items() for text in texts]
    return spark.createDataFrame(rows, "license string, template string")


def matchable(templates: DataFrame, threshold: float) -> DataFrame:
    """Each template once per bigram count `n` that a matching segment can have."""
    line = on_one_line(clean(F.col("template")))
    sized = templates.select("license", line.alias("line")).withColumn("m", count(F.col("line"), " "))
    wanted = sized.filter("m > 0").select(
        "license", "m", pairs_of(F.col("line")).alias("pairs"), numbered(pairs_of(F.col("line"))).alias("wanted")
    )
    low = F.ceil(F.col("m") * F.lit(threshold) / F.lit(2 - threshold) - 1e-9)
    high = F.floor(F.col("m") * F.lit(2 - threshold) / F.lit(threshold) + 1e-9)
    return wanted.withColumn("n", F.explode(F.sequence(low.cast("int"), high.cast("int"))))


def segments(docs: DataFrame, high: int) -> DataFrame:
    """`doc_id`, `kind`, `position` (from 0) and `line`, the normalised segment, for segments that can have
    at most `high` bigrams. No segment comes twice."""

    def entries(kind, parts):
        return F.transform(
            parts,
            lambda part, i: F.struct(
                F.lit(kind).alias("kind"), i.alias("position"), part.alias("line")
            ),
        )

    # Between two words of a block stand three separators at most.
    def several_lines(entry):
        return F.contains(F.trim(entry["line"], F.lit(" \n")), F.lit("\n")) & (
            count(entry["line"], " ", "\n") <= 3 * high + 6
        )

    def one_line(entry):
        return count(F.trim(entry["line"]), " ").between(1, high)

    def whole(text, blocks):
        return F.when(F.size(blocks) > 1, entries("text", F.array(text))).otherwise(
            F.array().cast("array<struct<kind:string,position:int,line:string>>")
        )

    def all_of(text):
        blocks = F.split(text, "\n *\n[ \n]*")
        chosen = F.concat(
            F.filter(entries("line", F.split(text, "\n")), one_line),
            F.filter(entries("block", blocks), several_lines),
            whole(text, blocks),
        )
        return F.transform(
            chosen,
            lambda s: F.struct(s["kind"].alias("kind"), s["position"].alias("position"), on_one_line(s["line"]).alias("line")),
        )

    # A variable of a lambda is worked out once, where an alias would be copied into each of its uses.
    found = F.flatten(F.transform(F.array(clean(F.col("text"))), all_of))
    return (
        docs.filter(F.col("text").isNotNull())
        # As for the outer form, see `embedded_licenses`; a text without segments gives a row without line.
        .select("doc_id", F.explode_outer(found).alias("s"))
        .select("doc_id", "s.kind", "s.position", "s.line")
        .filter("line is not null")
    )


def scan_licenses(
    docs: DataFrame, templates: DataFrame | None = None, threshold: float = THRESHOLD
) -> DataFrame:
    """One row per segment that matches a licence: `doc_id, kind, position, license, dice`, of several
    licences the one with the largest coefficient, then the first by name.

    Null and empty texts match nothing; repeated rows give repeated rows; other columns are not read. Templates
    that are null or of one word have no bigram and match nothing. `templates` has `license` and `template`.
    """
    if templates is None:
        templates = template_frame(docs.sparkSession)
    known = matchable(templates, threshold)
    size = known.agg(
        F.max("n").alias("n"), F.sum(2 * F.length(F.array_join("wanted", " "))).alias("bytes")
    ).first()
    high = size["n"] or 0
    sized = segments(docs, high).withColumn("n", count(F.col("line"), " "))
    # A handful of templates per count: a segment meets them as one array, so each segment is one row.
    lists = known.groupBy("n").agg(
        F.array_distinct(F.flatten(F.collect_list("pairs"))).alias("any_pair"),
        F.collect_list(F.struct("license", "wanted", "m")).alias("candidates"),
    )
    if (size["bytes"] or 0) <= MOST_SENT_BYTES:
        lists = F.broadcast(lists)
    # Nearly all segments share no pair with any template of fitting size.
    touched = sized.join(lists, "n").filter(F.arrays_overlap(pairs_of(F.col("line")), F.col("any_pair")))

    def best_of(found):
        def score(candidate):
            shared = F.size(F.array_intersect(found, candidate["wanted"]))
            return F.struct(
                (-2.0 * shared / (F.col("n") + candidate["m"])).alias("minus"),
                candidate["license"].alias("license"),
            )

        return F.array_min(F.transform("candidates", score))

    bags = F.transform(F.transform(F.array(pairs_of(F.col("line"))), numbered), best_of)
    return (
        touched.select("doc_id", "kind", "position", F.explode(bags).alias("best"))
        .filter(-F.col("best.minus") >= threshold)
        .select("doc_id", "kind", "position", "best.license", (-F.col("best.minus")).alias("dice"))
    )


def template_pairs(templates: DataFrame, threshold: float) -> DataFrame:
    """Distinct bigrams of each template: `word`, `next`, `template_no`, `license`, `m` (bigrams of the template), `high` (of
    its longest window), `least` (what any window must share with it), `pair_no` and `times` (how often it has it)."""
    line = on_one_line(clean(F.col("template")))
    pairs = (
        templates.select("license", line.alias("line"))
        .distinct()
        .withColumn("m", count(F.col("line"), " "))
        .filter("m > 0")
        .withColumn("template_no", F.xxhash64("license", "line"))
        .select("license", "m", "template_no", F.explode(pairs_of(F.col("line"))).alias("pair"))
        .groupBy("license", "m", "template_no", "pair")
        .agg(F.count("*").cast("int").alias("times"))
    )
    low = F.ceil(F.col("m") * F.lit(threshold) / F.lit(2 - threshold) - 1e-9)
    return pairs.select(
        F.substring_index("pair", " ", 1).alias("word"),
        F.substring_index("pair", " ", -1).alias("next"),
        "template_no",
        "license",
        "m",
        F.floor(F.col("m") * F.lit(2 - threshold) / F.lit(threshold) + 1e-9).cast("int").alias("high"),
        F.ceil(F.lit(threshold) * (F.col("m") + low) / 2 - 1e-9).cast("int").alias("least"),
        F.row_number().over(Window.partitionBy("template_no").orderBy("pair")).alias("pair_no"),
        "times",
    )


def text_pairs(text: Column) -> Column:
    """Adjacent word pairs of a whole text, in order, as structs of two; the last word has no other."""

    def of(words):
        return F.arrays_zip(words, F.slice(words, 2, F.size(words)))

    # A variable of a lambda is worked out once, where an alias would be copied into each of its uses.
    return F.get(F.transform(F.array(F.split(on_one_line(clean(text)), " ")), of), F.lit(0))


def best_window(hits: Column) -> Column:
    """Of the windows that begin in stretch `block`: `minus` (the coefficient, negative), `position`, `n`.

    `hits` are the positions of the template's bigrams in order. A hit adds to what a window shares unless the
    window holds its bigram as often as the template already.
    """

    def with_earlier(all_hits):
        def one(hit, i):
            same = F.filter(F.slice(all_hits, 1, i), lambda other: other["pair_no"] == hit["pair_no"])
            before = F.get(same, F.size(same) - hit["times"])
            return F.struct(
                hit["position"].alias("position"), F.coalesce(before["position"], F.lit(-1)).alias("before")
            )

        return F.transform(all_hits, one)

    def best_of(all_hits):
        def from_start(start):
            inside = F.filter(
                all_hits,
                lambda hit: (hit["position"] >= start["position"])
                & (hit["position"] < start["position"] + F.col("high")),
            )

            def add(state, hit):
                shared = state["shared"] + F.when(hit["before"] < start["position"], 1).otherwise(0)
                n = hit["position"] - start["position"] + 1
                window = F.struct(
                    (-2.0 * shared / (n + F.col("m"))).alias("minus"),
                    start["position"].alias("position"),
                    n.alias("n"),
                )
                return F.struct(shared.alias("shared"), F.least(state["best"], window).alias("best"))

            nothing = F.struct(F.lit(0.0).alias("minus"), start["position"].alias("position"), F.lit(0).alias("n"))
            return F.aggregate(
                inside, F.struct(F.lit(0).alias("shared"), nothing.alias("best")), add, lambda state: state["best"]
            )

        starts = F.filter(all_hits, lambda hit: F.floor(hit["position"] / F.col("high")) == F.col("block"))
        return F.array_min(F.transform(starts, from_start))

    return F.get(F.transform(F.transform(F.array(hits), with_earlier), best_of), F.lit(0))


def embedded_licenses(
    docs: DataFrame, templates: DataFrame | None = None, threshold: float = THRESHOLD
) -> DataFrame:
    """One row per row of `docs` and licence that some window of its words matches, on lines of its own or not:
    `doc_id, kind` (`window`), `position` (of the best window's first word, from 0), `license, dice`; of several windows
    the one with the largest coefficient, then the first.

    Odd input is taken as by `scan_licenses`.
    """
    if templates is None:
        templates = template_frame(docs.sparkSession)
    known = template_pairs(templates, threshold)
    size = known.agg(F.sum(F.length("word") + F.length("next") + F.length("license") + 32).alias("bytes")).first()["bytes"] or 0
    if size <= MOST_SENT_BYTES:
        known = F.broadcast(known)
    block = F.floor(F.col("position") / F.col("high"))
    hits = (
        docs.filter(F.col("text").isNotNull())
        .select("doc_id", F.monotonically_increasing_id().alias("row"), "text")
        # The outer form, as for the other one the optimizer works the pairs out twice more, to see if there are any.
        .select("doc_id", "row", F.posexplode_outer(text_pairs(F.col("text"))).alias("position", "pair"))
        .select("doc_id", "row", "position", "pair.*")
        .toDF("doc_id", "row", "position", "word", "next")
        .join(known, ["word", "next"])
        .withColumn("block", F.explode(F.array(block, block - 1)))
        .filter("block >= 0")
    )
    groups = (
        hits.groupBy("row", "doc_id", "template_no", "license", "m", "high", "least", "block")
        .agg(F.collect_list(F.struct("position", "pair_no", "times")).alias("hits"))
        .filter(F.size("hits") >= F.col("least"))
    )
    return (
        groups.select("row", "doc_id", "license", best_window(F.array_sort("hits")).alias("best"))
        .filter(-F.col("best.minus") >= threshold)
        .groupBy("row", "doc_id", "license")
        .agg(F.min("best").alias("best"))
        .select(
            "doc_id",
            F.lit("window").alias("kind"),
            F.col("best.position").alias("position"),
            "license",
            (-F.col("best.minus")).alias("dice"),
        )
    )


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def oracle_sql(threshold: float = THRESHOLD) -> str:
    """The same over `documents` for DuckDB, without the pruning."""
    rows = ", ".join(
        f"({_quoted(name)}, {_quoted(text)})" for name, texts in TEMPLATES.items() for text in texts
    )
    marks = "[\\x00-\\x09\\x0b-/:-@\\[-`{-\\x7f]+"

    def clean_sql(column):
        return f"regexp_replace(lower({column}), '{marks}', ' ', 'g')"

    def one_line(text):
        return f"trim(regexp_replace({text}, '[ \n]+', ' ', 'g'), ' ')"

    pairs = "[w[i] || ' ' || w[i + 1] for i in range(1, len(w))]"
    bag = "[p[i] || ' ' || len([q for q in p[1:i - 1] if q = p[i]]) for i in range(1, len(p) + 1)]"
    return f"""
    with templates(license, template) as (values {rows}),
    wanted as (select license, {bag} as wanted from (select license, {pairs} as p from (
        select license, string_split({one_line(clean_sql('template'))}, ' ') as w from templates
    ) where len(w) > 1)),
    cleaned as (select row_number() over () as row, doc_id, {clean_sql('text')} as t
                from documents where text is not null),
    lines as (select row, doc_id, unnest(string_split(t, '\n')) as line,
                     generate_subscripts(string_split(t, '\n'), 1) - 1 as position from cleaned),
    blocks as (select row, doc_id, unnest(b) as block, generate_subscripts(b, 1) - 1 as position, len(b) as n
               from (select *, regexp_split_to_array(t, '\n *\n[ \n]*') as b from cleaned)),
    segments as (
        select row, doc_id, 'line' as kind, position, line from lines
        union all select row, doc_id, 'block', position, block from blocks
        where contains(trim(block, ' \n'), '\n')
        union all select distinct row, doc_id, 'text', 0, t from blocks join cleaned using (row, doc_id) where n > 1),
    words as (select row, doc_id, kind, position, string_split({one_line('line')}, ' ') as w from segments),
    found as (select row, doc_id, kind, position, {bag} as found from (
        select row, doc_id, kind, position, {pairs} as p from words where len(w) > 1 and len(w) < 2000)),
    scored as (select row, doc_id, kind, position, license,
                      2.0::double * len(list_intersect(found, wanted)) / (len(found) + len(wanted)) as dice
               from found, wanted),
    ranked as (select *, row_number() over (partition by row, kind, position order by dice desc, license) as r
               from scored where dice >= {threshold}::double),
    notices as (select row_number() over () as t, license, p from (select distinct license, p from (
        select license, {pairs} as p from (
            select license, string_split({one_line(clean_sql('template'))}, ' ') as w from templates
        ) where len(w) > 1))),
    notice_pairs as (select t, any_value(license) as license, any_value(m) as m, pair, count(*) as times
                     from (select t, license, len(p) as m, unnest(p) as pair from notices) group by t, pair),
    positions as (select row, doc_id, unnest(p) as pair, generate_subscripts(p, 1) - 1 as pos from (
        select row, doc_id, {pairs} as p from (
            select row, doc_id, string_split({one_line('t')}, ' ') as w from cleaned) where len(w) > 1)),
    hits as (select row, doc_id, pos, t, license, m, pair, times from positions join notice_pairs using (pair)),
    spans as (select a.row, a.t, a.pos as first, b.pos as last from hits a join hits b
              on a.row = b.row and a.t = b.t and b.pos >= a.pos and b.pos < a.pos + 2 * a.m),
    shared as (select row, doc_id, t, license, m, first, last, pair, least(count(*), any_value(times)) as n
               from spans join hits using (row, t) where pos between first and last
               group by row, doc_id, t, license, m, first, last, pair),
    windows as (select row, doc_id, license, first,
                       2.0::double * sum(n) / (last - first + 1 + m) as dice
                from shared group by row, doc_id, t, license, m, first, last),
    best as (select *, row_number() over (partition by row, license order by dice desc, first) as r
             from windows where dice >= {threshold}::double)
    select doc_id, kind, position::int as position, license, dice from ranked where r = 1
    union all
    select doc_id, 'window', first::int, license, dice from best where r = 1
    """
