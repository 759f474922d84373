"""License scans with DataFrame functions only.

A text's passages (its lines, and the whole text) are normalised and compared to licence templates by the Dice
coefficient over word bigrams. Since 2 * min(a, b) / (a + b) bounds the coefficient of sets of a and b bigrams, sizes
alone rule out most templates for a passage. Templates are a fixed, short list, kept as a literal in the plan.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainframe.llm.common import text_of

#: Notices of public licences.
TEMPLATES = {
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "cc-by-4.0": "Licensed under CC BY 4.0.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "mit": "Released under the MIT License.",
    "mit-header": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
#: Whole texts of short public licences.
WHOLE_TEXTS = {
    "bsd-2-clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "mit-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
}
LEAST_DICE = 0.8
#: Templates of ``notices``: the same, with the whole permission paragraph.
NOTICES = TEMPLATES | {
    "mit-header": TEMPLATES["mit-header"] + ", including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
}


def template_bigrams(text: str) -> list[str]:
    words = re.findall("[a-z0-9]+", text.lower())
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


#: All but ASCII letters and digits; and all but these and line feeds, as ranges: the negated class with a line feed in it
#: takes the JVM's matcher eight times as long.
NOT_WORD, NOT_WORD_OR_LINE = "[^a-z0-9]+", r"[\x00-\x09\x0b-/:-`{-\x{10ffff}]+"


def normalised(text: Column, parts: str = NOT_WORD) -> Column:
    """Lower case; runs of ``parts`` become one blank."""
    return F.regexp_replace(F.lower(text), parts, " ")


def split_words(text: Column) -> Column:
    """The words of a normalised text."""
    return F.filter(F.split(text, " "), lambda w: w != "")


def words(text: Column) -> Column:
    """Runs of ASCII letters and digits, in lower case."""
    return split_words(normalised(text))


def once(value: Column) -> Column:
    """``value`` as a generated column: what is built upon it reads it, where a projection would compute it again for
    each use."""
    return F.explode(F.array(value))


def bigrams(own: Column) -> Column:
    """The distinct pairs of neighbouring words."""
    pairs = F.zip_with(F.slice(own, 1, F.greatest(F.size(own) - 1, F.lit(0))), F.slice(own, 2, F.greatest(F.size(own) - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b))
    return F.array_distinct(pairs)


def bounds(size: int, least: float) -> tuple[int, int]:
    """Sizes that sets may have which reach ``least`` against one of ``size``."""
    return math.ceil(size * least / (2 - least) - 1e-9), math.floor(size * (2 - least) / least + 1e-9)


def template_sets(templates: dict[str, str]) -> dict[str, list[str]]:
    """Each template's distinct bigrams. One of less than two words has none: it has no Dice coefficient with anything, so it
    matches nothing, itself included, and is left out."""
    return {name: grams for name, text in templates.items() if (grams := template_bigrams(text))}


def passages(df: DataFrame) -> DataFrame:
    """(doc_id, pos, text): each line with its number, and the whole text as number -1 if it has several lines; normalised,
    which happens once a document."""
    # names of this kind are reserved: the columns of ``df`` but doc_id and text are left behind
    own = df.select("doc_id", once(normalised(text_of("text"), NOT_WORD_OR_LINE)).alias("__norm"))
    lines = F.split("__norm", "\n")
    whole = F.when(F.contains("__norm", F.lit("\n")), F.array(F.replace("__norm", F.lit("\n"), F.lit(" ")))).otherwise(F.array().cast("array<string>"))
    first = F.when(F.contains("__norm", F.lit("\n")), -1).otherwise(0)
    return own.select("doc_id", first.alias("first"), F.posexplode(F.concat(whole, lines)).alias("k", "text")).select(
        "doc_id", (F.col("k") + F.col("first")).alias("pos"), "text"
    )


def matches(df: DataFrame, templates: dict[str, str] = TEMPLATES, least: float = LEAST_DICE) -> DataFrame:
    """(doc_id, pos, license, dice): passages of ``df`` (doc_id, text; other columns are ignored) that reach ``least``
    against a template.

    Null and empty texts have no bigrams and match nothing; repeated rows match each; a passage that reaches ``least``
    against several templates has a row for each of them, ties too; a template of less than two words matches nothing; an
    empty table, or one of templates, gives no rows. Whole texts of any
    length are looked at. No shuffle and no join.

    Sizes prune before any bigram is made: a passage has fewer distinct bigrams than words, and more than distinct words
    less two, so blanks and distinct words tell which passages lie outside all templates' bounds. Then each template is
    compared only with passages whose distinct bigrams lie in its own bounds.
    """
    own = template_sets(templates)
    if not own:
        return matches(df.limit(0), {"none": "no words"}, least)
    limits = {name: bounds(len(g), least) for name, g in own.items()}
    low, high = min(a for a, _ in limits.values()), max(b for _, b in limits.values())
    text = F.btrim("text")
    blanks = F.char_length(text) - F.char_length(F.replace(text, F.lit(" "), F.lit("")))
    enough = passages(df).where(blanks >= low).select("doc_id", "pos", once(split_words(text)).alias("w"))
    # every distinct word but the first one ends a bigram of its own
    enough = enough.where((F.size("w") <= high + 1) | (F.size(F.array_distinct("w")) <= high + 1))
    small = enough.select("doc_id", "pos", once(bigrams(F.col("w"))).alias("grams")).withColumn("n", F.size("grams")).where(F.col("n").between(low, high))
    tests = [
        F.when(
            F.col("n").between(*limits[name]),
            F.struct(
                F.lit(name).alias("license"),
                (F.lit(2.0) * F.size(F.array_intersect("grams", F.array(*map(F.lit, g)))) / (F.col("n") + len(g))).alias("dice"),
            ),
        )
        for name, g in sorted(own.items())
    ]
    found = small.select("doc_id", "pos", F.explode(F.array(*tests)).alias("x"))
    return found.where(F.col("x.dice") >= least).select("doc_id", "pos", "x.license", "x.dice")


def license_lines(documents: DataFrame) -> DataFrame:
    """doc_id, pos, license, dice (to 9 places) of every passage that matches a notice or a whole licence."""
    found = matches(documents.select("doc_id", "text"), TEMPLATES | WHOLE_TEXTS)
    return found.select("doc_id", F.col("pos").cast("long").alias("pos"), "license", F.round("dice", 9).alias("dice"))


def anchors(size: int, least: float) -> int:
    """Distinct bigrams of a template of ``size`` that a set must have to reach ``least``: it has itself no fewer."""
    return math.ceil(size * least / (2 - least) - 1e-9)


def notices(df: DataFrame, templates: dict[str, str] = NOTICES, least: float = LEAST_DICE) -> DataFrame:
    """(doc_id, word, n_words, license, dice): runs of words anywhere in a text, across lines, that reach ``least``.

    A run begins and ends at bigrams of the template (others at its ends only lower the coefficient) and has at most as
    many bigrams, repeats counted, as the template's bounds allow. Of runs of a template that overlap, the best stays,
    then the first, then the shortest. ``word`` is the number of the run's first word. No shuffle and no join.
    """
    own = template_sets(templates)
    if not own:
        return notices(df.limit(0), {"none": "no words"}, least)
    every = sorted(set().union(*own.values()))
    text = df.select("doc_id", words(text_of("text")).alias("w"))
    n = F.greatest(F.size("w") - 1, F.lit(0))
    text = text.select("doc_id", F.zip_with(F.slice("w", 1, n), F.slice("w", 2, n), lambda a, b: F.concat_ws(" ", a, b)).alias("all"))
    hits = F.filter(F.transform("all", lambda g, i: F.struct(i.alias("at"), g.alias("g"))), lambda x: x["g"].isin(every))
    # exploding an array of one keeps the hits from being computed again for each of their uses
    text = text.select("doc_id", "all", F.explode(F.array(hits)).alias("hits")).where(F.size("hits") >= min(anchors(len(g), least) for g in own.values()))
    kinds = F.array(
        *(
            F.struct(F.lit(name).alias("license"), F.lit(len(g)).alias("size"), F.lit(anchors(len(g), least)).alias("need"), F.lit(bounds(len(g), least)[1]).alias("most"), F.array(*map(F.lit, g)).alias("grams"))
            for name, g in sorted(own.items())
        )
    )
    one = text.select("doc_id", "all", "hits", F.explode(kinds).alias("t"))
    one = one.select("doc_id", "all", "t", F.explode(F.array(F.filter("hits", lambda x: F.array_contains("t.grams", x["g"])))).alias("hits")).where(F.size("hits") >= F.col("t.need"))

    def runs(x: Column, i: Column) -> Column:
        """Runs from hit ``i`` on: the later hits within reach, as ends."""
        later = F.slice(F.col("hits"), i + 1, F.col("t.most"))
        ends = F.filter(later, lambda y, k: (k + 1 >= F.col("t.need")) & (y["at"] - x["at"] < F.col("t.most")))
        return F.transform(ends, lambda y: scored(x["at"], y["at"]))

    def scored(first: Column, last: Column) -> Column:
        grams = F.array_distinct(F.slice(F.col("all"), first + 1, last - first + 1))
        dice = F.lit(2.0) * F.size(F.array_intersect(grams, F.col("t.grams"))) / (F.size(grams) + F.col("t.size"))
        return F.struct((-dice).alias("worse"), first.alias("first"), last.alias("last"))

    found = F.array_sort(F.filter(F.flatten(F.transform("hits", runs)), lambda r: -r["worse"] >= least))
    one = one.select("doc_id", "t.license", F.explode(F.array(found)).alias("found")).where(F.size("found") > 0)
    apart = lambda r: lambda c: (c["first"] > r["last"]) | (c["last"] < r["first"])
    best = F.aggregate("found", F.slice("found", 1, 0), lambda acc, r: F.when(F.forall(acc, apart(r)), F.concat(acc, F.array(r))).otherwise(acc))
    one = one.select("doc_id", "license", F.explode(best).alias("r"))
    return one.select("doc_id", F.col("r.first").cast("long").alias("word"), (F.col("r.last") - F.col("r.first") + 2).cast("long").alias("n_words"), "license", (-F.col("r.worse")).alias("dice"))


def license_notices(documents: DataFrame) -> DataFrame:
    """``notices`` of documents, dice to 9 places."""
    return notices(documents.select("doc_id", "text")).withColumn("dice", F.round("dice", 9))


def _oracle() -> str:
    rows = ", ".join("('{}', [{}])".format(n, ", ".join(f"'{g}'" for g in template_bigrams(t))) for n, t in (TEMPLATES | WHOLE_TEXTS).items())
    return rf"""
WITH templates(license, t) AS (VALUES {rows}),
lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS pos FROM documents
  UNION ALL SELECT doc_id, text, -1 FROM documents WHERE contains(text, chr(10))),
words AS (
  SELECT doc_id, pos, list_filter(string_split(regexp_replace(lower(line), '[^a-z0-9]+', ' ', 'g'), ' '), lambda x: x <> '') AS w FROM lines),
grams AS (
  SELECT doc_id, pos, list_distinct(list_transform(range(1, greatest(len(w), 1)), lambda i: w[i] || ' ' || w[i + 1])) AS g FROM words),
scored AS (
  SELECT doc_id, pos, license, 2.0 * len(list_intersect(g, t)) / (len(g) + len(t)) AS dice FROM grams, templates WHERE len(g) >= 1)
SELECT doc_id, CAST(pos AS BIGINT) AS pos, license, round(CAST(dice AS DOUBLE), 9) AS dice FROM scored WHERE dice >= {LEAST_DICE}
"""


ORACLE_SQL = _oracle()
