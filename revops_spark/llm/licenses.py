"""Licence scan by sentence rules, in DataFrame expressions only.

Texts are cut into parts at line ends and after . ! ? ; : followed by white
space, and normalised (lower case, everything but letters and digits to single
spaces). A part that the sentence table knows becomes its identifier, and so
does a run of parts that only single line ends divide: a sentence wrapped over
lines, with or without comment marks (signs, not words such as REM). Blank lines
and ends of sentences are never joined over; "v." before a digit may be an end of
a sentence or none. Sentences count by the place of their first word, the
shorter first where several begin there; the
identifiers of a document, in order of appearance, are matched against the
rules. A rule is an ordered sequence of identifiers; it matches where they
appear in that order, other known sentences may stand between them, and as often
as they do so one after the other. A rule that is part of a longer one counts
only as often as the longer one doesn't account for it: the three sentences of
BSD-3-Clause are not a BSD-2-Clause as well, unless its text stands there again.

"SPDX-License-Identifier:" is followed by an expression: operands, divided by AND,
OR or WITH (any case), in any brackets, up to the end of the line or the first
word that is no operator. Its known identifiers are licences, in their usual
spelling; what follows WITH is an exception and no licence. The expression may
begin on the next line, behind comment marks. Each known identifier counts as one
known sentence.

Everything happens within a document's own row: no join, no shuffle, nothing
collected. The tables are literals of a fixed size. The sentences are looked up
as one tree of words, so a text is compared at each mark with those sentences
alone that share its words so far.

Results for odd input: a null or empty text holds no licence; a sentence that
occurs several times counts at each place; an expression that ends in an operator
keeps its operands; unknown identifiers are passed over; repeated rows are scanned
alike; a null id is kept; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Sentences of well-known licence texts and notices, normalised.
SENTENCES = [
    (1, "licensed under the apache license version 2 0"),
    (2, "licensed under the apache license version 2 0 the license"),
    (3, "you may not use this file except in compliance with the license"),
    (4, "you may obtain a copy of the license at"),
    (5, "released under the mit license"),
    (6, "licensed under the mit license"),
    (7, "permission is hereby granted free of charge to any person obtaining a copy of this software "
        "and associated documentation files the software to deal in the software without restriction "
        "including without limitation the rights to use copy modify merge publish distribute "
        "sublicense and or sell copies of the software and to permit persons to whom the software is "
        "furnished to do so subject to the following conditions"),
    (8, "the above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the software"),
    (9, "this work is licensed under the gnu general public license version 3"),
    (10, "this program is free software"),
    (11, "you can redistribute it and or modify it under the terms of the gnu general public license "
         "as published by the free software foundation either version 3 of the license or at your "
         "option any later version"),
    (12, "you can redistribute it and or modify it under the terms of the gnu general public license "
         "as published by the free software foundation either version 2 of the license or at your "
         "option any later version"),
    (13, "licensed under cc by nc 4 0"),
    (14, "licensed under cc by 4 0"),
    (15, "licensed under cc by sa 4 0"),
    (16, "this work is licensed under a creative commons attribution 4 0 international license"),
    (17, "redistribution and use in source and binary forms with or without modification are "
         "permitted provided that the following conditions are met"),
    (18, "redistributions of source code must retain the above copyright notice this list of "
         "conditions and the following disclaimer"),
    (19, "neither the name of the copyright holder nor the names of its contributors may be used to "
         "endorse or promote products derived from this software without specific prior written "
         "permission"),
    (20, "this source code form is subject to the terms of the mozilla public license v 2 0"),
    (24, "all rights reserved"),
    (19, "neither the name of the author nor the names of its contributors may be used to endorse or "
         "promote products derived from this software without specific prior written permission"),
    (19, "neither the name of the university nor the names of its contributors may be used to endorse "
         "or promote products derived from this software without specific prior written permission"),
    (25, "you can redistribute it and or modify it under the terms of the gnu general public license "
         "as published by the free software foundation"),
    (26, "either version 2 of the license or at your option any later version"),
    (27, "either version 3 of the license or at your option any later version"),
    (28, "you can redistribute it and or modify it under the terms of the gnu general public license "
         "version 2 as published by the free software foundation"),
    (29, "this library is free software"),
    (30, "you can redistribute it and or modify it under the terms of the gnu lesser general public "
         "license as published by the free software foundation"),
    (31, "either version 2 1 of the license or at your option any later version"),
    (32, "you can redistribute it and or modify it under the terms of the gnu lesser general public "
         "license as published by the free software foundation either version 3 of the license or at "
         "your option any later version"),
    (33, "you can redistribute it and or modify it under the terms of the gnu affero general public "
         "license as published by the free software foundation either version 3 of the license or at "
         "your option any later version"),
    (34, "permission to use copy modify and or distribute this software for any purpose with or "
         "without fee is hereby granted provided that the above copyright notice and this permission "
         "notice appear in all copies"),
    (34, "permission to use copy modify and distribute this software for any purpose with or without "
         "fee is hereby granted provided that the above copyright notice and this permission notice "
         "appear in all copies"),
    (35, "this is free and unencumbered software released into the public domain"),
    (36, "cc0 1 0 universal"),
    (36, "creative commons zero v1 0 universal"),
    (37, "this program and the accompanying materials are made available under the terms of the "
         "eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0"),
    (37, "this program and the accompanying materials are made available under the terms of the "
         "eclipse public license 2 0 which is available at http www eclipse org legal epl 2 0"),
    (38, "permission is granted to anyone to use this software for any purpose including commercial "
         "applications and to alter it and redistribute it freely subject to the following "
         "restrictions"),
    (39, "distributed under the boost software license version 1 0"),
]

# Names that one-line notices give a licence, as sentence identifier,
# licence and names. They are written behind each of the openings below.
NOTICE_NAMES = [
    (51, "MIT", ["mit license"]),
    (52, "Apache-2.0", ["apache license 2 0", "apache 2 0 license"]),
    (53, "BSD-2-Clause", ["bsd 2 clause license"]),
    (54, "BSD-3-Clause", ["bsd 3 clause license"]),
    (55, "ISC", ["isc license"]),
    (56, "MPL-2.0", ["mozilla public license 2 0", "mozilla public license version 2 0"]),
    (57, "GPL-2.0-only", ["gnu general public license version 2", "gnu general public license v2 0"]),
    (58, "GPL-3.0-only", ["gnu general public license version 3", "gnu general public license v3 0"]),
    (59, "AGPL-3.0-only", ["gnu affero general public license version 3",
                           "gnu affero general public license v3 0"]),
    (60, "LGPL-3.0-only", ["gnu lesser general public license version 3",
                           "gnu lesser general public license v3 0"]),
    (61, "CC0-1.0", ["cc0 1 0 license"]),
    (62, "Unlicense", ["unlicense"]),
    (63, "EPL-2.0", ["eclipse public license 2 0", "eclipse public license version 2 0"]),
]
OPENINGS = [f"{what}{how} under the" for what in ("", "this project is ", "this software is ", "this work is ")
            for how in ("licensed", "released", "distributed")]
_KNOWN = {text for _, text in SENTENCES}
SENTENCES += [(i, text) for i, _, names in NOTICE_NAMES for name in names for opening in OPENINGS
              if (text := f"{opening} {name}") not in _KNOWN]

# Licence and the sentence identifiers that prove it, in order.
RULES = [
    ("AGPL-3.0-or-later", (10, 33)),
    ("Apache-2.0", (1,)),
    ("Apache-2.0", (2, 3, 4)),
    ("BSD-2-Clause", (17, 18)),
    ("BSD-3-Clause", (17, 18, 19)),
    ("BSL-1.0", (39,)),
    ("CC-BY-4.0", (14,)),
    ("CC-BY-4.0", (16,)),
    ("CC-BY-NC-4.0", (13,)),
    ("CC-BY-SA-4.0", (15,)),
    ("CC0-1.0", (36,)),
    ("EPL-2.0", (37,)),
    ("GPL-2.0-only", (10, 28)),
    ("GPL-2.0-or-later", (10, 12)),
    ("GPL-2.0-or-later", (10, 25, 26)),
    ("GPL-3.0-only", (9,)),
    ("GPL-3.0-or-later", (10, 11)),
    ("GPL-3.0-or-later", (10, 25, 27)),
    ("ISC", (34,)),
    ("LGPL-2.1-or-later", (29, 30, 31)),
    ("LGPL-3.0-or-later", (10, 32)),
    ("LGPL-3.0-or-later", (29, 30, 27)),
    ("MIT", (5,)),
    ("MIT", (6,)),
    ("MIT", (7, 8)),
    ("MPL-2.0", (20,)),
    ("Unlicense", (35,)),
    ("Zlib", (38,)),
] + [(name, (i,)) for i, name, _ in NOTICE_NAMES]

# SPDX identifiers, and versions of the GNU licences, whose older
# identifiers say "only" by nothing and "or later" by a plus sign.
SPDX_IDS = ["0BSD", "Apache-2.0", "Artistic-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSD-4-Clause", "BSL-1.0",
            "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0", "CC0-1.0", "CDDL-1.0", "EPL-1.0", "EPL-2.0", "EUPL-1.2",
            "ISC", "MIT", "MIT-0", "MPL-1.1", "MPL-2.0", "MS-PL", "OFL-1.1", "PSF-2.0", "PostgreSQL",
            "Unlicense", "WTFPL", "Zlib"]
GNU_IDS = ["AGPL-3.0", "GPL-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0"]


def spdx_names() -> dict[str, str]:
    """Lower-case SPDX identifiers, older spellings too, and the licences they name."""
    names = {i.lower() + plus: i for i in SPDX_IDS for plus in ("", "+")}
    for i in GNU_IDS:
        for end, name in (("", "-only"), ("-only", "-only"), ("+", "-or-later"), ("-or-later", "-or-later")):
            names[i.lower() + end] = i + name
    return names


# Marks between parts: a single line end may stand within a sentence, an end not.
_LINE, _END = "\n", "\x02"
_SENTENCE_END = r"(?<=[.!?;:])\s+"
_VERSION = r"(?<=[^\p{L}\p{N}][vV]\.)(?=\s)[^\S\n]*+\n?+[^\p{L}\p{N}\n]*+(?=\p{N})"
_SPDX = r"(?i)spdx-license-identifier:"
# an expression's words and brackets, on the tag's line or the next
_EXPRESSION = r"^[^\p{L}\p{N}\n]*+\n?+[^\p{L}\p{N}\n]*+([A-Za-z0-9.+() \t-]+)"
_OPERATORS = ["AND", "OR", "WITH"]


def marked(text):
    """The normalised parts of a text, each between two marks."""
    text = F.translate(F.coalesce(text.cast("string"), F.lit("")), _END, "_")
    text = F.regexp_replace(text, _VERSION, "_" + _LINE)
    text = F.lower(F.regexp_replace(text, _SENTENCE_END, _END))
    text = F.regexp_replace(text, r"[^\p{L}\p{N}\n\x02]+", " ")
    # two line ends without a word between them are a blank line
    text = F.regexp_replace(text, r"[ \n\x02]*(?:\x02|\n ?\n)[ \n\x02]*", _END)
    return F.concat(F.lit(_END), F.trim(F.regexp_replace(text, r" ?\n ?", _LINE)), F.lit(_END))


def _tree(sentences: list[list[str]]) -> str:
    """A regular expression for the longest of the sentences (lists of words) that a
    text begins with: what follows a common word is written once."""
    rest: dict[str, list[list[str]]] = {}
    for words in sentences:
        if words:
            rest.setdefault(words[0], []).append(words[1:])
    ways = [rf"[ \n]\Q{word}\E{_tree(rest[word])}" for word in sorted(rest)]
    if [] in sentences:
        ways.append(r"(?=[\n\x02])")
    return ways[0] if len(ways) == 1 else f"(?:{'|'.join(ways)})"


def known_sentences(text, sentences: list[tuple[int, str]]):
    """Identifiers of the known sentences of a text, in order of appearance."""
    table = F.array(*[F.lit(s) for _, s in sentences])
    ids = F.array(*[F.lit(i) for i, _ in sentences])
    # the longest that begins at a mark; sentences that it begins with end at a mark within
    first: dict[str, list[list[str]]] = {}
    for _, s in sentences:
        word, *others = s.split(" ")
        first.setdefault(word, []).append(others)
    longest = r"[\n\x02](?=({}))".format("|".join(rf"\Q{w}\E{_tree(first[w])}" for w in sorted(first)))
    runs = F.transform(F.regexp_extract_all(marked(text), F.lit(longest), F.lit(1)),
                       lambda x: F.split(x, _LINE))
    at = F.flatten(F.transform(runs, lambda x: F.transform(
        F.sequence(F.lit(1), F.size(x)),
        lambda n: F.array_position(table, F.array_join(F.slice(x, F.lit(1), n), " ")))))
    return F.transform(F.filter(at, lambda x: x > 0), lambda x: F.element_at(ids, x.cast("int")))


def spdx_licenses(text):
    """The licences that a text's SPDX expressions name, one per known identifier."""
    names = F.create_map(*[F.lit(x) for pair in sorted(spdx_names().items()) for x in pair])

    # words and end are bound to lambda variables, so they are made once a tag
    def with_end(words):
        # an operator has an odd place; the first other word there ends the expression
        end = F.array_min(F.transform(words, lambda x, i: F.when(
            (i % 2 == 1) & ~F.upper(x).isin(_OPERATORS), i)))
        return F.struct(words.alias("words"), F.coalesce(end, F.size(words)).alias("end"))

    def operands(tag):
        return F.filter(tag["words"], lambda x, i: (i % 2 == 0) & (i < tag["end"])
                        & ~F.coalesce(F.upper(F.get(tag["words"], i - 1)) == "WITH", F.lit(False)))

    text = F.coalesce(text.cast("string"), F.lit(""))
    behind = F.split(text, _SPDX)
    behind = F.slice(behind, F.lit(2), F.size(behind))
    words = F.transform(behind, lambda x: F.split(F.regexp_extract(x, _EXPRESSION, 1), r"[() \t]+"))
    found = F.flatten(F.transform(F.transform(words, with_end), operands))
    found = F.transform(found, lambda x: F.element_at(names, F.lower(F.rtrim(x, F.lit(".-")))))
    return F.when(text.rlike(_SPDX), F.filter(found, lambda x: x.isNotNull())).otherwise(
        F.array().cast("array<string>"))


def _times(ids, rule: tuple[int, ...]):
    """How often the rule's identifiers appear in `ids` in this order, one after the other."""
    steps = F.array(*[F.lit(r) for r in rule])
    done = F.aggregate(ids, F.lit(0), lambda at, x: F.when(
        x == F.element_at(steps, at % len(rule) + 1), at + 1).otherwise(at))
    return F.floor(done / len(rule))


def longer_rules(rules: list[tuple[str, tuple[int, ...]]]) -> dict[tuple[int, ...], list[tuple[int, ...]]]:
    """For each sequence the longer sequences that hold it without a gap."""
    sequences = {r for _, r in rules}
    return {a: sorted(b for b in sequences if len(b) > len(a) and any(
        b[i:i + len(a)] == a for i in range(len(b) - len(a) + 1))) for a in sequences}


def _own_times(ids, rule: tuple[int, ...], longer: dict):
    """`_times` without those that longer rules account for."""
    n = _times(ids, rule)
    for other in longer[rule]:
        n = n - F.greatest(_own_times(ids, other, longer), F.lit(0))
    return n


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         sentences: list[tuple[int, str]] | None = None,
         rules: list[tuple[str, tuple[int, ...]]] | None = None) -> DataFrame:
    """One row per document: doc_id, licenses (sorted, joined by a comma; empty if
    none), n_licenses, n_sentences (known sentences)."""
    sentences = SENTENCES if sentences is None else sentences
    rules = RULES if rules is None else rules
    longer = longer_rules(rules)
    found = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                        known_sentences(F.col(text_col), sentences).alias("ids"),
                        spdx_licenses(F.col(text_col)).alias("spdx"))
    proved = F.filter(
        F.array(*[F.when(_own_times(F.col("ids"), rule, longer) > 0, F.lit(name)) for name, rule in rules]),
        lambda x: x.isNotNull())
    none = F.array().cast("array<string>")
    names = F.array_sort(F.array_distinct(F.concat(F.when(F.size("ids") > 0, proved).otherwise(none), "spdx")))
    return found.withColumn("names", names).select(
        "doc_id", F.array_join("names", ",").alias("licenses"),
        F.size("names").cast("long").alias("n_licenses"),
        (F.size("ids") + F.size("spdx")).cast("long").alias("n_sentences"))


def oracle_sql(documents: str = "documents") -> str:
    """The scan as DuckDB SQL, with regular expressions over identifier sequences.

    It looks parts up one by one, so it holds for texts without wrapped sentences."""
    table = ", ".join(f"({i}, '{s}')" for i, s in SENTENCES)
    spdx = ", ".join(f"('{k}', '{v}')" for k, v in sorted(spdx_names().items()))
    longer = longer_rules(RULES)

    def own(rule):
        n = "len(regexp_extract_all(ids, '{}'))".format(".*?".join(f",{i}," for i in rule))
        return n + "".join(f" - greatest({own(other)}, 0)" for other in longer[rule])

    tests = ", ".join(f"CASE WHEN {own(rule)} > 0 THEN '{name}' END" for name, rule in RULES)
    gap = r"[() \t]+"
    return f"""
WITH known(sentence_id, sentence) AS (VALUES {table}),
spdx_id(id, name) AS (VALUES {spdx}),
cut AS (SELECT doc_id, regexp_split_to_array(regexp_replace(text,
            '([.!?;:])\\s+', '\\1' || chr(10), 'g'), '\\n+') AS parts FROM {documents}),
part AS (SELECT doc_id, unnest(parts) AS part, generate_subscripts(parts, 1) AS place FROM cut),
hit AS (SELECT doc_id, place, sentence_id FROM part JOIN known
        ON trim(regexp_replace(lower(part), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) = sentence),
doc AS (SELECT doc_id, ',' || string_agg(sentence_id, ',,' ORDER BY place) || ',' AS ids,
               count(*) AS n FROM hit GROUP BY doc_id),
tag AS (SELECT doc_id, unnest(regexp_split_to_array(text, '(?i)spdx-license-identifier:')[2:]) AS behind
        FROM {documents}),
expression AS (SELECT doc_id, regexp_replace(regexp_extract(behind,
    '(?i)^[^\\p{{L}}\\p{{N}}\\n]*\\n?[^\\p{{L}}\\p{{N}}\\n]*([A-Z0-9][A-Z0-9.+-]*'
    || '(?:{gap}(?:AND|OR|WITH){gap}[A-Z0-9.+-]+)*)', 1), '(?i){gap}WITH{gap}[A-Z0-9.+-]+', '', 'g') AS e FROM tag),
operand AS (SELECT doc_id, unnest(regexp_split_to_array(e, '(?i){gap}(?:AND|OR){gap}')) AS id FROM expression),
tagged AS (SELECT doc_id, list(name) AS spdx, count(*) AS n_spdx
           FROM operand JOIN spdx_id ON lower(rtrim(operand.id, '.-')) = spdx_id.id GROUP BY doc_id),
named AS (SELECT doc_id, coalesce(n, 0) + coalesce(n_spdx, 0) AS n, list_sort(list_distinct(
              list_concat(CASE WHEN ids IS NULL THEN [] ELSE [{tests}] END, coalesce(spdx, [])))) AS names
          FROM doc FULL JOIN tagged USING (doc_id))
SELECT d.doc_id, coalesce(array_to_string(names, ','), '') AS licenses,
       coalesce(len(names), 0)::BIGINT AS n_licenses, coalesce(n, 0)::BIGINT AS n_sentences
FROM {documents} d LEFT JOIN named USING (doc_id)"""
