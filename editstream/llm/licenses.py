"""Licence scan: known sentences first, then ordered rules over their identifiers."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from editstream.llm.common import same, table

# Fixed texts of public licences and notices: what a sentence must say to be known.
SENTENCES = [
    "Licensed under the Apache License, Version 2.0",
    "you may not use this file except in compliance with the License",
    "You may obtain a copy of the License at",
    "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    "See the License for the specific language governing permissions and limitations under the License",
    "Licensed under the Apache License, Version 2.0 (the \"License\")",
    "Released under the MIT License",
    "Licensed under the MIT License",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT",
    "This work is licensed under the GNU General Public License, version 3",
    "This program is free software",
    "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "either version 3 of the License, or (at your option) any later version",
    "either version 2 of the License, or (at your option) any later version",
    "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY",
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "This is free and unencumbered software released into the public domain",
    "Licensed under CC BY-NC 4.0",
    "Licensed under CC BY 4.0",
    "Licensed under CC BY-SA 4.0",
    "This work is licensed under the Creative Commons Attribution 4.0 International License",
]

# Fixed rules: identifiers are places in the list above, counted from 0.
RULES = [
    ("Apache-2.0", [0]),
    ("Apache-2.0", [5, 1, 2]),
    ("Apache-2.0", [5, 1]),
    ("MIT", [6]),
    ("MIT", [7]),
    ("MIT", [8, 9, 10]),
    ("GPL-3.0-only", [11]),
    ("GPL-3.0-or-later", [12, 13, 14]),
    ("GPL-2.0-or-later", [12, 13, 15]),
    ("BSD-2-Clause", [17, 18, 19]),
    ("BSD-3-Clause", [17, 18, 19, 20]),
    ("ISC", [21]),
    ("MPL-2.0", [22]),
    ("Unlicense", [23]),
    ("CC-BY-NC-4.0", [24]),
    ("CC-BY-4.0", [25]),
    ("CC-BY-SA-4.0", [26]),
    ("CC-BY-4.0", [27]),
]

# The published GPL notices have a comma here, which does not end a sentence: added to the lists above,
# with places counted on.
COMMA_FORMS = [
    f"{SENTENCES[13]}, {SENTENCES[14]}",
    f"{SENTENCES[13]}, {SENTENCES[15]}",
]
COMMA_RULES = [
    ("GPL-3.0-or-later", [12, len(SENTENCES)]),
    ("GPL-2.0-or-later", [12, len(SENTENCES) + 1]),
]

# More notices, as their licences publish them; places are counted on from the lists above.
_NEXT = len(SENTENCES) + len(COMMA_FORMS)
MORE_SENTENCES = [
    "This library is free software",
    "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    "either version 2.1 of the License, or (at your option) any later version",
    "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 2.1 of the License, or (at your option) any later version",
    "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE",
]
MORE_RULES = [
    ("LGPL-2.1-or-later", [_NEXT, _NEXT + 1, _NEXT + 2]),
    ("LGPL-2.1-or-later", [_NEXT, _NEXT + 3]),
    ("LGPL-3.0-or-later", [_NEXT, _NEXT + 1, 14]),
    ("LGPL-3.0-or-later", [_NEXT, _NEXT + 4]),
    ("AGPL-3.0-or-later", [12, _NEXT + 5, 14]),
    ("AGPL-3.0-or-later", [12, _NEXT + 6]),
    ("EPL-2.0", [_NEXT + 7]),
]

ALL_SENTENCES = SENTENCES + COMMA_FORMS + MORE_SENTENCES
#: The rules in the order in which they are tried: the longest first, equally long ones as listed.
ORDERED_RULES = sorted(RULES + COMMA_RULES + MORE_RULES, key=lambda rule: -len(rule[1]))

# A sentence ends at a mark before a blank or the text's end; lines end it in the second reading.
ENDS = r"[.!?;:]+(?=\s|$)"
LINES = r"[.!?;:]+(?=\s|$)|\n"
# The dot of "v. 2.0", "ver. 2.0" or "vers. 2.0" ends no sentence.
VERSION = r"(?i)\b(v|ver|vers)\.(?=[^\S\n]*\n?[^\S\n]*[0-9])"


def normalised(sentence: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(sentence), r"[^a-z0-9]+", " "))


def sequence(ids: list[int]) -> str:
    """Every identifier between commas of its own, so that one can be taken out without its neighbours."""
    return "".join(f",{i}," for i in ids)


def scan_licenses(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The licences that a document's known sentences add up to.

    Sentences, lower-cased and with all but letters and digits as single blanks, are looked up in the
    list of known ones. Rules are tried in their order, the longest first: a rule holds if its
    identifiers stand next to each other, in its order, in what is left of the document's sequence of
    known sentences (other sentences may lie between), and takes them out of it, wherever they stand
    so. Texts are read twice: with line ends as blanks, and with line ends as ends of sentences, for
    lists and headings; a licence counts if either reading has it.

    Returns ``doc, print, n_sentences`` (known ones in the reading that has more) and ``licenses``
    (sorted, distinct), a row per document id and text; null and empty texts have none.
    """
    spark = docs.sparkSession
    known = spark.createDataFrame(
        [(i, s) for i, s in enumerate(ALL_SENTENCES)], "id int, sentence string"
    ).select("id", normalised(F.col("sentence")).alias("sentence"))
    shortest = min(len(re.sub("[^a-z0-9]+", " ", s.lower()).strip()) for s in ALL_SENTENCES)
    text = F.coalesce(docs[text_col], F.lit(""))
    keys = docs.select(docs[id_col].alias("doc"), F.xxhash64(text).alias("print"))
    plain = F.regexp_replace(text, VERSION, "$1 ")
    readings = F.array(F.split(plain, ENDS, -1), F.split(plain, LINES, -1))
    units = (
        docs.select(
            docs[id_col].alias("doc"),
            F.xxhash64(text).alias("print"),
            F.posexplode(readings).alias("reading", "units"),
        )
        .select("doc", "print", "reading", F.posexplode("units").alias("pos", "unit"))
        .where(F.char_length("unit") >= shortest)
    )
    hits = units.select(
        "doc", "print", "reading", "pos", normalised(F.col("unit")).alias("sentence")
    ).join(F.broadcast(known), "sentence")
    rules = F.array(
        *[
            F.struct(F.lit(name).alias("name"), F.lit(sequence(ids)).alias("ids"))
            for name, ids in ORDERED_RULES
        ]
    )
    read = (
        hits.select("doc", "print", "reading", "pos", "id")
        .distinct()
        .groupBy("doc", "print", "reading")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "id"))).alias("found"))
        .select(
            "doc",
            "print",
            F.size("found").alias("n"),
            F.array_join(
                F.transform("found", lambda x: F.concat(F.lit(","), x["id"].cast("string"), F.lit(","))), ""
            ).alias("ids"),
        )
    )
    none = F.array().cast("array<string>")
    held = F.aggregate(
        rules,
        F.struct(F.col("ids").alias("left"), none.alias("names")),
        lambda seen, r: F.when(
            F.contains(seen["left"], r["ids"]),
            F.struct(
                F.replace(seen["left"], r["ids"], F.lit("")).alias("left"),
                F.array_append(seen["names"], r["name"]).alias("names"),
            ),
        ).otherwise(seen),
        lambda seen: seen["names"],
    )
    scanned = (
        read.select("doc", "print", "n", held.alias("held"))
        .groupBy("doc", "print")
        .agg(F.max("n").alias("n"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("held")))).alias("held"))
        .withColumnsRenamed({"doc": "doc_2", "print": "print_2"})
    )
    return keys.join(
        scanned,
        same(F.col("doc"), F.col("doc_2")) & (F.col("print") == F.col("print_2")),
        "left",
    ).select(
        "doc",
        "print",
        F.coalesce("n", F.lit(0)).cast("long").alias("n_sentences"),
        F.coalesce("held", F.array().cast("array<string>")).alias("licenses"),
    )


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents")).select(
        F.col("doc").alias("doc_id"),
        "n_sentences",
        F.array_join("licenses", ",").alias("licenses"),
    )


def _sql() -> str:
    known = ", ".join("({}, '{}')".format(i, s.replace("'", "''")) for i, s in enumerate(ALL_SENTENCES))
    norm = "trim(regexp_replace(lower({}), '[^a-z0-9]+', ' ', 'g'))"
    # No look-ahead in this SQL's patterns: a mark takes its blank along, which is trimmed anyway.
    ends, lines = r"[.!?;:]+(\s|$)", r"[.!?;:]+(\s|$)|\n"
    version = r"(?i)\b(v|ver|vers)\.([^\S\n]*\n?[^\S\n]*[0-9])"
    tried, steps = "left0", []
    for number, (name, ids) in enumerate(ORDERED_RULES, 1):
        rule = sequence(ids)
        steps.append(
            f"left{number} AS (SELECT doc_id, reading, n, replace(ids, '{rule}', '') AS ids, CASE WHEN "
            f"contains(ids, '{rule}') THEN list_append(names, '{name}') ELSE names END AS names FROM {tried})"
        )
        tried = f"left{number}"
    return rf"""
WITH known AS (SELECT id, {norm.format('s')} AS s FROM (VALUES {known}) t(id, s)),
texts AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '{version}', '\1 \2', 'g') AS t FROM documents),
units AS (
  SELECT doc_id, reading, unnest(u) AS s, generate_subscripts(u, 1) AS pos FROM (
    SELECT doc_id, 0 AS reading, string_split_regex(t, '{ends}') AS u FROM texts
    UNION ALL
    SELECT doc_id, 1, string_split_regex(t, '{lines}') FROM texts)),
left0 AS (
  SELECT doc_id, reading, count(*) AS n, string_agg(',' || id || ',', '' ORDER BY pos) AS ids,
         CAST([] AS VARCHAR[]) AS names
  FROM (SELECT doc_id, reading, pos, {norm.format('s')} AS s FROM units) u JOIN known k ON u.s = k.s
  GROUP BY doc_id, reading),
{", ".join(steps)},
named AS (SELECT doc_id, string_agg(name, ',' ORDER BY name) AS licenses FROM (
  SELECT DISTINCT doc_id, unnest(names) AS name FROM {tried}) GROUP BY doc_id)
SELECT d.doc_id, coalesce(h.n, 0) AS n_sentences, coalesce(n.licenses, '') AS licenses
FROM documents d LEFT JOIN (SELECT doc_id, max(n) AS n FROM left0 GROUP BY doc_id) h ON d.doc_id = h.doc_id
LEFT JOIN named n ON d.doc_id = n.doc_id
"""


SQL = _sql()
