"""Licence scans by canonical digest: whole texts, paragraphs and lines against known licence texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Spellings that count as one, longer ones first where one contains another.
EQUIVALENT = [
    ("licence", "license"), ("licenced", "licensed"), ("organisation", "organization"), ("recognise", "recognize"), ("favour", "favor"),
    ("honour", "honor"), ("labour", "labor"), ("judgement", "judgment"), ("acknowledgement", "acknowledgment"), ("catalogue", "catalog"),
    ("programme", "program"), ("practise", "practice"), ("analogue", "analog"), ("artefact", "artifact"), ("authorise", "authorize"),
    ("authorised", "authorized"), ("sub license", "sublicense"), ("non infringement", "noninfringement"), ("copyright owner", "copyright holder"),
    ("per cent", "percent"), ("whilst", "while"), ("wilful", "willful"), ("fulfilment", "fulfillment"), ("initialise", "initialize"), ("https", "http"),
]

# Short notices and short licences in their authors' words; more are a parameter of ``scan``.
WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, '
    "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
    "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
MIT_GRANT = (
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal '
    "in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies "
    "of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
)
MIT_CONDITION = "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
ISC_GRANT = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright "
    "notice and this permission notice appear in all copies."
)
KNOWN = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MIT", f"MIT License\n\nCopyright (c) year holder\n\n{MIT_GRANT}\n\n{MIT_CONDITION}\n\n{WARRANTY}"),
    ("MIT", f"{MIT_GRANT}\n\n{MIT_CONDITION}\n\n{WARRANTY}"),
    ("MIT", MIT_GRANT),
    ("ISC", ISC_GRANT),
    ("ISC", "SPDX-License-Identifier: ISC"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "SPDX-License-Identifier: CC0-1.0"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
]

COPYRIGHT_LINES = r"(?im)^[^\p{L}\p{N}\n]*(copyright\b|\(c\)|©)[^\n]*$"
MAX_BROADCAST_DIGESTS = 100_000


def canonical(text: Column) -> Column:
    """Lower case; copyright lines out; punctuation and white space to single spaces; one spelling for equivalent words."""
    out = F.lower(F.regexp_replace(text, COPYRIGHT_LINES, ""))
    out = F.concat(F.lit(" "), F.regexp_replace(out, r"[^\p{L}\p{N}]+", " "), F.lit(" "))
    for other, word in EQUIVALENT:
        out = F.replace(out, F.lit(f" {other} "), F.lit(f" {word} "))
    return F.trim(out)


def digests(texts: DataFrame) -> DataFrame:
    """licence, digest of the canonical text; ``texts`` has licence and text."""
    out = texts.select("licence", canonical(F.col("text")).alias("c")).filter("c <> ''")
    return out.groupBy(F.md5("c").alias("digest")).agg(F.min("licence").alias("licence"))


def known_texts(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(KNOWN, "licence string, text string")


def units(docs: DataFrame) -> DataFrame:
    """doc_id, unit (text, paragraph or line) and text: the entire text, and its paragraphs and lines if it has several.

    Canonical digests ignore case, punctuation, white space and copyright lines. Null texts have no units.
    """
    doc = docs.select(F.col("doc_id").cast("long"), "text").filter("text IS NOT NULL")
    paragraphs = F.split("text", r"\n[ \t\r]*\n")
    lines = F.split("text", "\n")
    all_units = F.concat(
        F.array(F.struct(F.lit("text").alias("unit"), F.col("text"))),
        F.when(F.size(paragraphs) > 1, F.transform(paragraphs, lambda p: F.struct(F.lit("paragraph").alias("unit"), p.alias("text")))).otherwise(F.array()),
        F.when(F.size(lines) > 1, F.transform(lines, lambda p: F.struct(F.lit("line").alias("unit"), p.alias("text")))).otherwise(F.array()),
    )
    return doc.select("doc_id", F.explode(all_units).alias("u")).select("doc_id", "u.unit", "u.text")


def scan(docs: DataFrame, known: DataFrame) -> DataFrame:
    """doc_id, licence, unit and n for every known licence text that a document holds as a whole unit.

    Digests are broadcast while there are at most MAX_BROADCAST_DIGESTS of them (48 bytes each), else joined by
    shuffle. Repeated doc_ids are counted together; documents without a match, null and empty texts give no row.
    """
    table = digests(known)
    if table.count() <= MAX_BROADCAST_DIGESTS:
        table = F.broadcast(table)
    digested = units(docs).select("doc_id", "unit", F.md5(canonical(F.col("text"))).alias("digest"))
    return digested.join(table, "digest").groupBy("doc_id", "licence", "unit").agg(F.count("*").alias("n"))


def scan_sql() -> str:
    """The same in DuckDB SQL over ``documents``, with the built-in texts."""
    literal = lambda s: "'" + s.replace("'", "''") + "'"
    known = ", ".join(f"({literal(a)}, {literal(b)})" for a, b in KNOWN)

    def canon(c: str) -> str:
        c = f"lower(regexp_replace({c}, {literal(COPYRIGHT_LINES)}, '', 'g'))"
        c = f"' ' || regexp_replace({c}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g') || ' '"
        for other, word in EQUIVALENT:
            c = f"replace({c}, {literal(f' {other} ')}, {literal(f' {word} ')})"
        return f"trim({c}, ' ')"

    paragraphs = r"regexp_split_to_array(text, '\n[ \t\r]*\n')"
    return f"""
WITH known(licence, text) AS (VALUES {known}),
table_ AS (SELECT md5(c) AS digest, min(licence) AS licence FROM (SELECT licence, {canon('text')} AS c FROM known) WHERE c <> '' GROUP BY 1),
units AS (
  SELECT doc_id, 'text' AS unit, text FROM documents WHERE text IS NOT NULL
  UNION ALL SELECT doc_id, 'paragraph', unnest({paragraphs}) FROM documents WHERE text IS NOT NULL AND len({paragraphs}) > 1
  UNION ALL SELECT doc_id, 'line', unnest(string_split(text, chr(10))) FROM documents WHERE text IS NOT NULL AND contains(text, chr(10)))
SELECT doc_id, licence, unit, count(*) AS n FROM (SELECT doc_id, unit, md5({canon('text')}) AS digest FROM units) JOIN table_ USING (digest) GROUP BY ALL"""
