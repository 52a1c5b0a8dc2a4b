"""Licence texts found by the digest of their canonical form.

Case, punctuation, copyright lines and equivalent spellings do not change what a licence says. They are removed
from the known texts and from the scanned ones in the same way; then an entire text is a known licence if the
digests of both are equal, which is one hash join. Entire texts are the whole document and each of its lines
(a one-line notice).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# How a copyright line begins, after A-Z are lower-cased: the word or its sign, followed by the other one or by a year. A
# wrapped line of a text that opens with the word alone, or a third item "(c)", is none.
_GAP, _YEAR = r"[^\p{L}\p{N}©(]*", r"[12][0-9]{3}|[<\[{](year|yyyy)"
COPYRIGHT = rf"^{_GAP}(copyright{_GAP}(\(c\)|©|{_YEAR})|(\(c\)|©){_GAP}(copyright|{_YEAR}))"
OTHER = r"[^\p{L}\p{N}]+"  # what separates words

# Spellings that licence matching treats as equal, each with the one it is replaced by.
SPELLINGS = [
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("sublicence", "sublicense"),
    ("favour", "favor"), ("fulfil", "fulfill"), ("fulfilment", "fulfillment"), ("initialise", "initialize"),
    ("judgement", "judgment"), ("organisation", "organization"), ("merchantibility", "merchantability"),
    ("noncommercial", "non commercial"), ("per cent", "percent"), ("copyright holder", "copyright owner"),
    ("wilful", "willful"), ("v2 0", "version 2 0"), ("v3", "version 3"), ("gnu gpl", "gnu general public license"),
]

# Public licence texts and notices, with their public identifiers.
LICENSES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License").'),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    (
        "MIT",
        "MIT License\n\nCopyright (c) <year> <holder>\n\nPermission is hereby granted, free of charge, to any person "
        'obtaining a copy of this software and associated documentation files (the "Software"), to deal in the '
        "Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
        "furnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission "
        "notice shall be included in all copies or substantial portions of the Software.\n\nTHE SOFTWARE IS PROVIDED "
        '"AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
        "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT "
        "OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE "
        "SOFTWARE.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n\n"
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE '
        "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR "
        "ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, "
        "DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
        "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
]
BROADCAST_TEXTS = 10_000  # a longer list of known texts is joined by a shuffle


def known_licenses(spark: SparkSession) -> DataFrame:
    """``license_id, text`` of the licences listed here; any table of that form can be used instead."""
    return spark.createDataFrame(LICENSES, "license_id string, text string")


def _spaced(words: str) -> str:
    return " " + words.replace(" ", "  ") + " "


def canonical_lines(text: Column) -> Column:
    """The lines of a text with copyright lines emptied, A-Z lower-cased, words joined by single spaces and
    spellings made equal; null for null."""

    def canonical(line: Column) -> Column:
        # Two blanks between words, so that neighbours share none and each is replaced.
        words = F.concat(F.lit(" "), F.regexp_replace(F.translate(line, UPPER, LOWER), OTHER, "  "), F.lit(" "))
        for spelling, usual in SPELLINGS:
            words = F.replace(words, F.lit(_spaced(spelling)), F.lit(_spaced(usual)))
        return F.trim(F.regexp_replace(words, " +", " "))

    def line(one: Column) -> Column:
        return F.when(F.translate(one, UPPER, LOWER).rlike(COPYRIGHT), F.lit("")).otherwise(canonical(one))

    return F.transform(F.split(text, "\n", -1), line)


def _whole(lines: Column) -> Column:
    return F.array_join(F.filter(lines, lambda line: line != ""), " ")


def scan_licenses(
    docs: DataFrame, licenses: DataFrame, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Documents and lines of documents that are a known licence text.

    One row per match: ``doc_id, scope`` (document or line), ``line_no`` (0 for the document, else from 1),
    ``license_id, digest`` (SHA-256 of the canonical text). A document that is one line matches in both scopes.
    A text that is null, empty or all copyright lines matches nothing; known texts with equal digests and ids are
    one, with different ids they all match. Repeated rows match each for itself; a null doc_id is returned as
    null. Other columns are ignored; empty tables give an empty result.
    """
    digests = licenses.select("license_id", F.sha2(_whole(canonical_lines(F.col("text"))), 256).alias("digest"))
    digests = digests.where(F.col("digest") != F.sha2(F.lit(""), 256)).distinct()
    if licenses.limit(BROADCAST_TEXTS + 1).count() <= BROADCAST_TEXTS:
        digests = F.broadcast(digests)
    lines = docs.select(F.col(doc_id).alias("doc_id"), canonical_lines(F.col(text)).alias("lines"))
    whole = F.array(_whole(F.col("lines")))
    units = lines.select("doc_id", F.posexplode(F.concat(whole, F.col("lines"))).alias("line_no", "line"))
    units = units.where(F.col("line") != "").select(
        "doc_id",
        F.when(F.col("line_no") == 0, F.lit("document")).otherwise(F.lit("line")).alias("scope"),
        F.col("line_no").cast("long").alias("line_no"),
        F.sha2("line", 256).alias("digest"),
    )
    return units.join(digests, "digest").select("doc_id", "scope", "line_no", "license_id", "digest")


def oracle() -> str:
    """The same matches in SQL, over the tables ``documents`` and the licences listed here."""

    def quoted(value: str) -> str:
        return "'" + value.replace("'", "''") + "'"

    words = f"' ' || regexp_replace(translate(l, '{UPPER}', '{LOWER}'), '{OTHER}', '  ', 'g') || ' '"
    for spelling, usual in SPELLINGS:
        words = f"replace({words}, '{_spaced(spelling)}', '{_spaced(usual)}')"
    words = f"regexp_replace({words}, ' +', ' ', 'g')"
    rows = ", ".join(f"({quoted(name)}, {quoted(text)})" for name, text in LICENSES)
    return f"""
    WITH texts AS (
        SELECT doc_id, NULL AS license_id, text FROM documents
        UNION ALL SELECT NULL, * FROM (VALUES {rows}) v(license_id, text)
    ), split AS (
        SELECT doc_id, license_id, list_transform(string_split(text, chr(10)),
            lambda l: CASE WHEN regexp_matches(translate(l, '{UPPER}', '{LOWER}'), '{COPYRIGHT}') THEN ''
                ELSE trim({words}) END) AS lines
        FROM texts
    ), whole AS (
        SELECT *, array_to_string(list_filter(lines, lambda l: l <> ''), ' ') AS joined FROM split
    ), known AS (
        SELECT DISTINCT license_id, sha256(joined) AS digest FROM whole WHERE license_id IS NOT NULL
    ), units AS (
        SELECT doc_id, 'document' AS scope, CAST(0 AS BIGINT) AS line_no, joined AS line FROM whole
        WHERE license_id IS NULL
        UNION ALL
        SELECT doc_id, 'line', n, line FROM (
            SELECT doc_id, unnest(range(1, len(lines) + 1)) AS n, unnest(lines) AS line FROM whole
            WHERE license_id IS NULL)
    )
    SELECT doc_id, scope, line_no, known.license_id, digest
    FROM units JOIN known ON sha256(line) = digest WHERE line <> ''
    """
