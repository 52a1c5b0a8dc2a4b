"""Known licence texts in every wrapping, neighbouring spellings, and lines that only look like copyright lines."""

import re
import textwrap

import pytest

pytest.importorskip("millrace.llm")

from pyspark.sql import functions as F  # noqa: E402

from millrace.llm.license_scan import canonical_lines, known_licenses, scan_licenses  # noqa: E402


def wrapped(text, width):
    return "\n\n".join(textwrap.fill(part, width, break_long_words=False) for part in text.split("\n\n"))


def test_every_wrapping_of_a_known_text_matches(spark):
    known = [(r["license_id"], r["text"]) for r in known_licenses(spark).collect() if len(r["text"]) > 400]
    assert {name for name, _ in known} == {"MIT", "ISC"}
    rows = [(f"{name} {width}", wrapped(text, width)) for name, text in known for width in range(40, 101)]
    assert any(re.search("(?m)^COPYRIGHT HOLDERS", text) for _, text in rows)
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    found = scan_licenses(docs, known_licenses(spark)).where("scope = 'document'").collect()
    assert sorted((r["doc_id"], r["license_id"]) for r in found) == sorted((k, k.split()[0]) for k, _ in rows)


def test_neighbouring_spellings_and_copyright_lines(spark):
    cases = {
        "Licence licence, LICENCE": "license license license",
        "copyright holder copyright holder": "copyright owner copyright owner",
        "sublicence v2.0": "sublicense version 2 0",
        "copyright holders be liable": "copyright holders be liable",
        "(c) the third condition": "c the third condition",
        "Copyright (c) 2020 Somebody": "",
        " * Copyright 1999-2003, Somebody": "",
        "(C) 2020 Somebody": "",
        "© 2021 Somebody": "",
        "(c) Copyright Somebody": "",
        "Copyright [yyyy] [name]": "",
        "": "",
    }
    lines = spark.createDataFrame([(c,) for c in cases], "text string").select("text", canonical_lines(F.col("text"))[0])
    assert dict(map(tuple, lines.collect())) == cases
    long = spark.createDataFrame([(1, "word " * 400_000 + "\nReleased under the MIT licence.")], "doc_id long, text string")
    assert [r["line_no"] for r in scan_licenses(long, known_licenses(spark)).collect()] == [2]
