"""Dates and telephone numbers as they are written outside the United States."""

import datetime
import re

import pytest

pytest.importorskip("millrace.llm")

from millrace.llm import pseudonyms  # noqa: E402


def pseudonymised(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r[1:] for r in sorted(pseudonyms.pseudonymise(docs, pseudonyms.KEY).collect())]


def test_dates_of_other_forms(spark):
    values = [
        "2021-03-04", "03/04/2021", "3/4/2021", "03-04-2021", "04.03.2021", "4.3.2021", "23/12/2020", "23-12-2020", "31/1/1999",
        "23.12.2020", "2020-12-23",
    ]
    new = [text for text, n in pseudonymised(spark, values) if n == 1]
    assert len(new) == len(values) and not set(new) & set(values)
    day = datetime.date.fromisoformat(new[0])
    assert new[1] == f"{day:%m/%d/%Y}" and new[2] == f"{day.month}/{day.day}/{day.year}" and new[3] == f"{day:%m-%d-%Y}"
    assert new[4] == f"{day:%d.%m.%Y}" and new[5] == f"{day.day}.{day.month}.{day.year}"
    assert new[7] == new[6].replace("/", "-") and datetime.datetime.strptime(new[9], "%d.%m.%Y").date().isoformat() == new[10]
    for one in (new[6], new[8]):
        assert datetime.datetime.strptime(one, "%d/%m/%Y").day > 12
    stays = ["13/31/1999", "31/02/2020", "31.02.2020", "12.25.1999", "1.2.2020.5", "3.1.2.2020", "2021-02-30T10:15", "2021-03-04Total"]
    assert pseudonymised(spark, stays) == [(text, 0) for text in stays]
    around = [("2021-03-04T10:15:00Z", new[0] + "T10:15:00Z"), ("am 04.03.2021.", f"am {new[4]}."), ("(23/12/2020)", f"({new[6]})")]
    assert pseudonymised(spark, [text for text, _ in around]) == [(text, 1) for _, text in around]


def test_days_after_the_twelfth_are_permuted_among_themselves(spark):
    days = [datetime.date(1700, 1, 1) + datetime.timedelta(n) for n in range(189 * 773)]
    late = [day for day in days if day.day > 12]
    from pyspark.sql import functions as F

    rows = spark.range(len(late)).select("id", pseudonyms._late_day(F.col("id")).alias("day")).toPandas()
    assert len(late) == 9 * 9833 and dict(zip(rows.id, rows.day)) == dict(enumerate(late))
    some = [f"{day:%d/%m/%Y}" for day in late[::17]]
    new = [text for text, n in pseudonymised(spark, some) if n == 1]
    assert len(new) == len(set(new)) == len(some) and all(int(text[:2]) > 12 for text in new)


def test_international_telephone_numbers(spark):
    values = [
        "+49 30 1234567", "+49301234567", "+49 (0)30 1234567", "+49 (30) 123-4567", "+33 1 23 45 67 89", "+33 1.23.45.67.89",
        "+34 612 345 678", "+7 495 123-45-67", "+15551234567", "+1 555 123 4567", "+353 1 234 5678", "+44 20 7946 0958",
    ]
    found = pseudonymised(spark, [f"é {v}, {v}!" for v in values])
    new = []
    for value, (text, n) in zip(values, found):
        got = re.fullmatch(r"é (.*), (.*)!", text)
        assert n == 2 and got[1] == got[2] != value and re.sub("[0-9]", "0", got[1]) == re.sub("[0-9]", "0", value)
        code = re.match(r"\+(?:[17]|353|[34][0-9])(?: \(0\))?", value)[0]
        assert got[1].startswith(code)
        new.append(got[1])
    plain = [re.sub("[^0-9]", "", text.replace("(0)", "")) for text in new]
    assert plain[0] == plain[1] == plain[2] == plain[3] and plain[4] == plain[5] and plain[8] == plain[9]
    stays = ["+999 1234 567", "+49 1234", "+1 555 1234", "+123456789012345678901", "a+49301234567"]
    assert pseudonymised(spark, stays) == [(text, 0) for text in stays]
    both = pseudonymised(spark, ["+33 1 23 45 67 89 23/12/2020 +33 1 23 45 67 89 1.2.3.4 +49 30 1234567 555-123-4567", "23/12/2020"])
    assert both[0][1] == 6 and both[0][0].startswith(f"{new[4]} {both[1][0]} {new[4]} ")
