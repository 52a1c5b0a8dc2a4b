import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions import dates, jsonpath, nested, text, vectors
from millrace.schemas import struct


def column(spark, rows, ddl, expression):
    """Values of one expression over rows of inline data, in order."""
    df = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], f"_i int, {ddl}")
    return [row[0] for row in df.orderBy("_i").select(expression).collect()]


def test_bucket_label_edges(spark):
    ages = [30, 31, 40, 41, 50, 51, 60, 61, None]
    labels = column(spark, [(a,) for a in ages], "age int", text.bucket_label(F.col("age")))
    assert labels == ["<=30", "31-40", "31-40", "41-50", "41-50", "51-60", "51-60", "61+", None]


def test_bucket_label_as_python_udf_agrees(spark):
    def label(age):
        if age is None:
            return None
        for low, high in ((0, 30), (31, 40), (41, 50), (51, 60)):
            if age <= high:
                return "<=30" if high == 30 else f"{low}-{high}"
        return "61+"

    ages = spark.range(0, 100).select(F.col("id").cast("int").alias("age"))
    both = ages.select(text.bucket_label(F.col("age")).alias("a"), F.udf(label, "string")("age").alias("b"))
    assert both.filter("a != b").count() == 0


def test_name_parts(spark):
    rows = [("Ann Lee",), ("  Bo   Chan ",), ("Solo",), (None,)]
    assert column(spark, rows, "name string", text.name_part(F.col("name"), 0)) == ["Ann", "Bo", "Solo", None]
    assert column(spark, rows, "name string", text.name_part(F.col("name"), 1)) == ["Lee", "Chan", None, None]


def test_email_pattern(spark):
    rows = [("cool@example.com",), ("coolmail.com",), ("a@b",), (None,)]
    assert column(spark, rows, "e string", text.is_email(F.col("e"))) == [True, False, False, None]


def test_contains_ignores_case(spark):
    rows = [("Hello",), ("bye",), (None,)]
    assert column(spark, rows, "t string", text.contains_ignoring_case(F.col("t"), "HELL")) == [True, False, None]


def test_fallback_and_plain_number(spark):
    rows = [(" ", "7"), ("1,250,000 THB", "7"), (None, " 8 ")]
    picked = text.first_non_empty(F.col("a"), F.col("b"))
    assert column(spark, rows, "a string, b string", picked) == ["7", "1,250,000 THB", "8"]
    assert column(spark, rows, "a string, b string", text.plain_number(picked, [" THB"])) == ["7", "1250000", "8"]


def test_ratio_by_zero_is_null(spark):
    assert column(spark, [(1, 0), (1, 4), (0, 0)], "a int, b int", text.ratio(F.col("a"), F.col("b"))) == [None, 0.25, None]


def test_money_and_object_name(spark):
    assert column(spark, [(1.743,), (None,)], "h double", text.money(F.col("h"))) == [1.74, None]
    named = text.object_name(F.col("t"), F.col("s"))
    assert column(spark, [("T1", 5)], "t string, s bigint", named) == ["T1-5.json"]


def test_london_text_follows_clock_changes(spark):
    def millis(*when):
        return str(int(dt.datetime(*when, tzinfo=dt.timezone.utc).timestamp() * 1000))

    rows = [
        (millis(2026, 3, 29, 0, 59, 59),),
        (millis(2026, 3, 29, 1, 0, 0),),
        (millis(2026, 10, 25, 0, 59, 59),),
        (millis(2026, 10, 25, 1, 0, 0),),
        (millis(2024, 1, 5)[:-3] + "250",),
        (None,),
        ("soon",),
    ]
    assert column(spark, rows, "ms string", dates.london_text(dates.instant_from_millis(F.col("ms")))) == [
        "2026-03-29 00:59:59+00:00",
        "2026-03-29 02:00:00+01:00",
        "2026-10-25 01:59:59+01:00",
        "2026-10-25 01:00:00+00:00",
        "2024-01-05 00:00:00.250000+00:00",
        None,
        None,
    ]


def test_date_formats(spark):
    row = spark.sql("SELECT DATE'2021-02-03' AS d").select(
        dates.slash_date(F.col("d")), dates.month_name(F.col("d")), dates.compact_date(F.col("d"))
    )
    assert tuple(row.first()) == ("2021/02/03/", "February 2021", "20210203")


def test_month_bounds_cross_the_year():
    assert dates.month_bounds(2021, 12) == (dt.datetime(2021, 12, 1), dt.datetime(2022, 1, 1))
    assert dates.day_bounds("2020-02-28") == (dt.datetime(2020, 2, 28), dt.datetime(2020, 2, 29))


PERSON, FRUITS = '{ "name" : "Jakob", "age" : "6" }', '{"fruits": ["apple", "banana"]}'


@pytest.mark.parametrize(
    ("body", "path", "fragment", "scalar"),
    [
        (PERSON, "$.name", '"Jakob"', "Jakob"),
        (PERSON, "$.age", '"6"', "6"),
        (FRUITS, "$.fruits", '["apple","banana"]', None),
        (FRUITS, "$.missing", None, None),
        ('{"n": 6, "t": true, "z": null}', "$.n", "6", "6"),
        ('{"n": 6, "t": true, "z": null}', "$.t", "true", "true"),
        ('{"n": 6, "t": true, "z": null}', "$.z", None, None),
        ('{"o": {"z": 1, "a": "[x]"}}', "$.o", '{"z":1,"a":"[x]"}', None),
        ('{"o": {"z": 1, "a": "[x]"}}', "$.o.a", '"[x]"', "[x]"),
        ("no json", "$.o", None, None),
        (None, "$.o", None, None),
    ],
)
def test_json_accessors(spark, body, path, fragment, scalar):
    df = spark.createDataFrame([(body,)], "body string")
    both = df.select(jsonpath.json_query(F.col("body"), path), jsonpath.json_value(F.col("body"), path)).first()
    assert tuple(both) == (fragment, scalar)
    added = jsonpath.with_json(df, "body", {"q": path}, {"v": path})
    assert added.columns == ["body", "q", "v"]
    assert tuple(added.first())[1:] == (fragment, scalar)


def test_flatten_names_leaves_by_path(spark):
    df = spark.sql("SELECT struct('on' AS debug, struct('T' AS title, 5 AS width) AS window) AS widget, 1 AS n")
    flat = nested.flatten(df)
    assert flat.columns == ["widget.debug", "widget.window.title", "widget.window.width", "n"]
    assert tuple(flat.first()) == ("on", "T", 5, 1)


def test_batch_explode_and_quarantine(spark):
    batches = spark.createDataFrame([(1, '[{"a":1},{"a":2}]'), (2, "[]"), (3, "broken"), (4, None)], "id int, b string")
    exploded = nested.explode_json_batch(batches, "b", struct("a int")).select("id", "message.a")
    assert sorted(map(tuple, exploded.collect())) == [(1, 1), (1, 2)]
    texts = spark.createDataFrame([(1, '{"a":1}'), (2, '{"a":'), (3, "[1]"), (4, None), (5, "{}")], "id int, t string")
    good, bad = nested.parse_or_quarantine(texts, "t", struct("a int"))
    assert sorted(map(tuple, good.collect()), key=str) == [(1, 1), (5, None)]
    assert sorted(row["id"] for row in bad.collect()) == [2, 3, 4]


def test_arrays_and_structs(spark):
    history = spark.sql(
        """SELECT array(named_struct('status', 'current', 'address', 'London', 'postcode', 'ABC123D'),
           named_struct('status', 'birth', 'address', 'New York', 'postcode', 'SHI747H')) AS address_history"""
    )
    assert [r.addr.address for r in history.select(F.explode("address_history").alias("addr")).collect()] == [
        "London",
        "New York",
    ]
    assert history.select(F.inline("address_history")).columns == ["status", "address", "postcode"]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(*[st.floats(-100, 100, width=32)] * 3), min_size=2, max_size=2))
def test_vector_functions_match_plain_arithmetic(spark, pair):
    a, b = pair
    row = spark.createDataFrame([(list(a), list(b))], "a array<double>, b array<double>").select(
        vectors.cosine_similarity(F.col("a"), F.col("b")), vectors.euclidean_distance(F.col("a"), F.col("b"))
    ).first()
    distance = sum((x - y) ** 2 for x, y in zip(a, b)) ** 0.5
    lengths = (sum(x * x for x in a) * sum(y * y for y in b)) ** 0.5
    assert row[1] == pytest.approx(distance)
    if lengths == 0:
        assert row[0] is None
    elif lengths > 1e-6:
        assert row[0] == pytest.approx(sum(x * y for x, y in zip(a, b)) / lengths, abs=1e-6)


def test_vectors_of_different_length_give_null(spark):
    row = spark.sql("SELECT array(1D, 2D) AS a, array(1D) AS b").select(
        vectors.cosine_similarity(F.col("a"), F.col("b")), vectors.euclidean_distance(F.col("a"), F.col("b"))
    )
    assert tuple(row.first()) == (None, None)


def test_every_batch_is_messages_or_one_quarantine_row(spark):
    texts = ['[{"a":1},{"a":2}]', "[]", "broken", None, '[{"a":1}, 5]', '{"a":1}', "[null]", '[{"a":"x"}]', '[{"a":1}', ""]
    batches = spark.createDataFrame(list(enumerate(texts)), "id int, b string")
    good, bad = nested.split_json_batches(batches, "b", struct("a int"))
    assert sorted(tuple(r) for r in good.select("id", "message.a").fillna(-1).collect()) == [(0, 1), (0, 2), (7, -1)]
    assert sorted((r["id"], r["b"]) for r in bad.collect()) == [(k, t) for k, t in enumerate(texts) if k not in (0, 7)]
