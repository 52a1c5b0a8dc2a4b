import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from millrace.operators import governance as G
from millrace.operators import quality as Q


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def frame(spark):
    return spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, "c"), (None, "c")], "id int, kind string")


def test_checks_return_failing_rows(spark):
    df = frame(spark)
    assert Q.not_null(df, "kind").count() == 1
    assert rows(Q.unique(df, "id")) == [(1, 2)]  # nulls are not repeats
    assert rows(Q.accepted_values(df, "kind", ["a", "b"])) == [(None, "c"), (None, "c")]
    parent = spark.createDataFrame([(1,), (1,), (None,)], "key int")
    assert rows(Q.relationships(df, "id", parent, "key")) == [(2, None)]
    assert rows(Q.orphan_keys(df, "id", parent, "key")) == [(2, 1)]
    assert Q.not_null(df.limit(0), "kind").isEmpty() and Q.unique(df.limit(0), "id").isEmpty()


def test_time_checks(spark):
    now = dt.datetime(2024, 1, 1, 12)
    df = spark.createDataFrame([(now - dt.timedelta(hours=h), now) for h in (-1, 0, 3)], "a timestamp_ntz, b timestamp_ntz")
    assert Q.not_after(df, "a", Q.run_time(now)).count() == 1
    assert Q.not_after(df, "a").isEmpty()
    assert Q.ordered(df, "a", "b").count() == 1


@pytest.mark.parametrize(("minutes", "status"), [(30, "pass"), (60, "pass"), (61, "warn"), (120, "warn"), (121, "error")])
def test_freshness(spark, minutes, status):
    now = dt.datetime(2024, 1, 1, 12)
    df = spark.createDataFrame([(now - dt.timedelta(minutes=minutes),), (dt.datetime(2020, 1, 1),)], "ts timestamp_ntz")
    row = Q.freshness(df, "ts", Q.run_time(now)).first()
    assert (row["age_seconds"], row["status"]) == (minutes * 60, status)
    assert Q.freshness(df.limit(0), "ts", Q.run_time(now)).first()["status"] == "error"


def test_record_validation(spark):
    raw = spark.createDataFrame(
        [("My First Blog", None, "true"), ("My First Blog", "d", "Yeah"), (None, "d", "0"), ("t", "d", None)],
        "title string, description string, is_active string",
    )
    fields = [Q.Field("title", "string"), Q.Field("description", "string", True), Q.Field("is_active", "boolean")]
    checked = Q.validate(raw, fields)
    assert rows(Q.valid(checked)) == [("My First Blog", None, True)]
    errors = sorted(r["errors"] for r in Q.rejected(checked).collect())
    assert errors == [["is_active: field required"], ["is_active: not a boolean"], ["title: field required"]]
    number = Q.validate(spark.createDataFrame([("x",), ("5",)], "n string"), [Q.Field("n", "int")])
    assert rows(number.select("n", F.size("errors"))) == [(5, 0), (None, 1)]


def test_suite_loses_no_check(spark):
    df = frame(spark)
    absent = [Q.Check("t", "nope", "not_null"), Q.Check("t", "nope", "unique"), Q.Check("t", "id", "unique")]
    found = {(r["column_name"], r["check_name"]): (r["failures"], r["passed"]) for r in Q.run_suite({"t": df}, absent).collect()}
    assert found == {("nope", "not_null"): (1, False), ("nope", "unique"): (1, False), ("id", "unique"): (1, False)}
    parent = Q.Check("t", "id", "relationships", parent=("elsewhere", "id"))
    for lost in (Q.Check("elsewhere", "id", "not_null"), Q.Check("t", "id", "notnull"), Q.Check("t", "id", "relationships"), parent):
        with pytest.raises(ValueError, match="unknown kinds|not given|no parent"):
            Q.run_suite({"t": df}, [Q.Check("t", "id", "not_null"), lost])
    with pytest.raises(ValueError, match="no checks"):
        Q.run_suite({"t": df}, [])
    free = Q.Check("t", "id", "positive", predicate="id <= 1")
    assert Q.run_suite({"t": df}, [free]).first()["failures"] == 2


def test_suite_has_one_row_per_check(spark):
    tables = {"child": frame(spark), "parent": spark.createDataFrame([(1,)], "key int")}
    checks = [
        Q.Check("child", "kind", "not_null"),
        Q.Check("child", "id", "unique"),
        Q.Check("child", "kind", "accepted_values", values=("a", "b", "c")),
        Q.Check("child", "id", "relationships", parent=("parent", "key")),
        Q.Check("child", "nope", "column_exists"),
        Q.Check("child", "id", "column_type", values=("int",)),
        Q.Check("child", "kind", "short", predicate="length(kind) > 0"),
        Q.Check("parent", "key", "unique"),
    ]
    result = {(r["column_name"], r["check_name"]): (r["failures"], r["passed"]) for r in Q.run_suite(tables, checks).collect()}
    assert result == {
        ("kind", "not_null"): (1, False), ("id", "unique"): (1, False), ("kind", "accepted_values"): (0, True),
        ("id", "relationships"): (1, False), ("nope", "column_exists"): (1, False), ("id", "column_type"): (0, True),
        ("kind", "short"): (4, False), ("key", "unique"): (0, True),
    }


def test_model_unit_test(spark):
    from millrace.functions.text import is_email

    given = spark.createDataFrame([("cool@example.com",), ("coolmail.com",)], "email string")
    expected = spark.createDataFrame([("cool@example.com",)], "email string")
    Q.expect_rows(given.filter(is_email(F.col("email"))), expected)
    with pytest.raises(Exception, match="DIFFERENT_ROWS|[Dd]iff"):
        Q.expect_rows(given, expected)


NAMES = {
    "email": "PII_MASKING", "Zip_Code": "PII_MASKING", "order_cost": "FINANCIAL_MASKING", "product_name": None,
    "shipping_service": "CREDENTIAL_MASKING", "quantity": None, "passport_no": "IDENTIFIER_MASKING",
    "tax_id": "FINANCIAL_MASKING", "blood_type": "HEALTH_MASKING", "PRODUCT_NAME": None, "product_names": "PII_MASKING",
}


def test_classification_by_substring(spark):
    assert {n: G.category_of(n) for n in NAMES} == NAMES
    columns = spark.createDataFrame([(n,) for n in NAMES], "column_name string")
    assert {r["column_name"]: r["category"] for r in G.classify(columns).collect()} == NAMES


def test_masking_covers_nulls_and_keeps_the_rest(spark):
    df = spark.createDataFrame([("a@b", 1.0, 3), (None, None, None)], "email string, price double, quantity int")
    assert rows(G.mask(df)) == [
        ("MASKED_PII_MASKING", "MASKED_FINANCIAL_MASKING", 3), ("MASKED_PII_MASKING", "MASKED_FINANCIAL_MASKING", None)
    ]
    sampled = G.sample(spark.range(500), ["id"])
    assert sampled.count() == 100 and dict(sampled.dtypes) == {"id": "string"}


def test_catalogue_with_descriptions(spark):
    tables = {"users": spark.createDataFrame([], "user_id string, age int")}
    listed = G.catalogue(spark, tables, {("users", "age"): "Age in years"})
    assert rows(listed.select("table_name", "column_name", "data_type", "description")) == [
        ("users", "age", "int", "Age in years"), ("users", "user_id", "string", None)
    ]
    joined = G.with_descriptions(listed, listed.filter("description is not null"))
    assert rows(joined.select("column_name", "description")) == rows(listed.select("column_name", "description"))


MODELS = [
    {"name": "users", "columns": [{"name": "id", "data_tests": ["not_null", "unique"]}, {"name": "email"}]},
    {"name": "empty"},
]


def declared(spark, models):
    return spark.createDataFrame([(json.dumps(model),) for model in models], "value string")


def test_unreadable_models_fail(spark):
    broken = spark.createDataFrame([('{"name": "m", "columns": 7}',)], "value string")
    with pytest.raises(Exception, match="FAILFAST|MALFORMED"):
        G.captured_schema(broken).collect()


def test_schema_drift_and_freeze(spark):
    before = G.captured_schema(declared(spark, MODELS))
    grown = G.captured_schema(declared(spark, [*MODELS, {"name": "new", "columns": [{"name": "a"}, {"name": "b"}]}]))
    drift = {r["level"]: tuple(r)[1:] for r in G.schema_drift(before, grown).collect()}
    assert drift == {"model": (2, 3, 1, 0), "column": (3, 5, 2, 0)}
    assert rows(G.changed_columns(before, grown)) == [("new", "a", "added"), ("new", "b", "added")]
    G.require_kept_schema(before, grown)
    with pytest.raises(G.DriftError, match="removed: 2 removed") as lost:
        G.require_kept_schema(grown, before)
    assert rows(lost.value.changes) == [("new", "a", "removed"), ("new", "b", "removed")]
    same = {r["level"]: tuple(r)[1:] for r in G.schema_drift(before, before).collect()}
    assert same == {"model": (2, 2, 0, 0), "column": (3, 3, 0, 0)}


def test_check_drift_and_freeze(spark):
    before = G.captured_checks(declared(spark, MODELS))
    assert rows(before) == [("users", "id", "not_null"), ("users", "id", "unique")]
    typed = {"expect_type": {"column_type": "string"}}
    later = G.captured_checks(declared(spark, [{"name": "users", "columns": [{"name": "id", "tests": ["not_null", typed]}]}]))
    assert {(r["test"], r["status"]) for r in G.changed_checks(before, later).collect()} == {
        ("unique", "removed"), ('{"expect_type":{"column_type":"string"}}', "added")
    }
    orders = [[{"range": {"min": 1, "max": 2}}], [{"range": {"max": 2, "min": 1}}]]
    one, other = (G.captured_checks(declared(spark, [{"name": "m", "columns": [{"name": "c", "tests": t}]}])) for t in orders)
    G.require_same_checks(one, other)
    G.require_same_checks(before, before)
    with pytest.raises(G.DriftError):
        G.require_same_checks(before, later)


def test_run_report(spark, tmp_path):
    report = G.run_report([("sample", spark.range(3)), ("verify", None)])
    assert rows(report) == [("sample", "SUCCESS", 3, 1), ("verify", "UNKNOWN", None, None)]
    G.write_report(report, str(tmp_path / "report"))
    assert spark.read.json(str(tmp_path / "report")).count() == 2


def test_repeated_keys_of_many_sets_in_one_scan(spark):
    rows = [(1, "a", 0.0, None), (1, "b", -0.0, "x"), (2, "a", 1.5, None), (None, "a", 1.5, "x"), (3, None, None, "y")]
    df = spark.createDataFrame(rows, "k int, name string, part double, note string")
    sets = [["k"], ["name"], ["part"], ["k", "name"], ["note"], ["name", "note"]]
    found = Q.repeated_keys(df, sets)
    got = sorted((r["set_no"], r["n_records"]) for r in found.collect())
    expected = sorted((i, r["n_records"]) for i, columns in enumerate(sets) for r in Q.unique(df, *columns).collect())
    assert got == expected == [(0, 2), (1, 3), (2, 2), (2, 2), (4, 2)]
    plan = Q.repeated_keys(df, sets)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert Q.repeated_keys(df.limit(0), sets).collect() == []


def test_suite_reads_a_table_twice_however_many_keys_it_checks(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, 2, 3), (1, 5, 6)], "a int, b int, c int").write.parquet(path)
    table = spark.read.parquet(path)
    suite = Q.run_suite({"t": table}, [Q.Check("t", c, kind) for c in "abc" for kind in ("unique", "not_null")])
    assert suite._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 2
    assert {(r["column_name"], r["check_name"]): r["failures"] for r in suite.collect() if r["failures"]} == {("a", "unique"): 1}


def test_row_differences_count_repeats_and_nulls(spark):
    model = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "c")], "k int, v string")
    expected = spark.createDataFrame([("a", 1), (None, 2), ("d", 3)], "v string, k int")
    assert sorted(tuple(r) for r in Q.row_differences(model, expected).collect()) == [(1, "a", 2, 1), (3, "c", 1, 0), (3, "d", 0, 1)]
    assert Q.row_differences(model, model).collect() == []
