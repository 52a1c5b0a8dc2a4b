import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.dates import moment
from millrace.operators import history as H
from millrace.operators import lake as lake_module
from millrace.operators.day_range import Days, implied_days
from millrace.operators.lake import ConstraintError, LakeTable, joined_ranges
from millrace.session import scratch

READINGS = "meter string, slot bigint, taken timestamp_ntz, litres bigint, state string"
SCHEMA = "meter string NOT NULL, slot bigint NOT NULL, taken timestamp_ntz NOT NULL, litres bigint NOT NULL, state string"
COLUMNS = ["meter", "slot", "taken", "litres", "state"]
KEYS = ["meter", "slot"]


def at(day, hour=0):
    return dt.datetime(2023, 11, day, hour)


# Slots 1 and 2 are read on the 1st, 3 to 5 on the 5th, 6 to 8 on the 9th, alternating between two meters.
FIRST = [("ab"[n % 2], n, at(1 + n // 3 * 4, n), 10 * n, None) for n in range(1, 9)]
ALL = [1, 2, 3, 4, 5, 6, 7, 8]


@pytest.fixture
def readings(spark):
    lake = LakeTable.create(spark, scratch(spark, "readings"), T.StructType.fromDDL(SCHEMA), KEYS, "taken")
    lake.append(spark.createDataFrame(FIRST, READINGS))
    return lake


def given(spark, *rows):
    return spark.createDataFrame(list(rows), READINGS)


def ids(df):
    return sorted(row["slot"] for row in df.collect())


def per_day(lake):
    return {row["created_at_day"].day: row["record_count"] for row in lake.partitions().collect()}


def test_scans(readings):
    assert ids(readings.scan(F.col("meter") == "a")) == [2, 4, 6, 8]
    assert [tuple(r) for r in readings.scan("slot = 6", ["litres", "meter"]).collect()] == [(60, "a")]
    assert ids(readings.scan(F.col("state").isNotNull())) == []
    assert ids(readings.scan(F.col("litres").between(20, 40))) == [2, 3, 4]
    assert ids(readings.scan_between(at(2), at(9, 7))) == [3, 4, 5, 6]
    assert readings.scan().columns == COLUMNS


def partition_filters(df):
    return df._jdf.queryExecution().toString().split("PartitionFilters: [")[1].split("]")[0]


def test_any_time_filter_prunes_days(readings):
    for where in ("taken >= '2023-11-05' AND taken < '2023-11-06' AND meter = 'a'", F.col("taken") > moment(at(5))):
        assert "created_at_day" in partition_filters(readings.scan(where))
    assert len(readings.scan("taken < '2023-11-05'").inputFiles()) == 1
    assert ids(readings.scan("taken < '2023-11-05 04:00:00'")) == [1, 2, 3]


SINCE, BEFORE = dt.date(2023, 11, 5), dt.date(2023, 11, 7)
MANY = ", ".join(f"timestamp_ntz'2023-11-05 {hour:02}:00:00'" for hour in range(24))
RANGES = [
    ("taken >= timestamp_ntz'2023-11-05' AND taken < timestamp_ntz'2023-11-08'", Days(SINCE, BEFORE)),
    ("timestamp_ntz'2023-11-05' <= taken AND timestamp_ntz'2023-11-07 05:00:00' > taken", Days(SINCE, BEFORE)),
    ("NOT (taken < timestamp_ntz'2023-11-05' OR taken > timestamp_ntz'2023-11-07')", Days(SINCE, BEFORE)),
    ("taken BETWEEN '2023-11-05' AND '2023-11-07' OR taken = timestamp_ntz'2023-11-06 01:00:00'", Days(SINCE, BEFORE)),
    ("taken IN (timestamp_ntz'2023-11-07 05:00:00', timestamp_ntz'2023-11-05 00:00:00')", Days(SINCE, BEFORE)),
    (f"taken IN ({MANY})", Days(SINCE, SINCE)),
    ("to_date(taken) = date'2023-11-05'", Days(SINCE, SINCE)),
    ("to_date(taken) > date'2023-11-04' AND meter = 'a'", Days(SINCE, None)),
    ("taken <=> timestamp_ntz'2023-11-05 03:00:00'", Days(SINCE, SINCE)),
    ("taken >= timestamp_ntz'2023-11-05' OR meter = 'a'", Days()),
    ("hour(taken) = 3", Days()),
    ("taken <> timestamp_ntz'2023-11-05'", Days()),
    ("date_trunc('DAY', taken) >= timestamp_ntz'2023-11-05'", Days()),
    ("meter = 'a'", Days()),
]


@pytest.mark.parametrize("where, days", RANGES)
def test_days_of_a_filter(readings, where, days):
    assert implied_days(readings.scan(), where, "taken") == days
    whole = readings.spark.createDataFrame(FIRST, READINGS)
    assert ids(readings.scan(where)) == ids(whole.filter(where))


def test_days_in_other_time_zones_are_wider(readings):
    readings.spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert implied_days(readings.scan(), "taken = timestamp_ntz'2023-11-05'", "taken") == Days(dt.date(2023, 11, 4), dt.date(2023, 11, 6))
    finally:
        readings.spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_changes_read_only_the_days_of_their_filter(readings, monkeypatch):
    seen = []
    stored = LakeTable._stored

    def watched(self, days=None):
        days = None if days is None else list(days)
        seen.append(None if days is None else sorted(d.day for d in days))
        return stored(self, days)

    monkeypatch.setattr(LakeTable, "_stored", watched)
    readings.update("taken > timestamp_ntz'2023-11-09 00:00:00' AND meter = 'a'", {"state": F.lit("late")})
    readings.delete("taken < timestamp_ntz'2023-11-02'")
    readings.overwrite(given(readings.spark, ("c", 30, at(5), 1, None)), "taken = timestamp_ntz'2023-11-05 03:00:00'")
    assert seen == [[9], [9], [1], [1], [5], [5]]
    assert {r["slot"]: r["state"] for r in readings.scan().collect()} == {4: None, 5: None, 6: "late", 7: None, 8: "late", 30: None}


def test_update_then_delete(readings):
    readings.update("meter = 'b'", {"state": F.lit("seen")})
    readings.delete("slot < 3")
    left = {r["slot"]: r["state"] for r in readings.scan().collect()}
    assert left == {n: "seen" if n % 2 else None for n in range(3, 9)}
    assert per_day(readings) == {5: 3, 9: 3}  # the emptied first of the month is gone


def test_upsert_twice_is_upsert_once(spark, readings):
    change = given(spark, ("b", 3, at(5, 3), 7, "new"), ("z", 20, at(17), 2, None))
    readings.upsert(change)
    once = sorted(map(tuple, readings.scan().collect()))
    readings.upsert(change)
    assert sorted(map(tuple, readings.scan().collect())) == once
    assert [r["days"] for r in readings.history().collect()][-2:] == [2, 0]
    assert sorted(row[1] for row in once) == [*ALL, 20] and ("b", 3, at(5, 3), 7, "new") in once


def test_upsert_moves_a_row_to_its_new_day_without_rewriting_that_day(spark, readings):
    ninth = readings.folders[dt.date(2023, 11, 9)]
    readings.upsert(given(spark, ("a", 2, at(9), 20, None)))
    assert ids(readings.scan()) == ALL and per_day(readings) == {1: 1, 5: 3, 9: 4}
    assert readings.folders[dt.date(2023, 11, 9)][:1] == ninth and len(readings.folders[dt.date(2023, 11, 9)]) == 2


def test_overwrite_where(spark, readings):
    readings.overwrite(given(spark, ("a", 30, at(1), 1, None), ("b", 1, at(1), 5, None)), "meter = 'b'")
    assert ids(readings.scan()) == [1, 2, 4, 6, 8, 30]
    with pytest.raises(ConstraintError, match="already"):
        readings.overwrite(given(spark, ("a", 2, at(1), 1, None)), "meter = 'b'")
    assert ids(readings.scan()) == [1, 2, 4, 6, 8, 30]


def test_null_conditions_delete_nothing(readings):
    readings.delete("state > 'a'")
    assert ids(readings.scan()) == ALL
    assert readings.history().collect()[-1]["days"] == 0


def test_constraints(spark, readings):
    with pytest.raises(ConstraintError, match="not unique"):
        readings.upsert(given(spark, FIRST[4], FIRST[4]))
    hole = given(spark, ("a", 40, at(9), None, None))
    with pytest.raises(ConstraintError, match="litres"):
        readings.upsert(hole)
    with pytest.raises(ConstraintError):
        readings.append(hole)
    assert ids(readings.scan()) == ALL
    with pytest.raises(ValueError, match="keys or days"):
        readings.update("slot = 1", {"taken": F.lit(None)})


def test_columns_come_and_go(spark, readings):
    readings.add_column("note", "string")
    assert {r["note"] for r in readings.scan().collect()} == {None}
    readings.update("slot = 7", {"note": F.lit("fragile")})
    again = LakeTable.create(spark, readings.root, T.StructType.fromDDL(SCHEMA), KEYS, "taken")
    assert again.scan("note is not null").count() == 1
    again.drop_column("note")
    assert "note" not in again.scan().columns
    again.add_column("note", "string")
    assert again.scan("note is not null").count() == 0  # dropped values do not come back
    with pytest.raises(ValueError, match="exists"):
        again.add_column("note", "string")
    with pytest.raises(ValueError, match="identifies"):
        again.drop_column("slot")


def test_append_refuses_repeated_keys(spark, readings):
    for rows in ([("z", 50, at(20), 1, None), ("z", 50, at(20), 2, None)], [("z", 50, at(20), 1, None), ("b", 5, at(20), 1, None)]):
        with pytest.raises(ConstraintError, match="key"):
            readings.append(given(spark, *rows))
    assert ids(readings.scan()) == ALL and readings.version == 1


def test_append_and_history(spark, readings):
    readings.append(given(spark, ("z", 50, at(20), 1, None)).drop("state"))
    assert ids(readings.scan()) == [*ALL, 50]
    assert [(r["version"], r["operation"], r["days"]) for r in readings.history().collect()] == [
        (0, "create", 0), (1, "append", 0), (2, "append", 0)
    ]


def test_a_new_range_of_keys_opens_no_old_file(spark, readings, monkeypatch):
    opened = []
    rows_of = LakeTable._rows
    monkeypatch.setattr(LakeTable, "_rows", lambda self, paths: (opened.extend(paths), rows_of(self, paths))[1])
    readings.append(given(spark, ("c", 1, at(1), 1, None), ("c", 9, at(30), 1, None)))
    assert opened == []
    readings.upsert(given(spark, ("c", 9, at(30), 2, None), ("d", 1, at(2), 2, None)))
    assert opened and all("created_at_day=2023-11-30" in path for path in opened)
    opened.clear()
    with pytest.raises(ConstraintError):  # within the keys of the 5th, and one of them
        readings.append(given(spark, ("a", 4, at(2), 1, None)))
    assert ids(readings.scan()) == sorted([*ALL, 1, 1, 9])


def test_ranges_of_keys_are_joined():
    ranges = [((n,), (n + 1,)) for n in range(0, 300, 3)]
    assert joined_ranges(ranges, 1000) == ranges
    few = joined_ranges(ranges, 7)
    assert len(few) <= 7 and all(any(low <= r[0] and r[1] <= high for low, high in few) for r in ranges)
    assert joined_ranges([((1,), (5,)), ((2,), (3,)), ((5,), (9,))]) == [((1,), (9,))] and joined_ranges([]) == []


def test_a_change_that_dies_before_its_record_is_not_there(spark, readings, monkeypatch):
    before = sorted(map(tuple, readings.scan().collect()))

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(lake_module, "write_record", killed)
        for change in (
            lambda: readings.delete("slot < 7"),
            lambda: readings.append(given(spark, ("z", 50, at(20), 1, None))),
            lambda: readings.upsert(given(spark, ("b", 3, at(9), 7, "new"))),
        ):
            with pytest.raises(KeyboardInterrupt):
                change()
            for table in (readings, LakeTable(spark, readings.root, KEYS, "taken")):
                assert sorted(map(tuple, table.scan().collect())) == before and per_day(table) == {1: 2, 5: 3, 9: 3}
    readings.delete("slot < 7")
    assert ids(readings.scan()) == [7, 8]


def test_earlier_versions(spark, readings):
    frame = readings.scan()
    readings.delete("meter = 'a'")
    readings.add_column("note", "string")
    assert ids(frame) == ALL and ids(readings.at(1).scan()) == ALL and ids(readings.at(0).scan()) == []
    assert ids(readings.scan()) == ids(readings.at(2).scan()) == [1, 3, 5, 7] and "note" not in readings.at(2).scan().columns
    for change in (lambda t: t.delete("slot = 1"), lambda t: t.add_column("x", "int")):
        with pytest.raises(ValueError, match="only be read"):
            change(readings.at(1))
    with pytest.raises(ValueError, match="no version 9"):
        readings.at(9)
    readings.expire(keep=2)
    assert ids(readings.scan()) == [1, 3, 5, 7] and ids(readings.at(2).scan()) == [1, 3, 5, 7]
    with pytest.raises(ValueError, match="no version 1"):
        readings.at(1)
    assert [r["version"] for r in LakeTable(spark, readings.root, KEYS, "taken").history().collect()] == [2, 3]


def test_two_writers_of_one_version(spark, readings):
    other = LakeTable(spark, readings.root, KEYS, "taken")
    readings.delete("slot = 1")
    with pytest.raises(FileExistsError):
        other.delete("slot = 2")
    assert ids(LakeTable(spark, readings.root, KEYS, "taken").scan()) == ALL[1:]


def test_a_table_keyed_by_text_without_rows(spark):
    schema = T.StructType([T.StructField("code", T.StringType(), False), T.StructField("at", T.TimestampNTZType(), False)])
    codes = LakeTable.create(spark, scratch(spark, "codes"), schema, ["code"], "at")
    assert codes.scan().count() == 0 and codes.partitions().count() == 0
    codes.delete("at > '2020-01-01'")
    rows = [(f"{kind}-{n}", at(n)) for kind in "ab" for n in (3, 4)]
    for _ in range(2):
        codes.upsert(spark.createDataFrame(rows, "code string, at timestamp_ntz"))
    assert codes.scan().count() == 4


# -- history ------------------------------------------------------------------------------------

USERS = "user_id string, name string, updated_at timestamp_ntz"


def day(n):
    return dt.datetime(2024, 1, n)


def test_snapshots(spark):
    first = spark.createDataFrame([("u1", "Ann", day(1)), ("u2", "Bo", day(1)), ("u2", "Old", dt.datetime(2023, 1, 1))], USERS)
    second = spark.createDataFrame([("u1", "Anna", day(3)), ("u2", "Bob", day(1)), ("u3", "Cy", day(2))], USERS)
    versions = H.apply_snapshot(H.start_history(first, "user_id", "updated_at"), second, "user_id", "updated_at")
    expected = [
        ("u1", "Ann", day(1), day(1), day(3)),
        ("u1", "Anna", day(3), day(3), None),
        ("u2", "Bo", day(1), day(1), None),  # equal timestamp: no change
        ("u3", "Cy", day(2), day(2), None),
    ]
    assert sorted(map(tuple, versions.collect()), key=repr) == sorted(expected, key=repr)
    again = H.apply_snapshot(versions, second, "user_id", "updated_at")
    assert sorted(map(tuple, again.collect()), key=repr) == sorted(expected, key=repr)
    stale = spark.createDataFrame([("u1", "Stale", day(2))], USERS)
    assert H.apply_snapshot(again, stale, "user_id", "updated_at").count() == 4


def test_history_from_log_crosses_buckets(spark):
    def at(h, m=0):
        return dt.datetime(2024, 1, 1, h, m)

    log = [("a", "x", at(1)), ("a", "y", at(1, 30)), ("a", "z", at(5)), ("a", "z", at(5)), ("b", "q", at(2)), (None, "n", at(2)), ("b", "t", None)]
    df = spark.createDataFrame(log, USERS)
    for bucket in ("hour", "day", "minute"):
        got = H.history_from_log(df, "user_id", "updated_at", bucket).select("user_id", "name", "valid_from", "valid_to")
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(
            [("a", "x", at(1), at(1, 30)), ("a", "y", at(1, 30), at(5)), ("a", "z", at(5), None), ("b", "q", at(2), None)],
            key=repr,
        )


# -- stored history -------------------------------------------------------------------------------


def files_of(df):
    return {path.split("/generation=")[1] for path in df.inputFiles()}


def operators(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("\n")


def test_stored_history_equals_the_history_of_frames(spark):
    runs = [
        [(f"u{k}", f"n{k}", day(1 + k % 3)) for k in range(300)] + [("u7", "older", dt.datetime(2023, 1, 1))],
        [(f"u{k}", f"m{k}", day(2 + k % 4)) for k in range(0, 400, 50)],
        [("u0", "same", day(2)), ("u50", "again", day(20))],
        [("u50", "again", day(20))],
    ]
    stored = H.StoredHistory(spark, scratch(spark, "history"), "user_id", "updated_at")
    frames, changed = None, []
    for rows in runs:
        source = spark.createDataFrame(rows, USERS)
        changed.append(stored.run(source))
        frames = H.start_history(source, "user_id", "updated_at") if frames is None else H.apply_snapshot(frames, source, "user_id", "updated_at")
        assert sorted(map(tuple, stored.versions().collect()), key=repr) == sorted(map(tuple, frames.collect()), key=repr)
    assert changed[0] == 300 and changed[2:] == [1, 0] and stored.version == 2
    assert stored.versions().columns == frames.columns and stored.current().count() == 302
    again = H.StoredHistory(spark, stored.root, "user_id", "updated_at", parts=3)
    assert again.parts == H.CUTS  # as begun
    assert again.run(spark.createDataFrame([("u50", "more", day(25))], USERS)) == 1
    assert again.versions().filter("user_id = 'u50' AND valid_to IS NULL").first()["name"] == "more"


def test_a_run_writes_only_what_it_touches(spark):
    stored = H.StoredHistory(spark, scratch(spark, "history"), "user_id", "updated_at")
    stored.run(spark.createDataFrame([(f"u{k}", "x", day(1)) for k in range(500)], USERS))
    sizes = []
    for n in range(3):
        before, closed, cuts = files_of(stored.current()), stored.closed, dict(stored.cuts)
        stored.run(spark.createDataFrame([("u3", f"v{n}", day(2 + n))], USERS))
        assert len(files_of(stored.current()) - before) == 1 and len(before & files_of(stored.current())) >= len(before) - 1
        assert stored.closed[:-1] == closed and sum(cuts[c] != stored.cuts[c] for c in cuts) == 1
        sizes.append(operators(stored.versions()))
    assert len(set(sizes)) == 1


def test_a_run_broadcasts_no_keys(spark):
    """Files of many keys can be smaller than Spark's limit for broadcasts while their rows fill the driver."""
    stored = H.StoredHistory(spark, scratch(spark, "history"), "user_id", "updated_at")
    stored.run(spark.createDataFrame([(f"u{k}", "x", day(1)) for k in range(50)], USERS))
    limit = "spark.sql.maxBroadcastTableSize"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "1b")  # any broadcast of rows fails
    try:
        assert stored.run(spark.createDataFrame([(f"u{k}", "y", day(2)) for k in range(0, 60, 2)], USERS)) == 30
    finally:
        spark.conf.set(limit, before)
    assert stored.current().count() == 55 and stored.versions().count() == 80


def test_a_run_that_dies_leaves_the_history_as_it_was(spark, monkeypatch):
    stored = H.StoredHistory(spark, scratch(spark, "history"), "user_id", "updated_at")
    stored.run(spark.createDataFrame([("u1", "Ann", day(1))], USERS))
    before = sorted(map(tuple, stored.versions().collect()))
    later = spark.createDataFrame([("u1", "Anna", day(3))], USERS)
    with monkeypatch.context() as patch:
        patch.setattr(H, "write_record", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            stored.run(later)
    assert sorted(map(tuple, H.StoredHistory(spark, stored.root, "user_id", "updated_at").versions().collect())) == before
    for bad in ([(None, "x", day(1))], [("u9", "x", None)]):
        with pytest.raises(ValueError, match="without"):
            stored.run(spark.createDataFrame(bad, USERS))
        assert H.undated(spark.createDataFrame(bad, USERS), "user_id", "updated_at").count() == 1
    assert stored.run(later) == 1 and stored.versions().count() == 2
    assert stored.run(later.limit(0)) == 0
