import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from millrace import schemas
from millrace.plans.rail import join_companies
from millrace.streaming import movements as M
from millrace.streaming import sources


def millis(*when):
    return str(int(dt.datetime(*when, tzinfo=dt.timezone.utc).timestamp() * 1000))


def message(kind, **body):
    return {"header": {"msg_type": kind, "msg_queue_timestamp": millis(2024, 7, 1)}, "body": body}


FRAMES = [
    [
        message("0003", train_id="T1", toc_id="88", actual_timestamp=millis(2024, 7, 1, 12), direction_ind="UP", route="9"),
        message("0001", train_id="T0", toc_id="88"),
    ],
    [message("0003", train_id="T2", toc_id="x", actual_timestamp=millis(2024, 1, 5, 12), event_type="ARRIVAL")],
    [message("0003", train_id="T3")],
]


def write_lines(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def feed(tmp_path):
    write_lines(tmp_path / "feed", "a.txt", [*[json.dumps(f) for f in FRAMES], "garbage"])
    return str(tmp_path / "feed")


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_published_fields(spark, tmp_path):
    batch = M.published(M.movement_bodies(spark.read.text(feed(tmp_path))))
    assert tuple(batch.columns) == schemas.MOVEMENT_FIELDS and len(batch.columns) == 29
    assert rows(batch.select("train_id", "actual_timestamp", "route", "platform")) == [
        ("T1", "2024-07-01 13:00:00+01:00", "UP", None),
        ("T2", "2024-01-05 12:00:00+00:00", None, None),
        ("T3", None, None, None),
    ]
    own_route = M.published(M.movement_bodies(spark.read.text(feed(tmp_path))), route_field="route")
    assert rows(own_route.filter("train_id = 'T1'").select("route")) == [("9",)]
    encoded = sources.as_json(batch.filter("train_id = 'T3'")).first()[0]
    assert json.loads(encoded)["platform"] is None and len(json.loads(encoded)) == 29


def test_stream_equals_batch_and_takes_in_only_new_files(spark, tmp_path):
    path = feed(tmp_path)
    raw, typed = str(tmp_path / "raw"), str(tmp_path / "typed")

    def run():
        published = M.published(M.movement_bodies(sources.text_folder(spark, path)))
        M.land(sources.as_json(published), raw, str(tmp_path / "c1"))
        M.run(M.typed(M.landed(spark, raw, streaming=True)), typed, str(tmp_path / "c2"))
        return spark.read.schema(schemas.movements()).parquet(typed)

    shown = ["train_id", "toc_id", "route"]
    assert rows(run().select(*shown)) == [("T1", "88", "UP"), ("T2", "x", None), ("T3", None, None)]
    assert run().count() == 3  # nothing new, nothing twice
    write_lines(tmp_path / "feed", "b.txt", [json.dumps([message("0003", train_id="T4", toc_id="20")])])
    streamed = run()
    whole = M.typed(M.landed(spark, raw))
    assert rows(streamed) == rows(whole) and streamed.count() == 4
    assert streamed.filter("train_id = 'T1'").select(F.col("actual_timestamp").cast("string")).first()[0] == "2024-07-01 12:00:00"


def test_undecodable_messages_are_quarantined(spark, tmp_path):
    write_lines(tmp_path / "in", "m.txt", ['{"train_id": "T1", "actual_timestamp": "None"}', '{"train_id"', "[1]"])
    M.land(sources.text_folder(spark, str(tmp_path / "in")), str(tmp_path / "raw"), str(tmp_path / "c"))
    assert rows(M.quarantined(spark, str(tmp_path / "raw"))) == [("[1]",), ('{"train_id"',)]
    typed = M.typed(M.landed(spark, str(tmp_path / "raw")))
    assert rows(typed.select("train_id", "actual_timestamp")) == [("T1", None)]


def test_day_load_survives_a_replayed_batch(spark, tmp_path):
    typed = M.typed(sources.as_json(M.published(M.movement_bodies(spark.read.text(feed(tmp_path))))))
    write = M._replace_batch(str(tmp_path / "days"), "actual_timestamp")
    write(typed.limit(3), 0)
    write(typed, 0)
    write(typed.filter("train_id = 'T1'"), 1)
    stored = spark.read.schema("train_id string, day date, batch bigint").parquet(str(tmp_path / "days"))
    assert rows(stored.groupBy("train_id").count()) == [("T1", 2), ("T2", 1), ("T3", 1)]


def test_streaming_day_load_and_enrichment(spark, tmp_path):
    path = feed(tmp_path)
    companies = spark.createDataFrame([(88, "A"), (88, "B"), (7, "C")], "toc_id int, company_name string")
    write_lines(tmp_path / "raw", "a.txt", [
        r[0] for r in sources.as_json(M.published(M.movement_bodies(spark.read.text(path)))).collect()
    ])
    stream = M.typed(sources.text_folder(spark, str(tmp_path / "raw")))
    M.load_days(stream, str(tmp_path / "days"), str(tmp_path / "c1"))
    days = spark.read.schema("day date, batch bigint").parquet(str(tmp_path / "days"))
    assert rows(days.groupBy("day").count()) == [
        (None, 1), (dt.date(2024, 1, 5), 1), (dt.date(2024, 7, 1), 1)
    ]
    enriched = join_companies(stream.withColumnRenamed("actual_timestamp", "actual_timestamp_utc"), companies)
    M.run(enriched, str(tmp_path / "out"), str(tmp_path / "c2"))
    assert rows(spark.read.parquet(str(tmp_path / "out")).select("train_id")) == [("T1",), ("T1",), ("T2",), ("T3",)]


def test_topic_options():
    options = sources.topic_options("host:9092", "movements", "group", {"security.protocol": "SASL_SSL"})
    assert options["startingOffsets"] == "earliest" and options["kafka.security.protocol"] == "SASL_SSL"
    assert options["subscribe"] == "movements" and options["kafka.group.id"] == "group"


def test_compaction_can_be_repeated_wherever_it_died(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "days")
    write = M._replace_batch(path, "at")
    for batch in range(4):
        rows = [(10 * batch + k, dt.datetime(2024, 1, 1 + k % 2, batch)) for k in range(4)]
        write(spark.createDataFrame(rows, "n int, at timestamp_ntz"), batch)

    def held():
        rows = spark.read.parquet(path).select("n", "day", "batch").collect()
        return sorted(r["n"] for r in rows), sorted({(str(r["day"]), r["batch"]) for r in rows})

    before = held()[0]
    for step in ("remove_folder", "move_folder"):
        with monkeypatch.context() as patch:
            real, calls = getattr(M, step), []

            def dies(*given):
                calls.append(given)
                if len(calls) == (3 if step == "remove_folder" else 1):
                    raise KeyboardInterrupt
                real(*given)

            patch.setattr(M, step, dies)
            with pytest.raises(KeyboardInterrupt):
                M.compact_days(spark, path, ["2024-01-01"] if step == "remove_folder" else ["2024-01-02"])
        if step == "remove_folder":
            write(spark.createDataFrame([(99, dt.datetime(2024, 1, 1))], "n int, at timestamp_ntz"), 5)  # the stream goes on
    M.compact_days(spark, path, ["2024-01-01", "2024-01-02"])
    assert held()[0] == sorted([*before, 99])
    M.compact_days(spark, path, ["2024-01-01", "2024-01-02"])
    days = [day for day, _ in held()[1]]
    assert held()[0] == sorted([*before, 99]) and ("2024-01-01", 5) in held()[1] and days.count("2024-01-02") <= 2
    write(spark.createDataFrame([(99, dt.datetime(2024, 1, 1))], "n int, at timestamp_ntz"), 5)  # the newest batch again
    assert held()[0] == sorted([*before, 99])
