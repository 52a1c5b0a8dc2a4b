import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.schemas import commerce, movements, struct
from millrace.sinks import backfill
from millrace.sinks import tables as S
from millrace.sinks.layout import cleaned_path, raw_path
from millrace.sources import files, html, jdbc, landing


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_csv_scans(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,price,day\n1,2.5,2024-01-05\n2,x,\n")
    text = files.read_csv_text(spark, str(tmp_path))
    assert [f.dataType.simpleString() for f in text.schema] == ["string"] * 3
    declared = "id int, price double, day date"
    with pytest.raises(Exception, match="FAILFAST"):
        files.read_csv_typed(spark, str(tmp_path), declared).collect()
    typed = files.read_csv_typed(spark, str(tmp_path), declared, strict=False)
    assert rows(typed) == [(1, 2.5, dt.date(2024, 1, 5)), (2, None, None)]
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "b.csv").write_text("id,price\n1,2.5\n2,3\n")
    inferred = files.read_csv_inferred(spark, str(tmp_path / "b"))
    assert [f.dataType.simpleString() for f in inferred.schema] == ["int", "double"]


def test_untidy_header_is_renamed_by_position(spark, tmp_path):
    path = tmp_path / "homes.csv"
    path.write_text('"Sell", "List", "Age"\n142, 160,  60\n175, 180,  12\n   \n')
    homes = files.read_csv_renamed(spark, str(path), ["Sell", "List", "Age"])
    assert homes.columns == ["Sell", "List", "Age"]
    assert rows(homes) == [(142, 160, 60), (175, 180, 12)]


def test_json_lines_take_none_text_as_null(spark, tmp_path):
    (tmp_path / "m.json").write_text(
        '{"actual_timestamp": "2024-07-01 13:00:00+01:00", "train_id": "T1", "toc_id": "88"}\n'
        '{"actual_timestamp": "None", "train_id": "T2"}\nnot json\n'
    )
    read = files.read_json_lines(spark, str(tmp_path / "*.json"), movements())
    assert len(read.columns) == 29
    shown = read.select("train_id", "toc_id", F.col("actual_timestamp").cast("string"))
    assert rows(shown) == [("T1", "88", "2024-07-01 12:00:00"), ("T2", None, None), (None, None, None)]


def test_multi_line_documents_flatten(spark, tmp_path):
    (tmp_path / "w.json").write_text('[\n {"widget": {"debug": "on", "window": {"title": "A", "width": 5}}},\n {"widget": {"debug": "off"}}\n]')
    flat = files.read_json_documents(spark, str(tmp_path / "w.json"))
    assert flat.columns == ["widget.debug", "widget.window.title", "widget.window.width"]
    assert rows(flat) == [("off", None, None), ("on", "A", 5)]


def test_xml_rows_under_different_tags(spark, tmp_path):
    body = "".join(f"<{t}><X>{x}</X><Y>{y}</Y></{t}>" for t, x, y in (("A", 1.3, 2.6), ("B", 1.4, 1.4), ("C", 5.2, 4.6)))
    (tmp_path / "c.xml").write_text(f"<root>{body}</root>")
    read = files.read_xml(spark, str(tmp_path / "c.xml"), ["A", "B", "C"], "X double, Y double")
    assert rows(read) == [(1.3, 2.6), (1.4, 1.4), (5.2, 4.6)]
    S.write_xml(read, str(tmp_path / "out"))
    assert "<data>" in next((tmp_path / "out").glob("part-*")).read_text()
    assert rows(files.read_xml(spark, str(tmp_path / "out"), ["row"], read.schema)) == rows(read)


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv"])
def test_round_trips(spark, tmp_path, fmt):
    df = spark.createDataFrame([(1, "a", 1.5), (2, None, None)], "id bigint, name string, price double")
    path = str(tmp_path / fmt)
    getattr(S, f"write_{fmt}")(df, path)
    back = {
        "parquet": lambda: files.read_parquet(spark, path),
        "orc": lambda: files.read_orc(spark, path),
        "json": lambda: files.read_json_lines(spark, path, df.schema),
        "csv": lambda: files.read_csv_typed(spark, path, df.schema),
    }[fmt]()
    assert rows(back) == rows(df)


def test_avro_is_gated(spark, tmp_path):
    df = spark.range(1)
    if files.avro_available(spark):
        S.write_avro(df, str(tmp_path / "a"))
        assert files.read_avro(spark, str(tmp_path / "a")).count() == 1
        return
    with pytest.raises(RuntimeError, match="spark-avro"):
        files.read_avro(spark, str(tmp_path / "a"))
    with pytest.raises(RuntimeError, match="spark-avro"):
        S.write_avro(df, str(tmp_path / "a"))


def test_guarded_read(spark, tmp_path):
    assert files.read_if_present(spark, str(tmp_path / "nowhere")) is None
    (tmp_path / "empty.csv").write_text("a,b\n")
    assert files.read_if_present(spark, str(tmp_path / "empty.csv")) is None
    (tmp_path / "full.csv").write_text("a,b\n1,2\n")
    assert rows(files.read_if_present(spark, str(tmp_path / "full.csv"))) == [("1", "2")]


def test_find_documents(spark):
    people = spark.createDataFrame(
        [("b", {"age": 4}), ("a", {"age": 4}), ("c", {"age": 5})], "name string, info struct<age:int>"
    )
    found = files.find(people, {"info.age": 4}, ["name"], [("name", True)])
    assert [r[0] for r in found.collect()] == ["a", "b"]
    assert [r[0] for r in files.find(people, sort=[("name", False)]).collect()] == ["c", "b", "a"]


def test_views_preview_and_in_memory_rows(spark, capsys):
    df = spark.createDataFrame([("Java", 20000), ("Python", 100000)], ["language", "users_count"])
    assert rows(files.query_view(df, "languages", "SELECT language FROM languages WHERE users_count > 50000")) == [("Python",)]
    df.show()
    df.printSchema()
    assert "users_count" in capsys.readouterr().out


def test_html_listing_with_fallback_price(spark):
    page = """<article class="listing"><a class="ellipsize" href="/car/1"> Car One </a>
      <div class="listing__price"> 1,250,000 บาท</div></article>
      <article class="listing"><a class="ellipsize" href="/car/2">Car Two</a><div class="listing__price"> </div>
      <span class="hot">990,000 บาท</span></article>"""
    pages = spark.createDataFrame([(1, page), (2, "<p>nothing</p>"), (3, None)], "page_id int, html string")
    cells = {
        "title": html.Cell([r"<a[^>]*>([^<]*)</a>"]),
        "url": html.Cell([r'href="([^"]*)"']),
        "price": html.Cell([r'listing__price">([^<]*)<', r'"hot">([^<]*)<'], [" บาท"]),
    }
    found = html.listing(pages, "html", r'(?s)<article class="listing">(.*?)</article>', cells)
    assert rows(found) == [(1, 0, "Car One", "/car/1", "1250000"), (1, 1, "Car Two", "/car/2", "990000")]


def test_html_cell_texts(spark):
    page = "<table><tr><td> 1 </td><td>2</td></tr><tr><td>3</td></tr></table>"
    df = spark.createDataFrame([(page,)], "html string")
    found = html.cell_texts(df, "html", r"(?s)<tr>(.*?)</tr>", r"<td>([^<]*)</td>")
    assert [r["cells"] for r in found.orderBy("item").collect()] == [["1", "2"], ["3"]]


def test_jdbc_options():
    db = jdbc.Database("jdbc:postgresql://host/db", {"user": "u"}, fetch_size=500)
    whole = jdbc.table_options(db, "orders", ("id", 0, 1000, 8))
    assert whole["dbtable"] == "orders" and whole["numPartitions"] == "8" and whole["fetchsize"] == "500"
    assert jdbc.query_options(db, "select 1")["query"] == "select 1"
    split = jdbc.query_options(db, "select id from orders;", ("id", 0, 1000, 8))
    assert split == {**whole, "dbtable": "(select id from orders) extract_rows"}  # Spark splits no ``query``


def test_slices_and_increments(spark):
    stamps = [dt.datetime(2021, 2, 9, 23, 59), dt.datetime(2021, 2, 10), dt.datetime(2021, 2, 10, 23, 59), dt.datetime(2021, 2, 11)]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(stamps)], "id int, created_at timestamp_ntz")
    assert rows(jdbc.day_slice(df, "created_at", "2021-02-10").select("id")) == [(1,), (2,)]
    assert rows(jdbc.increment(df, df.filter("id <= 1"), "created_at").select("id")) == [(2,), (3,)]
    assert jdbc.increment(df, df.filter("id > 9"), "created_at").count() == 4


def test_landed_records_take_model_names(spark):
    landed = spark.createDataFrame([("e1", "u1", "o1")], "event_id string, user string, `order` string")
    schema = struct("event_id string, session_id string, user_id string, order_id string, product_id string")
    assert rows(landing.normalise(landed, schema)) == [("e1", None, "u1", "o1", None)]
    assert landing.table_name("order-items") == "order_items" and landing.table_name("users") == "users"


def test_landing_and_layout(spark, tmp_path):
    root = str(tmp_path)
    assert raw_path(root, "shop", "users", "2020-10-23") == f"{root}/raw/shop/users/2020-10-23"
    assert cleaned_path(root, "shop", "promos") == f"{root}/cleaned/shop/promos"
    with pytest.raises(ValueError, match="by day"):
        raw_path(root, "shop", "orders")
    df = spark.createDataFrame([("1", "a")], "id string, name string")
    assert landing.land_day(df.limit(0), root, "shop", "users", "2020-10-22") is None
    path = landing.land_day(df, root, "shop", "users", "2020-10-23")
    assert rows(files.read_if_present(spark, path)) == [("1", "a")]
    (tmp_path / "records.json").write_text('[{"id": "1"}, {"id": "2", "name": "b"}]')
    read = landing.read_records(spark, str(tmp_path / "records.json"), "id string, name string")
    assert rows(read) == [("1", None), ("2", "b")]
    assert landing.read_records(spark, str(tmp_path / "none.json"), "id string") is None


def day_rows(spark, path):
    return rows(spark.read.schema("id int, ts timestamp_ntz, created_at_day date").parquet(path).select("id", "created_at_day"))


def test_replacing_a_day_keeps_the_others(spark, tmp_path):
    path = str(tmp_path / "t")
    stamps = [dt.datetime(2021, 2, d, 5) for d in (9, 10, 10, 11)]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(stamps)], "id int, ts timestamp_ntz")
    S.write_by_day(df, path, "ts")
    changed = df.filter("id = 1").withColumn("id", F.lit(7))
    for _ in range(2):
        S.replace_days(changed, path, "ts")
    d = dt.date
    assert day_rows(spark, path) == [(0, d(2021, 2, 9)), (3, d(2021, 2, 11)), (7, d(2021, 2, 10))]


def test_daily_ingest_skips_empty_input(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, dt.datetime(2021, 2, 9))], "id int, ts timestamp_ntz")
    assert S.ingest_day(df, path, "ts", "2021-02-09")
    assert not S.ingest_day(df, path, "ts", "2021-02-10")
    assert not S.ingest_day(None, path, "ts", "2021-02-10")
    assert day_rows(spark, path) == [(1, dt.date(2021, 2, 9))]


def test_tables_seed_dump_and_audit(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    for _ in range(2):
        S.load_table(df, "loaded_people")
    assert spark.table("loaded_people").count() == 2
    S.dump_table(spark, "loaded_people", str(tmp_path / "dump"))
    S.load_seed(spark, str(tmp_path / "dump"), "id int, name string", "seeded_people")
    assert rows(spark.table("seeded_people")) == [(1, "a"), (2, "b")]
    row = S.audited(lambda: S.write_parquet(df, str(tmp_path / "p")), lambda: spark.read.parquet(str(tmp_path / "p")), "p").first()
    assert (row.table_name, row.row_count, row.column_count) == ("p", 2, 2) and row.seconds > 0
    S.export_query(spark, "SELECT max(id) AS id FROM seeded_people", str(tmp_path / "x"))
    assert rows(spark.read.parquet(str(tmp_path / "x"))) == [(2,)]


def test_conform_parses_and_reports_missing(spark):
    df = spark.createDataFrame([("u1", "2020-12-07T01:02:03Z"), ("u2", "soon")], "user_id string, created_at string")
    schema = struct("user_id string, created_at timestamp")
    shown = S.conform(df, schema, strict=False).select("user_id", F.col("created_at").cast("string"))
    assert rows(shown) == [("u1", "2020-12-07 01:02:03"), ("u2", None)]
    with pytest.raises(Exception, match="created_at is no timestamp: soon"):
        S.conform(df, schema).collect()
    assert S.conform(df.filter("user_id = 'u1'"), schema).count() == 1
    nulls = df.withColumn("created_at", F.lit(None).cast("string"))
    assert [r.created_at for r in S.conform(nulls, schema).collect()] == [None, None]
    loaded, rejected = S.conform_or_reject(df, schema)
    assert [r.user_id for r in loaded.collect()] == ["u1"] and loaded.schema["created_at"].dataType == schema["created_at"].dataType
    assert rows(rejected) == [("u2", "soon", ["created_at"])]
    assert [part.count() for part in S.conform_or_reject(nulls, schema)] == [2, 0]
    with pytest.raises(ValueError, match="email"):
        S.conform(df, commerce("users"))


def test_clustered_load_spreads_a_hot_value(spark, tmp_path):
    hot = spark.range(4000).select(F.lit("same").alias("name"), "id").unionByName(
        spark.range(50).select(F.concat(F.lit("z"), "id").alias("name"), "id")
    )
    S.write_clustered(hot, str(tmp_path / "c"), ["name"], files=4)
    stored = spark.read.parquet(str(tmp_path / "c"))
    holding = stored.filter("name = 'same'").select(F.input_file_name().alias("f")).distinct().count()
    assert stored.count() == 4050 and holding > 1


def test_fallback_plan(spark, tmp_path):
    good = spark.createDataFrame([("1",)], "a string")
    bad = spark.createDataFrame([("x",)], "a string").select(F.col("a").cast("int"))
    assert S.first_that_works(lambda: good, lambda: bad, str(tmp_path / "p")) == ("primary", None)
    written, error = S.first_that_works(lambda: bad, lambda: good, str(tmp_path / "f"))
    assert written == "fallback" and "CAST_INVALID_INPUT" in str(error)
    assert rows(spark.read.parquet(str(tmp_path / "f"))) == [("1",)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT") as both:
        S.first_that_works(lambda: bad, lambda: bad, str(tmp_path / "f"))
    assert "CAST_INVALID_INPUT" in str(both.value.__cause__)
    assert rows(spark.read.parquet(str(tmp_path / "f"))) == [("1",)]  # the old output is still there
    assert sorted(p.name for p in tmp_path.iterdir()) == ["f", "p"]


def test_backfill_modes(spark):
    d = [dt.date(2024, 3, 10 + i) for i in range(5)]
    bounds = spark.createDataFrame([(d[0], d[4])], "a date, b date")
    days = backfill.days_between(F.col("a"), F.col("b"), bounds)
    log = spark.createDataFrame([(d[0], "success"), (d[1], "failed"), (d[2], "failed"), (d[2], "success")], "day date, status string")
    assert [r[0] for r in rows(backfill.plan_days(days, log))] == [d[3], d[4]]
    assert [r[0] for r in rows(backfill.plan_days(days, log, "missing_and_failed"))] == [d[1], d[3], d[4]]
    assert backfill.plan_days(days, log, "all").count() == 5
    with pytest.raises(ValueError, match="mode"):
        backfill.plan_days(days, log, "some")


def test_rows_of_nulls_are_rows_and_blank_lines_are_none(spark, tmp_path):
    path = tmp_path / "untidy.csv"
    path.write_text('"a", "b"\n1, x\n\n   \n,\n2,\n')
    assert rows(files.read_csv_renamed(spark, str(path), ["a", "b"])) == rows(spark.createDataFrame([(1, "x"), (None, None), (2, None)], "a int, b string"))


NESTED = """<UL class='menu'><li class="x y" id=one>first <b>bold</b><ul><li class="y">inner</li><li class=x>deep</li></ul> tail</li>
<!-- <li class="x">hidden</li> --><script>var t = '<li class="x">no</li>';</script></li>
<li data-class="x">other</li><li title="a > b" class="y  x"><a href='/second'>second</a></li><LI CLASS="x">open"""


def test_elements_by_class_and_nesting(spark):
    pages = spark.createDataFrame([(1, NESTED), (2, "<p>nothing</p>"), (3, None), (4, "")], "page_id int, html string")
    found = html.elements(pages, "html", html.Selector("li", ["x"])).orderBy("page_id", "item").collect()
    assert [(r["page_id"], r["item"], r["inner"]) for r in found] == [
        (1, 0, 'first <b>bold</b><ul><li class="y">inner</li><li class=x>deep</li></ul> tail'),
        (1, 1, "deep"),
        (1, 2, "<a href='/second'>second</a>"),
        (1, 3, "open"),
    ]
    assert [r["opening"] for r in found][2:] == ['<li title="a > b" class="y  x">', '<LI CLASS="x">']
    both = html.elements(pages, "html", html.Selector("li", ["x", "y"])).collect()
    assert [r["inner"][:5] for r in both] == ["first", "<a hr"]
    assert html.elements(pages, "html", html.Selector("li", (), {"id": "one"})).count() == 1
    assert html.elements(pages, "html", html.Selector("li", (), {"class": None})).count() == 5
    assert html.elements(pages, "html", html.Selector("l")).count() == 0


def test_selected_listing_falls_back_to_a_second_selector(spark):
    page = (
        '<div class="card"><div class="name"> A <i>b</i></div><span class="price">1,200 kr</span><a href="/a">go</a></div>'
        '<div class="card"><div class="name">C</div><span class="price"> </span><span class="hot">950 kr</span></div>'
    )
    pages = spark.createDataFrame([(1, page)], "page_id int, html string")
    parts = {
        "name": html.Part([html.Selector("div", ["name"])]),
        "price": html.Part([html.Selector("span", ["price"]), html.Selector("span", ["hot"])], suffixes=[" kr"]),
        "url": html.Part([html.Selector("a")], attribute="href"),
    }
    found = html.selected_listing(pages, "html", html.Selector("div", ["card"]), parts).orderBy("item").collect()
    assert [(r["item"], r["name"], r["price"], r["url"]) for r in found] == [(0, "A b", "1200", "/a"), (1, "C", "950", None)]


def test_elements_equal_a_parser(spark):
    from html.parser import HTMLParser

    class Divs(HTMLParser):
        def __init__(self):
            super().__init__()
            self.open, self.found = [], []

        def handle_starttag(self, tag, attrs):
            if tag == "div":
                self.found.append([dict(attrs).get("class"), ""])
                self.open.append(len(self.found) - 1)

        def handle_endtag(self, tag):
            if tag == "div" and self.open:
                self.open.pop()

        def handle_data(self, data):
            for i in self.open:
                self.found[i][1] += data

    rng = np.random.default_rng(8)
    parts = ["<div>", '<div class="a">', "<div class='a b'>", "<p>", "</div>", "</div>", "word ", "1 < 2 ", "<!-- </div> -->"]
    texts = ["".join(rng.choice(parts, int(rng.integers(0, 30)))) for _ in range(200)]
    pages = spark.createDataFrame(list(enumerate(texts)), "page_id int, html string")
    rows = html.elements(pages, "html", html.Selector("div", ["a"])).withColumn("text", html.text_of(F.col("inner")))
    found = {}
    for row in rows.orderBy("page_id", "item").collect():
        found.setdefault(row["page_id"], []).append(row["text"])
    for number, text in enumerate(texts):
        parser = Divs()
        parser.feed(text)
        parser.close()
        wanted = [" ".join(t.split()) for c, t in parser.found if c and "a" in c.split()]
        assert found.get(number, []) == wanted, text
