"""Commerce and rail models on small inline tables with answers worked out by hand."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace.operators import governance, quality
from millrace.operators.joins import sums_over_lines
from millrace.plans import bindings, commerce  # noqa: F401
from millrace.plans.bindings import project
from millrace.plans.commerce import lines_in_month
from millrace.plans.models import MODELS, Project
from millrace.plans.rail import join_companies
from millrace.schemas import COMMERCE
from millrace.session import configure

T0 = dt.datetime(2021, 2, 10, 8)


@pytest.fixture(scope="module")
def shop(spark):
    def frame(name, rows):
        return spark.createDataFrame(rows, COMMERCE[name])

    day = dt.timedelta(days=1)

    def order(oid, user, promo, address, when):
        return (oid, user, promo, address, when, 10.0, 1.0, 11.0, f"t{oid}", "ups", when + day, None, "shipped")

    def event(eid, session, kind, order_id=None, product=None):
        return (eid, session, "u1", "/x", T0, kind, order_id, product)

    tables = {
        "users": frame("users", [
            ("u1", "Ann", "Lee", "ann@x.org", "111-222-3333", T0 - day, T0, "a1"),
            ("u2", "Bo", "Chan", "bo.x.org", "111-222-333", T0, T0 - day, "a2"),
            ("u3", "Cy", "Dee", "cy@x.org", "111-222-3333", T0, T0, "a1"),
        ]),
        "addresses": frame("addresses", [
            ("a1", "1 Road", 90001, "California", "US"), ("a2", "2 Road", 73301, "Texas", "US"),
        ]),
        "products": frame("products", [("p1", "Fern", 5.0, 9), ("p2", "Cactus", 3.0, 4), ("p3", "Moss", 1.0, 1)]),
        "promos": frame("promos", [("digitized promo", 5, "active")]),
        "orders": frame("orders", [
            order("o1", "u1", None, "a1", T0), order("o2", "u1", "digitized promo", "a2", T0),
            order("o3", "u2", None, "a1", T0), order("o4", "u2", None, "a1", dt.datetime(2021, 3, 1)),
        ]),
        "order_items": frame("order_items", [
            ("o1", "p1", 1), ("o1", "p2", 2), ("o2", "p1", 3), ("o3", "p2", 4), ("o3", "p1", 5), ("o3", "p9", 1),
        ]),
        "events": frame("events", [
            event("e1", "s1", "page_view", product="p1"), event("e2", "s1", "add_to_cart", product="p1"),
            event("e3", "s1", "checkout", order_id="o1"), event("e4", "s2", "page_view", product="p1"),
            event("e5", "s2", "page_view", product="p2"), event("e6", "s3", "page_view", product="p2"),
            event("e7", "s3", "add_to_cart", product="p3"), event("e8", "s4", "checkout", order_id="o3"),
            event("e9", "s4", "package_shipped", order_id="o3"), event("e10", "s4", "page_view"),
        ]),
    }
    return Project(tables)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_totals_and_rates(shop):
    assert rows(shop.ref("number_of_users")) == [(3,)]
    assert rows(shop.ref("number_of_orders")) == [(4,)]
    assert rows(shop.ref("user_repeat_rate")) == [(1.0,)]
    assert rows(shop.ref("add_to_cart_rate")) == [(2, 4, 0.5)]


def test_rates_of_empty_tables_are_null(spark):
    empty = Project({n: spark.createDataFrame([], ddl) for n, ddl in COMMERCE.items()})
    assert rows(empty.ref("user_repeat_rate")) == [(None,)]
    assert rows(empty.ref("add_to_cart_rate")) == [(0, 0, None)]
    assert rows(empty.ref("fct_orders")) == []
    assert rows(empty.ref("conversion_rate_by_product")) == []
    text = commerce.monthly_summary(empty, "Texas", 2021, 2).first()[0]
    assert text == "In Texas, the most ordered houseplants are . In February 2021, there were 0 orders."


def test_repeat_rate_counts_distinct_orders(spark):
    ddl = COMMERCE["orders"]
    n = len(ddl.split(","))
    pad = [None] * (n - 2)
    data = [("o1", "u1", *pad), ("o1", "u1", *pad), ("o2", "u2", *pad), ("o3", "u2", *pad), ("o4", None, *pad), ("o5", None, *pad)]
    orders = spark.createDataFrame(data, ddl)
    # u1 repeats one order, u2 has two; the group without a user adds to the dividend only.
    assert rows(Project({"orders": orders}).ref("user_repeat_rate")) == [(1.0,)]


def test_conversion_keeps_the_fan_out(shop):
    assert rows(shop.ref("page_views_by_product")) == [("p1", "Fern", 2), ("p2", "Cactus", 2), ("p3", "Moss", 0)]
    assert rows(shop.ref("checkouts_by_product")) == [("p1", "Fern", 2), ("p2", "Cactus", 2), (None, None, 1)]
    assert rows(shop.ref("conversion_rate_by_product")) == [("Cactus", 2, 2, 1.0), ("Fern", 2, 2, 1.0)]


def test_product_without_views_has_no_rate(spark, shop):
    sources = {n: shop.source(n) for n in COMMERCE}
    sources["events"] = sources["events"].filter("event_type != 'page_view'")
    # p1 keeps an add_to_cart event, so it has a group with zero views
    assert rows(Project(sources).ref("conversion_rate_by_product")) == [("Fern", 2, 0, None)]


def test_order_fact_is_by_line_and_uses_the_order_address(shop):
    fact = shop.ref("fct_orders")
    assert len(fact.columns) == 19
    assert rows(fact.select("order_guid", "state", "quantity", "product_name")) == [
        ("o1", "California", 1, "Fern"), ("o1", "California", 2, "Cactus"), ("o2", "Texas", 3, "Fern"),
        ("o3", "California", 1, None), ("o3", "California", 4, "Cactus"), ("o3", "California", 5, "Fern"),
        ("o4", "California", None, None),
    ]
    assert fact.filter("order_guid = 'o1'").select("zipcode").first()[0] == "90001"


def test_order_lines_take_the_key_of_the_product_table(shop):
    lines = shop.ref("int_order_lines").select("order_guid", "product_guid")
    assert rows(lines.filter("order_guid in ('o3', 'o4')")) == [
        ("o3", "p1"), ("o3", "p2"), ("o3", None), ("o4", None)
    ]


def test_monthly_summary_counts_lines_and_breaks_ties_by_name(shop):
    top = commerce.top_products(shop, "California", 2021, 2, 2)
    assert [tuple(r) for r in top.collect()] == [("Cactus", 2), ("Fern", 2)]
    text = commerce.monthly_summary(shop, "California", 2021, 2, 2).first()[0]
    assert text == "In California, the most ordered houseplants are Cactus, Fern. In February 2021, there were 5 orders."
    march = commerce.monthly_summary(shop, "California", 2021, 3).first()[0]
    assert march == "In California, the most ordered houseplants are . In March 2021, there were 1 orders."


def test_staging_names(shop):
    assert shop.ref("stg_events").columns == [
        "event_guid", "session_guid", "user_guid", "page_url", "event_created_at_utc", "event_type", "order_guid",
        "product_guid",
    ]
    assert dict(shop.ref("stg_addresses").dtypes)["zipcode"] == "string"
    assert shop.ref("stg_promos").columns == ["promo_guid", "discount", "promo_status"]


def test_models_are_built_once_and_published(spark, shop):
    assert shop.ref("stg_orders") is shop.ref("stg_orders")
    assert rows(shop.materialise("number_of_users")) == [(3,)]
    assert rows(spark.sql("SELECT user_count FROM number_of_users")) == [(3,)]
    assert rows(shop.materialise("number_of_orders", "table", "reporting")) == [(4,)]
    assert rows(spark.table("reporting.number_of_orders")) == [(4,)]
    assert "fct_orders" in MODELS


def test_staging_checks_of_the_models(shop):
    users, events = shop.ref("stg_users"), shop.ref("stg_events")
    assert quality.has_length(users, "phone_number").count() == 1
    assert quality.has_at_sign(users, "email").count() == 1
    assert quality.ordered(users, "created_at_utc", "updated_at_utc").count() == 1
    kinds = ["page_view", "add_to_cart", "checkout", "package_shipped"]
    assert quality.accepted_values(events, "event_type", kinds).count() == 0
    masked = governance.mask(users).select("email", "user_guid").first()
    assert tuple(masked) == ("MASKED_PII_MASKING", "u1")


MOVEMENTS = "event_type string, actual_timestamp timestamp, event_source string, train_id string, variation_status string, toc_id string"


def test_movements_double_for_a_company_listed_twice(spark):
    moves = spark.createDataFrame(
        [("ARRIVAL", T0, "AUTOMATIC", f"T{i}", "LATE", toc) for i, toc in enumerate(["88", "20", "99", "x", None])], MOVEMENTS
    )
    companies = spark.createDataFrame([(88, "A"), (88, "B"), (20, "C"), (7, "D")], "toc_id int, company_name string")
    rail = Project({"movements": moves, "operating_companies": companies})
    fact = rail.ref("fct_movements")
    assert fact.columns == ["event_type", "actual_timestamp_utc", "event_source", "train_id", "variation_status", "toc_id"]
    assert sorted(r["train_id"] for r in fact.collect()) == ["T0", "T0", "T1", "T2", "T3", "T4"]
    once = join_companies(rail.ref("stg_movements"), rail.ref("stg_operating_companies"), dedupe_reference=True)
    assert once.count() == 5
    assert fact.filter(F.col("toc_id") == "x").count() == 1


def test_literal_relation(spark):
    assert rows(spark.sql("SELECT 'hello' AS greeting")) == [("hello",)]


def test_sums_over_lines_equal_a_left_join(spark):
    left = spark.createDataFrame([("a", 2), ("a", 3), ("b", 5), ("c", 7), (None, 11)], "k string, w bigint")
    lines = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("b", None), ("z", 9), (None, 4)], "k string, item int")
    joined = left.join(lines, "k", "left").groupBy("item").agg(F.sum("w").alias("w"))
    assert sorted(map(tuple, sums_over_lines(left, lines, "k", "item", "w").collect()), key=str) == sorted(map(tuple, joined.collect()), key=str)
    assert sums_over_lines(left.limit(0), lines, "k", "item", "w").collect() == []


def test_lines_are_read_once(spark):
    shop = project(configure(spark), "/root/testdata/sf0.001")
    for df in (shop.ref("checkouts_by_product"), lines_in_month(shop, "IRAN", 1996, 1)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert sum("l_orderkey" in line for line in plan.splitlines() if "Relation [" in line) == 1
