"""Extracts, loads, day partitions, backfill."""

import datetime as dt

from pyspark.sql import functions as F

from millrace.functions.dates import moment
from millrace.plans.bindings import project, table
from millrace.queries.registry import query
from millrace.queries.roles import with_roles
from millrace.schemas import struct
from millrace.session import scratch
from millrace.sinks import backfill
from millrace.sinks import tables as S
from millrace.sinks.layout import cleaned_path, raw_path
from millrace.sources import files, jdbc, landing

DAY = "1998-02-10"


@query(f"SELECT * FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '{DAY}'")
def date_slice(spark, folder):
    return jdbc.day_slice(table(spark, folder, "orders"), "o_orderdate", DAY)


@query("""SELECT * FROM orders WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders
    WHERE o_orderdate < TIMESTAMP '2000-01-01')""")
def high_water_incremental(spark, folder):
    orders = table(spark, folder, "orders")
    loaded = orders.filter(F.col("o_orderdate") < moment(dt.datetime(2000, 1, 1)))
    return jdbc.increment(orders, loaded, "o_orderdate")


@query("""SELECT event_id, ts, event_type, CASE WHEN CAST(ts AS DATE) = DATE '2024-01-10' THEN value + 100 ELSE value END
    AS value, CAST(ts AS DATE) AS created_at_day FROM events""")
def day_partition_replace(spark, folder):
    """All days loaded, then one of them replaced; the others stay."""
    path = scratch(spark, "days")
    events = table(spark, folder, "events").select("event_id", "ts", "event_type", "value")
    S.write_by_day(events, path, "ts")
    day = jdbc.day_slice(events, "ts", "2024-01-10").withColumn("value", F.col("value") + 100)
    for _ in range(2):
        S.replace_days(day, path, "ts")
    return spark.read.schema(S.with_day(events, "ts").schema).parquet(path)


@query("SELECT event_id, ts, value FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-03' AND DATE '2024-01-09'")
def partitioned_load(spark, folder):
    path = scratch(spark, "days")
    events = table(spark, folder, "events").select("event_id", "ts", "value")
    S.write_by_day(events, path, "ts")
    stored = spark.read.schema(S.with_day(events, "ts").schema).parquet(path)
    days = F.col("created_at_day").between(F.lit(dt.date(2024, 1, 3)), F.lit(dt.date(2024, 1, 9)))
    return stored.filter(days).drop("created_at_day")


@query(with_roles("users", "SELECT * FROM users WHERE first_name = 'Customer' AND last_name < '000000100'"))
def clustered_load(spark, folder):
    path = scratch(spark, "clustered")
    S.write_clustered(project(spark, folder).source("users"), path, ["first_name", "last_name"])
    return spark.read.parquet(path).filter("first_name = 'Customer' AND last_name < '000000100'")


@query("SELECT * FROM part")
def truncate_and_load(spark, folder):
    """A table loaded twice holds the second load."""
    path, part = scratch(spark, "table"), table(spark, folder, "part")
    name = "part_" + path.rsplit("-", 1)[1]
    S.load_table(part.withColumn("p_size", F.lit(0)), name, path)
    S.load_table(part, name, path)
    return spark.table(name)


@query("SELECT o_custkey AS user_guid, count(DISTINCT o_orderkey) AS user_orders FROM orders GROUP BY 1")
def materialised_model(spark, folder):
    """A model published as a table of its layer, read through a view."""
    shop, path = project(spark, folder), scratch(spark, "reporting")
    stored = shop.materialise("orders_per_user", "table", "reporting", path)
    stored.createOrReplaceTempView("orders_per_user_view")
    return spark.table("orders_per_user_view")


@query("SELECT user_id, created_at, address_id FROM (" + with_roles(
    "users", "SELECT user_id, created_at, address_id FROM users") + ")")
def declared_schema_load(spark, folder):
    """Text columns loaded under a declared schema with parsed timestamps."""
    shown = project(spark, folder).source("users").select(
        *[F.col(c).cast("string").alias(c) for c in ("user_id", "created_at", "address_id")]
    )
    path = scratch(spark, "declared")
    S.write_parquet(S.conform(shown, struct("user_id bigint, created_at timestamp_ntz, address_id int")), path)
    return spark.read.parquet(path)


@query("""SELECT p_partkey, CASE WHEN p_size <= 40 THEN CAST(p_size AS INTEGER) END AS p_size,
    CASE WHEN p_size > 40 THEN p_type END AS rejected_text FROM part""")
def rejecting_load(spark, folder):
    """Sizes as text, some of them no numbers: good rows are loaded, the others are kept with their text."""
    size = F.when(F.col("p_size") > 40, F.col("p_type")).otherwise(F.col("p_size").cast("string"))
    shown = table(spark, folder, "part").select("p_partkey", size.alias("p_size"))
    loaded, rejected = S.conform_or_reject(shown, struct("p_partkey bigint, p_size int"))
    path, aside = scratch(spark, "loaded"), scratch(spark, "rejected")
    S.write_parquet(loaded.withColumn("rejected_text", F.lit(None).cast("string")), path)
    no_size = F.lit(None).cast("int").alias("p_size")
    S.write_parquet(rejected.select("p_partkey", no_size, F.col("p_size").alias("rejected_text")), aside)
    return spark.read.parquet(path, aside)


@query("""SELECT 'orders' AS table_name, count(*) AS row_count, CAST(6 AS BIGINT) AS column_count FROM orders
    UNION ALL SELECT 'lineitem', count(*), 11 FROM lineitem UNION ALL SELECT 'events', count(*), 6 FROM events""")
def load_audit(spark, folder):
    def audited(name):
        path, source = scratch(spark, name), table(spark, folder, name)
        row = S.audited(lambda: S.write_parquet(source, path), lambda: spark.read.parquet(path), name)
        return row.drop("seconds")

    return audited("orders").unionByName(audited("lineitem")).unionByName(audited("events"))


@query("SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1")
def export_query(spark, folder):
    path = scratch(spark, "export")
    table(spark, folder, "orders").createOrReplaceTempView("export_orders")
    S.export_query(spark, "SELECT o_orderpriority, count(*) AS n FROM export_orders GROUP BY 1", path)
    return spark.read.parquet(path)


@query("SELECT * FROM customer")
def bulk_dump(spark, folder):
    path, customers = scratch(spark, "dump"), table(spark, folder, "customer")
    customers.createOrReplaceTempView("dump_customer")
    S.dump_table(spark, "dump_customer", path)
    return files.read_csv_typed(spark, path, customers.schema)


@query("SELECT o_orderkey, o_orderstatus, 'fallback' AS written_by FROM orders")
def primary_or_fallback(spark, folder):
    """The primary plan fails on bad input at run time; the fallback's rows are what gets loaded."""
    path, orders = scratch(spark, "fallback"), table(spark, folder, "orders")
    chosen = S.first_that_works(
        lambda: orders.select("o_orderkey", F.col("o_orderstatus").cast("int")),
        lambda: orders.select("o_orderkey", "o_orderstatus"),
        path,
    )
    return spark.read.parquet(path).withColumn("written_by", F.lit(chosen.written))


RUN_LOG = """run_log AS (SELECT CAST(o_orderdate AS DATE) AS day, max(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS ok
    FROM orders WHERE day(o_orderdate) NOT IN (1, 15) GROUP BY 1),
  days AS (SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS day
    FROM orders)"""


def _run_log(spark, folder):
    """Daily runs as the orders suggest them: none on the 1st and 15th, failed where nothing finished."""
    orders = table(spark, folder, "orders").select(F.to_date("o_orderdate").alias("day"), "o_orderstatus")
    ran = orders.filter(~F.dayofmonth("day").isin(1, 15))
    status = F.when(F.col("o_orderstatus") == "F", "success").otherwise("failed")
    return ran.select("day", status.alias("status")).distinct()


def _days(spark, folder):
    bounds = table(spark, folder, "orders").agg(
        F.to_date(F.min("o_orderdate")).alias("first"), F.to_date(F.max("o_orderdate")).alias("last")
    )
    return backfill.days_between(F.col("first"), F.col("last"), bounds)


@query(f"WITH {RUN_LOG} SELECT day FROM days WHERE day NOT IN (SELECT day FROM run_log)")
def backfill_missing(spark, folder):
    return backfill.plan_days(_days(spark, folder), _run_log(spark, folder))


@query(f"WITH {RUN_LOG} SELECT day FROM days WHERE day NOT IN (SELECT day FROM run_log WHERE ok = 1)")
def backfill_missing_and_failed(spark, folder):
    return backfill.plan_days(_days(spark, folder), _run_log(spark, folder), "missing_and_failed")


@query(f"WITH {RUN_LOG} SELECT day FROM days")
def backfill_all(spark, folder):
    return backfill.plan_days(_days(spark, folder), _run_log(spark, folder), "all")


LANDED = {"event_id": "event_id", "user_id": "user", "order_id": "order", "product_id": "product"}


@query(with_roles("shop_events", """SELECT event_id, CAST(NULL AS VARCHAR) AS session_id, user_id, order_id, product_id
    FROM shop_events"""))
def landed_projection(spark, folder):
    """Landed records carry short key names; the models' names and order come back, absent fields as null."""
    events = project(spark, folder).source("events").select(*[F.col(c).alias(n) for c, n in LANDED.items()])
    path = scratch(spark, "landed")
    events.write.json(path)
    records = spark.read.schema("event_id bigint, user bigint, order bigint, product bigint").json(path)
    return landing.normalise(
        records, struct("event_id bigint, session_id string, user_id bigint, order_id bigint, product_id bigint")
    )


@query(with_roles("shop_events", """SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, CAST(user_id AS VARCHAR)
    AS user_id FROM shop_events WHERE CAST(created_at AS DATE) = DATE '2024-01-07'"""))
def landed_day(spark, folder):
    """One day of events landed raw; a day without events lands nothing."""
    root, events = scratch(spark, "landing"), project(spark, folder).source("events")
    columns = ["event_id", "event_type", "user_id"]
    for day in ("2024-01-07", "2031-01-01"):
        landing.land_day(jdbc.day_slice(events, "created_at", day).select(*columns), root, "shop", "events", day)
    assert files.read_if_present(spark, raw_path(root, "shop", "events", "2031-01-01")) is None
    return files.read_if_present(spark, raw_path(root, "shop", "events", "2024-01-07"))


@query(with_roles("products", "SELECT * FROM products"))
def layered_load(spark, folder):
    """Raw CSV, cleaned Parquet, then the typed read of the cleaned layer."""
    root, products = scratch(spark, "layers"), project(spark, folder).source("products")
    S.write_csv(products, raw_path(root, "shop", "products"))
    typed = files.read_csv_typed(spark, raw_path(root, "shop", "products"), products.schema)
    S.write_parquet(typed, cleaned_path(root, "shop", "products"))
    return files.read_parquet(spark, cleaned_path(root, "shop", "products"))


@query(with_roles("shop_events", """SELECT event_id, created_at, event_type, CAST(created_at AS DATE) AS created_at_day
    FROM shop_events WHERE CAST(created_at AS DATE) IN (DATE '2024-01-07', DATE '2024-01-08')"""))
def daily_ingest(spark, folder):
    """Two days ingested, one of them twice; a missing input is skipped."""
    path, events = scratch(spark, "ingest"), project(spark, folder).source("events")
    rows = events.select("event_id", "created_at", "event_type")
    for day in ("2024-01-07", "2024-01-08", "2024-01-07"):
        S.ingest_day(rows, path, "created_at", day)
    S.ingest_day(None, path, "created_at", "2024-01-09")
    return spark.read.schema(S.with_day(rows, "created_at").schema).parquet(path)


@query("SELECT CAST(s_suppkey AS INTEGER) AS s_suppkey, s_name FROM supplier")
def seed_load(spark, folder):
    """A CSV seed loaded into a table with declared types, and the table read."""
    path, place = scratch(spark, "seed"), scratch(spark, "seeded")
    S.write_csv(table(spark, folder, "supplier").select("s_suppkey", "s_name"), path)
    name = f"seed_{place.rsplit('-', 1)[1]}"
    S.load_seed(spark, path, "s_suppkey int, s_name string", name, place)
    return spark.table(name)
