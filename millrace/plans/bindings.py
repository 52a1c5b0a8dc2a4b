"""Commerce and rail sources read from the test tables.

Fixed binding: users from customer, orders from orders, order_items from lineitem, products from part,
addresses from nation with region, promos from the order priorities, events and movements from events.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.text import name_part
from millrace.plans import commerce, rail  # noqa: F401  (registers the models)
from millrace.plans.models import Project


_SCHEMAS: dict[tuple[str, str], T.StructType] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A test table; its footer is read for the schema once per application, not once per use."""
    path = f"{folder.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _SCHEMAS:
        _SCHEMAS[key] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[key]).parquet(path)


def users(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    name = F.replace("c_name", F.lit("#"), F.lit(" "))
    number = F.lpad(key.cast("string"), 10, "0")
    created = F.expr("TIMESTAMP_NTZ'1994-01-01 00:00:00' + make_dt_interval(CAST(c_custkey % 365 AS INT))")
    return table(spark, folder, "customer").select(
        key.alias("user_id"),
        name_part(name, 0).alias("first_name"),
        name_part(name, 1).alias("last_name"),
        F.when(key % 10 == 7, F.lower(name)).otherwise(
            F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.com"))
        ).alias("email"),
        F.when(key % 50 == 3, number)
        .otherwise(F.concat_ws("-", number.substr(1, 3), number.substr(4, 3), number.substr(7, 4)))
        .alias("phone_number"),
        created.alias("created_at"),
        F.when(key % 40 == 1, created - F.expr("INTERVAL 1 DAY"))
        .otherwise(created + F.expr("INTERVAL 2 DAY"))
        .alias("updated_at"),
        F.col("c_nationkey").alias("address_id"),
    )


def addresses(spark: SparkSession, folder: str) -> DataFrame:
    nations = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left"
    )
    return nations.select(
        F.col("n_nationkey").alias("address_id"),
        F.concat(F.lit("1 Main Street, "), "n_name").alias("address"),
        (F.col("n_nationkey") * 100 + 10001).cast("bigint").alias("zipcode"),
        F.col("r_name").alias("state"),
        F.col("n_name").alias("country"),
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("name"),
        F.col("p_retailprice").alias("price"),
        F.col("p_size").cast("bigint").alias("inventory"),
    )


def promos(spark: SparkSession, folder: str) -> DataFrame:
    level = F.substring("o_orderpriority", 1, 1).cast("bigint")
    return (
        table(spark, folder, "orders")
        .select("o_orderpriority")
        .distinct()
        .select(
            F.col("o_orderpriority").alias("promo_id"),
            (level * 5).alias("discount"),
            F.when(level <= 3, "active").otherwise("inactive").alias("status"),
        )
    )


def orders(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("o_orderkey")
    shipping = F.col("o_totalprice") * 0.0625
    return table(spark, folder, "orders").select(
        key.alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.when(key % 4 != 0, F.col("o_orderpriority")).alias("promo_id"),
        (F.col("o_custkey") % 25).cast("int").alias("address_id"),
        F.col("o_orderdate").alias("created_at"),
        F.col("o_totalprice").alias("order_cost"),
        shipping.alias("shipping_cost"),
        (F.col("o_totalprice") + shipping).alias("order_total"),
        F.concat(F.lit("TRK"), key.cast("string")).alias("tracking_id"),
        F.when(key % 3 == 0, "ups").when(key % 3 == 1, "fedex").otherwise("dhl").alias("shipping_service"),
        (F.col("o_orderdate") + F.expr("INTERVAL 7 DAY")).alias("estimated_delivery_at"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate") + F.expr("INTERVAL 5 DAY")).alias("delivered_at"),
        F.col("o_orderstatus").alias("status"),
    )


def order_items(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
    )


# Event types of the test table as commerce event types.
EVENT_TYPES = {"view": "page_view", "click": "add_to_cart", "purchase": "checkout", "signup": "package_shipped"}


def events(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_type")
    named = kind
    for found, wanted in EVENT_TYPES.items():
        named = F.when(kind == found, wanted).otherwise(named)
    product = F.get_json_object("props", "$.k").try_cast("bigint")
    return table(spark, folder, "events").select(
        "event_id",
        F.concat_ws("-", F.col("user_id").cast("string"), F.to_date("ts").cast("string")).alias("session_id"),
        "user_id",
        F.concat(F.lit("/"), kind, F.lit("/"), product.cast("string")).alias("page_url"),
        F.col("ts").alias("created_at"),
        named.alias("event_type"),
        F.when(kind.isin("purchase", "signup"), F.col("event_id")).alias("order_id"),
        F.when(kind.isin("view", "click"), product).alias("product_id"),
    )


def movements(spark: SparkSession, folder: str) -> DataFrame:
    """Events as typed movement rows (the columns the models use)."""
    kind = F.col("event_type")
    return table(spark, folder, "events").select(
        F.when(kind.isin("view", "click"), "ARRIVAL").otherwise("DEPARTURE").alias("event_type"),
        F.col("ts").alias("actual_timestamp"),
        F.when(kind == "error", "MANUAL").otherwise("AUTOMATIC").alias("event_source"),
        F.concat(F.lit("T"), F.col("event_id").cast("string")).alias("train_id"),
        F.when(F.col("value") > 20, "LATE").otherwise("ON TIME").alias("variation_status"),
        F.when(F.col("event_id") % 97 == 0, "n/a").otherwise((F.col("user_id") % 30).cast("string")).alias("toc_id"),
    )


def operating_companies(spark: SparkSession, folder: str) -> DataFrame:
    """Nations as companies; one id occurs twice, as in the real reference list."""
    nations = table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("toc_id"), F.col("n_name").alias("company_name")
    )
    again = nations.filter("toc_id = 8").withColumn("company_name", F.concat("company_name", F.lit(" II")))
    return nations.unionByName(again)


SOURCES = {
    f.__name__: f
    for f in (users, addresses, products, promos, orders, order_items, events, movements, operating_companies)
}


def project(spark: SparkSession, folder: str) -> Project:
    """The commerce and rail project over one folder of test tables."""
    return Project({name: partial(read, spark, folder) for name, read in SOURCES.items()})
