"""Commerce models: staging, joins, facts, rates, monthly summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.dates import in_range, month_bounds, month_name
from millrace.functions.text import ratio
from millrace.operators.joins import left_join_lines, sums_over_lines
from millrace.operators.project import rename, top_by_count
from millrace.plans.models import Project, model

# Staging names of the source columns.
STAGING_NAMES = {
    "users": {
        "user_id": "user_guid",
        "created_at": "created_at_utc",
        "updated_at": "updated_at_utc",
        "address_id": "address_guid",
    },
    "addresses": {"address_id": "address_guid"},
    "products": {"product_id": "product_guid", "name": "product_name"},
    "promos": {"promo_id": "promo_guid", "status": "promo_status"},
    "orders": {
        "order_id": "order_guid",
        "user_id": "user_guid",
        "promo_id": "promo_guid",
        "address_id": "address_guid",
        "created_at": "order_created_at_utc",
        "order_cost": "order_cost_usd",
        "shipping_cost": "shipping_cost_usd",
        "order_total": "order_total_usd",
        "tracking_id": "tracking_guid",
        "estimated_delivery_at": "estimated_delivery_at_utc",
        "delivered_at": "delivered_at_utc",
        "status": "order_status",
    },
    "order_items": {"order_id": "order_guid", "product_id": "product_guid"},
    "events": {
        "event_id": "event_guid",
        "session_id": "session_guid",
        "user_id": "user_guid",
        "created_at": "event_created_at_utc",
        "order_id": "order_guid",
        "product_id": "product_guid",
    },
}


def _stage(project: Project, table: str) -> DataFrame:
    return rename(project.source(table), STAGING_NAMES[table])


@model
def stg_users(project: Project) -> DataFrame:
    return _stage(project, "users")


@model
def stg_addresses(project: Project) -> DataFrame:
    return _stage(project, "addresses").withColumn("zipcode", F.col("zipcode").cast("string"))


@model
def stg_products(project: Project) -> DataFrame:
    return _stage(project, "products")


@model
def stg_promos(project: Project) -> DataFrame:
    return _stage(project, "promos")


@model
def stg_orders(project: Project) -> DataFrame:
    return _stage(project, "orders")


@model
def stg_order_items(project: Project) -> DataFrame:
    return _stage(project, "order_items")


@model
def stg_events(project: Project) -> DataFrame:
    return _stage(project, "events")


@model
def int_orders_joined(project: Project) -> DataFrame:
    """Order lines with user, delivery address and product; the address is the order's own.

    The order-side joins come first, at order grain; lines and products follow. A hot user, address or
    product sits on the left, which AQE can split; a hot order is split among its lines.
    """
    users = project.ref("stg_users").select("user_guid", F.col("created_at_utc").alias("user_created_at_utc"))
    addresses = project.ref("stg_addresses").select("address_guid", "zipcode", "state", "country")
    lines = project.ref("stg_order_items")
    products = project.ref("stg_products")
    orders = project.ref("stg_orders").join(users, "user_guid", "left").join(addresses, "address_guid", "left")
    return (
        left_join_lines(orders, lines, "order_guid")
        .join(products, "product_guid", "left")
        .select(
            "order_guid", "order_created_at_utc", "order_cost_usd", "shipping_cost_usd", "order_total_usd",
            "shipping_service", "estimated_delivery_at_utc", "delivered_at_utc", "order_status", "user_guid",
            "promo_guid", "user_created_at_utc", "zipcode", "state", "country", "quantity", "product_name",
            "price", "inventory",
        )
    )


@model
def int_order_lines(project: Project) -> DataFrame:
    """Orders with their lines and products; the product key is the product table's."""
    lines = project.ref("stg_order_items").withColumnRenamed("product_guid", "line_product_guid")
    products = project.ref("stg_products")
    return (
        left_join_lines(project.ref("stg_orders"), lines, "order_guid")
        .join(products, F.col("line_product_guid") == products["product_guid"], "left")
        .select(
            "order_guid", "user_guid", "product_guid", "product_name", "promo_guid", "order_cost_usd",
            "shipping_cost_usd", "order_total_usd", "shipping_service", "quantity", "inventory",
            "order_created_at_utc", "estimated_delivery_at_utc", "delivered_at_utc", "order_status",
        )
    )


@model
def fct_orders(project: Project) -> DataFrame:
    return project.ref("int_orders_joined")


@model
def number_of_users(project: Project) -> DataFrame:
    return project.ref("stg_users").agg(F.count_distinct("user_guid").alias("user_count"))


@model
def number_of_orders(project: Project) -> DataFrame:
    return project.ref("stg_orders").agg(F.count_distinct("order_guid").alias("order_count"))


@model
def orders_per_user(project: Project) -> DataFrame:
    return project.ref("stg_orders").groupBy("user_guid").agg(F.count_distinct("order_guid").alias("user_orders"))


@model
def user_repeat_rate(project: Project) -> DataFrame:
    """Share of ordering users with two or more distinct orders; orders without a user count for nobody
    in the divisor but, as one group, may count in the dividend."""
    flags = project.ref("orders_per_user").select("user_guid", (F.col("user_orders") >= 2).cast("int").alias("repeat"))
    # One row per user already, so counting the non-null keys is counting the distinct users.
    return flags.agg(ratio(F.sum("repeat"), F.count("user_guid")).alias("repeat_rate"))


@model
def add_to_cart_rate(project: Project) -> DataFrame:
    """Sessions with an add-to-cart over all sessions: one grouped pass, no join of two totals."""
    sessions = (
        project.ref("stg_events")
        .filter(F.col("session_guid").isNotNull())
        .groupBy("session_guid")
        .agg(F.max(F.when(F.col("event_type") == "add_to_cart", 1).otherwise(0)).alias("added"))
    )
    totals = sessions.agg(
        F.coalesce(F.sum("added"), F.lit(0)).alias("number_of_unique_add_to_cart_sessions"),
        F.count(F.lit(1)).alias("number_of_unique_sessions"),
    )
    return totals.withColumn(
        "add_to_cart_rate", ratio(F.col("number_of_unique_add_to_cart_sessions"), F.col("number_of_unique_sessions"))
    )


def _flag(event_type: str):
    return F.when(F.col("event_type") == event_type, 1).otherwise(0)


@model
def page_views_by_product(project: Project) -> DataFrame:
    """Page views of every product that has any event; events are counted before products are joined."""
    counted = (
        project.ref("stg_events")
        .filter(F.col("product_guid").isNotNull())
        .groupBy(F.col("product_guid").alias("event_product_guid"))
        .agg(F.sum(_flag("page_view")).alias("views"))
    )
    products = project.ref("stg_products").select("product_guid", "product_name")
    return (
        counted.join(products, counted["event_product_guid"] == products["product_guid"], "left")
        .groupBy("product_guid", "product_name")
        .agg(F.sum("views").alias("page_view_count"))
    )


@model
def checkouts_by_product(project: Project) -> DataFrame:
    """Checkout events fanned out over the products of their order.

    Events shrink to one row per order and lines to one row per (order, product) before they meet, so neither a hot
    order nor a hot product multiplies rows, and the lines are read once. An event whose order is not known, or has no
    lines, counts under no product.
    """
    orders = project.ref("stg_orders").groupBy("order_guid").agg(F.count(F.lit(1)).alias("orders"))
    events = (
        project.ref("stg_events")
        .filter(F.col("order_guid").isNotNull())
        .groupBy("order_guid")
        .agg(F.sum(_flag("checkout")).alias("checkouts"))
        .join(orders, "order_guid", "left")
        .select(
            F.when(F.col("orders").isNotNull(), F.col("order_guid")).alias("order_guid"),
            (F.col("checkouts") * F.coalesce("orders", F.lit(1))).alias("checkouts"),
        )
    )
    lines = project.ref("stg_order_items").select("order_guid", F.col("product_guid").alias("line_product_guid"))
    counted = sums_over_lines(events, lines, "order_guid", "line_product_guid", "checkouts")
    products = project.ref("stg_products").select("product_guid", "product_name")
    return (
        counted.join(products, F.col("line_product_guid") == products["product_guid"], "left")
        .groupBy("product_guid", "product_name")
        .agg(F.sum("checkouts").alias("checkout_count"))
    )


@model
def conversion_rate_by_product(project: Project) -> DataFrame:
    """Checkout lines over page views; products without a key on either side drop out.

    Same sums as the two models above, but as the key must exist the joins are inner: events are first
    reduced to one row per order, then meet the lines once, and the product names come last.
    """
    checkouts = (
        project.ref("stg_events")
        .filter(F.col("order_guid").isNotNull())
        .groupBy("order_guid")
        .agg(F.sum(_flag("checkout")).alias("checkouts"))
        .join(project.ref("stg_orders").select("order_guid"), "order_guid")
        .join(project.ref("stg_order_items").select("order_guid", "product_guid"), "order_guid")
        .groupBy("product_guid")
        .agg(F.sum("checkouts").alias("checkouts"))
    )
    products = project.ref("stg_products").select("product_guid", "product_name")
    bought = (
        checkouts.join(products, "product_guid")
        .groupBy("product_guid", "product_name")
        .agg(F.sum("checkouts").alias("checkout_count"))
    )
    viewed = project.ref("page_views_by_product").select("product_guid", "page_view_count")
    return bought.join(viewed, "product_guid").select(
        "product_name",
        "checkout_count",
        "page_view_count",
        ratio(F.col("checkout_count"), F.col("page_view_count")).alias("conversion_rate"),
    )


def lines_in_month(project: Project, state: str, year: int, month: int) -> DataFrame:
    """Fact rows of one state and month, counted by product key before the names are joined."""
    addresses = project.ref("stg_addresses").filter(F.col("state") == state).select("address_guid")
    orders = (
        project.ref("stg_orders")
        .filter(in_range(F.col("order_created_at_utc"), month_bounds(year, month)))
        .select("order_guid", "address_guid")
        .join(addresses, "address_guid")
    )
    orders = orders.groupBy("order_guid").agg(F.count(F.lit(1)).alias("lines"))
    lines = project.ref("stg_order_items").select("order_guid", "product_guid")
    wanted = lines.join(orders.select("order_guid"), "order_guid", "left_semi")  # no other order's lines move on
    counted = sums_over_lines(orders, wanted, "order_guid", "product_guid", "lines")
    products = project.ref("stg_products").select("product_guid", "product_name")
    return counted.join(products, "product_guid", "left").select("product_name", "lines")


def top_products(project: Project, state: str, year: int, month: int, k: int = 3) -> DataFrame:
    """The most ordered products of a state in a month; equal counts in name order."""
    return top_by_count(lines_in_month(project, state, year, month), "product_name", k, weight="lines")


def monthly_summary(project: Project, state: str, year: int, month: int, k: int = 3) -> DataFrame:
    """One sentence about a state's month: its top products and its number of fact rows.

    The count is of order lines, as the fact's grain is the line. The month's total is the rollup row
    above the products, so one pass gives both; after the limit only ``k + 1`` rows are left to word.
    """
    rolled = (
        lines_in_month(project, state, year, month)
        .rollup("product_name")
        .agg(F.sum("lines").alias("record_count"), F.grouping("product_name").alias("is_total"))
    )
    best = rolled.orderBy(F.desc("is_total"), F.desc("record_count"), F.asc_nulls_last("product_name")).limit(k + 1)
    ranked = F.when(F.col("is_total") == 0, F.struct((-F.col("record_count")).alias("rank"), "product_name"))
    names = F.transform(F.array_sort(F.collect_list(ranked)), lambda pair: pair["product_name"])
    total = F.coalesce(F.max(F.when(F.col("is_total") == 1, F.col("record_count"))), F.lit(0))
    place = state.replace("%", "%%")
    # Fixed value: the wording of the sentence.
    sentence = f"In {place}, the most ordered houseplants are %s. In %s, there were %d orders."
    when = month_name(F.make_date(F.lit(year), F.lit(month), F.lit(1)))
    return best.agg(F.format_string(sentence, F.concat_ws(", ", names), when, total).alias("text"))
