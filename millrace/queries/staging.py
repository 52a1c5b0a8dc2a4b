"""Staging projections."""

from millrace.operators.project import lower_names
from millrace.plans.bindings import project, table
from millrace.queries.registry import query
from millrace.queries.roles import with_roles


@query(with_roles("users", """SELECT user_id AS user_guid, first_name, last_name, email, phone_number,
    created_at AS created_at_utc, updated_at AS updated_at_utc, address_id AS address_guid FROM users"""))
def stg_users(spark, folder):
    return project(spark, folder).ref("stg_users")


@query(with_roles("addresses", """SELECT address_id AS address_guid, address, CAST(zipcode AS VARCHAR) AS zipcode,
    state, country FROM addresses"""))
def stg_addresses(spark, folder):
    return project(spark, folder).ref("stg_addresses")


@query(with_roles("products", """SELECT product_id AS product_guid, name AS product_name, price, inventory
    FROM products"""))
def stg_products(spark, folder):
    return project(spark, folder).ref("stg_products")


@query(with_roles("promos", "SELECT promo_id AS promo_guid, discount, status AS promo_status FROM promos"))
def stg_promos(spark, folder):
    return project(spark, folder).ref("stg_promos")


@query(with_roles("shop_orders", """SELECT order_id AS order_guid, user_id AS user_guid, promo_id AS promo_guid,
    address_id AS address_guid, created_at AS order_created_at_utc, order_cost AS order_cost_usd,
    shipping_cost AS shipping_cost_usd, order_total AS order_total_usd, tracking_id AS tracking_guid,
    shipping_service, estimated_delivery_at AS estimated_delivery_at_utc, delivered_at AS delivered_at_utc,
    status AS order_status FROM shop_orders"""))
def stg_orders(spark, folder):
    return project(spark, folder).ref("stg_orders")


@query(with_roles("order_items", "SELECT order_id AS order_guid, product_id AS product_guid, quantity FROM order_items"))
def stg_order_items(spark, folder):
    return project(spark, folder).ref("stg_order_items")


@query(with_roles("shop_events", """SELECT event_id AS event_guid, session_id AS session_guid, user_id AS user_guid,
    page_url, created_at AS event_created_at_utc, event_type, order_id AS order_guid, product_id AS product_guid
    FROM shop_events"""))
def stg_events(spark, folder):
    return project(spark, folder).ref("stg_events")


@query(with_roles("movements", """SELECT event_type, actual_timestamp AS actual_timestamp_utc, event_source, train_id,
    variation_status, toc_id FROM movements"""))
def stg_movements(spark, folder):
    return project(spark, folder).ref("stg_movements")


@query("SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def lower_case_columns(spark, folder):
    part = table(spark, folder, "part")
    return lower_names(part.toDF(*[c.upper() for c in part.columns]))
