"""The named commerce and rail results."""

import datetime as dt

from millrace.operators.project import bounded_fetch, month_and_state
from millrace.plans import commerce
from millrace.plans.bindings import project
from millrace.plans.rail import join_companies
from millrace.queries.registry import query
from millrace.queries.roles import with_roles

STATE, YEAR, MONTH = "ASIA", 1998, 2

ORDER_FACT = """SELECT o.order_id AS order_guid, o.created_at AS order_created_at_utc, order_cost AS order_cost_usd,
    shipping_cost AS shipping_cost_usd, order_total AS order_total_usd, shipping_service,
    estimated_delivery_at AS estimated_delivery_at_utc, delivered_at AS delivered_at_utc, o.status AS order_status,
    o.user_id AS user_guid, o.promo_id AS promo_guid, u.created_at AS user_created_at_utc,
    CAST(a.zipcode AS VARCHAR) AS zipcode, a.state, a.country, i.quantity, p.name AS product_name, p.price, p.inventory
    FROM shop_orders o LEFT JOIN users u ON o.user_id = u.user_id LEFT JOIN addresses a ON o.address_id = a.address_id
    LEFT JOIN order_items i ON i.order_id = o.order_id LEFT JOIN products p ON i.product_id = p.product_id"""
FACT_ROLES = "shop_orders users addresses order_items products"


@query(with_roles(FACT_ROLES, ORDER_FACT))
def mart_fct_orders(spark, folder):
    return project(spark, folder).ref("fct_orders")


@query(with_roles("shop_orders order_items products", """
    SELECT o.order_id AS order_guid, user_id AS user_guid, p.product_id AS product_guid, p.name AS product_name,
      promo_id AS promo_guid, order_cost AS order_cost_usd, shipping_cost AS shipping_cost_usd,
      order_total AS order_total_usd, shipping_service, quantity, inventory, created_at AS order_created_at_utc,
      estimated_delivery_at AS estimated_delivery_at_utc, delivered_at AS delivered_at_utc, status AS order_status
    FROM shop_orders o LEFT JOIN order_items i ON o.order_id = i.order_id
    LEFT JOIN products p ON i.product_id = p.product_id"""))
def int_order_lines(spark, folder):
    return project(spark, folder).ref("int_order_lines")


@query("SELECT count(DISTINCT c_custkey) AS user_count FROM customer")
def mart_number_of_users(spark, folder):
    return project(spark, folder).ref("number_of_users")


@query("SELECT count(DISTINCT o_orderkey) AS order_count FROM orders")
def mart_number_of_orders(spark, folder):
    return project(spark, folder).ref("number_of_orders")


@query("SELECT o_custkey AS user_guid, count(DISTINCT o_orderkey) AS user_orders FROM orders GROUP BY 1")
def orders_per_user(spark, folder):
    return project(spark, folder).ref("orders_per_user")


@query("""SELECT CAST(sum(CAST(n >= 2 AS INTEGER)) AS DOUBLE) / CAST(count(DISTINCT o_custkey) AS DOUBLE) AS repeat_rate
    FROM (SELECT o_custkey, count(DISTINCT o_orderkey) AS n FROM orders GROUP BY 1)""")
def mart_user_repeat_rate(spark, folder):
    return project(spark, folder).ref("user_repeat_rate")


@query(with_roles("shop_events", """
    SELECT a AS number_of_unique_add_to_cart_sessions, s AS number_of_unique_sessions,
      CAST(a AS DOUBLE) / CAST(s AS DOUBLE) AS add_to_cart_rate
    FROM (SELECT count(DISTINCT session_id) FILTER (WHERE event_type = 'add_to_cart') AS a,
            count(DISTINCT session_id) AS s FROM shop_events)"""))
def mart_add_to_cart_rate(spark, folder):
    return project(spark, folder).ref("add_to_cart_rate")


PAGE_VIEWS = """SELECT p.product_id AS product_guid, p.name AS product_name,
    CAST(sum(CASE WHEN event_type = 'page_view' THEN 1 ELSE 0 END) AS BIGINT) AS page_view_count
    FROM shop_events e LEFT JOIN products p ON e.product_id = p.product_id
    WHERE e.product_id IS NOT NULL GROUP BY 1, 2"""
CHECKOUTS = """SELECT p.product_id AS product_guid, p.name AS product_name,
    CAST(sum(CASE WHEN event_type = 'checkout' THEN 1 ELSE 0 END) AS BIGINT) AS checkout_count
    FROM shop_events e LEFT JOIN shop_orders o ON e.order_id = o.order_id
    LEFT JOIN order_items i ON i.order_id = o.order_id LEFT JOIN products p ON i.product_id = p.product_id
    WHERE e.order_id IS NOT NULL GROUP BY 1, 2"""


@query(with_roles("shop_events products", PAGE_VIEWS))
def page_views_by_product(spark, folder):
    return project(spark, folder).ref("page_views_by_product")


@query(with_roles("shop_events shop_orders order_items products", CHECKOUTS))
def checkouts_by_product(spark, folder):
    return project(spark, folder).ref("checkouts_by_product")


@query(with_roles("shop_events shop_orders order_items products", f"""
    SELECT c.product_name, checkout_count, page_view_count,
      CAST(checkout_count AS DOUBLE) / nullif(CAST(page_view_count AS DOUBLE), 0) AS conversion_rate
    FROM ({CHECKOUTS}) c JOIN ({PAGE_VIEWS}) v ON c.product_guid = v.product_guid"""))
def mart_conversion_by_product(spark, folder):
    return project(spark, folder).ref("conversion_rate_by_product")


MONTH_SLICE = f"""state = '{STATE}' AND order_created_at_utc >= TIMESTAMP '{YEAR}-{MONTH:02}-01'
    AND order_created_at_utc < TIMESTAMP '{YEAR}-{MONTH + 1:02}-01'"""


@query(with_roles(FACT_ROLES, f"""SELECT product_name, count(*) AS record_count FROM ({ORDER_FACT}) f
    WHERE {MONTH_SLICE} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3"""))
def top3_parts_month(spark, folder):
    return commerce.top_products(project(spark, folder), STATE, YEAR, MONTH)


@query(with_roles(FACT_ROLES, f"""SELECT * FROM ({ORDER_FACT}) f WHERE {MONTH_SLICE}"""))
def fact_month_slice(spark, folder):
    facts = project(spark, folder).ref("fct_orders")
    return month_and_state(facts, "order_created_at_utc", YEAR, MONTH, STATE, "state")


@query(with_roles(FACT_ROLES, f"""
    SELECT 'In {STATE}, the most ordered houseplants are '
      || (SELECT string_agg(product_name, ', ' ORDER BY n DESC, product_name) FROM
           (SELECT product_name, count(*) AS n FROM ({ORDER_FACT}) f WHERE {MONTH_SLICE}
            GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3) t)
      || '. In {dt.date(YEAR, MONTH, 1):%B %Y}, there were '
      || (SELECT CAST(count(*) AS VARCHAR) FROM ({ORDER_FACT}) f WHERE {MONTH_SLICE}) || ' orders.' AS text"""))
def mart_state_summary(spark, folder):
    return commerce.monthly_summary(project(spark, folder), STATE, YEAR, MONTH)


MOVEMENT_FACT = """SELECT event_type, actual_timestamp AS actual_timestamp_utc, event_source, train_id,
    variation_status, m.toc_id FROM movements m
    LEFT JOIN operating_companies c ON TRY_CAST(m.toc_id AS INTEGER) = c.toc_id"""


@query(with_roles("movements operating_companies", MOVEMENT_FACT))
def mart_fct_movements(spark, folder):
    return project(spark, folder).ref("fct_movements")


@query(with_roles("movements", """SELECT event_type, actual_timestamp AS actual_timestamp_utc, event_source, train_id,
    variation_status, toc_id FROM movements"""))
def fct_movements_deduped(spark, folder):
    rail = project(spark, folder)
    return join_companies(rail.ref("stg_movements"), rail.ref("stg_operating_companies"), dedupe_reference=True)


@query(with_roles("movements operating_companies", f"SELECT * FROM ({MOVEMENT_FACT}) ORDER BY train_id LIMIT 100"))
def bounded_fetch_movements(spark, folder):
    return bounded_fetch(project(spark, folder).ref("fct_movements"), 5000, ["train_id"])
