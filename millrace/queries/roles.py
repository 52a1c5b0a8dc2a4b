"""The bindings of ``millrace.plans.bindings`` as SQL, for oracles."""

ROLES = {
    "users": """
        SELECT c_custkey AS user_id, split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name,
               CASE WHEN c_custkey % 10 = 7 THEN lower(replace(c_name, '#', ' '))
                    ELSE lower(replace(c_name, '#', '.')) || '@example.com' END AS email,
               CASE WHEN c_custkey % 50 = 3 THEN lpad(CAST(c_custkey AS VARCHAR), 10, '0')
                    ELSE substr(lpad(CAST(c_custkey AS VARCHAR), 10, '0'), 1, 3) || '-'
                      || substr(lpad(CAST(c_custkey AS VARCHAR), 10, '0'), 4, 3) || '-'
                      || substr(lpad(CAST(c_custkey AS VARCHAR), 10, '0'), 7, 4) END AS phone_number,
               TIMESTAMP '1994-01-01 00:00:00' + to_days(CAST(c_custkey % 365 AS INTEGER)) AS created_at,
               TIMESTAMP '1994-01-01 00:00:00' + to_days(CAST(c_custkey % 365 AS INTEGER)
                 + CASE WHEN c_custkey % 40 = 1 THEN -1 ELSE 2 END) AS updated_at,
               c_nationkey AS address_id
        FROM customer""",
    "addresses": """
        SELECT n_nationkey AS address_id, '1 Main Street, ' || n_name AS address,
               CAST(n_nationkey * 100 + 10001 AS BIGINT) AS zipcode, r_name AS state, n_name AS country
        FROM nation LEFT JOIN region ON n_regionkey = r_regionkey""",
    "products": """
        SELECT p_partkey AS product_id, p_name AS name, p_retailprice AS price, CAST(p_size AS BIGINT) AS inventory
        FROM part""",
    "promos": """
        SELECT DISTINCT o_orderpriority AS promo_id, CAST(substr(o_orderpriority, 1, 1) AS BIGINT) * 5 AS discount,
               CASE WHEN CAST(substr(o_orderpriority, 1, 1) AS BIGINT) <= 3 THEN 'active' ELSE 'inactive' END AS status
        FROM orders""",
    "shop_orders": """
        SELECT o_orderkey AS order_id, o_custkey AS user_id,
               CASE WHEN o_orderkey % 4 <> 0 THEN o_orderpriority END AS promo_id,
               CAST(o_custkey % 25 AS INTEGER) AS address_id, o_orderdate AS created_at, o_totalprice AS order_cost,
               o_totalprice * CAST(0.0625 AS DOUBLE) AS shipping_cost,
               o_totalprice + o_totalprice * CAST(0.0625 AS DOUBLE) AS order_total,
               'TRK' || CAST(o_orderkey AS VARCHAR) AS tracking_id,
               CASE o_orderkey % 3 WHEN 0 THEN 'ups' WHEN 1 THEN 'fedex' ELSE 'dhl' END AS shipping_service,
               o_orderdate + INTERVAL 7 DAY AS estimated_delivery_at,
               CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 5 DAY END AS delivered_at,
               o_orderstatus AS status
        FROM orders""",
    "order_items": """
        SELECT l_orderkey AS order_id, l_partkey AS product_id, CAST(l_quantity AS BIGINT) AS quantity FROM lineitem""",
    "shop_events": """
        SELECT event_id, CAST(user_id AS VARCHAR) || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS session_id, user_id,
               '/' || event_type || '/' || json_extract_string(props, '$.k') AS page_url, ts AS created_at,
               CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'add_to_cart'
                    WHEN 'purchase' THEN 'checkout' WHEN 'signup' THEN 'package_shipped' ELSE event_type END
                 AS event_type,
               CASE WHEN event_type IN ('purchase', 'signup') THEN event_id END AS order_id,
               CASE WHEN event_type IN ('view', 'click') THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END
                 AS product_id
        FROM events""",
    "movements": """
        SELECT CASE WHEN event_type IN ('view', 'click') THEN 'ARRIVAL' ELSE 'DEPARTURE' END AS event_type,
               ts AS actual_timestamp, CASE WHEN event_type = 'error' THEN 'MANUAL' ELSE 'AUTOMATIC' END AS event_source,
               'T' || CAST(event_id AS VARCHAR) AS train_id,
               CASE WHEN value > 20 THEN 'LATE' ELSE 'ON TIME' END AS variation_status,
               CASE WHEN event_id % 97 = 0 THEN 'n/a' ELSE CAST(user_id % 30 AS VARCHAR) END AS toc_id
        FROM events""",
    "operating_companies": """
        SELECT n_nationkey AS toc_id, n_name AS company_name FROM nation
        UNION ALL SELECT n_nationkey, n_name || ' II' FROM nation WHERE n_nationkey = 8""",
}


def with_roles(names: str, body: str) -> str:
    """``body`` behind the named roles as common table expressions."""
    return "WITH " + ", ".join(f"{n} AS ({ROLES[n]})" for n in names.split()) + " " + body
