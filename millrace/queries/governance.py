"""Catalogue, masking, drift and reports over whole tables."""

import datetime as dt

from pyspark.sql import functions as F

from millrace.functions.dates import moment
from millrace.operators import governance as G
from millrace.plans.bindings import project, table
from millrace.queries.registry import query
from millrace.queries.roles import with_roles
from millrace.sinks.tables import audit

HALF = dt.datetime(2024, 1, 16)


@query(with_roles("users", """SELECT user_id AS user_guid, 'MASKED_PII_MASKING' AS first_name,
    'MASKED_PII_MASKING' AS last_name, 'MASKED_PII_MASKING' AS email, 'MASKED_PII_MASKING' AS phone_number,
    created_at AS created_at_utc, updated_at AS updated_at_utc, 'MASKED_PII_MASKING' AS address_guid FROM users"""))
def masked_users(spark, folder):
    return G.mask(project(spark, folder).ref("stg_users"))


@query(with_roles("shop_orders", """SELECT CAST(order_id AS VARCHAR) AS order_guid, CAST(user_id AS VARCHAR) AS user_guid,
    'MASKED_PII_MASKING' AS address_guid, promo_id AS promo_guid,
    strftime(created_at, '%Y-%m-%d %H:%M:%S') AS order_created_at_utc,
    'MASKED_FINANCIAL_MASKING' AS order_cost_usd, 'MASKED_FINANCIAL_MASKING' AS shipping_cost_usd,
    'MASKED_FINANCIAL_MASKING' AS order_total_usd, tracking_id AS tracking_guid,
    'MASKED_CREDENTIAL_MASKING' AS shipping_service,
    strftime(estimated_delivery_at, '%Y-%m-%d %H:%M:%S') AS estimated_delivery_at_utc,
    strftime(delivered_at, '%Y-%m-%d %H:%M:%S') AS delivered_at_utc, status AS order_status
    FROM shop_orders ORDER BY order_id LIMIT 100"""))
def masked_sample(spark, folder):
    orders = project(spark, folder).ref("stg_orders")
    return G.mask(G.sample(orders, ["order_guid"]))


CATEGORY = """CASE WHEN contains(c, 'name') OR contains(c, 'email') OR contains(c, 'address') OR contains(c, 'state')
    THEN 'PII_MASKING' WHEN contains(c, 'price') OR contains(c, 'total') OR contains(c, 'discount') OR contains(c, 'tax')
    THEN 'FINANCIAL_MASKING' END"""
AUDITED = ("customer", "lineitem", "orders", "part", "events")


@query(" UNION ALL ".join(
    f"""SELECT '{t}' AS table_name, c AS column_name, {CATEGORY} AS category, (SELECT count(*) FROM {t}) AS row_count
    FROM (SELECT unnest([{columns}]) AS c)"""
    for t, columns in {
        "customer": "'c_custkey', 'c_name', 'c_nationkey', 'c_acctbal', 'c_mktsegment'",
        "lineitem": """'l_orderkey', 'l_partkey', 'l_suppkey', 'l_linenumber', 'l_quantity', 'l_extendedprice',
            'l_discount', 'l_tax', 'l_returnflag', 'l_linestatus', 'l_shipdate'""",
        "orders": "'o_orderkey', 'o_custkey', 'o_orderstatus', 'o_totalprice', 'o_orderdate', 'o_orderpriority'",
        "part": "'p_partkey', 'p_name', 'p_brand', 'p_type', 'p_size', 'p_retailprice'",
        "events": "'event_id', 'ts', 'user_id', 'event_type', 'value', 'props'",
    }.items()
))
def classified_catalogue(spark, folder):
    """Every column with its category, next to its table's row count."""
    tables = {name: table(spark, folder, name) for name in AUDITED}
    columns = G.classify(G.catalogue(spark, tables)).select("table_name", "column_name", "category")
    parts = [audit(df, name).select("table_name", "row_count") for name, df in tables.items()]
    counts = parts[0]
    for part in parts[1:]:
        counts = counts.unionByName(part)
    return columns.join(counts, "table_name", "left")


def _event_schema(spark, folder, late):
    """Models and columns as found in the event messages of one half of the month."""
    cut = moment(HALF)
    side = F.col("ts") >= cut if late else F.col("ts") < cut
    found = table(spark, folder, "events").filter(side)
    return found.select(
        F.concat_ws("_", F.lit("user"), F.col("user_id").cast("string"), "event_type").alias("model"),
        F.explode(F.json_object_keys("props")).alias("column"),
    )


SNAPSHOT = """SELECT DISTINCT 'user_' || CAST(user_id AS VARCHAR) || '_' || event_type AS model,
    unnest(json_keys(props)) AS "column" FROM events WHERE ts {} TIMESTAMP '2024-01-16'"""


@query(f"""WITH b AS ({SNAPSHOT.format('<')}), a AS ({SNAPSHOT.format('>=')}), m AS (
      SELECT coalesce(b.model, a.model) AS model, b.model IS NOT NULL AS was, a.model IS NOT NULL AS is_now
      FROM (SELECT DISTINCT model FROM b) b FULL JOIN (SELECT DISTINCT model FROM a) a ON a.model = b.model),
    c AS (SELECT b.model IS NOT NULL AS was, a.model IS NOT NULL AS is_now
      FROM b FULL JOIN a ON a.model = b.model AND a."column" = b."column"),
    f AS (SELECT 'model' AS level, was, is_now FROM m UNION ALL SELECT 'column', was, is_now FROM c)
    SELECT level, count(*) FILTER (WHERE was) AS before_count, count(*) FILTER (WHERE is_now) AS after_count,
      count(*) FILTER (WHERE is_now AND NOT was) AS added, count(*) FILTER (WHERE was AND NOT is_now) AS removed
    FROM f GROUP BY 1""")
def schema_drift(spark, folder):
    return G.schema_drift(_event_schema(spark, folder, False), _event_schema(spark, folder, True))


@query(f"""WITH b AS ({SNAPSHOT.format('<')}), a AS ({SNAPSHOT.format('>=')})
    SELECT *, 'removed' AS status FROM (SELECT * FROM b EXCEPT SELECT * FROM a)
    UNION ALL SELECT *, 'added' FROM (SELECT * FROM a EXCEPT SELECT * FROM b)""")
def drifted_columns(spark, folder):
    return G.changed_columns(_event_schema(spark, folder, False), _event_schema(spark, folder, True))


def _order_checks(spark, folder, late):
    """Accepted-value checks as each half of the order history would declare them."""
    cut = moment(dt.datetime(1998, 6, 1))
    side = F.col("o_orderdate") >= cut if late else F.col("o_orderdate") < cut
    test = F.concat(F.lit("accepted_value:"), F.date_format("o_orderdate", "MM-dd"), F.lit(" "), "o_orderpriority")
    return table(spark, folder, "orders").filter(side).select(
        F.lit("orders").alias("model"), F.lit("o_orderpriority").alias("column"), test.alias("test")
    )


ORDER_CHECKS = """SELECT DISTINCT 'orders' AS model, 'o_orderpriority' AS "column",
    'accepted_value:' || strftime(o_orderdate, '%m-%d') || ' ' || o_orderpriority AS test
    FROM orders WHERE o_orderdate {} TIMESTAMP '1998-06-01'"""


@query(f"""WITH b AS ({ORDER_CHECKS.format('<')}), a AS ({ORDER_CHECKS.format('>=')})
    SELECT *, 'removed' AS status FROM (SELECT * FROM b EXCEPT SELECT * FROM a)
    UNION ALL SELECT *, 'added' FROM (SELECT * FROM a EXCEPT SELECT * FROM b)""")
def check_drift(spark, folder):
    return G.changed_checks(_order_checks(spark, folder, False), _order_checks(spark, folder, True))


@query("""SELECT 'orders' AS step, 'SUCCESS' AS status, (SELECT count(*) FROM orders) AS records, CAST(6 AS BIGINT) AS columns
    UNION ALL SELECT 'masked', 'SUCCESS', (SELECT count(*) FROM customer), 5 UNION ALL SELECT 'report', 'UNKNOWN', NULL, NULL""")
def run_report(spark, folder):
    masked = G.mask(table(spark, folder, "customer"))
    return G.run_report([("orders", table(spark, folder, "orders")), ("masked", masked), ("report", None)])
