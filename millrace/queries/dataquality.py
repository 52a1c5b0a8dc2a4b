"""Data-quality checks over whole tables. A check's rows are its failures."""

import datetime as dt

from pyspark.sql import functions as F

from millrace.operators import quality as Q
from millrace.plans.bindings import project, table
from millrace.queries.registry import query
from millrace.queries.roles import with_roles

EVENT_TYPES = ("page_view", "add_to_cart", "checkout", "package_shipped")
ACCEPTED = ", ".join(f"'{e}'" for e in EVENT_TYPES)


@query(with_roles("shop_orders", "SELECT order_id, promo_id FROM shop_orders WHERE promo_id IS NULL"))
def dq_not_null(spark, folder):
    orders = project(spark, folder).source("orders").select("order_id", "promo_id")
    return Q.not_null(orders, "promo_id")


@query("""SELECT l_orderkey, l_linenumber, count(*) AS n_records FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def dq_unique(spark, folder):
    return Q.unique(table(spark, folder, "lineitem"), "l_orderkey", "l_linenumber")


@query(with_roles("shop_events", f"SELECT event_id, event_type FROM shop_events WHERE event_type NOT IN ({ACCEPTED})"))
def dq_accepted_values(spark, folder):
    events = project(spark, folder).source("events").select("event_id", "event_type")
    return Q.accepted_values(events, "event_type", EVENT_TYPES)


@query("""SELECT l_orderkey, l_partkey, l_suppkey FROM lineitem
    WHERE l_suppkey * 3 NOT IN (SELECT s_suppkey FROM supplier)""")
def dq_relationships(spark, folder):
    lines = table(spark, folder, "lineitem").withColumn("tripled", F.col("l_suppkey") * 3)
    lines = lines.select("l_orderkey", "l_partkey", "l_suppkey", "tripled")
    return Q.relationships(lines, "tripled", table(spark, folder, "supplier"), "s_suppkey").drop("tripled")


@query("""SELECT user_id, count(*) AS n_records FROM events WHERE user_id NOT IN
    (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') GROUP BY 1""")
def dq_orphan_keys(spark, folder):
    builders = table(spark, folder, "customer").filter("c_mktsegment = 'BUILDING'")
    return Q.orphan_keys(table(spark, folder, "events"), "user_id", builders, "c_custkey")


@query("SELECT event_id, ts FROM events WHERE ts > TIMESTAMP '2024-01-20'")
def dq_not_in_future(spark, folder):
    events = table(spark, folder, "events").select("event_id", "ts")
    return Q.not_after(events, "ts", Q.run_time(dt.datetime(2024, 1, 20)))


@query(with_roles("users", "SELECT user_id, created_at, updated_at FROM users WHERE created_at > updated_at"))
def dq_created_before_updated(spark, folder):
    users = project(spark, folder).source("users").select("user_id", "created_at", "updated_at")
    return Q.ordered(users, "created_at", "updated_at")


@query(with_roles("users", "SELECT user_id, email FROM users WHERE NOT contains(email, '@')"))
def dq_email_at(spark, folder):
    return Q.has_at_sign(project(spark, folder).source("users").select("user_id", "email"), "email")


@query(with_roles("users", "SELECT user_id, phone_number FROM users WHERE length(phone_number) <> 12"))
def dq_phone_length(spark, folder):
    return Q.has_length(project(spark, folder).source("users").select("user_id", "phone_number"), "phone_number")


@query("""SELECT max(ts) AS max_loaded_at,
    CAST(floor(epoch_us(TIMESTAMP '2024-01-31 01:00:00') / 1000000.0 - epoch_us(max(ts)) / 1000000.0) AS BIGINT) AS age_seconds,
    CASE WHEN TIMESTAMP '2024-01-31 01:00:00' - max(ts) >= INTERVAL 7201 SECOND THEN 'error'
         WHEN TIMESTAMP '2024-01-31 01:00:00' - max(ts) >= INTERVAL 3601 SECOND THEN 'warn' ELSE 'pass' END AS status
    FROM events""")
def freshness(spark, folder):
    return Q.freshness(table(spark, folder, "events"), "ts", Q.run_time(dt.datetime(2024, 1, 31, 1)))


RECORDS = """SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN event_type END AS title,
    CASE WHEN event_id % 3 = 0 THEN props END AS description,
    CASE event_id % 5 WHEN 0 THEN 'Yeah' WHEN 1 THEN 'true' WHEN 2 THEN 'No' WHEN 3 THEN '1' END AS is_active
    FROM events"""


@query(f"""SELECT event_id, title, coalesce(description, 'none') AS description,
      CASE WHEN lower(is_active) IN ('true', '1') THEN true WHEN lower(is_active) = 'no' THEN false END AS is_active,
      concat_ws('; ', CASE WHEN title IS NULL THEN 'title: field required' END,
        CASE WHEN is_active IS NULL THEN 'is_active: field required'
             WHEN is_active = 'Yeah' THEN 'is_active: not a boolean' END) AS errors
    FROM ({RECORDS})""")
def validate_records(spark, folder):
    records = table(spark, folder, "events")
    number = F.col("event_id")
    active = F.when(number % 5 == 0, "Yeah").when(number % 5 == 1, "true").when(number % 5 == 2, "No")
    raw = records.select(
        "event_id",
        F.when(number % 7 != 0, F.col("event_type")).alias("title"),
        F.when(number % 3 == 0, F.col("props")).alias("description"),
        active.when(number % 5 == 3, "1").alias("is_active"),
    )
    fields = [
        Q.Field("title", "string"),
        Q.Field("description", "string", optional=True, default="none"),
        Q.Field("is_active", "boolean"),
    ]
    return Q.validate(raw, fields).withColumn("errors", F.concat_ws("; ", "errors"))


CHECKS = [
    Q.Check("users", "user_guid", "not_null"),
    Q.Check("users", "user_guid", "unique"),
    Q.Check("users", "email", "email_has_at", predicate="NOT contains(email, '@')"),
    Q.Check("users", "phone_number", "phone_length", predicate=f"length(phone_number) != {Q.PHONE_LENGTH}"),
    Q.Check("users", "updated_at_utc", "not_before_created", predicate="created_at_utc > updated_at_utc"),
    Q.Check("events", "event_guid", "not_null"),
    Q.Check("events", "event_guid", "unique"),
    Q.Check("events", "event_guid", "column_exists"),
    Q.Check("events", "event_type", "column_type", values=("string",)),
    Q.Check("events", "event_type", "accepted_values", values=EVENT_TYPES),
    Q.Check("events", "user_guid", "relationships", parent=("users", "user_guid")),
    Q.Check("events", "order_guid", "relationships", parent=("orders", "order_guid")),
    Q.Check("events", "missing_guid", "column_exists"),
    Q.Check("orders", "order_guid", "not_null"),
    Q.Check("orders", "order_guid", "unique"),
    Q.Check("orders", "promo_guid", "not_null"),
    Q.Check("order_items", "order_guid", "not_null"),
    Q.Check("order_items", "order_guid", "unique"),
    Q.Check("order_items", "product_guid", "relationships", parent=("products", "product_guid")),
    Q.Check("products", "product_guid", "unique"),
]


def _row(table_name, column, check, failures):
    return f"SELECT '{table_name}' AS table_name, '{column}' AS column_name, '{check}' AS check_name, ({failures}) AS failures"


SUITE_SQL = " UNION ALL ".join(
    [
        _row("users", "user_guid", "not_null", "SELECT count(*) FROM users WHERE user_id IS NULL"),
        _row("users", "user_guid", "unique", "SELECT count(*) - count(DISTINCT user_id) FROM users"),
        _row("users", "email", "email_has_at", "SELECT count(*) FROM users WHERE NOT contains(email, '@')"),
        _row("users", "phone_number", "phone_length", "SELECT count(*) FROM users WHERE length(phone_number) <> 12"),
        _row("users", "updated_at_utc", "not_before_created", "SELECT count(*) FROM users WHERE created_at > updated_at"),
        _row("events", "event_guid", "not_null", "SELECT count(*) FROM shop_events WHERE event_id IS NULL"),
        _row("events", "event_guid", "unique", "SELECT count(*) - count(DISTINCT event_id) FROM shop_events"),
        _row("events", "event_guid", "column_exists", "SELECT CAST(0 AS BIGINT)"),
        _row("events", "event_type", "column_type", "SELECT CAST(0 AS BIGINT)"),
        _row("events", "event_type", "accepted_values",
             f"SELECT count(*) FROM shop_events WHERE event_type NOT IN ({ACCEPTED})"),
        _row("events", "user_guid", "relationships",
             "SELECT count(*) FROM shop_events WHERE user_id NOT IN (SELECT user_id FROM users)"),
        _row("events", "order_guid", "relationships",
             "SELECT count(*) FROM shop_events WHERE order_id NOT IN (SELECT order_id FROM shop_orders)"),
        _row("events", "missing_guid", "column_exists", "SELECT CAST(1 AS BIGINT)"),
        _row("orders", "order_guid", "not_null", "SELECT count(*) FROM shop_orders WHERE order_id IS NULL"),
        _row("orders", "order_guid", "unique", "SELECT count(*) - count(DISTINCT order_id) FROM shop_orders"),
        _row("orders", "promo_guid", "not_null", "SELECT count(*) FROM shop_orders WHERE promo_id IS NULL"),
        _row("order_items", "order_guid", "not_null", "SELECT count(*) FROM order_items WHERE order_id IS NULL"),
        _row("order_items", "order_guid", "unique",
             "SELECT count(*) FROM (SELECT order_id FROM order_items GROUP BY 1 HAVING count(*) > 1)"),
        _row("order_items", "product_guid", "relationships",
             "SELECT count(*) FROM order_items WHERE product_id NOT IN (SELECT product_id FROM products)"),
        _row("products", "product_guid", "unique", "SELECT count(*) - count(DISTINCT product_id) FROM products"),
    ]
)


@query(with_roles("users shop_events shop_orders order_items products",
                  f"SELECT *, failures = 0 AS passed FROM ({SUITE_SQL})"))
def dq_suite(spark, folder):
    shop = project(spark, folder)
    tables = {name: shop.ref(f"stg_{name}") for name in ("users", "events", "orders", "order_items", "products")}
    return Q.run_suite(tables, CHECKS)


@query("""WITH counts AS (SELECT o_custkey AS user_guid, count(DISTINCT o_orderkey) AS n FROM orders GROUP BY 1)
    SELECT user_guid, n AS user_orders, CAST(1 AS BIGINT) AS found, CAST(0 AS BIGINT) AS wanted FROM counts WHERE user_guid % 10 = 0
    UNION ALL SELECT user_guid, n + 1, 0, 1 FROM counts WHERE user_guid % 10 = 0""")
def model_unit_test(spark, folder):
    """A model against expected rows, of which those of every tenth user are wrong by one."""
    model = project(spark, folder).ref("orders_per_user")
    orders = table(spark, folder, "orders").groupBy(F.col("o_custkey").alias("user_guid"))
    counted = orders.agg(F.count_distinct("o_orderkey").alias("user_orders"))
    wrong = F.when(F.col("user_guid") % 10 == 0, 1).otherwise(0)
    return Q.row_differences(model, counted.withColumn("user_orders", F.col("user_orders") + wrong))
