"""Filters, joins, aggregates, ordering and set operations."""

import datetime as dt

from pyspark.sql import functions as F

from millrace.functions.dates import in_range, moment, month_bounds
from millrace.functions.text import is_email, ratio
from millrace.operators import project as P
from millrace.operators import quality, sets
from millrace.operators.joins import left_join_lines
from millrace.plans.bindings import project, table
from millrace.queries.registry import query
from millrace.queries.roles import with_roles
from millrace.sources.jdbc import high_water_mark

NOW = dt.datetime(2001, 7, 31)


# -- filters ------------------------------------------------------------------------------------


@query("SELECT * FROM orders WHERE o_orderstatus = 'P'")
def filter_equal(spark, folder):
    return table(spark, folder, "orders").filter(F.col("o_orderstatus") == "P")


@query("SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_extendedprice > 80000")
def filter_greater(spark, folder):
    lines = table(spark, folder, "lineitem").filter(F.col("l_extendedprice") > 80000)
    return lines.select("l_orderkey", "l_linenumber", "l_extendedprice")


@query(f"SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '{NOW}' - INTERVAL 7 DAY")
def filter_last_seven_days(spark, folder):
    return P.newer_than_days(table(spark, folder, "orders"), "o_orderdate", 7, quality.run_time(NOW))


@query("SELECT * FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 40")
def filter_and(spark, folder):
    return table(spark, folder, "lineitem").filter((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 40))


@query("SELECT * FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')")
def filter_in(spark, folder):
    return table(spark, folder, "customer").filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"))


@query(with_roles("shop_orders", "SELECT order_id, status FROM shop_orders WHERE delivered_at IS NULL"))
def filter_is_null(spark, folder):
    return project(spark, folder).source("orders").filter(F.col("delivered_at").isNull()).select("order_id", "status")


@query(with_roles("shop_events", "SELECT event_id, product_id FROM shop_events WHERE product_id IS NOT NULL"))
def filter_not_null(spark, folder):
    events = project(spark, folder).source("events")
    return events.filter(F.col("product_id").isNotNull()).select("event_id", "product_id")


@query("SELECT * FROM part WHERE starts_with(p_name, 'red')")
def filter_prefix(spark, folder):
    return table(spark, folder, "part").filter(F.col("p_name").startswith("red"))


@query(with_roles("users", r"""SELECT user_id, email FROM users
    WHERE regexp_matches(email, '^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$')"""))
def filter_valid_email(spark, folder):
    users = project(spark, folder).source("users")
    return users.filter(is_email(F.col("email"))).select("user_id", "email")


@query("SELECT * FROM orders WHERE month(o_orderdate) = 2 AND year(o_orderdate) = 1998 AND o_orderstatus = 'O'")
def filter_month_year(spark, folder):
    wanted = in_range(F.col("o_orderdate"), month_bounds(1998, 2)) & (F.col("o_orderstatus") == "O")
    return table(spark, folder, "orders").filter(wanted)


@query("SELECT l_partkey, l_quantity FROM lineitem WHERE l_orderkey = 3")
def filter_with_columns(spark, folder):
    return table(spark, folder, "lineitem").filter("l_orderkey = 3").select("l_partkey", "l_quantity")


@query("SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def bounded_fetch(spark, folder):
    return P.bounded_fetch(table(spark, folder, "orders"), 1000, [F.desc("o_totalprice"), "o_orderkey"])


# -- joins --------------------------------------------------------------------------------------


@query(with_roles("shop_events products", """SELECT event_id, e.product_id, p.name AS product_name
    FROM shop_events e LEFT JOIN products p ON e.product_id = p.product_id WHERE e.product_id IS NOT NULL"""))
def join_events_products(spark, folder):
    shop = project(spark, folder)
    events = shop.source("events").filter(F.col("product_id").isNotNull()).select("event_id", "product_id")
    products = shop.source("products").select("product_id", F.col("name").alias("product_name"))
    return events.join(products, "product_id", "left").select("event_id", "product_id", "product_name")


@query(with_roles("shop_events order_items", """SELECT event_id, e.order_id, i.product_id
    FROM shop_events e LEFT JOIN order_items i ON e.order_id = i.order_id WHERE e.order_id IS NOT NULL"""))
def join_events_order_lines(spark, folder):
    """The fan-out is wanted: one row per event and line of its order."""
    shop = project(spark, folder)
    events = shop.source("events").filter(F.col("order_id").isNotNull()).select("event_id", "order_id")
    lines = shop.source("order_items").select("order_id", "product_id")
    return left_join_lines(events, lines, "order_id", null_keys=False).select("event_id", "order_id", "product_id")


@query("""SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, r.returned_quantity
    FROM lineitem l LEFT JOIN (
      SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, sum(l_quantity) AS returned_quantity
      FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL) r
    ON l.l_orderkey = r.l_orderkey AND l.l_partkey = r.l_partkey AND l.l_suppkey = r.l_suppkey
       AND l.l_linenumber = r.l_linenumber""")
def composite_key_join(spark, folder):
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    lines = table(spark, folder, "lineitem")
    returned = (
        lines.filter("l_returnflag = 'R'").groupBy(*keys).agg(F.sum("l_quantity").alias("returned_quantity"))
    )
    return lines.select(*keys).join(returned, keys, "left")


@query("""SELECT event_id, user_id FROM events
    WHERE user_id IS NOT NULL AND user_id * 12 NOT IN (SELECT c_custkey FROM customer)""")
def anti_join_orphans(spark, folder):
    events = table(spark, folder, "events").withColumn("scaled_id", F.col("user_id") * 12)
    orphans = quality.relationships(events, "scaled_id", table(spark, folder, "customer"), "c_custkey")
    return orphans.select("event_id", "user_id")


@query("""SELECT u AS user_count, o AS order_count, CAST(o AS DOUBLE) / CAST(u AS DOUBLE) AS orders_per_user
    FROM (SELECT count(DISTINCT c_custkey) AS u FROM customer), (SELECT count(DISTINCT o_orderkey) AS o FROM orders)""")
def totals_side_by_side(spark, folder):
    shop = project(spark, folder)
    both = P.side_by_side(shop.ref("number_of_users"), shop.ref("number_of_orders"))
    return both.withColumn("orders_per_user", ratio(F.col("order_count"), F.col("user_count")))


# -- aggregates ---------------------------------------------------------------------------------


@query("SELECT count(DISTINCT l_partkey) FILTER (WHERE l_returnflag = 'R') AS returned_parts FROM lineitem")
def filtered_distinct_count(spark, folder):
    returned = table(spark, folder, "lineitem").filter("l_returnflag = 'R'")
    return returned.agg(F.count_distinct("l_partkey").alias("returned_parts"))


@query("""SELECT l_returnflag, l_linestatus, CAST(sum(CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END) AS BIGINT)
    AS discounted, count(*) AS lines FROM lineitem GROUP BY 1, 2""")
def conditional_sum(spark, folder):
    flagged = F.sum(F.when(F.col("l_discount") > 0.05, 1).otherwise(0)).alias("discounted")
    lines = table(spark, folder, "lineitem")
    return lines.groupBy("l_returnflag", "l_linestatus").agg(flagged, F.count(F.lit(1)).alias("lines"))


@query("SELECT event_type, count(*) AS record_count FROM events GROUP BY 1")
def count_per_key(spark, folder):
    return table(spark, folder, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("record_count"))


@query("SELECT count(*) AS record_count FROM orders WHERE o_orderstatus = 'F' AND year(o_orderdate) = 1997")
def filtered_count(spark, folder):
    year = (dt.datetime(1997, 1, 1), dt.datetime(1998, 1, 1))
    found = table(spark, folder, "orders").filter(in_range(F.col("o_orderdate"), year))
    return found.filter("o_orderstatus = 'F'").agg(F.count(F.lit(1)).alias("record_count"))


@query("SELECT max(ts) AS last_loaded FROM events")
def high_water(spark, folder):
    return high_water_mark(table(spark, folder, "events"), "ts")


@query("""SELECT CAST(sum(CAST(l_returnflag = 'R' AS INTEGER)) AS BIGINT) AS returned,
    CAST(sum(CAST(l_returnflag = 'R' AS INTEGER)) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS returned_rate FROM lineitem""")
def flag_sum_and_ratio(spark, folder):
    flagged = F.sum((F.col("l_returnflag") == "R").cast("int"))
    return table(spark, folder, "lineitem").agg(
        flagged.alias("returned"), ratio(flagged, F.count(F.lit(1))).alias("returned_rate")
    )


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2")
def group_by_ordinal(spark, folder):
    table(spark, folder, "orders").createOrReplaceTempView("millrace_orders")
    return spark.sql("SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM millrace_orders GROUP BY 1, 2")


@query("""SELECT count(*) AS distinct_count FROM
    (SELECT DISTINCT l_partkey, l_suppkey, l_linenumber FROM lineitem)""")
def composite_distinct(spark, folder):
    return sets.count_distinct_tuples(table(spark, folder, "lineitem"), ["l_partkey", "l_suppkey", "l_linenumber"])


@query("""SELECT c_mktsegment, string_agg(c_name, ' / ' ORDER BY r) AS c_name FROM
    (SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS r FROM customer)
    WHERE r <= 3 GROUP BY 1""")
def ordered_concat(spark, folder):
    """Names of the three richest customers of each segment, in order."""
    richest = P.top_per_group(
        table(spark, folder, "customer"), "c_mktsegment", [F.desc("c_acctbal"), F.asc("c_custkey")], 3
    )
    return P.joined_text(richest, "c_name", " / ", groups=["c_mktsegment"])


# -- ordering -----------------------------------------------------------------------------------


@query("SELECT p_name, count(*) AS record_count FROM part GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3")
def top3_names(spark, folder):
    return P.top_by_count(table(spark, folder, "part"), "p_name", 3)


@query("SELECT s_suppkey, s_name, s_acctbal FROM supplier ORDER BY s_acctbal DESC, s_suppkey")
def sort_descending(spark, folder):
    suppliers = table(spark, folder, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    return suppliers.orderBy(F.desc("s_acctbal"), F.asc("s_suppkey"))


@query("SELECT * FROM supplier ORDER BY s_suppkey LIMIT 3")
def limit_rows(spark, folder):
    return table(spark, folder, "supplier").orderBy("s_suppkey").limit(3)


@query("""SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_quantity > 49
    EXCEPT SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_returnflag = 'N' ORDER BY 3, 1, 2""")
def ordered_except(spark, folder):
    lines = table(spark, folder, "lineitem")
    columns = ["l_orderkey", "l_partkey", "l_quantity"]
    large = lines.filter("l_quantity > 49").select(*columns)
    rest = sets.except_rows(large, lines.filter("l_returnflag = 'N'").select(*columns))
    return rest.orderBy("l_quantity", "l_orderkey", "l_partkey")  # a full order spreads equal quantities


# -- set operations -----------------------------------------------------------------------------


@query("""SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01'
    EXCEPT SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'""")
def except_delta(spark, folder):
    orders, cut = table(spark, folder, "orders"), moment(dt.datetime(1999, 1, 1))
    source = orders.filter(F.col("o_orderdate") >= cut).select("o_custkey", "o_orderstatus")
    loaded = orders.filter(F.col("o_orderdate") < cut).select("o_custkey", "o_orderstatus")
    return sets.except_rows(source, loaded)


@query("""SELECT c_custkey AS party_key, c_name AS party_name FROM customer
    UNION ALL SELECT s_suppkey, s_name FROM supplier""")
def union_all(spark, folder):
    customers = table(spark, folder, "customer").selectExpr("c_custkey AS party_key", "c_name AS party_name")
    suppliers = table(spark, folder, "supplier").selectExpr("s_name AS party_name", "s_suppkey AS party_key")
    return sets.union_all(customers, suppliers)


@query("""WITH b AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'),
    a AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01')
    SELECT o_custkey, 'removed' AS status FROM b WHERE o_custkey NOT IN (SELECT o_custkey FROM a)
    UNION ALL SELECT o_custkey, 'added' FROM a WHERE o_custkey NOT IN (SELECT o_custkey FROM b)""")
def two_way_diff(spark, folder):
    orders, cut = table(spark, folder, "orders"), moment(dt.datetime(1998, 1, 1))
    before, after = orders.filter(F.col("o_orderdate") < cut), orders.filter(F.col("o_orderdate") >= cut)
    return sets.two_way_difference(before, after, ["o_custkey"])


@query("SELECT DISTINCT l_shipdate, l_returnflag FROM lineitem")
def distinct_values(spark, folder):
    return sets.distinct_values(table(spark, folder, "lineitem"), "l_shipdate", "l_returnflag")
