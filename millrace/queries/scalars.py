"""Scalar functions over whole tables."""

from pyspark.sql import functions as F

from millrace.functions import dates, text
from millrace.plans.bindings import project, table
from millrace.queries.registry import query
from millrace.queries.roles import with_roles


@query("SELECT c_custkey, split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name FROM customer")
def name_split(spark, folder):
    name = F.replace("c_name", F.lit("#"), F.lit("  "))
    return table(spark, folder, "customer").select(
        "c_custkey", text.name_part(name, 0).alias("first_name"), text.name_part(name, 1).alias("last_name")
    )


BUCKETS = """CASE WHEN {0} <= 30 THEN '<=30' WHEN {0} <= 40 THEN '31-40' WHEN {0} <= 50 THEN '41-50'
    WHEN {0} <= 60 THEN '51-60' WHEN {0} > 60 THEN '61+' END"""


@query(f"SELECT p_partkey, {BUCKETS.format('(p_size * 2)')} AS size_bucket FROM part")
def size_bucket(spark, folder):
    bucket = text.bucket_label(F.col("p_size") * 2).alias("size_bucket")
    return table(spark, folder, "part").select("p_partkey", bucket)


@query("""SELECT o_orderkey, strftime(o_orderdate, '%Y/%m/%d/') AS slashed, strftime(o_orderdate, '%B %Y') AS month_name,
    strftime(o_orderdate, '%Y%m%d') AS compact, CAST(o_orderdate AS DATE) AS order_day,
    CAST(month(o_orderdate) AS INTEGER) AS order_month, CAST(year(o_orderdate) AS INTEGER) AS order_year FROM orders""")
def date_formats(spark, folder):
    day = F.col("o_orderdate")
    return table(spark, folder, "orders").select(
        "o_orderkey",
        dates.slash_date(day).alias("slashed"),
        dates.month_name(day).alias("month_name"),
        dates.compact_date(day).alias("compact"),
        F.to_date(day).alias("order_day"),
        F.month(day).alias("order_month"),
        F.year(day).alias("order_year"),
    )


@query("""SELECT p_partkey, CAST(p_retailprice * 1000 AS BIGINT) AS price, CASE WHEN p_size % 2 = 0 THEN p_brand
    ELSE p_type END AS label FROM part""")
def clean_price(spark, folder):
    """Displayed prices with separators and a unit, read back; a blank label falls back to another."""
    shown = F.concat(F.lit(" "), F.format_number(F.col("p_retailprice") * 1000, 0), F.lit(" THB "))
    brand = F.when(F.col("p_size") % 2 == 0, F.col("p_brand")).otherwise("  ")
    return table(spark, folder, "part").select(
        "p_partkey",
        text.plain_number(shown, ["THB"]).cast("bigint").alias("price"),
        text.first_non_empty(brand, F.col("p_type")).alias("label"),
    )


LONDON_SQL = "(ts AT TIME ZONE 'UTC' AT TIME ZONE 'Europe/London')"


@query(f"""SELECT event_id, strftime(t, '%Y-%m-%d %H:%M:%S') || CASE WHEN microsecond(t) % 1000000 = 0 THEN ''
    ELSE strftime(t, '.%f') END || CASE WHEN date_diff('hour', u, t) = 1 THEN '+01:00' ELSE '+00:00' END AS london_text,
    t AS london_clock FROM (
      SELECT event_id, u, u AT TIME ZONE 'UTC' AT TIME ZONE 'Europe/London' AS t FROM (
        SELECT event_id, date_trunc('millisecond', ts) + to_days(CAST(event_id % 366 AS INTEGER)) AS u FROM events))""")
def epoch_to_london(spark, folder):
    """Epoch milliseconds as text, spread over a year, to London time: both clock changes are met."""
    shifted = F.expr("ts + make_dt_interval(CAST(event_id % 366 AS INT))").cast("timestamp")
    millis = F.unix_millis(shifted).cast("string")
    instant = dates.instant_from_millis(millis)
    return table(spark, folder, "events").select(
        "event_id",
        dates.london_text(instant).alias("london_text"),
        dates.london_clock(instant).cast("timestamp_ntz").alias("london_clock"),
    )


@query("""SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS is_return,
    CAST(l_discount > 0.05 AS INTEGER) AS is_discounted, CAST(l_quantity AS DOUBLE) AS quantity,
    CAST(l_linenumber AS VARCHAR) AS line_text FROM lineitem""")
def flags_and_casts(spark, folder):
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("is_return"),
        (F.col("l_discount") > 0.05).cast("int").alias("is_discounted"),
        F.col("l_quantity").cast("double").alias("quantity"),
        F.col("l_linenumber").cast("string").alias("line_text"),
    )


@query("""SELECT doc_id, CAST(length(text) AS INTEGER) AS text_length, contains(lower(text), 'the') AS mentions_the
    FROM documents""")
def text_tests(spark, folder):
    return table(spark, folder, "documents").select(
        "doc_id",
        F.length("text").alias("text_length"),
        text.contains_ignoring_case(F.col("text"), "THE").alias("mentions_the"),
    )


@query("""SELECT c_custkey, 'Customer ' || c_name || ' of ' || c_mktsegment || ' holds ' || CAST(CAST(floor(c_acctbal)
    AS BIGINT) AS VARCHAR) || '.' AS sentence FROM customer""")
def text_template(spark, folder):
    sentence = F.format_string("Customer %s of %s holds %d.", "c_name", "c_mktsegment", F.floor("c_acctbal"))
    return table(spark, folder, "customer").select("c_custkey", sentence.alias("sentence"))


@query("SELECT c_custkey, CAST(round(CAST(c_acctbal AS DECIMAL(18,4)) / 3, 2) AS DOUBLE) AS third FROM customer")
def round_money(spark, folder):
    third = F.col("c_acctbal").cast("decimal(18,4)") / 3
    return table(spark, folder, "customer").select("c_custkey", text.money(third).alias("third"))


@query("""SELECT event_id, 'T' || CAST(event_id AS VARCHAR) || '-' || CAST(CAST(floor(epoch(ts)) AS BIGINT) AS VARCHAR)
    || '.json' AS object_name FROM events""")
def object_names(spark, folder):
    train = F.concat(F.lit("T"), F.col("event_id").cast("string"))
    return table(spark, folder, "events").select(
        "event_id", text.object_name(train, F.unix_seconds(F.col("ts").cast("timestamp"))).alias("object_name")
    )


@query("""SELECT o_orderkey, CAST(o_orderdate + INTERVAL 1 DAY AS TIMESTAMP) AS parsed FROM orders""")
def text_to_timestamp(spark, folder):
    shown = F.date_format(F.col("o_orderdate") + F.expr("INTERVAL 1 DAY"), "yyyy-MM-dd HH:mm:ss")
    parsed = F.try_to_timestamp(shown).cast("timestamp_ntz")
    return table(spark, folder, "orders").select("o_orderkey", parsed.alias("parsed"))


@query(with_roles("users", "SELECT user_id, created_at > updated_at AS is_reversed FROM users"))
def compare_timestamps(spark, folder):
    users = project(spark, folder).source("users")
    return users.select("user_id", (F.col("created_at") > F.col("updated_at")).alias("is_reversed"))
