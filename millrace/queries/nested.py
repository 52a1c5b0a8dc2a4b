"""Arrays, structs and JSON over whole tables."""

from pyspark.sql import functions as F

from millrace.functions import jsonpath, nested
from millrace.plans.bindings import table
from millrace.queries.registry import query
from millrace.schemas import struct
from millrace.session import spread


@query("""SELECT o_orderkey, unnest([o_orderstatus, o_orderpriority, 'order']) AS tag FROM orders""")
def array_unnest(spark, folder):
    tags = F.array("o_orderstatus", "o_orderpriority", F.lit("order"))
    return table(spark, folder, "orders").select("o_orderkey", F.explode(tags).alias("tag"))


@query("""SELECT o_orderkey, unnest(CASE WHEN o_orderstatus = 'P' THEN [] ELSE [o_orderpriority] END) AS tag
    FROM orders""")
def empty_array_drops_row(spark, folder):
    tags = F.when(F.col("o_orderstatus") == "P", F.array().cast("array<string>")).otherwise(F.array("o_orderpriority"))
    return table(spark, folder, "orders").select("o_orderkey", F.explode(tags).alias("tag"))


@query("""SELECT c_custkey, 'current' AS status, c_name AS address, c_mktsegment AS postcode FROM customer
    UNION ALL SELECT c_custkey, 'birth', c_mktsegment, c_name FROM customer""")
def struct_unnest(spark, folder):
    history = F.array(
        F.struct(F.lit("current").alias("status"), F.col("c_name").alias("address"), F.col("c_mktsegment").alias("postcode")),
        F.struct(F.lit("birth").alias("status"), F.col("c_mktsegment").alias("address"), F.col("c_name").alias("postcode")),
    )
    return table(spark, folder, "customer").select("c_custkey", F.inline(history))


@query("SELECT c_custkey, c_name AS owner_name, c_mktsegment AS owner_segment FROM customer")
def struct_fields(spark, folder):
    owner = F.struct(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")).alias("owner")
    held = table(spark, folder, "customer").select("c_custkey", owner)
    return held.select("c_custkey", F.col("owner.name").alias("owner_name"), F.col("owner.segment").alias("owner_segment"))


def _documents(spark, folder):
    """Orders as JSON text with a string, a number, an array and an object."""
    orders = spread(table(spark, folder, "orders"))
    document = F.struct(
        F.col("o_orderpriority").alias("name"),
        F.col("o_orderkey").alias("age"),
        F.array("o_orderstatus", "o_orderpriority").alias("fruits"),
        F.struct(F.col("o_orderstatus").alias("zone"), F.col("o_custkey").alias("area")).alias("place"),
    )
    return orders.select("o_orderkey", F.to_json(document).alias("body"))


@query("""SELECT o_orderkey, '"' || o_orderpriority || '"' AS name, CAST(o_orderkey AS VARCHAR) AS age,
    '["' || o_orderstatus || '","' || o_orderpriority || '"]' AS fruits,
    '{"zone":"' || o_orderstatus || '","area":' || CAST(o_custkey AS VARCHAR) || '}' AS place,
    CAST(NULL AS VARCHAR) AS absent FROM orders""")
def json_query(spark, folder):
    paths = {name: f"$.{name}" for name in ("name", "age", "fruits", "place", "absent")}
    return jsonpath.with_json(_documents(spark, folder), "body", queries=paths).drop("body")


@query("""SELECT o_orderkey, o_orderpriority AS name, CAST(o_orderkey AS VARCHAR) AS age, CAST(NULL AS VARCHAR) AS fruits,
    CAST(NULL AS VARCHAR) AS place, o_orderstatus AS zone FROM orders""")
def json_value(spark, folder):
    paths = {name: f"$.{name}" for name in ("name", "age", "fruits", "place")} | {"zone": "$.place.zone"}
    return jsonpath.with_json(_documents(spark, folder), "body", values=paths).drop("body")


@query("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_value_props(spark, folder):
    return table(spark, folder, "events").select("event_id", jsonpath.json_value(F.col("props"), "$.k").alias("k"))


@query("""SELECT l_orderkey AS "order.key", l_linenumber AS "order.line.number", l_partkey AS "order.line.part",
    l_quantity AS quantity FROM lineitem""")
def flatten_nested(spark, folder):
    line = F.struct(F.col("l_linenumber").alias("number"), F.col("l_partkey").alias("part"))
    order = F.struct(F.col("l_orderkey").alias("key"), line.alias("line"))
    documents = table(spark, folder, "lineitem").select(order.alias("order"), F.col("l_quantity").alias("quantity"))
    return nested.flatten(documents)


@query("""SELECT event_id, event_type AS kind, CAST(user_id AS VARCHAR) AS who FROM events
    UNION ALL SELECT event_id, 'echo', CAST(user_id AS VARCHAR) FROM events""")
def explode_message_batch(spark, folder):
    message = F.struct(F.col("event_type").alias("kind"), F.col("user_id").cast("string").alias("who"))
    echo = F.struct(F.lit("echo").alias("kind"), F.col("user_id").cast("string").alias("who"))
    batches = table(spark, folder, "events").select("event_id", F.to_json(F.array(message, echo)).alias("batch"))
    exploded = nested.explode_json_batch(batches, "batch", struct("kind string, who string"))
    return exploded.select("event_id", "message.kind", "message.who")


def _messages(spark, folder):
    """Event properties as messages; every fifth is cut short."""
    cut = F.when(F.col("event_id") % 5 == 0, F.substring("props", 1, 4)).otherwise(F.col("props"))
    return table(spark, folder, "events").select("event_id", cut.alias("value"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events WHERE event_id % 5 <> 0")
def parse_or_drop(spark, folder):
    good, _ = nested.parse_or_quarantine(_messages(spark, folder), "value", struct("k int"))
    return good


@query("SELECT event_id, substr(props, 1, 4) AS value FROM events WHERE event_id % 5 = 0")
def quarantine_undecodable(spark, folder):
    _, bad = nested.parse_or_quarantine(_messages(spark, folder), "value", struct("k int"))
    return bad
