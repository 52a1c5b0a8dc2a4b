"""Lake-table changes over the whole events table, each ending in a scan of the final state."""

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import history
from millrace.operators.lake import ConstraintError, LakeTable
from millrace.plans.bindings import table
from millrace.queries.registry import query
from millrace.session import scratch

FIELDS = "event_id, ts, user_id, event_type, value, props"


def loaded(spark, folder) -> LakeTable:
    """A fresh lake table holding all events."""
    events = table(spark, folder, "events")
    required = {"event_id", "ts"}
    schema = T.StructType([T.StructField(f.name, f.dataType, f.name not in required) for f in events.schema.fields])
    lake = LakeTable.create(spark, scratch(spark, "lake"), schema, ["event_id"], "ts")
    lake.append(events)
    return lake


@query(f"SELECT {FIELDS} FROM events")
def lake_append(spark, folder):
    return loaded(spark, folder).scan()


@query(f"""SELECT event_id, ts, user_id, event_type, CASE WHEN event_type = 'click' THEN value + 1 ELSE value END AS value,
      props FROM events
    UNION ALL SELECT event_id + 100000000, ts + INTERVAL 1 DAY, user_id, 'late', value, props FROM events
      WHERE event_type = 'signup'""")
def lake_upsert(spark, folder):
    """Clicks replaced, late rows inserted."""
    lake, events = loaded(spark, folder), table(spark, folder, "events")
    replaced = events.filter("event_type = 'click'").withColumn("value", F.col("value") + 1)
    inserted = events.filter("event_type = 'signup'").withColumns(
        {
            "event_id": F.col("event_id") + 100000000,
            "ts": F.col("ts") + F.expr("INTERVAL 1 DAY"),
            "event_type": F.lit("late"),
        }
    )
    lake.upsert(replaced.unionByName(inserted))
    return lake.scan()


@query(f"""SELECT {FIELDS} FROM events WHERE event_type <> 'error'
    UNION ALL SELECT event_id, ts, user_id, 'fixed', 0.0, props FROM events WHERE event_type = 'error'""")
def lake_overwrite_where(spark, folder):
    lake = loaded(spark, folder)
    fixed = table(spark, folder, "events").filter("event_type = 'error'")
    lake.overwrite(fixed.withColumns({"event_type": F.lit("fixed"), "value": F.lit(0.0)}), "event_type = 'error'")
    return lake.scan()


@query("""SELECT event_id, ts, user_id, event_type, CASE WHEN event_type = 'view' THEN value * 2 ELSE value END AS value,
    props FROM events""")
def lake_update_where(spark, folder):
    lake = loaded(spark, folder)
    lake.update(F.col("event_type") == "view", {"value": F.col("value") * 2})
    return lake.scan()


@query(f"""SELECT {FIELDS} FROM events WHERE NOT (event_type = 'signup'
    OR (ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-06'))""")
def lake_delete_where(spark, folder):
    """One event type and one whole day deleted; the emptied day leaves no partition behind."""
    lake = loaded(spark, folder)
    lake.delete("event_type = 'signup' OR (ts >= TIMESTAMP_NTZ'2024-01-05' AND ts < TIMESTAMP_NTZ'2024-01-06')")
    return lake.scan()


@query("""SELECT event_id, ts, user_id, event_type, value, props, CAST(NULL AS VARCHAR) AS email,
    CASE WHEN event_type = 'click' THEN 'seen' END AS note FROM events""")
def lake_schema_evolve(spark, folder):
    """A column added, filled, dropped and added again comes back empty; another one keeps its values."""
    lake = loaded(spark, folder)
    lake.add_column("email", "string")
    lake.update("event_type = 'view'", {"email": F.lit("x@example.com")})
    lake.drop_column("email")
    lake.add_column("email", "string")
    lake.add_column("note", "string")
    lake.update("event_type = 'click'", {"note": F.lit("seen")})
    return lake.scan()


@query("""SELECT event_id, event_type, value FROM events
    WHERE ts >= TIMESTAMP '2024-01-03 06:00:00' AND ts < TIMESTAMP '2024-01-09'""")
def lake_scan_between(spark, folder):
    window = dt.datetime(2024, 1, 3, 6), dt.datetime(2024, 1, 9)
    return loaded(spark, folder).scan_between(*window, columns=["event_id", "event_type", "value"])


@query("""SELECT event_id, event_type, value FROM events
    WHERE CAST(ts AS DATE) = DATE '2024-01-07' OR (ts >= TIMESTAMP '2024-01-09 12:00:00' AND ts < TIMESTAMP '2024-01-10')""")
def lake_time_filter(spark, folder):
    """A filter on the timestamp as any caller writes it; only the days that it implies are read."""
    where = "to_date(ts) = DATE'2024-01-07' OR (ts >= '2024-01-09 12:00:00' AND ts < '2024-01-10')"
    return loaded(spark, folder).scan(where, ["event_id", "event_type", "value"])


@query("""SELECT event_id, user_id, event_type FROM events
    UNION ALL SELECT event_id + 100000000, user_id, event_type FROM events WHERE event_type = 'click'""")
def lake_append_constraint(spark, folder):
    """An append with keys that are there already adds nothing; one with a new range of keys opens no old file."""
    lake, clicks = loaded(spark, folder), table(spark, folder, "events").filter("event_type = 'click'")
    shifted = clicks.withColumn("event_id", F.col("event_id") + 100000000)
    try:
        lake.append(shifted.unionByName(clicks))
    except ConstraintError:
        lake.append(shifted)
    return lake.scan(columns=["event_id", "user_id", "event_type"])


@query("""SELECT CAST(1 AS BIGINT) AS version, event_id, value FROM events
    UNION ALL SELECT 2, event_id, CASE WHEN event_type = 'view' THEN 0.0 ELSE value END FROM events
    UNION ALL SELECT 3, event_id, CASE WHEN event_type = 'view' THEN 0.0 ELSE value END FROM events WHERE event_type <> 'error'""")
def lake_versions(spark, folder):
    """Every version of a table, read after all its changes."""
    lake = loaded(spark, folder)
    lake.update("event_type = 'view'", {"value": F.lit(0.0)})
    lake.delete("event_type = 'error'")
    versions = [lake.at(n).scan(columns=["event_id", "value"]).withColumn("version", F.lit(n).cast("bigint")) for n in (1, 2, 3)]
    return reduce(DataFrame.unionByName, versions).select("version", "event_id", "value")


@query("SELECT event_id, value FROM events WHERE event_type IN ('click', 'view') AND value > 20")
def lake_filtered_scan(spark, folder):
    wanted = F.col("event_type").isin("click", "view") & (F.col("value") > 20)
    return loaded(spark, folder).scan(wanted, ["event_id", "value"])


@query("SELECT CAST(ts AS DATE) AS created_at_day, count(*) AS record_count FROM events GROUP BY 1")
def lake_partitions(spark, folder):
    return loaded(spark, folder).partitions().select("created_at_day", "record_count")


@query("""SELECT CAST(0 AS BIGINT) AS version, 'create' AS operation, CAST(0 AS BIGINT) AS days
    UNION ALL SELECT 1, 'append', 0
    UNION ALL SELECT 2, 'delete', count(DISTINCT CAST(ts AS DATE)) FROM events WHERE event_type = 'error'""")
def lake_history(spark, folder):
    lake = loaded(spark, folder)
    lake.delete("event_type = 'error'")
    return lake.history().select("version", "operation", "days")


@query("""SELECT user_id, ts, event_type, value, ts AS valid_from,
    lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS valid_to FROM events""")
def history_from_log(spark, folder):
    log = table(spark, folder, "events").select("user_id", "ts", "event_type", "value")
    return history.history_from_log(log, "user_id", "ts")


@query("""SELECT o_orderkey, o_orderstatus, o_orderdate AS updated_at, o_orderdate AS valid_from,
      CASE WHEN o_orderstatus = 'P' THEN o_orderdate + INTERVAL 30 DAY END AS valid_to FROM orders
    UNION ALL SELECT o_orderkey, 'F', o_orderdate + INTERVAL 30 DAY, o_orderdate + INTERVAL 30 DAY, NULL
      FROM orders WHERE o_orderstatus = 'P'""")
def history_scd2(spark, folder):
    """Order status history: a first run, a second with pending orders finished, a third that changes nothing."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", F.col("o_orderdate").alias("updated_at"))
    pending = F.col("o_orderstatus") == "P"
    later = orders.select(
        "o_orderkey",
        F.when(pending, "F").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(pending, F.col("updated_at") + F.expr("INTERVAL 30 DAY")).otherwise(F.col("updated_at")).alias("updated_at"),
    )
    stored = history.StoredHistory(spark, scratch(spark, "history"), "o_orderkey", "updated_at")
    for source in (orders, later, later):
        stored.run(source)
    return stored.versions()


@query("""SELECT user_id, ts, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id
    ORDER BY ts DESC, event_type DESC, value DESC) AS r FROM events) WHERE r = 1""")
def latest_per_key(spark, folder):
    log = table(spark, folder, "events").select("user_id", "ts", "event_type", "value")
    return history.latest_per_key(log, ["user_id"], "ts")
