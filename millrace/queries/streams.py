"""The movement feed as streams: events become feed frames, every step takes in all of them."""

from pyspark.sql import functions as F

from millrace import schemas
from millrace.plans.bindings import project, table
from millrace.plans.rail import FACT_COLUMNS, join_companies
from millrace.queries.registry import query
from millrace.queries.roles import with_roles
from millrace.session import scratch
from millrace.streaming import movements as M
from millrace.streaming import sources

BODY = """SELECT 'T' || CAST(event_id AS VARCHAR) AS train_id, event_type,
    CASE WHEN event_id % 6 <> 0 THEN date_trunc('millisecond', ts) END AS actual_timestamp,
    CASE WHEN event_id % 97 = 0 THEN 'n/a' ELSE CAST(user_id % 30 AS VARCHAR) END AS toc_id,
    CASE WHEN event_id % 2 = 0 THEN 'UP' ELSE 'DOWN' END AS route, CAST(NULL AS VARCHAR) AS platform FROM events"""
SHOWN = ["train_id", "event_type", "actual_timestamp", "toc_id", "route", "platform"]


def frames(spark, folder):
    """Every event as a feed frame of two messages, a movement and one of another type."""
    millis = F.unix_millis(F.col("ts").cast("timestamp")).cast("string")
    number = F.col("event_id")
    values = {
        "train_id": F.concat(F.lit("T"), number.cast("string")),
        "event_type": F.col("event_type"),
        "actual_timestamp": F.when(number % 6 != 0, millis),
        "toc_id": F.when(number % 97 == 0, "n/a").otherwise((F.col("user_id") % 30).cast("string")),
        "direction_ind": F.when(number % 2 == 0, "UP").otherwise("DOWN"),
        "route": F.lit("ignored"),
    }
    body = F.struct(*[v.alias(n) for n, v in values.items()])

    def message(kind):
        header = F.struct(F.lit(kind).alias("msg_type"), millis.alias("msg_queue_timestamp"))
        return F.struct(header.alias("header"), body.alias("body"))

    return table(spark, folder, "events").select(F.to_json(F.array(message("0003"), message("0001"))).alias("value"))


def _streamed(spark, batch, label):
    """A batch of text laid down as files and taken up again as a stream."""
    path = scratch(spark, label)
    batch.write.text(path)
    return sources.text_folder(spark, path)


def _landed(spark, folder):
    """Frames split, projected and landed as JSON text; returns the landing path."""
    published = M.published(M.movement_bodies(_streamed(spark, frames(spark, folder), "frames")))
    path = scratch(spark, "raw")
    M.land(sources.as_json(published), path, scratch(spark, "checkpoint"))
    return path


def _as_ntz(rows):
    return rows.withColumn("actual_timestamp", F.col("actual_timestamp").cast("timestamp_ntz"))


@query("""SELECT 'T' || CAST(event_id AS VARCHAR) AS train_id, event_type, CASE WHEN event_id % 6 <> 0
    THEN CAST(epoch_us(ts) // 1000 AS VARCHAR) END AS actual_timestamp, 'ignored' AS route FROM events""")
def stream_split_messages(spark, folder):
    path = scratch(spark, "bodies")
    M.run(M.movement_bodies(_streamed(spark, frames(spark, folder), "frames")), path, scratch(spark, "checkpoint"))
    return spark.read.parquet(path).select("train_id", "event_type", "actual_timestamp", "route")


@query("""SELECT 'T' || CAST(event_id AS VARCHAR) AS train_id, CASE WHEN event_id % 6 <> 0 THEN
      strftime(t, '%Y-%m-%d %H:%M:%S') || CASE WHEN microsecond(t) % 1000000 = 0 THEN '' ELSE strftime(t, '.%f') END
      || '+00:00' END AS actual_timestamp, CASE WHEN event_id % 2 = 0 THEN 'UP' ELSE 'DOWN' END AS route
    FROM (SELECT *, date_trunc('millisecond', ts) AS t FROM events)""")
def stream_published(spark, folder):
    """The published text of the feed (January: London is on UTC)."""
    path = scratch(spark, "published")
    published = M.published(M.movement_bodies(_streamed(spark, frames(spark, folder), "frames")))
    M.run(published, path, scratch(spark, "checkpoint"))
    return spark.read.parquet(path).select("train_id", "actual_timestamp", "route")


@query(BODY)
def stream_movements(spark, folder):
    """Feed to typed rows: split, project, land, then the incremental transform."""
    raw, path = _landed(spark, folder), scratch(spark, "typed")
    M.run(M.typed(M.landed(spark, raw, streaming=True)), path, scratch(spark, "checkpoint"))
    return _as_ntz(spark.read.schema(schemas.movements()).parquet(path).select(*SHOWN))


@query("""SELECT CASE WHEN event_id % 5 = 0 THEN 'quarantine' ELSE 'landed' END AS folder, count(*) AS messages
    FROM events GROUP BY 1""")
def stream_land_raw(spark, folder):
    """Undecodable messages are counted in quarantine, not lost."""
    cut = F.when(F.col("event_id") % 5 == 0, F.substring("props", 1, 4)).otherwise(F.col("props"))
    messages = table(spark, folder, "events").select(cut.alias("value"))
    path = scratch(spark, "raw")
    M.land(_streamed(spark, messages, "messages"), path, scratch(spark, "checkpoint"))
    kept = M.landed(spark, path).select(F.lit("landed").alias("folder"))
    lost = M.quarantined(spark, path).select(F.lit("quarantine").alias("folder"))
    return kept.unionByName(lost).groupBy("folder").agg(F.count(F.lit(1)).alias("messages"))


@query("""SELECT part, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS total FROM (
      SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 'frame' ELSE 'body' END AS part FROM events
      UNION ALL SELECT event_id, 'other' FROM events WHERE event_id % 7 <> 0) GROUP BY 1""")
def stream_frame_quarantine(spark, folder):
    """Frames that cannot be decoded are set aside whole; all others are a movement and a message of another type."""
    number = F.col("event_id").cast("string")
    whole = F.to_json(F.array(*[
        F.struct(F.struct(F.lit(kind).alias("msg_type")).alias("header"), F.struct(number.alias("train_id")).alias("body"))
        for kind in ("0003", "0001")
    ]))
    cut = F.when(F.col("event_id") % 7 == 0, F.concat(F.lit('[{"header": '), number)).otherwise(whole)
    path = scratch(spark, "frames")
    M.land_bodies(_streamed(spark, table(spark, folder, "events").select(cut.alias("value")), "frames"), path, scratch(spark, "checkpoint"))
    numbers = {
        "body": F.get_json_object("value", "$.train_id"), "other": F.get_json_object("value", "$.body.train_id"),
        "frame": F.regexp_extract("value", "([0-9]+)$", 1),
    }
    parts = [
        M.landed_bodies(spark, path, part).select(F.lit(part).alias("part"), number.cast("long").alias("event_id"))
        for part, number in numbers.items()
    ]
    together = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return together.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("total"))


@query("""SELECT CAST(ts AS DATE) AS day, count(*) AS n, CAST(1 AS BIGINT) AS folders FROM events
    WHERE ts < (SELECT date_trunc('day', max(ts)) FROM events) GROUP BY 1""")
def stream_day_compaction(spark, folder):
    """Events that came in four late batches a day; every closed day becomes one folder."""
    events = table(spark, folder, "events").select("event_id", F.col("ts").alias("actual_timestamp"))
    path = scratch(spark, "days")
    write = M._replace_batch(path, "actual_timestamp")
    last = events.agg(F.date_trunc("day", F.max("actual_timestamp")).alias("last"))
    closed = events.join(F.broadcast(last), F.col("actual_timestamp") < F.col("last")).drop("last")
    for batch in range(4):
        write(closed.filter(F.col("event_id") % 4 == batch), batch)
    write(events.join(F.broadcast(last), F.col("actual_timestamp") >= F.col("last")).drop("last"), 4)
    stored = spark.read.schema("event_id bigint, day date, batch bigint").parquet(path)
    days = [str(row["day"]) for row in stored.filter("batch < 4").select("day").distinct().collect()]
    M.compact_days(spark, path, days)
    per_day = spark.read.schema("event_id bigint, day date, batch bigint").parquet(path).filter("batch < 4").groupBy("day")
    return per_day.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("batch").alias("folders"))


@query(f"SELECT CAST(actual_timestamp AS DATE) AS day, count(*) AS n FROM ({BODY}) GROUP BY 1")
def stream_day_load(spark, folder):
    """Typed rows streamed into day partitions; rows without a timestamp keep a day of null."""
    raw, path = _landed(spark, folder), scratch(spark, "days")
    M.load_days(M.typed(M.landed(spark, raw, streaming=True)), path, scratch(spark, "checkpoint"))
    return spark.read.schema("day date, batch bigint").parquet(path).groupBy("day").agg(F.count(F.lit(1)).alias("n"))


@query(with_roles("operating_companies", f"""SELECT event_type, actual_timestamp AS actual_timestamp_utc,
    CAST(NULL AS VARCHAR) AS event_source, train_id, CAST(NULL AS VARCHAR) AS variation_status, b.toc_id
    FROM ({BODY}) b LEFT JOIN operating_companies c ON TRY_CAST(b.toc_id AS INTEGER) = c.toc_id"""))
def stream_enrich(spark, folder):
    """Typed movement stream joined to the static company list."""
    typed = M.typed(M.landed(spark, _landed(spark, folder), streaming=True))
    companies = project(spark, folder).ref("stg_operating_companies")
    path = scratch(spark, "enriched")
    renamed = typed.withColumnRenamed("actual_timestamp", "actual_timestamp_utc")
    M.run(join_companies(renamed, companies), path, scratch(spark, "checkpoint"))
    stored = spark.read.parquet(path)
    return stored.withColumn("actual_timestamp_utc", F.col("actual_timestamp_utc").cast("timestamp_ntz")).select(
        *FACT_COLUMNS
    )
