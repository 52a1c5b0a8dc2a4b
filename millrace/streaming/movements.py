"""The movement feed: split, project, land, type, load, enrich. Each step takes a batch or a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace import schemas
from millrace.functions.dates import instant_from_millis, london_text
from millrace.functions.nested import explode_json_batch, is_json_batch, is_json_object
from millrace.session import file_names, move_folder, remove_folder
from millrace.sinks.tables import with_day

MOVEMENT = "0003"
ROUTE_FIELD = "direction_ind"  # as published: the route is filled from the direction


def movement_bodies(frames: DataFrame, text: str = "value") -> DataFrame:
    """Bodies of the movement messages inside JSON batch frames; other message types drop out."""
    messages = explode_json_batch(frames.select(text), text, schemas.movement_message())
    return messages.filter(F.col("message.header.msg_type") == MOVEMENT).select("message.body.*")


def land_bodies(frames: DataFrame, path: str, checkpoint: str, text: str = "value") -> StreamingQuery:
    """Land every frame of a stream: the bodies of its movement messages as JSON, one a line, or the frame itself.

    ``part=body`` holds the bodies, ``part=other`` the messages of other types, ``part=frame`` the frames that could not
    be decoded. All go through one file sink, so each is there once and none is lost.
    """
    ok = is_json_batch(F.col(text))
    message = F.from_json(F.when(ok, F.col(text)), T.ArrayType(schemas.movement_message()))
    wanted = F.coalesce(F.col("m.header.msg_type") == MOVEMENT, F.lit(False))
    rows = frames.select(F.col(text).alias("frame"), F.explode_outer(message).alias("m"), ok.alias("ok")).select(
        F.when(~F.col("ok"), F.col("frame")).when(wanted, F.to_json("m.body")).otherwise(F.to_json("m")).alias("value"),
        F.when(~F.col("ok"), "frame").when(wanted, "body").otherwise("other").alias("part"),
    )
    return run(rows.withColumn("value", F.coalesce("value", F.lit(""))), path, checkpoint, "text", "part")


def landed_bodies(spark: SparkSession, path: str, part: str = "body") -> DataFrame:
    """What ``land_bodies`` put aside under a part."""
    return spark.read.schema("value string, part string").text(path).filter(F.col("part") == part).select("value")


def compact_days(spark: SparkSession, path: str, days: list[str]) -> None:
    """Make one batch folder of the batch folders of each closed day (``YYYY-MM-DD``).

    The rows are first written to a hidden folder beside the table, which readers of ``path`` do not see; only when that
    is complete does it take the place of the small folders. A step that died is done again from whatever is complete:
    a finished copy replaces the day, an unfinished one is thrown away. The newest batch of the table is left alone, as
    a stream that comes up again may write it once more; later ones have folders of their own.
    """

    def number(batch: str) -> int:
        return int(batch.removeprefix("batch="))

    def batches_of(folder: str) -> list[str]:
        return [name for name in file_names(spark, folder) if name.startswith("batch=")]

    newest = max((number(b) for d in file_names(spark, path) if d.startswith("day=") for b in batches_of(f"{path}/{d}")), default=0)
    for day in days:
        folder, copy = f"{path}/day={day}", f"{path}/_compacted/day={day}"
        done = "_SUCCESS" in file_names(spark, copy)
        batches = [name for name in batches_of(folder) if number(name) < newest]
        if not done:
            if len(batches) < 2:
                continue
            remove_folder(spark, copy)
            rows = spark.read.parquet(*[f"{folder}/{name}" for name in batches])
            marker = spark.range(1).select(F.lit(",".join(batches)).alias("value"))
            marker.coalesce(1).write.mode("overwrite").text(f"{path}/_compacted/of-{day}")
            rows.hint("rebalance").write.parquet(copy)
        merged = spark.read.text(f"{path}/_compacted/of-{day}").first()["value"].split(",")
        first = min(merged, key=number)
        for name in merged:
            remove_folder(spark, f"{folder}/{name}")
        move_folder(spark, copy, f"{folder}/{first}")
        remove_folder(spark, f"{path}/_compacted/of-{day}")


def published(bodies: DataFrame, route_field: str = ROUTE_FIELD) -> DataFrame:
    """The 29 published fields: epoch milliseconds become zoned London text, absent ones stay null."""

    def value(name: str):
        if name in schemas.MOVEMENT_TIMESTAMPS:
            return london_text(instant_from_millis(F.col(name)))
        return F.col(route_field if name == "route" else name)

    return bodies.select([value(name).alias(name) for name in schemas.MOVEMENT_FIELDS])


def run(
    stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", partition: str | None = None
) -> StreamingQuery:
    """Take in everything new, append it to a folder exactly once, stop."""
    writer = stream.writeStream.format(fmt).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    query = (writer.partitionBy(partition) if partition else writer).start(path)
    query.awaitTermination()
    return query


def land(messages: DataFrame, path: str, checkpoint: str, text: str = "value") -> StreamingQuery:
    """Land raw messages, one JSON text a line, undecodable ones in a folder of their own.

    Both go through one file sink, so a message is landed once and none is lost silently.
    """
    marked = messages.select(F.col(text).alias("value"), is_json_object(F.col(text)).cast("string").alias("decoded"))
    return run(marked, path, checkpoint, "text", "decoded")


LANDED = "value string, decoded string"


def landed(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Decodable landed messages. Read from the landing path itself, whose sink log lists the
    committed files, so files of a failed attempt are never seen."""
    reader = spark.readStream if streaming else spark.read
    return reader.schema(LANDED).text(path).filter("decoded = 'true'").select("value")


def quarantined(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LANDED).text(path).filter("decoded = 'false'").select("value")


def typed(raw: DataFrame) -> DataFrame:
    """Landed JSON text as the declared 29 fields; the text ``None`` and bad timestamps read as null."""
    parsed = raw.select(F.from_json("value", schemas.movements()).alias("m"))
    return parsed.select("m.*")


def load_days(typed_rows: DataFrame, path: str, checkpoint: str, ts: str = "actual_timestamp") -> StreamingQuery:
    """Stream typed rows into a table partitioned by day and batch.

    A batch only ever replaces its own (day, batch) folders, so a batch that is replayed after a lost
    driver gives the same table, and a day may arrive in any number of batches.
    """
    query = (
        typed_rows.writeStream.foreachBatch(_replace_batch(path, ts))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def _replace_batch(path: str, ts: str) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        (
            with_day(batch, ts, "day")
            .withColumn("batch", F.lit(batch_id))
            .hint("rebalance", "day")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("day", "batch")
            .parquet(path)
        )

    return write
