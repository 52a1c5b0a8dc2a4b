"""Stream sources and the topic sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def topic_options(servers: str, topic: str, group: str, security: dict[str, str] | None = None) -> dict[str, str]:
    """Options of a topic reader: from the earliest offset, under a consumer group."""
    kafka = {f"kafka.{k}": v for k, v in (security or {}).items()}
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "kafka.group.id": group,
        "startingOffsets": "earliest",
        **kafka,
    }


def topic(
    spark: SparkSession, servers: str, name: str, group: str, security: dict[str, str] | None = None
) -> DataFrame:
    """Messages of a topic as one text column ``value``; needs the Kafka package on the class path."""
    rows = spark.readStream.format("kafka").options(**topic_options(servers, name, group, security)).load()
    return rows.select(F.col("value").cast("string").alias("value"))


def publish(messages: DataFrame, servers: str, name: str, checkpoint: str, security: dict[str, str] | None = None):
    """Send a stream of rows to a topic as JSON; returns the running query."""
    kafka = {f"kafka.{k}": v for k, v in (security or {}).items()}
    return (
        as_json(messages)
        .writeStream.format("kafka")
        .options(**{"kafka.bootstrap.servers": servers, "topic": name, "checkpointLocation": checkpoint, **kafka})
        .start()
    )


def as_json(rows: DataFrame) -> DataFrame:
    """Each row as one JSON text ``value``; null fields are written as null."""
    return rows.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


def text_folder(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """New files of a folder as lines of text, column ``value``; stands in for a topic.

    ``files_per_batch`` cuts a long backlog into batches of bounded size.
    """
    reader = spark.readStream
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).text(path)
