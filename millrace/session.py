"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from itertools import count

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the operators rely on. UTC keeps zone-free and zoned timestamps in step;
# the skew rule is forced so that a hot key is split even where that costs one more shuffle.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **settings: str) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster pass the job's own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("millrace")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in {**SQL_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, or the context's checkpoint folder.

    Only a local-mode session without either gets a temporary folder of this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if spark.sparkContext.getCheckpointDir():
        return spark.sparkContext.getCheckpointDir().rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="millrace-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is created until something is written there."""
    return f"{shared_folder(spark)}/millrace/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back: later steps survive lost executors, read only
    the columns they need and know the size of what they join."""
    path = scratch(df.sparkSession, "step")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of whatever file system its path names."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder of whatever file system holds; none where it does not exist."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return [status.getPath().getName() for status in system.listStatus(folder)] if system.exists(folder) else []


def write_record(spark: SparkSession, folder: str, name: str, text: str) -> None:
    """A small file that is there completely or not at all. One of that name already there is an error."""
    at = spark._jvm.org.apache.hadoop.fs.Path
    part, whole = at(f"{folder}/_{uuid.uuid4().hex}"), at(f"{folder}/{name}")
    system = whole.getFileSystem(spark._jsc.hadoopConfiguration())
    out = system.create(part, False)
    out.write(bytearray(text, "utf-8"))
    out.close()
    if system.exists(whole) or not system.rename(part, whole):
        system.delete(part, False)
        raise FileExistsError(f"{folder}/{name}")


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; the target must not be there."""
    at = spark._jvm.org.apache.hadoop.fs.Path
    system = at(source).getFileSystem(spark._jsc.hadoopConfiguration())
    if system.exists(at(target)) or not system.rename(at(source), at(target)):
        raise FileExistsError(target)


@contextmanager
def steps(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """``cut_lineage`` for the steps of one job; what they wrote is removed when the job is over."""
    folder, numbers = scratch(spark, "steps"), count()

    def keep(df: DataFrame) -> DataFrame:
        path = f"{folder}/{next(numbers)}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    try:
        yield keep
    finally:
        remove_folder(spark, folder)


def spread(scan: DataFrame) -> DataFrame:
    """A bare file scan, dealt out to all cores when it has fewer splits than there are cores.

    For work that costs much per row. A large input has more splits than cores and is left alone, so
    this never shuffles one.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan
