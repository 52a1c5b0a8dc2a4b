"""Type-2 history: one row per version of a key, valid from its timestamp until the next version's.

``StoredHistory`` keeps a history in a folder and brings it up to date run by run; the functions do the same on frames.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import file_names, steps, write_record

VALID_FROM, VALID_TO = "valid_from", "valid_to"
CUTS = 16  # parts of a stored history's open versions, by a hash of the key
RECORD = "version bigint, table_schema string, parts int, cuts array<struct<cut: int, generation: string>>, closed array<string>"


def undated(source: DataFrame, key: str, ts: str) -> DataFrame:
    """Rows without key or timestamp: they are no versions, and every history leaves them out or refuses them."""
    return source.filter(F.col(key).isNull() | F.col(ts).isNull())


def latest_per_key(df: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """The newest row of every key. Equal timestamps are settled by the remaining columns, so the
    outcome does not depend on row order. A grouped maximum: hot keys shrink before the shuffle."""
    rest = [c for c in df.columns if c not in (*keys, ts)]
    newest = df.groupBy(*keys).agg(F.max(F.struct(ts, *rest)).alias("_newest"))
    return newest.select(*keys, "_newest.*").select(*df.columns)


def start_history(source: DataFrame, key: str, ts: str) -> DataFrame:
    """History after the first run: one open version per key."""
    current = latest_per_key(source, [key], ts)
    return current.withColumns({VALID_FROM: F.col(ts), VALID_TO: F.lit(None).cast(current.schema[ts].dataType)})


def apply_snapshot(history: DataFrame, source: DataFrame, key: str, ts: str) -> DataFrame:
    """History after one more run over the current source rows.

    A key whose timestamp is newer than its open version closes that version and opens another; equal
    or older timestamps change nothing; keys missing from the source stay open. Both join sides hold
    one row per key, so no key can be hot.
    """
    columns = [c for c in history.columns if c not in (VALID_FROM, VALID_TO)]
    ts_type = history.schema[ts].dataType
    closed = history.filter(F.col(VALID_TO).isNotNull())
    current = history.filter(F.col(VALID_TO).isNull()).select(key, F.struct(*history.columns).alias("_old"))
    newest = latest_per_key(source.select(*columns), [key], ts).select(key, F.struct(*columns).alias("_new"))
    both = current.join(newest, key, "full")

    opens = F.col("_new").isNotNull() & (F.col("_old").isNull() | (F.col(f"_new.{ts}") > F.col(f"_old.{ts}")))
    kept = F.col("_old").withField(VALID_TO, F.when(opens, F.col(f"_new.{ts}")))
    opened = F.struct(
        *[F.col(f"_new.{c}").alias(c) for c in columns],
        F.col(f"_new.{ts}").alias(VALID_FROM),
        F.lit(None).cast(ts_type).alias(VALID_TO),
    )
    versions = F.array_compact(
        F.array(F.when(F.col("_old").isNotNull(), kept), F.when(opens, opened.cast(history.select(
            F.struct(*columns, VALID_FROM, VALID_TO).alias("s")).schema["s"].dataType)))
    )
    rewritten = both.select(F.explode(versions).alias("v")).select("v.*").select(*history.columns)
    return closed.unionByName(rewritten)


def history_from_log(log: DataFrame, key: str, ts: str, bucket: str = "hour") -> DataFrame:
    """History out of a full change log.

    The next version is looked up in two steps, so that a key holding much of the log is spread over
    its time buckets: inside a (key, bucket) with ``lead``, and from the last row of a bucket to the
    first row of the key's next bucket, over one row per (key, bucket). Rows without key or timestamp
    are no changes and are left out (``undated`` gives them); equal (key, timestamp) rows count once.
    """
    rest = [c for c in log.columns if c not in (key, ts)]
    changes = log.filter(F.col(key).isNotNull() & F.col(ts).isNotNull())
    slot = F.date_trunc(bucket, F.col(ts))
    versions = changes.groupBy(key, ts).agg(F.max(F.struct(*rest)).alias("_rest")).withColumn("_slot", slot)
    inside = versions.withColumn("_next", F.lead(ts).over(Window.partitionBy(key, "_slot").orderBy(ts)))
    firsts = changes.groupBy(key, slot.alias("_slot")).agg(F.min(ts).alias("_first"))
    later = firsts.select(
        key, "_slot", F.lead("_first").over(Window.partitionBy(key).orderBy("_slot")).alias("_later")
    )
    return inside.join(later, [key, "_slot"], "left").select(
        key, ts, "_rest.*", F.col(ts).alias(VALID_FROM), F.coalesce("_next", "_later").alias(VALID_TO)
    ).select(*log.columns, VALID_FROM, VALID_TO)


class StoredHistory:
    """The history of one key's rows in a folder. One writer at a time.

    Open versions lie in ``parts`` parts by a hash of the key, apart from closed ones; their number is set when the
    history is begun (take one that leaves some hundred megabytes a part) and kept with it. A run reads the source and the open
    versions once, rewrites the parts in which a key got a new version and adds the versions closed by it; closed
    versions are never read or written again. What it wrote counts from the moment its one small record is there.

    Layout: ``<root>/open/generation=<g>/cut=<n>/``, ``<root>/closed/generation=<g>/``, ``<root>/log/<version>.json``.
    """

    def __init__(self, spark: SparkSession, root: str, key: str, ts: str, parts: int = CUTS):
        self.spark, self.root, self.key, self.ts = spark, root.rstrip("/"), key, ts
        self.version, self.schema, self.cuts, self.closed, self.parts = self._latest(parts)

    def _latest(self, parts: int) -> tuple[int, T.StructType | None, dict[int, str], list[str], int]:
        names = sorted(n for n in file_names(self.spark, f"{self.root}/log") if n[:1].isdigit() and n.endswith(".json"))
        if not names:
            return -1, None, {}, [], parts
        record = self.spark.read.schema(RECORD).json(f"{self.root}/log/{names[-1]}").first()
        schema = T.StructType.fromJson(json.loads(record["table_schema"]))
        return record["version"], schema, {cut: g for cut, g in record["cuts"]}, list(record["closed"]), record["parts"]

    def _cut(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.parts)).cast("int")

    def _read(self, part: str, schema: T.StructType, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/{part}").parquet(*paths).select(schema.names)

    def _open(self, cuts: Iterable[int] | None = None) -> DataFrame:
        """Open versions of the given parts, or of all."""
        wanted = sorted(self.cuts if cuts is None else set(cuts) & set(self.cuts))
        schema = T.StructType([*self.schema.fields]).add(VALID_FROM, self.schema[self.ts].dataType)
        return self._read("open", schema, [f"{self.root}/open/generation={self.cuts[cut]}/cut={cut}" for cut in wanted])

    def current(self) -> DataFrame:
        """The open version of every key, with ``valid_from``."""
        return self._open()

    def versions(self) -> DataFrame:
        """All versions, with ``valid_from`` and ``valid_to`` (null while open)."""
        open_ = self._open().withColumn(VALID_TO, F.lit(None).cast(self.schema[self.ts].dataType))
        return open_.unionByName(self._read("closed", open_.schema, [f"{self.root}/closed/generation={g}" for g in self.closed]))

    def run(self, source: DataFrame) -> int:
        """Take in the source's current rows; returns the number of keys that got a new version.

        A key whose newest timestamp is later than its open version's closes that one and opens another; equal or older
        timestamps change nothing, keys missing from the source stay open. A row without key or timestamp that would make
        a version stops the run before anything is written (see ``undated``).
        """
        if self.schema is None:
            self.schema = T.StructType([T.StructField(f.name, f.dataType) for f in source.schema.fields])
        names, key, ts = self.schema.names, self.key, self.ts
        with steps(self.spark) as keep:
            rows = source.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields])
            newest = latest_per_key(rows, [key], ts)
            held = self._open().select(F.col(key).alias("_key"), F.struct(*names, VALID_FROM).alias("_old"))
            newer = F.col("_old").isNull() | (F.col(ts) > F.col(f"_old.{ts}"))
            # Files are far smaller than their rows: by their size a side of millions of keys would be broadcast.
            both = newest.join(held.hint("merge"), F.col(key) == F.col("_key"), "left")
            changed = keep(both.where(newer).withColumn("cut", self._cut()))
            per_cut = changed.groupBy("cut").agg(
                F.count(F.lit(1)).alias("n"), F.count_if(F.col(key).isNull() | F.col(ts).isNull()).alias("undated")
            ).collect()
            if any(row["undated"] for row in per_cut):
                raise ValueError(f"rows without {key} or {ts}")
            if per_cut:
                self._commit(changed, [row["cut"] for row in per_cut])
            return sum(row["n"] for row in per_cut)

    def _commit(self, changed: DataFrame, cuts: list[int]) -> None:
        names, ts, generation = self.schema.names, self.ts, uuid.uuid4().hex
        ended = changed.where(F.col("_old").isNotNull()).select("_old.*", F.col(ts).alias(VALID_TO))
        ended.write.parquet(f"{self.root}/closed/generation={generation}")
        opened = changed.select(*names, F.col(ts).alias(VALID_FROM), "cut")
        kept = self._open(cuts).join(changed.select(self.key).hint("merge"), self.key, "left_anti").withColumn("cut", self._cut())
        rows = kept.select(*names, VALID_FROM, "cut").unionByName(opened)
        rows.hint("rebalance", "cut").write.partitionBy("cut").parquet(f"{self.root}/open/generation={generation}")
        held, closed = self.cuts | dict.fromkeys(cuts, generation), [*self.closed, generation]
        record = {
            "version": self.version + 1,
            "table_schema": self.schema.json(),
            "parts": self.parts,
            "cuts": [{"cut": cut, "generation": g} for cut, g in sorted(held.items())],
            "closed": closed,
        }
        write_record(self.spark, f"{self.root}/log", f"{self.version + 1:012}.json", json.dumps(record))
        self.version, self.cuts, self.closed = self.version + 1, held, closed
