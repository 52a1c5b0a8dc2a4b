"""Models: functions from a project to a DataFrame, found by name, each built once per project."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from millrace.sinks.tables import load_table

MODELS: dict[str, Callable[[Project], DataFrame]] = {}


def model(build: Callable[[Project], DataFrame]) -> Callable[[Project], DataFrame]:
    """Register a model under its function name."""
    MODELS[build.__name__] = build
    return build


class Project:
    """Source tables by name and the models over them. A model is lazy: Catalyst sees the whole tree."""

    def __init__(self, sources: Mapping[str, Callable[[], DataFrame] | DataFrame]):
        self._sources = sources
        self._built: dict[str, DataFrame] = {}

    def source(self, name: str) -> DataFrame:
        found = self._sources[name]
        return found() if callable(found) else found

    def ref(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = MODELS[name](self)
        return self._built[name]

    def materialise(self, name: str, kind: str = "view", layer: str = "default", path: str | None = None) -> DataFrame:
        """Publish a model as a view, or as a table of its layer's database (stored at ``path`` if given)."""
        df = self.ref(name)
        spark = df.sparkSession
        if kind == "view":
            df.createOrReplaceTempView(name)
            return spark.table(name)
        place = f" LOCATION '{path}.db'" if path else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{layer}`{place}")
        load_table(df, f"{layer}.{name}", path)
        return spark.table(f"{layer}.{name}")
