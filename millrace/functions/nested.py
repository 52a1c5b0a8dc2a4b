"""Nested documents: flattening, message batches, lenient parsing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def leaf_paths(schema: T.StructType, prefix: str = "") -> list[tuple[str, str]]:
    """(quoted path, dotted name) of every non-struct field."""
    leaves = []
    for field in schema.fields:
        path, name = f"{prefix}`{field.name}`", f"{prefix}`{field.name}`".replace("`", "")
        if isinstance(field.dataType, T.StructType):
            leaves += leaf_paths(field.dataType, f"{path}.")
        else:
            leaves.append((path, name))
    return leaves


def flatten(df: DataFrame) -> DataFrame:
    """One column per leaf, named by its dotted path (``widget.window.title``)."""
    return df.select([F.col(path).alias(name) for path, name in leaf_paths(df.schema)])


def explode_json_batch(df: DataFrame, text: str, item: T.DataType, name: str = "message") -> DataFrame:
    """One row per element of a JSON array held as text; undecodable batches give no rows (``split_json_batches``
    keeps them)."""
    parsed = F.from_json(F.col(text), T.ArrayType(item))
    return df.select("*", F.explode(parsed).alias(name)).drop(text)


def split_json_batches(df: DataFrame, text: str, item: T.DataType, name: str = "message") -> tuple[DataFrame, DataFrame]:
    """(elements of the batches, batches that give none): together nothing of ``df`` is missing.

    A batch is undecodable if its text is null, no JSON, or no array of objects; it is quarantined as it came. One with
    an element that is no object is quarantined whole, as is an empty array: every row of ``df`` is either messages or
    one quarantine row. Batch and stream alike.
    """
    ok = is_json_batch(F.col(text))
    return explode_json_batch(df.filter(ok), text, item, name), df.filter(~ok)


def is_json_batch(text: Column) -> Column:
    """True for text that decodes to a JSON array of one or more objects, false for anything else including null."""
    elements = F.try_variant_get(F.try_parse_json(text), "$", "array<variant>")
    objects = F.forall(elements, lambda one: F.coalesce(F.schema_of_variant(one).startswith("OBJECT"), F.lit(False)))
    return F.coalesce(F.size(elements) > 0, F.lit(False)) & F.coalesce(objects, F.lit(False))


def parse_or_quarantine(df: DataFrame, text: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(decoded rows, rows whose text is not a JSON object)."""
    decoded = df.withColumn("_parsed", F.from_json(F.col(text), schema)).withColumn(
        "_ok", is_json_object(F.col(text))
    )
    good = decoded.filter("_ok").select(*[c for c in df.columns if c != text], "_parsed.*")
    bad = df.filter(~is_json_object(F.col(text)))
    return good, bad


def is_json_object(text: Column) -> Column:
    """True for text that decodes to a JSON object, false for anything else including null."""
    kind = F.schema_of_variant(F.try_parse_json(text))
    return F.coalesce(kind.startswith("OBJECT"), F.lit(False))
