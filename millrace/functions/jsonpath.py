"""JSON text accessors with warehouse semantics."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_TREE = "_json_tree"


def _found(tree: Column, path: str) -> Column:
    return F.try_variant_get(tree, path, "variant")


def _is_nested(tree: Column, path: str) -> Column:
    kind = F.schema_of_variant(_found(tree, path))
    return kind.startswith("ARRAY") | kind.startswith("OBJECT")


def _query(json: Column, tree: Column, path: str) -> Column:
    # Nested fragments are cut from the text, which keeps the order of their keys.
    text = F.to_json(_found(tree, path))
    return F.when(_is_nested(tree, path), F.get_json_object(json, path)).otherwise(F.nullif(text, F.lit("null")))


def _value(json: Column, tree: Column, path: str) -> Column:
    return F.when(~_is_nested(tree, path), F.try_variant_get(tree, path, "string"))


def json_query(json: Column, path: str) -> Column:
    """The JSON fragment at ``path``: strings keep their quotes; JSON null and bad input give null."""
    return _query(json, F.try_parse_json(json), path)


def json_value(json: Column, path: str) -> Column:
    """The scalar at ``path`` as text; null for arrays, objects, JSON null and bad input."""
    return _value(json, F.try_parse_json(json), path)


def with_json(
    df: DataFrame, json: str, queries: Mapping[str, str] | None = None, values: Mapping[str, str] | None = None
) -> DataFrame:
    """Add many fragments (``queries``) and scalars (``values``), name to path; a row is parsed once."""
    parsed, text = df.withColumn(_TREE, F.try_parse_json(json)), F.col(json)
    added = {name: _query(text, F.col(_TREE), path) for name, path in (queries or {}).items()}
    added |= {name: _value(text, F.col(_TREE), path) for name, path in (values or {}).items()}
    return parsed.withColumns(added).drop(_TREE)
