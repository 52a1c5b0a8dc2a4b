"""Paths of the layers: raw, then cleaned, then table; day-partitioned tables get a dated sub-folder."""

from __future__ import annotations

import datetime as dt

from millrace.schemas import PARTITIONED_TABLES


def layer_path(root: str, layer: str, domain: str, table: str, day: dt.date | str | None = None) -> str:
    path = f"{root.rstrip('/')}/{layer}/{domain}/{table}"
    if table in PARTITIONED_TABLES:
        if day is None:
            raise ValueError(f"{table} is stored by day: a day is needed")
        return f"{path}/{day}"
    return path


def raw_path(root: str, domain: str, table: str, day: dt.date | str | None = None) -> str:
    return layer_path(root, "raw", domain, table, day)


def cleaned_path(root: str, domain: str, table: str, day: dt.date | str | None = None) -> str:
    return layer_path(root, "cleaned", domain, table, day)
