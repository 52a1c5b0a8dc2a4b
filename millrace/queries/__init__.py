"""Registered queries with their oracle SQL, one module per operator family."""

from millrace.queries import (  # noqa: F401  (importing a module registers its queries)
    commerce,
    dataquality,
    files,
    governance,
    lake,
    loads,
    nested,
    relational,
    retrieval,
    scalars,
    staging,
    streams,
)
from millrace.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
