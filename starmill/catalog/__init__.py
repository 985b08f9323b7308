"""The registered queries, each with the SQL that must give the same rows."""

from starmill.catalog import (  # noqa: F401  (importing registers the queries)
    dimensions,
    facts,
    files,
    loads,
    pipelines,
    quality,
    reports,
    scalars,
)
from starmill.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
