"""The registered queries: how the given tables play the three roles, each query, and its SQL."""

from headway.catalog import (  # noqa: F401  (importing a module registers its queries)
    balancing,
    encoding,
    landing,
    modelling,
    outlook,
    preparation,
    reports,
)
from headway.catalog.registry import QUERIES, SQL, warehouse

__all__ = ["QUERIES", "SQL", "warehouse"]
