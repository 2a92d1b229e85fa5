"""The registered queries, one or more per operator, keyed by operator."""

from tablewright.catalog import (  # noqa: F401  (registers on import)
    categorical, features, images, models, prepare, profile, sources,
)
from tablewright.catalog.common import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
