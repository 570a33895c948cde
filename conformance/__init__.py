"""Queries over the shared test tables, each with the SQL it has to agree with."""

from conformance import batch, lake, streams, text  # noqa: F401  (each registers its queries)
from conformance.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
