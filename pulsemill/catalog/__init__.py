"""All registered queries."""

from pulsemill.catalog import decode, files, keyed, runs, stored, values  # noqa: F401
from pulsemill.catalog.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
