"""All registered queries."""

from . import feeds, formats, joins, predicates, privacy, records, sources, totals  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
