"""The queries that the driver runs, one per operator, with the SQL that checks each."""

from driver_queries import checks, compare, joins, mapping, sources
from driver_queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "checks", "compare", "joins", "mapping", "sources"]
