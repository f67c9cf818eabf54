"""Named queries over the given tables, each with the SQL it is checked against where there is one."""

from txguard.catalog import analytics, models, records, streams, tables  # noqa: F401  (they register)
from txguard.catalog.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
