"""All named queries: importing the modules that register them fills the dicts."""

from ledgerline.plans import queries as _marts  # noqa: F401
from ledgerline.plans import queries_checks as _checks  # noqa: F401
from ledgerline.plans import queries_io as _io  # noqa: F401
from ledgerline.plans.queries import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
