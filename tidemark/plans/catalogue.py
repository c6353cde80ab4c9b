"""All catalogue entries, collected."""

from tidemark.plans import scalars  # noqa: F401 - registers its queries
from tidemark.plans import records  # noqa: F401,I001
from tidemark.plans import log_layout, tables  # noqa: F401
from tidemark.plans import streams  # noqa: F401 - after tables, whose SQL it shares
from tidemark.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
