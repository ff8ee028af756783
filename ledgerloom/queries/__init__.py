"""Every registered query."""

from ledgerloom.queries import enrichment, operations, posting, relational, scans  # noqa: F401
from ledgerloom.queries.registry import REGISTRY

__all__ = ["REGISTRY"]
