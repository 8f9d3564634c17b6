"""All registered queries."""

from . import chain, follow, observe, outbox  # noqa: F401
from .registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
