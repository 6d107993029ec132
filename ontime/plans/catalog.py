"""All queries and their SQL equivalents: importing the modules registers them."""

from __future__ import annotations

from ontime.plans import flow, stores  # noqa: F401
from ontime.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
