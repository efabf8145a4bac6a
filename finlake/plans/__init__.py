"""Registered queries."""

from . import banking, events, governance, ingestion
from .registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES", "banking", "events", "governance", "ingestion"]
