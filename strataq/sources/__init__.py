"""Readers and writers."""

from strataq.sources.tables import table

__all__ = ["table"]
