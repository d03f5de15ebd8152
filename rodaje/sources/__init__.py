"""Readers and writers."""

from rodaje.sources.readers import table

__all__ = ["table"]
