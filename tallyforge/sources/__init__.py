"""Readers and line parsers."""

from tallyforge.sources.parsed import Parsed

__all__ = ["Parsed"]
