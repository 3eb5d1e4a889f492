"""Operators for preparing training data: one module each, with its registered query.

Nothing outside this folder imports it. ``QUERIES`` and ``SQL`` collect what the modules
register.
"""

from shelfcast.llm.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
