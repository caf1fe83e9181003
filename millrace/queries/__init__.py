"""Registered queries over the given tables."""

from millrace.queries import changes, columns, groups, io, jobs, joins, metadata  # noqa: F401
from millrace.queries.registry import ORACLE, SPARK

__all__ = ["ORACLE", "SPARK"]
