"""Queries over the test tables, each with the SQL that must give the same rows."""

from workload import asof, files, merges, sql, tables
from workload.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "asof", "files", "merges", "sql", "tables"]
