"""Registered queries over the test tables, each with the SQL that checks it."""

from tallyweave.catalogue import cleaning, files, incremental, loading, mapped, quality, resolved
from tallyweave.catalogue.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "cleaning", "files", "incremental", "loading", "mapped", "quality", "resolved"]
