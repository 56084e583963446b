"""Orderlake: ZIP files with sales CSVs to bronze, silver and quarantine tables, as Spark jobs."""

from orderlake.lake import Lake

__all__ = ["Lake"]
