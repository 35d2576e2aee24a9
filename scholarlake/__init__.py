"""Scholarly metadata snapshots to flat Parquet tables, on Spark."""

from scholarlake.plans import ENTITIES, TABLES, RunReport, entity_table, malformed_lines, run
from scholarlake.plans.job import configure
from scholarlake.sources import count_files, list_files, read_lines

__all__ = [
    "ENTITIES",
    "TABLES",
    "RunReport",
    "configure",
    "count_files",
    "entity_table",
    "list_files",
    "malformed_lines",
    "read_lines",
    "run",
]
