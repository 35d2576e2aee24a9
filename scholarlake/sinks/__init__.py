"""Parquet output."""

from scholarlake.sinks.parquet import table_path, write_table

__all__ = ["table_path", "write_table"]
