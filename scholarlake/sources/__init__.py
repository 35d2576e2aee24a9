"""Snapshot files as lines of text."""

from scholarlake.sources.snapshot import SnapshotFile, count_files, list_files, read_lines

__all__ = ["SnapshotFile", "count_files", "list_files", "read_lines"]
