"""From lines to unique records to table rows."""

from scholarlake.operators.dedup import duplicated_ids, first_per_id, keep_first
from scholarlake.operators.records import (
    RecordTable,
    malformed_lines,
    parse_records,
    table_rows,
)

__all__ = [
    "RecordTable",
    "duplicated_ids",
    "first_per_id",
    "keep_first",
    "malformed_lines",
    "parse_records",
    "table_rows",
]
