"""Sources (S1-S5) and sinks (K1-K4)."""

from cascara.sources.tables import load_table, TABLES
from cascara.sources.text import read_text_lines
from cascara.sources.csv import (
    ITEMS_SCHEMA, PROFILE_SCHEMA, RATINGS_SCHEMA, column_types, infer_schema, read_csv,
)
from cascara.sources.order import order_faults, written_rows
from cascara.sources.sinks import read_fields, write_text, write_csv

__all__ = [
    "load_table", "TABLES", "read_text_lines", "read_csv", "RATINGS_SCHEMA",
    "ITEMS_SCHEMA", "PROFILE_SCHEMA", "read_fields", "write_text", "write_csv",
    "column_types", "infer_schema", "order_faults", "written_rows",
]
