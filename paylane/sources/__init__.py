"""Reading the ledger tables, writing and reading back the line files."""

from .by_id import append_by_id, rows_of
from .lines import file_manifest, numbered, read_lines, write_lines
from .tables import BY_ID, SCHEMAS, conform, load_tables

__all__ = ["BY_ID", "SCHEMAS", "append_by_id", "conform", "file_manifest", "load_tables", "numbered", "read_lines", "rows_of", "write_lines"]
