"""Raw readers, table sinks and the shared working folder."""

from ledgerloom.sources.raw import conform_raw, load_raw, read_raw_csv
from ledgerloom.sources.tables import read_tables, work_folder, write_table, write_tables

__all__ = [
    "conform_raw",
    "load_raw",
    "read_raw_csv",
    "read_tables",
    "work_folder",
    "write_table",
    "write_tables",
]
