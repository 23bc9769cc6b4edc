"""Sinks: table writers, output read-back, typed bulk loads."""

from .published import OutputMemo, publish, published_files
from .writers import copy_csv_into_table, load_table, read_outputs, write_outputs, write_table

__all__ = ["OutputMemo", "copy_csv_into_table", "load_table", "publish", "published_files", "read_outputs", "write_outputs", "write_table"]
