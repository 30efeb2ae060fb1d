"""Where tables and feeds are read from and written to."""

from tidemark.sources.tables import Shape, Table, open_table

__all__ = ["Shape", "Table", "open_table"]
