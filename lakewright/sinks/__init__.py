"""Table sinks."""
from lakewright.sinks.tables import (drop_tables, ensure_namespace, list_tables, table_exists,
                                     write_table)

__all__ = ["drop_tables", "ensure_namespace", "list_tables", "table_exists", "write_table"]
