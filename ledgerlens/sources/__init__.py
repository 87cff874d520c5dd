from ledgerlens.sources.schemas import TABLES, TableSpec
from ledgerlens.sources.tables import load_tables, register_views, save_table, write_tables

__all__ = ["TABLES", "TableSpec", "load_tables", "register_views", "save_table", "write_tables"]
