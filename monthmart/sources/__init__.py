from .catalog import headings, load_summary, resource_catalog
from .tables import (
    append_once, bulk_load, create_new, delete_path, first_existing, inventory, list_names, loaded_rows, materialize,
    qualified, rebalanced, save_catalog_table, save_table, save_view, scratch_path, shared_dir, write_load,
)
from .workbook import file_metadata, is_workbook, scan_workbooks, sheet_rows, with_status

__all__ = [
    "append_once", "bulk_load", "create_new", "delete_path", "file_metadata", "first_existing", "headings", "inventory",
    "is_workbook", "list_names", "load_summary", "loaded_rows", "materialize", "qualified", "rebalanced", "resource_catalog",
    "save_catalog_table", "save_table", "save_view", "scratch_path", "scan_workbooks", "shared_dir", "sheet_rows",
    "with_status", "write_load",
]
