from .numeric import nonnegative, pct_change, rounded
from .parsing import (
    file_service, file_year, month_key, parse_number, parse_period, title_service, title_year,
)
from .text import alias_name, clean_name, clean_report_name, group_name, quoted

__all__ = [
    "alias_name", "clean_name", "clean_report_name", "file_service", "file_year", "group_name",
    "month_key", "nonnegative", "parse_number", "parse_period", "pct_change", "quoted", "rounded",
    "title_service", "title_year",
]
