"""Parsers for titles, file names, period headers and numbers, all as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import MONTHS, TITLE_PATTERN
from .text import UNICODE

# Text that is a plain number with at most one decimal comma or dot. Checked before
# the cast, which would also take forms such as '1.5d' or 'Infinity'.
NUMBER = r"^\s*[+-]?([0-9]+[.,]?[0-9]*|[.,][0-9]+)([eE][+-]?[0-9]+)?\s*$"
YEAR_MONTH = r"(\d{4})[.-](\d{1,2})"
MONTH_YEAR = r"([A-Z]{3})/(\d{4})"


def _group(col: Column, pattern: str, index: int) -> Column:
    """Capture group as text, null where the pattern is not found."""
    return F.nullif(F.regexp_extract(col, pattern, index), F.lit(""))


def title_service(title: Column, pattern: str = TITLE_PATTERN) -> Column:
    return _group(title, pattern, 1)


def title_year(title: Column, pattern: str = TITLE_PATTERN) -> Column:
    return _group(title, pattern, 2).try_cast("int")


def file_stem(name: Column) -> Column:
    """File name without its last extension."""
    return F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")


def file_service(name: Column) -> Column:
    """Service code: the stem without digits, upper case."""
    return F.upper(F.regexp_replace(file_stem(name), r"\d+", ""))


def file_year(name: Column) -> Column:
    """First run of four digits in the stem, null if there is none."""
    return _group(file_stem(name), r"\d{4}", 0).try_cast("int")


def strip(col: Column) -> Column:
    """Text without blanks at both ends, Unicode blanks included."""
    return F.regexp_replace(col, UNICODE + r"^\s+|\s+$", "")


def parse_number(text: Column) -> Column:
    """Double from text with a decimal comma or dot; null if it is no number."""
    return F.when(text.rlike(NUMBER), F.translate(text, ",", ".").try_cast("double"))


def _month_number(abbreviation: Column) -> Column:
    months = F.create_map(*[F.lit(v) for i, m in enumerate(MONTHS, 1) for v in (m, i)])
    return F.try_element_at(months, abbreviation)


def parse_period(text: Column, year_of_file: Column) -> Column:
    """struct<ano, mes> from a period header, null if the header is no period.

    Tried in turn: year and month number anywhere; month abbreviation, slash,
    year (an unknown abbreviation counts as January); a bare abbreviation, which
    takes the year of the file.
    """
    txt = F.upper(strip(text))
    numeric = F.struct(
        _group(txt, YEAR_MONTH, 1).try_cast("int").alias("ano"),
        _group(txt, YEAR_MONTH, 2).try_cast("int").alias("mes"),
    )
    named = F.struct(
        _group(txt, MONTH_YEAR, 2).try_cast("int").alias("ano"),
        F.coalesce(_month_number(_group(txt, MONTH_YEAR, 1)), F.lit(1)).alias("mes"),
    )
    bare = F.struct(year_of_file.cast("int").alias("ano"), _month_number(txt).alias("mes"))
    return (
        F.when(txt.rlike(YEAR_MONTH), numeric)
        .when(txt.rlike(MONTH_YEAR), named)
        .when(year_of_file.isNotNull() & txt.isin(*MONTHS), bare)
    )


def month_key(year: Column, month: Column) -> Column:
    """'YYYY-MM' text."""
    return F.format_string("%d-%02d", year, month)
