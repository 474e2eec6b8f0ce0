"""Name standardisation as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import GROUP_ALIASES, NAME_NOISE, NAME_NOTE, NAME_STARS, REPORT_ALIASES

# Java's \s is ASCII only; sheet text may hold no-break spaces.
UNICODE = "(?U)"


def quoted(name: str) -> Column:
    """Column of exactly this name, also when it holds dots or backticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def clean_name(col: Column, unicode_space: bool = False) -> Column:
    """Upper case, without bracketed notes and asterisks, single spaces."""
    flag = UNICODE if unicode_space else ""
    bare = F.trim(F.regexp_replace(F.upper(col), flag + NAME_NOISE, ""))
    return F.regexp_replace(bare, flag + r"\s+", " ")


def alias_name(col: Column, aliases: Sequence[tuple[str, str]] = GROUP_ALIASES) -> Column:
    """Label of the first alias whose prefix starts the name, else the name itself.

    One alternation finds the prefix, so the name is evaluated twice at most.
    """
    if not aliases:
        return col
    prefixes = "|".join(rf"\Q{prefix}\E" for prefix, _ in aliases)
    labels = F.create_map(*[F.lit(v) for pair in dict(reversed(aliases)).items() for v in pair])
    return F.coalesce(F.try_element_at(labels, F.regexp_extract(col, f"^({prefixes})", 1)), col)


def group_name(col: Column) -> Column:
    """Cleaned and aliased group name, as the mart stores it."""
    return alias_name(clean_name(col))


def clean_report_name(
    col: Column, aliases: Sequence[tuple[str, str]] = REPORT_ALIASES
) -> Column:
    """Name as the reports show it; a missing name becomes empty text."""
    text = F.regexp_replace(F.coalesce(col, F.lit("")), UNICODE + NAME_NOTE, "")
    text = F.regexp_replace(text, NAME_STARS, "")
    text = F.upper(F.trim(F.regexp_replace(text, UNICODE + r"\s+", " ")))
    return alias_name(text, aliases)
