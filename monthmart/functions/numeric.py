"""Rounding and percent change as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded(col: Column, digits: int) -> Column:
    """Round half away from zero, through decimal so that ties do not depend on the last bit."""
    exact = F.round(col.cast("double"), 6).cast("decimal(18,6)")
    return F.round(exact, digits).cast(f"decimal(18,{digits})")


def pct_change(now: Column, before: Column) -> Column:
    """Percent change, null unless the earlier value is above zero."""
    return F.when(before > 0, (now - before) / before * 100)


def nonnegative(col: Column) -> Column:
    """True for values >= 0; NaN, which Spark orders above every number, is out."""
    return (col >= 0) & ~F.isnan(col)
