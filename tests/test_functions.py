import math
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from monthmart.functions import (
    alias_name, clean_name, clean_report_name, file_service, file_year, group_name, month_key, nonnegative,
    parse_number, parse_period, pct_change, rounded, title_service, title_year,
)


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def apply(spark, expression, values, kind="string"):
    df = column(spark, values, kind).select("i", expression(F.col("v")).alias("r"))
    return [r["r"] for r in sorted(df.collect())]


def test_title(spark):
    titles = ["IDA - SCM - 2015", "SMP2014", "xSTFC -2013 b", "SCM- 20", "scm - 2015", None]
    assert apply(spark, title_service, titles) == ["SCM", None, "STFC", None, None, None]
    assert apply(spark, title_year, titles) == [2015, None, 2013, None, None, None]


def test_file_metadata(spark):
    names = ["SCM2015.ods", "smp.ods", "Stfc 2013 v2.ods", "a.b2014.ods"]
    assert apply(spark, file_service, names) == ["SCM", "SMP", "STFC  V", "A.B"]
    assert apply(spark, file_year, names) == [2015, None, 2013, 2014]


@pytest.mark.parametrize("text, number", [
    ("1,5", 1.5), ("12", 12.0), (" 3.25 ", 3.25), ("-5,5", -5.5), ("+7", 7.0), (",5", 0.5), ("1e3", 1000.0),
    ("1,2e-1", 0.12), ("5.", 5.0),
    ("1.234,5", None), ("1,234,5", None), ("n/d", None), ("", None), (None, None), ("nan", None), ("NaN", None),
    ("Infinity", None), ("1.5d", None), ("1 5", None), ("-", None), (".", None), (",", None),
])
def test_number(spark, text, number):
    assert apply(spark, parse_number, [text]) == [number]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(min_value=-1e9, max_value=1e9), min_size=1, max_size=200))
def test_number_round_trip(spark, values):
    texts = [repr(v).replace(".", ",") for v in values]
    assert apply(spark, parse_number, texts) == values


@pytest.mark.parametrize("text, year, expected", [
    ("2015-01", None, (2015, 1)), ("2015.7", None, (2015, 7)), ("2015-01-01T00:00", 2014, (2015, 1)),
    ("total 2015-13", None, (2015, 13)), (" jan/2015 ", None, (2015, 1)), ("DEZ/2014", 2015, (2014, 12)),
    ("XYZ/2015", None, (2015, 1)), ("março/2015", None, None), ("set", 2015, (2015, 9)), ("SET", None, None),
    ("OUTROS", 2015, None), ("2015", 2015, None), ("", 2015, None), (None, 2015, None),
    (" FEV ", 2015, (2015, 2)),
])
def test_period(spark, text, year, expected):
    df = spark.createDataFrame([(text, year)], "v string, y int").select(parse_period(F.col("v"), F.col("y")).alias("p"))
    found = df.first()["p"]
    assert (tuple(found) if found else None) == expected


def test_names(spark):
    names = ["Oi (Nova) **", "  Claro   S.A. ", "Telefônica (a) (b)", "x y", "ctbc", None, "Embratel *"]
    assert apply(spark, clean_name, names) == ["OI", "CLARO S.A.", "TELEFÔNICA", "X Y", "CTBC", None, "EMBRATEL"]
    assert apply(spark, lambda c: clean_name(c, unicode_space=True), ["x y"]) == ["X Y"]
    assert apply(spark, group_name, names) == ["OI", "CLARO", "VIVO", "X Y", "ALGAR", None, "EMBRATEL"]
    assert apply(spark, clean_report_name, ["sercomtel s (x)*", " a  b ", None]) == ["SERCOMTEL", "A B", ""]


def test_first_alias_wins_and_prefixes_are_plain_text(spark):
    aliases = [("A.", "DOT"), ("A", "FIRST"), ("AB", "LATER")]
    names = ["A.X", "AB", "XA", "A"]
    assert apply(spark, lambda c: alias_name(c, aliases), names) == ["DOT", "FIRST", "XA", "FIRST"]
    assert apply(spark, lambda c: alias_name(c, []), names) == names


def test_same_prefix_twice_takes_the_first(spark):
    assert apply(spark, lambda c: alias_name(c, [("A", "1"), ("A", "2")]), ["AX"]) == ["1"]


def test_rounding(spark):
    values = [81.15, 2.5, -2.5, 0.125, None, 1e-9]
    assert apply(spark, lambda c: rounded(c, 1), values, "double") == [
        Decimal("81.2"), Decimal("2.5"), Decimal("-2.5"), Decimal("0.1"), None, Decimal("0.0")]
    assert apply(spark, lambda c: rounded(c, 2), [0.125, -0.125], "double") == [Decimal("0.13"), Decimal("-0.13")]


def test_pct_change(spark):
    for before, expected in [(50.0, 100.0), (0.0, None), (-1.0, None), (None, None)]:
        assert apply(spark, lambda c: pct_change(F.lit(100.0), c), [before], "double") == [expected]


def test_nonnegative(spark):
    values = [0.0, 1.0, -0.5, math.nan, None]
    assert apply(spark, nonnegative, values, "double") == [True, True, False, False, None]


def test_month_key(spark):
    assert apply(spark, lambda c: month_key(c, F.lit(3)), [2015], "int") == ["2015-03"]
