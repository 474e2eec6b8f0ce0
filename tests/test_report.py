import pytest
from pyspark.sql import functions as F

from monthmart.operators import pivot, report

LONG = "Mes string, Operadora string, Delta double"
TREND = "ano_mes string, nome_grupo string, nome_servico string, ida double"


@pytest.fixture(scope="module")
def long(spark):
    return spark.createDataFrame([
        ("2014-12", "A", 9.0), ("2015-01", "A", 1.0), ("2015-02", "A", 2.0), ("2015-03", "A", None),
        ("2014-12", "B", 0.0), ("2015-01", "B", 3.0), ("2015-02", "B", 0.0), ("2015-03", "B", 0.0),
    ], LONG)


def test_sign_and_outliers(spark):
    df = spark.createDataFrame([("m", "g", v) for v in (200.0, -200.0, 200.1, -200.1, 0.0, None)], LONG)
    found = [r.Delta for r in report.signed_masked(df).collect()]
    assert found == [-200.0, 200.0, None, None, 0.0, None]
    assert str(found[4]) == "0.0"


def test_merge_names_ignores_missing(spark):
    df = spark.createDataFrame([("m", "Sercomtel x", 1.0), ("m", "SERCOMTEL (a)", 3.0), ("m", "sercomtel*", None),
                                ("m", "B", None)], LONG)
    assert {r.Operadora: r.Delta for r in report.merge_names(df).collect()} == {"SERCOMTEL": 2.0, "B": None}


def test_empty_selection_selects_everything(long):
    assert report.filter_long(long).count() == 8
    assert report.filter_long(long, ["2015"], ["2015-01", "2014-12"], ["A"]).count() == 1


def test_ranking_skips_missing(long):
    found = [tuple(r) for r in report.ranking(report.filter_long(long, ["2015"])).collect()]
    assert found == [("B", 1.0), ("A", 1.5)]


def test_best_and_worst_with_ties(spark):
    df = spark.createDataFrame([("m", g, 1.0) for g in "CAB"] + [("m", "N", None)], LONG)
    found = report.best_worst(df).first()
    assert (found.melhor, found.pior, float(found.melhor_media)) == ("A", "C", 1.0)


def test_default_selection(long):
    found = sorted(tuple(r) for r in report.default_selection(long, n_months=2, n_groups=1).collect())
    assert found == [("ano", "2015"), ("grupo", "A"), ("mes", "2015-02"), ("mes", "2015-03")]


@pytest.fixture(scope="module")
def trend(spark):
    return spark.createDataFrame([
        ("2015-01", "A", "S", 10.0), ("2015-01", "B", "T", 30.0), ("2015-02", "A", "S", 30.0),
        ("2015-03", "A", "S", 60.0), ("2014-01", "A", "U", 1.0)], TREND)


def values(df):
    return tuple(float(v) if v is not None and not isinstance(v, str) else v for v in df.first())


def test_market_kpi(trend):
    assert values(report.market_kpi(trend, ["2015"])) == ("2015-03", 100.0, 50.0)
    assert values(report.market_kpi(trend, ["2015"], ["2015-02", "2015-03"])) == ("2015-03", 100.0, None)
    assert values(report.market_kpi(trend, ["2015"], ["2015-02"])) == ("2015-02", None, None)


def test_market_kpi_after_a_zero_month(spark):
    rows = spark.createDataFrame([("2015-01", "A", "S", 0.0), ("2015-02", "A", "S", 5.0)], TREND)
    assert values(report.market_kpi(rows)) == ("2015-02", None, None)


def test_kpi_counts(long, trend):
    found = dict(tuple(r) for r in report.kpi_counts(long, trend, ["2015"], ["2015-01"], ["A"]).collect())
    assert found == {"grupos": 1, "meses": 1, "servicos": 2}


def test_service_series(trend):
    found = [r.ano_mes for r in report.service_series(trend, "S", ["A"], ["2015"]).collect()]
    assert found == ["2015-01", "2015-02", "2015-03"]


def test_distribution(long):
    found = {r.Operadora: tuple(r)[1:] for r in report.distribution(long).collect()}
    assert found["A"] == (1.0, 1.5, 2.0, 5.5, 9.0, 3)


def test_heat_matrix_and_extract(long):
    heat = {r.Operadora: tuple(r)[1:] for r in pivot.heat_matrix(long, ["2015-01", "2015-03"]).collect()}
    assert heat == {"A": (1.0, None), "B": (3.0, 0.0)}
    rows = report.tabular_extract(long, ["B"]).collect()
    assert [r.Mes for r in rows] == ["2014-12", "2015-01", "2015-02", "2015-03"]
    assert [float(r.B) for r in rows] == [0.0, 3.0, 0.0, 0.0]


def test_latest_row_and_market_column(spark):
    df = spark.createDataFrame([("2015-01", 1.0), ("2015-03", 4.26), ("2015-02", 2.0)],
                               f"Mes string, `{report.MARKET_COLUMN}` double")
    assert report.latest_row(df).first().Mes == "2015-03"
    assert values(report.market_column_kpi(df)) == ("2015-03", 4.3, 2.26)


def test_distinct_sorted(trend):
    found = report.distinct_sorted(trend, report.year_of(F.col("ano_mes")), "ano")
    assert [r.ano for r in found.collect()] == ["2014", "2015"]
