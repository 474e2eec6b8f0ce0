import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from monthmart.functions import pct_change
from monthmart.operators import variation

FACT = "id_tempo int, nome_grupo string, codigo_servico string, taxa_solicitacoes_resolvidas_5dias double"
TIME = "id_tempo int, ano int, mes int, ano_mes string"


@pytest.fixture(scope="module")
def mart(spark):
    rng = random.Random(7)
    # Keys are not chronological on purpose.
    keys = list(range(1, 9))
    rng.shuffle(keys)
    months = [(k, 2015, m, f"2015-{m:02d}") for m, k in enumerate(keys, 1)]
    rows = [
        (k, g, s, rng.choice([0.0, 10.0, 20.0, 35.5]))
        for k, *_ in months for g in "ABC" for s in ("SCM", "SMP") if rng.random() < 0.8
    ]
    return spark.createDataFrame(rows, FACT).repartition(3), spark.createDataFrame(months, TIME)


def approx(rows):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows)


def none_last(rows):
    return sorted(approx_row(r) for r in rows)


def approx_row(r):
    return tuple("~" if v is None else (f"{v:.9f}" if isinstance(v, float) else v) for v in r)


@pytest.mark.parametrize("market", ["groups", "flat"])
def test_row_mode_is_a_lag_over_all_rows(mart, market):
    fact, months = mart
    rows = variation.rated_rows(fact, months)
    means = variation.group_means(rows)
    benchmark = variation.market_means(means if market == "groups" else rows)
    own = variation.individual_variation(means)
    one_window = (
        own.join(benchmark.select("ano_mes", "valor_mercado"), "ano_mes")
        .withColumn("before", F.lag("valor_mercado").over(Window.orderBy("ano", "mes", "nome_grupo")))
        .withColumn("var_mercado", pct_change(F.col("valor_mercado"), F.col("before")))
        .filter("var_mercado is not null")
        .select("ano_mes", "nome_grupo", "var_mercado", "var_individual",
                (F.col("var_mercado") - F.col("var_individual")).alias("diferenca"))
    )
    found = variation.variation(fact, months, mode="row", market=market)
    assert none_last(found.collect()) == none_last(one_window.collect())


def test_falling_market_disappears_in_row_mode(spark):
    months = spark.createDataFrame([(1, 2015, 1, "2015-01"), (2, 2015, 2, "2015-02")], TIME)
    fact = spark.createDataFrame(
        [(1, "A", "SMP", 10.0), (1, "B", "SMP", 10.0), (2, "A", "SMP", 5.0), (2, "B", "SMP", 5.0)], FACT)
    by_month = {r.nome_grupo: r.var_mercado for r in variation.variation(fact, months).collect()}
    by_row = [(r.ano_mes, r.nome_grupo, r.var_mercado) for r in variation.variation(fact, months, "row").collect()]
    assert by_month == {"A": -50.0, "B": -50.0}
    assert sorted(by_row) == [("2015-01", "B", 0.0), ("2015-02", "A", -50.0), ("2015-02", "B", 0.0)]


def test_first_month_has_no_market_change(mart):
    fact, months = mart
    assert variation.variation(fact, months).filter("ano_mes = '2015-01'").count() == 0


def test_previous_is_the_previous_observed_month(spark):
    months = spark.createDataFrame([(9, 2015, 1, "2015-01"), (1, 2015, 2, "2015-02"), (5, 2015, 3, "2015-03")], TIME)
    fact = spark.createDataFrame(
        [(9, "A", "SMP", 10.0), (5, "A", "SMP", 15.0), (9, "B", "SMP", 10.0), (1, "B", "SMP", 20.0), (5, "B", "SMP", 0.0)], FACT)
    found = {(r.nome_grupo, r.ano_mes): r.var_individual for r in variation.variation(fact, months).collect()}
    assert found == {("A", "2015-03"): 50.0, ("B", "2015-02"): 100.0, ("B", "2015-03"): -100.0}


def test_zero_before_gives_no_change(spark):
    months = spark.createDataFrame([(1, 2015, 1, "2015-01"), (2, 2015, 2, "2015-02")], TIME)
    fact = spark.createDataFrame(
        [(1, "A", "SMP", 0.0), (2, "A", "SMP", 5.0), (1, "B", "SMP", 5.0), (2, "B", "SMP", 5.0)], FACT)
    found = {r.nome_grupo: r.var_individual for r in variation.variation(fact, months).collect()}
    assert found == {"A": None, "B": 0.0}


def test_services_mix_only_on_request(spark):
    months = spark.createDataFrame([(1, 2015, 1, "2015-01"), (2, 2015, 2, "2015-02")], TIME)
    fact = spark.createDataFrame(
        [(1, "A", "SCM", 10.0), (1, "A", "SMP", 20.0), (2, "A", "SCM", 30.0), (2, "A", "SMP", 40.0)], FACT)
    apart = {r.codigo_servico: float(r.var_individual) for r in variation.long_delta(fact, months).collect()}
    mixed = {r.codigo_servico: float(r.var_individual)
             for r in variation.long_delta(fact, months, by_service=False).collect()}
    assert apart == {"SCM": 200.0, "SMP": 100.0}
    assert mixed == {"SCM": 50.0, "SMP": 33.33}


def test_unknown_mode(mart):
    with pytest.raises(ValueError):
        variation.variation(*mart, mode="week")
    with pytest.raises(ValueError):
        variation.long_delta(*mart, mode="week")
