"""Dimensions, fact, pivot, the whole load and its plans."""

import re
import uuid

import pytest
from pyspark.sql import functions as F

from monthmart.operators import dimensions, fact, pivot
from monthmart.plans import fixture, queries
from monthmart.plans.mart import build_mart
from monthmart.sources import scratch_path

STAGING = (
    "ano int, mes int, ano_mes string, servico string, grupo_economico string, variavel string, "
    "valor double, arquivo_origem string"
)


def staging(spark, *rows):
    """(month, service, group, metric, value) each"""
    return spark.createDataFrame(
        [(2015, int(m[5:]), m, s, g, v, x, "f.ods") for m, s, g, v, x in rows], STAGING)


def measures(spark, *rows, missing=0):
    summary = fact.summarise_staging(staging(spark, *rows))
    found = fact.derive_measures(fact.consolidate(summary), missing).collect()
    return {(r.ano_mes, r.codigo_servico, r.nome_grupo): tuple(r)[3:] for r in found}


def numbers(values):
    return tuple(None if v is None else float(v) for v in values)


KEY = ("2015-01", "SMP", "OI")


@pytest.mark.parametrize("metrics, expected", [
    ({"Índice de Desempenho no Atendimento": 90.0, "Taxa de Resolvidas em 5 dias úteis": 80.0}, (90, 0, 0, 0)),
    ({"INDICADOR DE DESEMPENHO x": 70.126}, (70.13, 0, 0, 0)),
    ({"taxa de resolvidas em 5 dias": 80.0}, (80, 0, 0, 0)),
    ({"Taxa de Resolvidas no Período": 50.0, "Total de Solicitações": 5.0}, (0, 50, 5, 3)),
    ({"taxa de resolvidas no PERÍODO": 50.0, "Quantidade de reclamações": 5.4}, (0, 50, 5, 3)),
    ({"Taxa de Resolvidas no Período (x)": 50.0, "Total de Solicitações": 5.0}, (0, 0, 5, 0)),
    ({"total de solicitações": 5.0}, (0, 0, 0, 0)),
    ({"Quantidade de Respondidas": 2.5, "Total de Solicitações": 9.0, "Taxa de Resolvidas no Período": 100.0}, (0, 100, 9, 3)),
    ({"Outra coisa": 7.0}, (0, 0, 0, 0)),
])
def test_measures(spark, metrics, expected):
    found = measures(spark, *[("2015-01", "smp", "oi", v, x) for v, x in metrics.items()])
    assert {k: numbers(v) for k, v in found.items()} == {KEY: numbers(expected)}


def test_missing_measures_can_stay_null(spark):
    assert measures(spark, ("2015-01", "smp", "oi", "Outra", 1.0), missing=None) == {KEY: (None, None, None, None)}


def test_spellings_of_a_group_meet_at_the_maximum(spark):
    found = measures(
        spark, ("2015-01", "SMP", "Oi (a)", "Total de Solicitações", 3.0),
        ("2015-01", "smp", "OI **", "Total de Solicitações", 8.0),
        ("2015-01", "SMP", None, "Total de Solicitações", 9.0))
    assert numbers(found[KEY])[2] == 8 and len(found) == 1


def test_rate_that_does_not_fit_fails_the_load(spark):
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        measures(spark, ("2015-01", "SMP", "OI", "Taxa de Resolvidas no Período", 1000.0))


def test_star_join_drops_unmatched(spark):
    rows = staging(spark, ("2015-01", "SMP", "OI", "x", 1.0), ("2015-02", "SMP", "OI", "x", 1.0))
    summary = fact.summarise_staging(rows)
    months = dimensions.build_dim_tempo(summary).filter("mes = 1")
    found = fact.build_fact(summary, months, dimensions.build_dim_grupo(summary),
                            dimensions.build_dim_servico(summary), with_surrogates=True)
    assert [(r.id_tempo, r.id_grupo, r.id_servico) for r in found.collect()] == [(1, 1, 1)]


def test_months_out_of_range(spark):
    rows = spark.createDataFrame([(2015, 13, "2015-13"), (2015, 0, "2015-00"), (2014, 6, "2014-06")],
                                 "ano int, mes int, ano_mes string")
    found = [tuple(r) for r in dimensions.build_dim_tempo(rows).orderBy("id_tempo").collect()]
    assert found == [(1, 2014, 6, "2014-06", 2, 1), (2, 2015, 0, "2015-00", 4, 2), (3, 2015, 13, "2015-13", 4, 2)]


def test_unknown_service(spark):
    rows = spark.createDataFrame([("tvx",)], "servico string")
    assert tuple(dimensions.build_dim_servico(rows).first()) == (1, "TVX", "TVX", "Outros")


def test_dense_keys_over_many_names(spark):
    names = spark.range(5000).select(F.concat(F.lit("g"), F.col("id").cast("string")).alias("n"))
    keyed = dimensions.number_rows(names.repartition(7), "n", "k", start=10)
    ids = {r.n: r.k for r in keyed.collect()}
    assert sorted(ids.values()) == list(range(11, 5011))
    again = {r.n: r.k for r in dimensions.number_rows(names.repartition(3, "n"), "n", "k", start=10).collect()}
    assert ids == again


def test_insert_absent_keeps_the_old_rows(spark):
    old = spark.createDataFrame([(1, "A", True), (2, "B", False)], "id int, n string, ativo boolean")
    new = spark.createDataFrame([("B", True), ("C", True)], "n string, ativo boolean")
    found = dimensions.assign_keys(dimensions.insert_absent(old, new, ["n"]), "id", "n")
    assert sorted(tuple(r) for r in found.collect()) == [(1, "A", True), (2, "B", False), (3, "C", True)]


def test_upsert_replaces_values_and_keeps_the_key(spark):
    old = spark.createDataFrame([(5, "A", "x"), (6, "B", "y")], "id int, c string, v string")
    new = spark.createDataFrame([("B", "z"), ("C", "w")], "c string, v string")
    found = dimensions.assign_keys(dimensions.upsert(old, new, ["c"], "id"), "id", "c")
    assert sorted(tuple(r) for r in found.select("id", "c", "v").collect()) == [(5, "A", "x"), (6, "B", "z"), (7, "C", "w")]


def test_load_time(spark):
    assert dimensions.with_load_time(spark.range(1)).first()["data_carga"] is not None


def test_pivot_values_are_bounded(spark):
    df = spark.createDataFrame([(" b",), ("A",), (None,), ("a",)], "n string")
    assert pivot.pivot_values(df, "n") == ["A", "B"]
    spark.conf.set(pivot.MAX_VALUES_CONF, "1")
    try:
        with pytest.raises(ValueError):
            pivot.pivot_values(df, "n")
    finally:
        spark.conf.unset(pivot.MAX_VALUES_CONF)


DELTA = "ano_mes string, nome_grupo string, var_mercado double, var_individual double, diferenca double"


def test_pivot_fills_and_keeps_empty_groups(spark):
    delta = spark.createDataFrame(
        [("2015-02", "A", 81.15, 1.0, 80.15), ("2015-02", "B.C", 81.15, None, None), ("2015-03", "A", -1.0, 1.0, -2.0)], DELTA)
    groups = ["A", "B.C", "NONE"]
    filled = [numbers(r[1:]) for r in pivot.ordered(pivot.pivot_report(delta, groups)).collect()]
    assert filled == [(81.2, 80.2, 0, 0), (-1, -2, 0, 0)]
    empty = [numbers(r[1:]) for r in pivot.ordered(pivot.pivot_report(delta, groups, fill=None)).collect()]
    assert empty == [(81.2, 80.2, None, None), (-1, -2, None, None)]
    long = pivot.to_long(pivot.pivot_report(delta, groups, fill=None), groups)
    assert long.count() == 6 and long.filter("Delta is null").count() == 4


@pytest.fixture(scope="module")
def path(spark):
    return scratch_path(spark, "test-mart")


def test_no_rows_no_transformation(spark):
    empty = staging(spark, ("2015-01", "SMP", "OI", "x", -1.0))
    assert build_mart(empty, scratch_path(spark, "test-mart")) is None


def test_reload_replaces_rows_and_keeps_dimensions(spark, path):
    first = build_mart(staging(spark, ("2015-01", "SMP", "OI", "x", 1.0), ("2014-01", "SMP", "TIM", "x", 1.0)), path)
    assert (first.fato.count(), first.dim_grupo.count()) == (2, 2)
    second = build_mart(staging(spark, ("2015-03", "SCM", "OI", "x", 1.0), ("2015-03", "SCM", "OI", "y", float("nan"))), path)
    assert [tuple(r) for r in second.fato.select("id_tempo", "nome_grupo", "codigo_servico").collect()] == [(3, "OI", "SCM")]
    assert second.staging.count() == 1 and second.dim_tempo.count() == 3 and second.dim_grupo.count() == 2


def test_checks_pass_on_the_built_mart(spark, sf_dir):
    found = queries.mart(spark, sf_dir).checks()
    assert found.count() == 17 and found.filter("should_error").count() == 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_cleaning_stays_off_the_staging_scan(spark, sf_dir):
    m = queries.mart(spark, sf_dir)
    text = plan(fact.build_fact(fact.summarise_staging(m.staging), m.dim_tempo, m.dim_grupo, m.dim_servico))
    scan = next(line for line in text.splitlines() if "FileScan" in line and "variavel" in line)
    above = text.splitlines()[text.splitlines().index(scan) - 1]
    assert "regexp" not in scan.lower() and "Filter" in above and "regexp" not in above.lower()
    assert "PushedFilters: [IsNotNull(" in scan


def test_star_join_broadcasts_small_dimensions_without_hints(spark, sf_dir):
    m = queries.mart(spark, sf_dir)
    assert plan(m.trend(surrogate=True)).count("BroadcastHashJoin") == 3


@pytest.mark.parametrize("name", ["fact_build", "variation_month", "variation_row_lag", "long_delta", "pivot_view",
                                  "ranking", "kpi_counts", "checks", "grid_to_long"])
def test_plans_hold_no_cross_join_and_no_python(spark, sf_dir, name):
    text = plan(queries.mart(spark, sf_dir).checks() if name == "checks" else queries.QUERIES[name](spark, sf_dir))
    assert not re.search("CartesianProduct|NestedLoopJoin|Python|InArrow|InPandas", text)


def test_staging_is_computed_once_for_the_load(spark, sf_dir):
    base = fixture.staging(spark, sf_dir)
    calls = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            calls.add(batch.num_rows)
            yield batch

    build_mart(base.mapInArrow(count, base.schema), scratch_path(spark, f"once-{uuid.uuid4().hex}"))
    assert calls.value == base.count()
