"""Versions that share folders: what a load writes, who may commit, who may read, statistics that merge."""

import os
import random

import pytest
from pyspark.sql import functions as F

from monthmart.operators import quality, statistics
from monthmart.operators.quality import AcceptedValues, MaxLength, NotNull, Relationship, Unique
from monthmart.plans import mart as marts
from monthmart.plans import versions
from monthmart.plans.mart import build_mart, delete_old_versions, open_mart

STAGING = "ano int, mes int, ano_mes string, servico string, grupo_economico string, variavel string, valor double, arquivo_origem string"
RATE = "Taxa de Resolvidas em 5 dias úteis"


def staging(spark, *rows):
    """(month, group, value) each"""
    return spark.createDataFrame([(int(m[:4]), int(m[5:]), m, "SMP", g, RATE, v, "f.ods") for m, g, v in rows], STAGING)


def loads(mart, table="fato_ida"):
    return {f.ano: f.carga for f in mart.version.of(table)}


def rates(mart):
    return {(r.ano_mes, r.nome_grupo): float(r.v) for r in mart.fato.join(mart.dim_tempo, "id_tempo").selectExpr(
        "ano_mes", "nome_grupo", "taxa_solicitacoes_resolvidas_5dias AS v").collect()}


def test_a_load_writes_the_years_that_changed(spark, tmp_path):
    path = str(tmp_path / "mart")
    first = build_mart(staging(spark, ("2014-01", "aa", 1.0), ("2015-01", "aa", 2.0), ("2016-01", "bb", 3.0)), path)
    reader = open_mart(spark, path)
    second = build_mart(staging(spark, ("2014-01", "aa", 1.0), ("2015-01", "aa", 9.0), ("2017-01", "cc", 4.0)), path)
    one, two = set(loads(first).values()).pop(), second.version.of("dim_tempo")[0].carga
    for table in marts.BY_YEAR:
        assert loads(second, table) == {2014: one, 2015: two, 2017: two}
        assert not os.path.exists(f"{path}/tabelas/{table}/ano=2014/carga={two}")
    assert rates(second) == {("2014-01", "AA"): 1.0, ("2015-01", "AA"): 9.0, ("2017-01", "CC"): 4.0}
    assert rates(reader) == rates(first) == {("2014-01", "AA"): 1.0, ("2015-01", "AA"): 2.0, ("2016-01", "BB"): 3.0}
    # Rows in another order, or the same load again, make no version; a year less makes one without writing any.
    again = staging(spark, ("2017-01", "cc", 4.0), ("2015-01", "aa", 9.0), ("2014-01", "aa", 1.0)).repartition(3)
    assert build_mart(again, path).version == second.version
    fewer = build_mart(again.filter("ano != 2015"), path)
    assert set(loads(fewer)) == {2014, 2017} and set(loads(fewer).values()) == {one, two} and fewer.version.number == 2
    # A repeated row is another set of rows.
    assert build_mart(again.unionByName(again.filter("ano = 2014")), path).staging.count() == 4
    expected = rates(second)
    # Shared folders stay for as long as a kept version names them.
    assert len(delete_old_versions(spark, path, keep=1)) == 3
    assert rates(open_mart(spark, path)) == expected and os.path.exists(f"{path}/tabelas/fato_ida/ano=2017/carga={two}")
    assert not os.path.exists(f"{path}/tabelas/fato_ida/ano=2016/carga={one}")
    with pytest.raises(Exception):
        rates(reader)


def test_of_two_loads_from_one_version_the_second_is_refused(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "mart")
    build_mart(staging(spark, ("2014-01", "aa", 1.0)), path)
    commit = versions.commit

    def late(*args):
        monkeypatch.setattr(versions, "commit", commit)
        build_mart(staging(spark, ("2014-01", "aa", 5.0)), path)
        return commit(*args)

    monkeypatch.setattr(versions, "commit", late)
    with pytest.raises(versions.ConcurrentLoadError, match="version 1"):
        build_mart(staging(spark, ("2014-01", "aa", 7.0)), path)
    assert rates(open_mart(spark, path)) == {("2014-01", "AA"): 5.0}
    # Nothing of the refused load is left.
    assert len(os.listdir(f"{path}/manifesto")) == 2 and sum(len(os.listdir(f"{path}/tabelas/dim_tempo/{c}")) > 0 for c in os.listdir(f"{path}/tabelas/dim_tempo")) == 2


def test_a_lease_keeps_the_files_of_its_version(spark, tmp_path):
    path = str(tmp_path / "mart")
    old = build_mart(staging(spark, ("2014-01", "aa", 1.0)), path)
    build_mart(staging(spark, ("2014-01", "aa", 2.0)), path)
    with old.lease():
        build_mart(staging(spark, ("2014-01", "aa", 3.0)), path)
        assert len(delete_old_versions(spark, path, keep=1)) == 1
        assert rates(old) == {("2014-01", "AA"): 1.0}
    with old.lease(seconds=-1):
        assert delete_old_versions(spark, path, keep=1) == [old.version.name]
    assert delete_old_versions(spark, path, keep=1) == []


def test_names_follow_the_current_version(spark, tmp_path):
    path = str(tmp_path / "mart")
    spark.range(1).write.mode("overwrite").option("path", str(tmp_path / "old")).saveAsTable("segue_dim_tempo")
    names = build_mart(staging(spark, ("2014-01", "aa", 1.0), ("2015-01", "aa", 1.0)), path).publish("segue_")
    try:
        other = spark.newSession()
        assert other.table("segue_fato_ida").count() == 2
        build_mart(staging(spark, ("2014-01", "aa", 2.0), ("2015-01", "aa", 1.0), ("2016-01", "bb", 1.0)), path)
        assert other.table("segue_fato_ida").count() == 3 and other.table("segue_staging_ida").count() == 3
        assert sorted(r.nome_grupo for r in other.table("segue_dim_grupo_economico").collect()) == ["AA", "BB"]
        joined = other.sql("SELECT sum(f.taxa_solicitacoes_resolvidas_5dias) AS s FROM segue_fato_ida f JOIN segue_dim_tempo USING (id_tempo)")
        assert float(joined.first()["s"]) == 4.0
        delete_old_versions(spark, path, keep=1)
        assert other.table("segue_fato_ida").filter("ano = 2015").count() == 1
        plan = other.table("segue_fato_ida")._jdf.queryExecution().executedPlan().toString()
        assert "dynamicpruning" in plan
    finally:
        for name in names:
            spark.sql(f"DROP VIEW IF EXISTS {name}")


def test_a_mart_without_facts_can_be_read(spark, tmp_path):
    mart = build_mart(staging(spark, ("2014-01", None, 1.0)).withColumn("grupo_economico", F.lit("").cast("string")).withColumn("servico", F.lit("XYZ")), str(tmp_path / "m"))
    assert mart.staging.count() == 1 and "id_grupo" in mart.fato.columns


CHECKS = [NotNull("c", "k"), NotNull("c", "n"), Unique("c", ("k",)), Unique("c", ("k", "n")), AcceptedValues("c", "k", ("a", "b")),
          Relationship("c", "k", "p", "k"), MaxLength("c", "k", 1), MaxLength("c", "k", 2), Unique("p", ("k",)), NotNull("p", "k")]


def as_set(df):
    return sorted(tuple(r) for r in df.collect())


def test_checks_from_statistics_are_those_of_a_scan(spark):
    rng = random.Random(1)
    for size in (0, 1, 60):
        child = spark.createDataFrame(
            [(rng.choice(["a", "b", "cc", "ddd", "", ",", None]), rng.choice([1, 2, None]), rng.randrange(3)) for _ in range(size)], "k string, n int, ano int")
        parent = spark.createDataFrame([("a", 0), ("cc", 1), ("cc", 2), (None, 2)], "k string, ano int")
        taken = statistics.part_statistics(child, "c", CHECKS, F.col("ano"), F.lit("x")).unionByName(
            statistics.part_statistics(parent, "p", CHECKS, F.lit(None), F.lit("x")))
        expected = as_set(quality.run_checks({"c": child, "p": parent}, CHECKS))
        assert as_set(statistics.checks_from_statistics(taken, CHECKS)) == expected
        # Merged in another order, and merged again.
        again = statistics.merged(statistics.merged(taken.repartition(5)))
        assert as_set(statistics.checks_from_statistics(again, CHECKS)) == expected


def test_a_load_counts_only_what_it_writes(spark, tmp_path):
    path = str(tmp_path / "mart")
    build_mart(staging(spark, *[(f"2014-{m:02}", "aa", 1.0) for m in range(1, 13)], ("2015-01", "aa", 2.0)), path)
    second = build_mart(staging(spark, *[(f"2014-{m:02}", "aa", 1.0) for m in range(1, 13)], ("2015-01", "aa", 3.0)), path)
    load = second.version.of("dim_tempo")[0].carga
    counted = spark.read.parquet(f"{path}/estatisticas/{load}").filter("medida = 'linhas' AND tabela = 'staging_ida'")
    assert [(r.ano, r.n) for r in counted.collect()] == [(2015, 1)]
    assert as_set(second.constraints()) == as_set(quality.run_checks(second.tables(), quality.table_constraints()))
