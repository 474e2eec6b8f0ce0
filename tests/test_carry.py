"""Variation carried over loads against the full run."""

import random

import pytest
from pyspark.sql import functions as F

from monthmart.operators import carry, variation
from monthmart.plans.carried import read_variation, update_variation
from monthmart.plans.mart import build_mart

from test_versions import staging

FACT = "id_tempo int, nome_grupo string, codigo_servico string, taxa_solicitacoes_resolvidas_5dias double"


def tables(spark, seed):
    """A fact with gaps: groups that pause for years, a year without rows, null and zero rates."""
    rng = random.Random(seed)
    months = [(y * 12 + m, y, m, f"{y}-{m:02}") for y in (2010, 2011, 2013, 2014) for m in rng.sample(range(1, 13), 5)]
    facts = [(i, g, s, rng.choice([0.0, None, 10.0, 20.0, 35.0, 50.0])) for i, y, _, _ in months for g in "ABCD" for s in ("SMP", "SCM")
             if rng.random() < (0.1 if (g, y) in (("B", 2011), ("C", 2013)) else 0.7) and (g, y) not in (("D", 2011), ("D", 2013))]
    return spark.createDataFrame(facts, FACT), spark.createDataFrame(months, "id_tempo int, ano int, mes int, ano_mes string")


def rounded(df, *keys):
    return sorted(((r.ano_mes, *(r[k] for k in keys), *(None if r[c] is None else round(r[c], 6) for c in ("var_mercado", "var_individual", "diferenca")))
                   for r in df.collect()), key=str)


def unrounded_long(fact, months):
    rows = variation.rated_rows(fact, months)
    own = variation.individual_variation(rows, ("nome_grupo", "codigo_servico"))
    changes = variation.market_variation(variation.market_means(rows)).select("ano_mes", "var_mercado")
    return own.join(changes, "ano_mes").filter("var_mercado IS NOT NULL").withColumn("diferenca", variation.difference())


@pytest.mark.parametrize("grain, seed", [("groups", 1), ("services", 2)])
def test_each_prefix_equals_the_full_run(spark, grain, seed):
    fact, months = tables(spark, seed)
    fact, months = fact.cache(), months.cache()
    rows = variation.rated_rows(fact, months).cache()
    boundary, found = spark.createDataFrame([], carry.BOUNDARY_SCHEMA), []
    years = [2010, 2011, 2013, 2014]
    at_once = carry.boundaries(rows, years, grain).cache()
    for year in years:
        own = rows.filter(F.col("ano") == year)
        found += rounded(carry.year_variation(own, boundary, grain), *carry.KEYS[grain])
        boundary = spark.createDataFrame(carry.boundary_after(own, boundary, year, grain).collect(), carry.BOUNDARY_SCHEMA)
        upto = fact.join(months.filter(F.col("ano") <= year).select("id_tempo"), "id_tempo")
        full = variation.variation(upto, months) if grain == "groups" else unrounded_long(upto, months)
        assert sorted(found, key=str) == rounded(full, *carry.KEYS[grain])
        assert sorted(map(str, boundary.collect())) == sorted(map(str, at_once.filter(F.col("ano") == year).collect()))


def test_years_are_carried_until_nothing_differs():
    stored = {2010: "a", 2011: "b", 2013: "c", 2014: "d"}
    seen = []

    def run(years, changed, results):
        seen.clear()

        def store(year, rows, before):
            seen.append((year, before))
            return results[year], results[year] != stored.get(year)

        return carry.carry_forward(years, changed, lambda y: y, lambda y: stored.get(y), store)

    assert run([2010, 2011, 2013, 2014], [2011], {2011: "B", 2013: "c"}) == [2011, 2013] and seen == [(2011, "a"), (2013, "B")]
    assert run([2010, 2011, 2013, 2014], [2010], {2010: "a"}) == [2010] and seen == [(2010, None)]
    assert run([2010, 2011, 2012, 2013, 2014], [2012], {2012: "n", 2013: "c"}) == [2012, 2013] and seen == [(2012, "b"), (2013, "n")]
    assert run([2010, 2013, 2014], [2011], {2013: "C", 2014: "D"}) == [2013, 2014] and seen == [(2013, "a"), (2014, "C")]
    assert run([2010, 2011], [2013, 2014], {}) == []


def test_stored_variation_follows_the_loads(spark, tmp_path):
    path, kept = str(tmp_path / "mart"), str(tmp_path / "variation")
    first = [("2013-01", "aa", 10.0), ("2013-02", "aa", 20.0), ("2014-01", "aa", 30.0), ("2014-02", "bb", 5.0), ("2016-01", "aa", 10.0)]
    mart = build_mart(staging(spark, *first), path)
    assert update_variation(mart, kept) == [2013, 2014, 2016] and update_variation(mart, kept) == []

    def load(*rows):
        after = build_mart(staging(spark, *rows), path)
        years = update_variation(after, kept)
        assert rounded(read_variation(after, kept), "nome_grupo") == rounded(after.variation(), "nome_grupo")
        return years

    # A new month costs its year; an older one is carried into the year in which its group appears next.
    assert load(*first, ("2016-02", "bb", 7.0)) == [2016]
    assert load(*first[:3], ("2014-02", "bb", 6.0), first[4], ("2016-02", "bb", 7.0)) == [2014, 2016]
    assert load(*first[:2], first[4], ("2016-02", "bb", 7.0)) == [2016]
    assert load(*first[:2], ("2015-05", "cc", 1.0), first[4], ("2016-02", "bb", 7.0)) == [2015, 2016]
