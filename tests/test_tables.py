from monthmart.constants import STAGING_COLUMNS
from monthmart.plans.queries import build_or_reuse
from monthmart.sources import (
    bulk_load, first_existing, inventory, materialize, save_catalog_table, save_table, save_view, shared_dir,
)

ROW = (2015, 1, "2015-01", "SMP", "OI", "x", 1.0, "f.ods")
SCHEMA = "ano int, mes int, ano_mes string, servico string, grupo_economico string, variavel string, valor double, arquivo_origem string"


def test_bulk_load(spark, tmp_path):
    path = str(tmp_path / "staging")
    rows = spark.createDataFrame([ROW + ("more",), (2014,) + ROW[1:] + ("more",)], SCHEMA + ", extra string")
    bulk_load(rows, path)
    assert set(spark.read.parquet(path).columns) == set(STAGING_COLUMNS)
    bulk_load(rows.filter("ano = 2015"), path)
    assert spark.read.parquet(path).count() == 1
    bulk_load(rows.limit(0), path)
    assert spark.read.parquet(path).count() == 1
    bulk_load(rows, path, truncate=False)
    assert spark.read.parquet(path).count() == 3


def test_partition_reload(spark, tmp_path):
    path = str(tmp_path / "t")
    old = spark.createDataFrame([(1, 2014), (2, 2015)], "v int, ano int")
    save_table(old, path, ["ano"])
    new = spark.createDataFrame([(3, 2015)], "v int, ano int")
    assert sorted(tuple(r) for r in save_table(new, path, ["ano"], only_partitions=True).collect()) == [(1, 2014), (3, 2015)]
    assert [tuple(r) for r in save_table(new, path, ["ano"]).collect()] == [(3, 2015)]


def test_catalog_table(spark, tmp_path):
    name, path = "monthmart_table", str(tmp_path / "t")
    try:
        for v in (1, 2):
            df = spark.createDataFrame([(v, 2015), (v, 2016)], "v int, ano int")
            save_catalog_table(df, name, path, ["ano"])
            assert sorted(tuple(r) for r in spark.table(name).collect()) == [(v, 2015), (v, 2016)]
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_first_existing_even_if_empty(spark):
    save_view(spark.range(0), "monthmart_empty")
    save_view(spark.range(2), "monthmart_full")
    assert first_existing(spark, ["monthmart_none", "monthmart_empty", "monthmart_full"]).count() == 0
    assert first_existing(spark, ["monthmart_none"]) is None


def test_inventory(spark):
    save_view(spark.range(2), "monthmart_two")
    assert [tuple(r) for r in inventory(spark, ["monthmart_two"]).collect()] == [("monthmart_two", 2)]
    assert "monthmart_two" in [r.tabela for r in inventory(spark).collect()]
    assert inventory(spark, []).count() == 0


def test_shared_dir_is_the_one_the_session_names(spark):
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert named is None or shared_dir(spark) == named


def test_materialize_reads_from_the_file(spark):
    df = materialize(spark.range(3), "three")
    assert df.count() == 3 and df.dtypes == spark.range(3).dtypes
    assert "Range" not in df._jdf.queryExecution().executedPlan().toString()


def test_build_once(spark):
    calls = []
    for _ in range(2):
        build_or_reuse(spark, "key of the test", lambda: calls.append(1))
    assert calls == [1]
