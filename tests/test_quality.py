from monthmart.operators import quality
from monthmart.operators.quality import AcceptedValues, MaxLength, NotNull, Relationship, Unique


def failures(tables, *checks):
    found = quality.run_checks(tables, list(checks)).collect()
    for r in found:
        assert r.should_warn == r.should_error == (r.failures != 0)
    return {(r.checagem, r.tabela, r.coluna): r.failures for r in found}


def test_clean_and_dirty(spark):
    parent = spark.createDataFrame([("A",), ("B",), (None,)], "k string")
    child = spark.createDataFrame(
        [("A", 1), ("A", 1), ("Z", 2), ("Z", 3), ("Y", None), (None, 4)], "k string, n int")
    tables = {"p": parent, "c": child}
    assert failures(
        tables, NotNull("p", "k"), NotNull("c", "k"), NotNull("c", "n"), Unique("p", ("k",)), Unique("c", ("k",)),
        Unique("c", ("k", "n")), AcceptedValues("c", "k", ("A",)), Relationship("c", "k", "p", "k"),
        MaxLength("c", "k", 1), MaxLength("c", "k", 0),
    ) == {
        ("not_null", "p", "k"): 1, ("not_null", "c", "k"): 1, ("not_null", "c", "n"): 1,
        ("unique", "p", "k"): 0, ("unique", "c", "k"): 2, ("unique", "c", "k,n"): 1,
        ("accepted_values", "c", "k"): 2, ("relationships", "c", "k"): 3,
        ("max_length", "c", "k"): 5,
    }


def test_empty_tables_pass(spark):
    empty = spark.createDataFrame([], "k string")
    assert set(failures({"e": empty}, NotNull("e", "k"), Unique("e", ("k",)), AcceptedValues("e", "k", ("A",)),
                        Relationship("e", "k", "e", "k"), MaxLength("e", "k", 1)).values()) == {0}


def test_row_checks_of_a_table_share_one_scan(spark, tmp_path):
    spark.range(3).selectExpr("id a", "id b").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    checks = quality.run_checks({"t": df}, [NotNull("t", "a"), NotNull("t", "b")])
    assert checks._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_hot_key_is_counted_before_it_moves(spark):
    hot = spark.range(10000).selectExpr("case when id % 3 = 0 then 'A' else 'Z' || id % 5 end as k")
    parent = spark.createDataFrame([("A",)], "k string")
    orphans = quality.orphan_keys(hot, "k", parent, "k")
    assert "partial_count" in orphans._jdf.queryExecution().executedPlan().toString()
    assert sum(r.n_rows for r in orphans.collect()) == hot.filter("k <> 'A'").count()


def test_gate(spark):
    assert quality.has_rows(spark.range(1)) and not quality.has_rows(spark.range(0))
