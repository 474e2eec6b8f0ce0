import os
import random

import pytest
from pyspark.sql import functions as F
from test_workbook import row, text, write

from monthmart.operators import grid
from monthmart.plans import ingest
from monthmart.plans.ingest import cached_long_rows, compact, empty_long, read_folder
from monthmart.plans.mart import REPORT_VIEWS, ConstraintError, build_mart, delete_old_versions, load_folder, open_mart
from monthmart.sources import first_existing, inventory, scan_workbooks, with_status
from monthmart.streaming.ingest import load_arriving


def book(folder, name, *values, month="2015-01"):
    write(folder / name, row(text("t")), row(text("Grupo Econômico"), text("Variável"), text(month)),
          *[row(text("OI"), text(f"m{i}"), text(v)) for i, v in enumerate(values)])


def found(df):
    return sorted((r.arquivo_origem, r.variavel, r.valor) for r in df.collect())


def test_folder(spark, tmp_path):
    book(tmp_path, "SMP2015.ods", "1,5", "2")
    (tmp_path / "BAD2015.ods").write_bytes(b"x")
    long, report = read_folder(spark, str(tmp_path))
    assert found(long) == [("SMP2015.ods", "m0", 1.5), ("SMP2015.ods", "m1", 2.0)]
    assert {r.arquivo: r.status for r in report.collect()} == {"SMP2015.ods": "ok", "BAD2015.ods": "unreadable"}
    assert long.schema.fieldNames() == empty_long(spark).schema.fieldNames() and empty_long(spark).count() == 0


def runs(spark, path):
    return spark.read.parquet(f"{path}/entradas").select("lote").distinct().count()


def test_cache(spark, tmp_path):
    folder, path = tmp_path / "in", str(tmp_path / "cache")
    folder.mkdir()

    def load():
        return cached_long_rows(scan_workbooks(spark, str(folder)), path)

    # A file that cannot be read is tried again; once it is whole, its rows are there.
    (folder / "BAD2015.ods").write_bytes(b"x")
    assert found(load()) == [] and found(load()) == []
    assert spark.read.parquet(f"{path}/entradas").count() == 0
    # One without a known layout is remembered.
    write(folder / "SCM2013.ods", row(text("t")), row(text("nothing")))
    assert found(load()) == [] and runs(spark, path) == 1
    (folder / "BAD2015.ods").rename(tmp_path / "bad")
    assert found(load()) == [] and runs(spark, path) == 1
    (folder / "SCM2013.ods").rename(tmp_path / "unknown")
    path = str(tmp_path / "second cache")
    book(folder, "SMP2015.ods", "1")
    assert found(load()) == [("SMP2015.ods", "m0", 1.0)]
    assert found(load()) == [("SMP2015.ods", "m0", 1.0)] and runs(spark, path) == 1
    book(folder, "SCM2015.ods", "2", "3")
    assert len(found(load())) == 3 and runs(spark, path) == 2
    # A changed file replaces its rows; the other stays in the cache.
    book(folder, "SMP2015.ods", "4", "5", "6")
    assert found(load()) == [("SCM2015.ods", "m0", 2.0), ("SCM2015.ods", "m1", 3.0), ("SMP2015.ods", "m0", 4.0),
                             ("SMP2015.ods", "m1", 5.0), ("SMP2015.ods", "m2", 6.0)]
    assert runs(spark, path) == 3
    # A file that is gone is passed over.
    (folder / "SCM2015.ods").rename(tmp_path / "elsewhere")
    assert {f for f, *_ in found(load())} == {"SMP2015.ods"}
    assert runs(spark, path) == 3


def test_damaged_cache_is_read_anew(spark, tmp_path):
    folder, path = tmp_path / "in", tmp_path / "cache"
    folder.mkdir()
    book(folder, "SMP2015.ods", "1", "2")
    cached_long_rows(scan_workbooks(spark, str(folder)), str(path))
    for base, _, names in os.walk(path / "linhas"):
        for name in names:
            if name.endswith(".parquet"):
                with open(os.path.join(base, name), "r+b") as file:
                    file.truncate(20)
                os.remove(os.path.join(base, f".{name}.crc"))
    again = cached_long_rows(scan_workbooks(spark, str(folder)), str(path))
    assert found(again) == [("SMP2015.ods", "m0", 1.0), ("SMP2015.ods", "m1", 2.0)]
    assert runs(spark, str(path)) == 2


def test_arriving_files_are_loaded_once(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    staging, checkpoint = str(tmp_path / "staging"), str(tmp_path / "checkpoint")

    def load():
        query = load_arriving(spark, str(folder), staging, checkpoint)
        query.awaitTermination()
        rows = spark.read.parquet(staging)
        return sorted((r.arquivo_origem, r.variavel, r.valor, r.ano) for r in rows.collect())

    book(folder, "SMP2015.ods", "1", "-2")
    assert load() == [("SMP2015.ods", "m0", 1.0, 2015)]
    assert len(load()) == 1
    book(folder, "SCM2014.ods", "3", month="2014-05")
    (folder / "BAD2015.ods").write_bytes(b"x")
    assert load() == [("SCM2014.ods", "m0", 3.0, 2014), ("SMP2015.ods", "m0", 1.0, 2015)]


@pytest.mark.parametrize("block", [grid.ROWS_PER_BLOCK, 7])
def test_hot_file_is_deduplicated_whole(spark, monkeypatch, block):
    """A third of all rows in one file, every key twice: the earlier row wins, nothing is lost."""
    monkeypatch.setattr(grid, "ROWS_PER_BLOCK", block)
    header = spark.createDataFrame(
        [(f"{k}2015.ods", 1, ["Grupo Econômico", "Variável", "2015-01"]) for k in "ABC"],
        "arquivo string, row_idx int, cells array<string>")
    data = spark.range(6000).select(
        F.when(F.col("id") < 2000, "A2015.ods").when(F.col("id") < 4000, "B2015.ods").otherwise("C2015.ods").alias("arquivo"),
        (F.col("id") + 2).cast("int").alias("row_idx"),
        F.array(F.concat(F.lit("g"), (F.col("id") % 1000).cast("string")), F.lit("m"), F.col("id").cast("string")).alias("cells"))
    long = grid.grid_to_long(with_status(header.unionByName(data))).groupBy("arquivo_origem").agg(
        F.count(F.lit(1)).alias("n"), F.max("valor").alias("m"), F.min("valor").alias("l"))
    assert sorted(tuple(r) for r in long.collect()) == [
        ("A2015.ods", 1000, 999.0, 0.0), ("B2015.ods", 1000, 2999.0, 2000.0), ("C2015.ods", 1000, 4999.0, 4000.0)]


def test_folder_to_report(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    metric = "Taxa de Resolvidas em 5 dias úteis"
    for service, factor in (("SMP", 1), ("SCM", 2)):
        write(folder / f"{service}2015.ods", row(text("t")),
              row(text("Grupo Econômico"), text("Variável"), text("2015-01"), text("FEV/2015"), text("mar")),
              row(text("Oi (a)"), text(metric), text("10,0"), text("15"), text("15")),
              row(text("TIM *"), text(metric), text(str(10 * factor)), text("-1"), text("30")))
    mart, report = load_folder(spark, str(folder), str(tmp_path / "out"))
    names = mart.create_views()
    assert set(REPORT_VIEWS) < set(names)
    counts = dict(tuple(r) for r in inventory(spark, ["staging_ida", "fato_ida", REPORT_VIEWS[0]]).collect())
    # Negative values never reach staging; TIM has no row for February.
    assert counts == {"staging_ida": 10, "fato_ida": 10, REPORT_VIEWS[0]: 2}
    found = first_existing(spark, REPORT_VIEWS).collect()
    assert [tuple(float(v) for v in r[1:]) for r in found] == [(20.0, -30.0, 0.0), (50.0, 50.0, -50.0)]
    assert mart.checks().filter("should_error").count() == 0
    assert "data_carga" in mart.fato.columns


def damage(path):
    for base, _, names in os.walk(path / "linhas"):
        for name in names:
            if name.endswith(".parquet"):
                with open(os.path.join(base, name), "r+b") as file:
                    file.truncate(20)
                os.remove(os.path.join(base, f".{name}.crc"))


def test_damage_after_the_load_is_an_error(spark, tmp_path):
    folder, path = tmp_path / "in", tmp_path / "cache"
    folder.mkdir()
    book(folder, "SMP2015.ods", "1", "2")
    rows = cached_long_rows(scan_workbooks(spark, str(folder)), str(path))
    damage(path)
    with pytest.raises(Exception):
        rows.collect()


def test_content_is_read_behind_pushed_filters(spark, tmp_path):
    files = scan_workbooks(spark, str(tmp_path)).filter("modificationTime >= timestamp'2020-01-01'")
    plan = files._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(modificationTime" in plan


def test_compaction_keeps_current_rows(spark, tmp_path):
    folder, path, target = tmp_path / "in", str(tmp_path / "cache"), str(tmp_path / "compact")
    folder.mkdir()
    book(folder, "SMP2015.ods", "1")
    cached_long_rows(scan_workbooks(spark, str(folder)), path)
    book(folder, "SMP2015.ods", "4", "5")
    files = scan_workbooks(spark, str(folder))
    cached_long_rows(files, path)
    compact(spark, files, path, target)
    assert spark.read.parquet(f"{target}/linhas").count() == 2
    assert len(found(cached_long_rows(files, target))) == 2 and runs(spark, target) == 1


def test_files_of_one_name_are_refused(spark, tmp_path):
    files = scan_workbooks(spark, str(tmp_path))
    twice = spark.createDataFrame([("a.ods", 1, None, b"x"), ("a.ods", 2, None, b"y")], files.schema)
    with pytest.raises(ValueError, match="a.ods"):
        cached_long_rows(twice, str(tmp_path / "cache"))


def test_versions(spark, tmp_path):
    """A refused or failing load leaves the mart as it is; old groups keep keys and state over loads."""
    path = str(tmp_path / "mart")
    base = [(2015, 1, "2015-01", "SMP", g, "Taxa de Resolvidas em 5 dias úteis", 10.0, "SMP2015.ods") for g in ("bb", "cc")]
    schema = "ano int, mes int, ano_mes string, servico string, grupo_economico string, variavel string, valor double, arquivo_origem string"
    first = build_mart(spark.createDataFrame(base, schema), path)
    keys = {r.nome_grupo: r.id_grupo for r in first.dim_grupo.collect()}
    more = [(2014, 12, "2014-12", "SCM", g, *base[0][5:]) for g in ("aa", "cc", "dd")]
    build_mart(spark.createDataFrame(more, schema), path)
    opened = open_mart(spark, path)
    now = {r.nome_grupo: r.id_grupo for r in opened.dim_grupo.collect()}
    assert set(now) == {"AA", "BB", "CC", "DD"} and all(now[k] == v for k, v in keys.items())
    assert sorted(r.id_tempo for r in opened.dim_tempo.collect()) == [1, 2]
    assert build_mart(spark.createDataFrame([], schema), path) is None
    with pytest.raises(ConstraintError):
        build_mart(spark.createDataFrame([(2015, 1, "2015-01", "TOO LONG A CODE", "aa", "x", 1.0, "f")], schema), path)
    with pytest.raises(Exception, match="1000"):
        build_mart(spark.createDataFrame([base[0][:6] + (1000.0, "f")], schema), path)
    assert open_mart(spark, path).fato.count() == 3
    delete_old_versions(spark, path, keep=1)
    assert open_mart(spark, path).fato.count() == 3
    names = opened.publish("teste_")
    try:
        assert spark.newSession().table("teste_fato_ida").count() == 3
    finally:
        for name in names:
            spark.sql(f"DROP VIEW IF EXISTS {name}")


def opened_files(spark, folder, path):
    """Names of the files that a load would open, and the plan that chooses them."""
    files = scan_workbooks(spark, str(folder))
    held = ingest.complete_entries(spark, path)
    listed = files.select(F.col("arquivo").alias("arquivo_origem"), "length", "modificationTime").join(
        held, list(ingest.VERSION), "left").withColumn("pendente", F.col("lote").isNull())
    return files, listed.cache()


def scanned(df):
    """Number of files that the scan of a collected plan opened."""
    def walk(node):
        yield node
        children = node.children()
        for i in range(children.size()):
            yield from walk(children.apply(i))

    df = df.select("arquivo", F.length("content"))
    df.collect()
    found = [n.metrics().apply("numFiles").value() for n in walk(df._jdf.queryExecution().executedPlan()) if n.metrics().contains("numFiles")]
    return found[-1]


def test_an_old_broken_file_opens_no_others(spark, tmp_path):
    folder, path = tmp_path / "in", str(tmp_path / "cache")
    folder.mkdir()
    for k in range(6):
        book(folder, f"SMP201{k}.ods", "1", month=f"201{k}-01")
        os.utime(folder / f"SMP201{k}.ods", (1.5e9 + k * 1000,) * 2)
    (folder / "BAD2009.ods").write_bytes(b"x")
    os.utime(folder / "BAD2009.ods", (1.4e9,) * 2)
    cached_long_rows(scan_workbooks(spark, str(folder)), path)
    book(folder, "SCM2016.ods", "2", month="2016-01")
    os.utime(folder / "SCM2016.ods", (1.6e9,) * 2)
    files, listed = opened_files(spark, folder, path)
    by_name = ingest.files_to_open(files, listed)
    assert sorted(r.arquivo for r in by_name.collect()) == ["BAD2009.ods", "SCM2016.ods"] and scanned(by_name) == 2
    by_time = ingest.files_to_open(files, listed, few=0)
    assert sorted(r.arquivo for r in by_time.collect()) == ["BAD2009.ods", "SCM2016.ods"]
    assert "Or(And(GreaterThanOrEqual(modificationTime" in by_time._jdf.queryExecution().executedPlan().toString()
    assert ingest.files_to_open(files, listed, few=0, most=1).count() == 8
    assert len(found(cached_long_rows(files, path))) == 7
    assert ingest.files_to_open(files, listed.withColumn("pendente", F.lit(False))) is None


def test_ranges_leave_out_the_most_held_files(spark):
    rng = random.Random(4)
    for _ in range(4):
        marks = [(t, rng.random() < 0.4) for t in rng.sample(range(2000), 60)]
        table = spark.createDataFrame([(t, p) for t, p in marks], "t int, pendente boolean").select(
            F.timestamp_seconds("t").alias("modificationTime"), "pendente")
        waiting = sorted(t for t, p in marks if p)
        for most in (1, 3, 100):
            ranges = [tuple(int(x.timestamp()) for x in r) for r in ingest.time_ranges(table, most)]
            assert len(ranges) <= most and all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
            inside = [t for t, _ in marks if any(a <= t <= b for a, b in ranges)]
            assert set(waiting) <= set(inside)
            gaps = sorted((sum(not p and a < t < b for t, p in marks) for a, b in zip(waiting, waiting[1:])), reverse=True)
            assert len(inside) == len(waiting) + sum(gaps) - sum(gaps[: most - 1])
        assert len(ingest.time_ranges(table, 100, steps=3)) <= 3
    assert ingest.time_ranges(table.filter("NOT pendente")) == []


def test_small_runs_merge_in_place(spark, tmp_path):
    folder, path = tmp_path / "in", str(tmp_path / "cache")
    folder.mkdir()
    counts, before = [], None
    for k in range(9):
        book(folder, f"SMP20{k:02}.ods", str(k), month=f"20{k:02}-01")
        if k == 5:
            book(folder, "SMP2000.ods", "90", "91", month="2000-01")
        files = scan_workbooks(spark, str(folder))
        rows = cached_long_rows(files, path)
        before = before or rows
        counts.append(ingest.merge_runs(files, path, tier=3))
    assert max(counts) <= 5 and counts[-1] <= 4
    expected = sorted([("SMP2000.ods", "m0", 90.0), ("SMP2000.ods", "m1", 91.0)] + [(f"SMP20{k:02}.ods", "m0", float(k)) for k in range(1, 9)])
    assert found(cached_long_rows(files, path)) == expected
    # Whoever reads from before goes on reading until the retired runs are deleted.
    assert found(before) == [("SMP2000.ods", "m0", 0.0)] and ingest.clean_cache(spark, path) == []
    assert len(ingest.clean_cache(spark, path, hours=0)) >= 6
    assert found(cached_long_rows(files, path)) == expected


def test_tiers():
    assert ingest.full_tiers({"a": 1, "b": 2, "c": 3, "d": 70}, 3) == []
    assert ingest.full_tiers({"a": 1, "b": 2, "c": 1, "d": 70, "e": 0}, 3) == [["a", "b", "c", "e"]]
    # A hundred loads of one size, merged as they come, never leave more than a tier's worth of runs for each power.
    sizes, most = {}, 0
    for k in range(100):
        sizes[f"r{k}"] = 1
        while full := ingest.full_tiers(sizes, 4):
            for runs in full:
                sizes[f"m{k}{runs[0]}"] = sum(sizes.pop(r) for r in runs)
        most = max(most, len(sizes))
    assert most <= 3 * 4 and sum(sizes.values()) == 100
