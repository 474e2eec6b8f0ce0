"""Arriving workbooks by version: replaced and repaired ones arrive, a restart repeats nothing."""

import os

from test_ingest import book

from monthmart.streaming import versions


def at(path, seconds):
    os.utime(path, (seconds, seconds))


def test_versions_arrive_once_each(spark, tmp_path):
    folder, path, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "checkpoint")
    folder.mkdir()

    def load():
        query = versions.load_versions(spark, str(folder), path, checkpoint)
        query.awaitTermination()
        return sorted((r.arquivo_origem, r.valor) for r in versions.current_rows(spark, path).collect())

    def lotes():
        return sorted(n for n in os.listdir(f"{path}/entradas") if n.startswith("lote=") )

    book(folder, "SMP2015.ods", "1", "-2")
    at(folder / "SMP2015.ods", 1_600_000_000)
    (folder / "SCM2015.ods").write_bytes(b"x")
    at(folder / "SCM2015.ods", 1_600_000_000)
    assert load() == [("SMP2015.ods", 1.0)]
    assert [r.arquivo for r in versions.unreadable(spark, path).collect()] == ["SCM2015.ods"]
    # A restart hands out nothing again, but tries the unreadable version.
    assert load() == [("SMP2015.ods", 1.0)] and len(lotes()) == 2 and lotes()[0] == "lote=000000000"
    # A replaced workbook takes the place of its rows, a repaired one arrives.
    book(folder, "SMP2015.ods", "5", "6")
    at(folder / "SMP2015.ods", 1_600_000_100)
    book(folder, "SCM2015.ods", "7")
    at(folder / "SCM2015.ods", 1_600_000_100)
    book(folder, "notes.txt", "9")
    assert load() == [("SCM2015.ods", 7.0), ("SMP2015.ods", 5.0), ("SMP2015.ods", 6.0)]
    assert versions.unreadable(spark, path).count() == 0
    # A version that cannot be read leaves the rows of the one before.
    (folder / "SMP2015.ods").write_bytes(b"broken")
    at(folder / "SMP2015.ods", 1_600_000_200)
    assert load() == [("SCM2015.ods", 7.0), ("SMP2015.ods", 5.0), ("SMP2015.ods", 6.0)]
    assert [r.arquivo for r in versions.unreadable(spark, path).collect()] == ["SMP2015.ods"]


def test_a_version_that_becomes_readable_is_read_again(spark, tmp_path):
    """As after a store gave half a file: the same version, whole at the next run."""
    folder, path = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    book(folder, "SMP2015.ods", "1")
    files = versions.scan_workbooks(spark, str(folder))
    half = files.withColumn("content", versions.F.lit(b"half"))
    versions._load(half, path, "000000000")
    assert versions.current_rows(spark, path).count() == 0 and versions.unreadable(spark, path).count() == 1
    versions.retry_unreadable(spark, str(folder), path, "de-novo")
    assert [r.valor for r in versions.current_rows(spark, path).collect()] == [1.0] and versions.unreadable(spark, path).count() == 0
    versions._load(files, path, "000000000")  # a batch that is repeated
    assert versions.current_rows(spark, path).count() == 1


def test_files_are_dealt_out_in_order_and_by_size(tmp_path, monkeypatch):
    monkeypatch.setattr(versions, "BYTES_PER_TASK", 10)
    for k, size in enumerate((4, 4, 4, 30, 1)):
        (tmp_path / f"f{k}.ods").write_bytes(b"x" * size)
        at(tmp_path / f"f{k}.ods", 1000 - k // 2)
    reader = versions.VersionReader(str(tmp_path), "*.ods")
    last = reader.latestOffset()
    tasks = [[p.rsplit("/")[-1] for _, p, _ in t.files] for t in reader.partitions(reader.initialOffset(), last)]
    assert tasks == [["f4.ods", "f2.ods"], ["f3.ods"], ["f0.ods", "f1.ods"]]
    assert reader.partitions(last, last) == [] and versions.VersionReader(str(tmp_path / "none"), "*").latestOffset() == reader.initialOffset()
    listed = reader.partitions(reader.initialOffset(), last)[0]
    (tmp_path / "f2.ods").write_bytes(b"new")
    os.remove(tmp_path / "f4.ods")
    assert list(reader.read(listed)) == []
