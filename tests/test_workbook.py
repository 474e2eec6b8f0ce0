import zipfile

import pytest
from pyspark.sql import functions as F

from monthmart.operators import grid
from monthmart.sources import file_metadata, is_workbook, load_summary, scan_workbooks, sheet_rows

HEAD = (
    '<office:document-content xmlns:office="urn:oasis:names:tc:opendocument:xmlns:office:1.0" '
    'xmlns:table="urn:oasis:names:tc:opendocument:xmlns:table:1.0" '
    'xmlns:text="urn:oasis:names:tc:opendocument:xmlns:text:1.0"><office:body><office:spreadsheet>'
)
TAIL = "</office:spreadsheet></office:body></office:document-content>"


def text(value, extra=""):
    return f'<table:table-cell office:value-type="string"{extra}><text:p>{value}</text:p></table:table-cell>'


def typed(kind, attribute, value):
    return f'<table:table-cell office:value-type="{kind}" office:{attribute}="{value}"><text:p>shown</text:p></table:table-cell>'


def row(*cells, extra=""):
    return f"<table:table-row{extra}>{''.join(cells)}</table:table-row>"


def write(path, *rows, second=""):
    with zipfile.ZipFile(path, "w") as book:
        book.writestr("content.xml", f"{HEAD}<table:table>{''.join(rows)}</table:table>{second}{TAIL}")


@pytest.fixture()
def folder(tmp_path):
    blank = '<table:table-cell table:number-columns-repeated="3"/>'
    write(
        tmp_path / "SMP2015.ods",
        row(text("Título")),
        row('<table:table-cell table:number-columns-repeated="16384"/>', extra=' table:number-rows-repeated="4"'),
        row(text("Grupo Econômico"), text("Variável"), typed("date", "date-value", "2015-01-01"), text("FEV/2015"),
            '<table:table-cell table:number-columns-repeated="16000"/>'),
        row(text("OI"), text("M"), typed("float", "value", "12.5"), typed("percentage", "value", "0.25")),
        row(text("TIM"), text("M", ' table:number-columns-repeated="2"'), typed("currency", "value", "7.0")),
        f"<table:table-row-group>{row(text('A&amp;B'), '<table:covered-table-cell/>', blank, text('far'))}</table:table-row-group>",
        row(blank, extra=' table:number-rows-repeated="1048000"'),
        second=f"<table:table>{row(text('other sheet'))}</table:table>",
    )
    (tmp_path / "SCM2015.ods").write_bytes(b"not a zip")
    (tmp_path / "STFC2015.ods").write_bytes(b"PK\x03\x04 broken")
    (tmp_path / "notes.txt").write_text("PK")
    return str(tmp_path)


def by_row(spark, folder, name="SMP2015.ods"):
    found = sheet_rows(scan_workbooks(spark, folder)).filter(F.col("arquivo") == name)
    return {r.row_idx: r.cells for r in found.collect() if r.row_idx is not None}


def test_first_sheet(spark, folder):
    assert by_row(spark, folder) == {
        0: ["Título"],
        5: ["Grupo Econômico", "Variável", "2015-01-01", "FEV/2015"],
        6: ["OI", "M", "12.5", "0.25"],
        7: ["TIM", "M", "M", "7"],
        8: ["A&B", None, None, None, None, "far"],
    }


def test_inline_text(spark, tmp_path):
    spaced = '<table:table-cell office:value-type="string"><office:annotation><text:p>note</text:p></office:annotation>' \
        '<text:p>a<text:s text:c="2"/>b<text:span>c</text:span>d</text:p><text:p>e<text:tab/>f</text:p></table:table-cell>'
    write(tmp_path / "A.ods", row(spaced, typed("boolean", "boolean-value", "true"), typed("time", "time-value", "PT1H")))
    assert by_row(spark, str(tmp_path), "A.ods") == {0: ["a  bcd\ne\tf", "true", "PT1H"]}


def test_repeated_rows_with_text(spark, tmp_path):
    write(tmp_path / "A.ods", row(text("x"), extra=' table:number-rows-repeated="3"'), row(text("y")))
    assert by_row(spark, str(tmp_path), "A.ods") == {0: ["x"], 1: ["x"], 2: ["x"], 3: ["y"]}


def test_many_rows_come_in_batches(spark, tmp_path):
    write(tmp_path / "A.ods", *[row(text(str(i))) for i in range(5001)])
    found = by_row(spark, str(tmp_path), "A.ods")
    assert len(found) == 5001 and found[5000] == ["5000"]


def test_a_bad_file_stops_only_itself(spark, folder):
    rows = sheet_rows(scan_workbooks(spark, folder))
    report = {r.arquivo: r for r in grid.layout_report(rows).collect()}
    assert {n: r.status for n, r in report.items()} == {
        "SMP2015.ods": "ok", "SCM2015.ods": "unreadable", "STFC2015.ods": "unreadable"}
    assert report["SMP2015.ods"].linhas == 5 and "BadZipFile" in report["SCM2015.ods"].erro
    long = grid.grid_to_long(rows).collect()
    assert sorted((r.grupo_economico, r.ano_mes, r.valor) for r in long) == [
        ("OI", "2015-01", 12.5), ("OI", "2015-02", 0.25), ("TIM", "2015-02", 7.0)]


def test_rows_before_a_defect_do_not_count(spark, tmp_path):
    good = row(text("t")) + row(text("Grupo Econômico"), text("2015-01")) + row(text("OI"), text("1")) * 2500
    with zipfile.ZipFile(tmp_path / "A2015.ods", "w") as book:
        book.writestr("content.xml", HEAD + "<table:table>" + good + "<oops>")
    rows = sheet_rows(scan_workbooks(spark, str(tmp_path)))
    status = grid.layout_report(rows).first()
    assert status.status == "unreadable" and "ParseError" in status.erro
    assert grid.grid_to_long(rows).count() == 0


def test_signature_and_metadata(spark, folder):
    files = file_metadata(scan_workbooks(spark, folder)).withColumn("ok", is_workbook(F.col("content")))
    found = {r.arquivo: (r.servico, r.ano_arquivo, r.ok) for r in files.drop("content").collect()}
    assert found == {"SMP2015.ods": ("SMP", 2015, True), "SCM2015.ods": ("SCM", 2015, False),
                     "STFC2015.ods": ("STFC", 2015, True)}
    assert tuple(load_summary(files, F.col("ok")).first()) == (2, 3)


def test_listing_does_not_read_content(spark, folder):
    plan = scan_workbooks(spark, folder).drop("content")._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]
