from monthmart.operators import grid
from monthmart.sources import with_status

SCHEMA = "arquivo string, row_idx int, cells array<string>"
HEADER = ["Grupo Econômico", "Variável", "2015-01", "2015-02"]


def rows(spark, *sheets):
    """Each sheet is (file name, list of rows)."""
    data = [(name, i, row) for name, sheet in sheets for i, row in enumerate(sheet)]
    return with_status(spark.createDataFrame(data, SCHEMA))


def long(spark, *sheets):
    found = grid.grid_to_long(rows(spark, *sheets)).collect()
    return sorted((r.arquivo_origem, r.grupo_economico, r.variavel, r.ano_mes, r.valor) for r in found)


def test_plain_sheet(spark):
    sheet = [["t"], [None], HEADER, ["OI", "M", "1,5", "2"], ["TIM", "M", None, "3.25"]]
    assert long(spark, ("SMP2015.ods", sheet)) == [
        ("SMP2015.ods", "OI", "M", "2015-01", 1.5), ("SMP2015.ods", "OI", "M", "2015-02", 2.0),
        ("SMP2015.ods", "TIM", "M", "2015-02", 3.25)]


def test_output_columns(spark):
    df = grid.grid_to_long(rows(spark, ("SMP2015.ods", [["t"], HEADER, ["OI", "M", "1", "2"]])))
    assert tuple(df.columns) == grid.LONG_COLUMNS
    first = df.filter("mes = 1").first()
    assert (first.periodo, first.servico, first.ano) == ("2015-01", "SMP", 2015)


def test_sentinel_is_not_searched_in_the_first_row(spark):
    assert long(spark, ("SMP2015.ods", [HEADER, ["OI", "M", "1", "2"]])) == []


def test_sentinel_anywhere_in_the_row_first_hit_wins(spark):
    sheet = [["t"], [None, " grupo ECONÔMICO ", "M", "2015-01"], [None, "OI", "A", "1"],
             [None, "Grupo Econômico", "M", "5"]]
    # The blank header is called c0 and is taken for the group; the sentinel column is the metric.
    assert long(spark, ("SMP2015.ods", sheet)) == []
    named = [["t"], ["x", "Grupo Econômico", "2015-01"], ["OI", "A", "1"], ["TIM", "Grupo Econômico", "5"]]
    assert long(spark, ("SMP2015.ods", named)) == [
        ("SMP2015.ods", "OI", "A", "2015-01", 1.0), ("SMP2015.ods", "TIM", "Grupo Econômico", "2015-01", 5.0)]


def test_blank_leading_header_is_the_group_column(spark):
    sheet = [["t"], [None, "Grupo Econômico", "2015-01"], ["OI", "M", "1"]]
    assert long(spark, ("SMP2015.ods", sheet)) == [("SMP2015.ods", "OI", "M", "2015-01", 1.0)]


def test_columns_beyond_the_header_count_as_unnamed(spark):
    sheet = [["t"], ["Grupo Econômico", "2015-01"], ["OI", "1", "note"]]
    # Position 2 has no header, is called c2 and becomes the metric column.
    assert long(spark, ("SMP2015.ods", sheet)) == [("SMP2015.ods", "OI", "note", "2015-01", 1.0)]


def test_single_id_column(spark):
    sheet = [["t"], ["Grupo Econômico", "2015-01"], ["OI", "1"]]
    assert long(spark, ("SMP2015.ods", sheet)) == [("SMP2015.ods", "OI", "Valor Único", "2015-01", 1.0)]


def test_further_id_columns_and_unnamed_are_dropped(spark):
    sheet = [["t"], ["Unnamed: 0", "Grupo Econômico", "Variável", "UF", "2015-01"], ["z", "OI", "M", "DF", "1"]]
    assert long(spark, ("SMP2015.ods", sheet)) == [("SMP2015.ods", "OI", "M", "2015-01", 1.0)]


def test_period_by_substring_vanishes(spark):
    sheet = [["t"], ["Grupo Econômico", "Variável", "OUTROS", "SETOR", "JAN", "FEV/2014"], ["OI", "M", "1", "2", "3", "4"]]
    # OUTROS and SETOR hold a month abbreviation but no period; FEV/2014 is of another year.
    assert long(spark, ("SMP2015.ods", sheet)) == [("SMP2015.ods", "OI", "M", "2015-01", 3.0)]


def test_no_year_in_the_file_name(spark):
    sheet = [["t"], ["Grupo Econômico", "Variável", "JAN", "FEV/2014", "2013.3"], ["OI", "M", "1", "2", "3"]]
    assert long(spark, ("SMP.ods", sheet)) == [
        ("SMP.ods", "OI", "M", "2013-03", 3.0), ("SMP.ods", "OI", "M", "2014-02", 2.0)]


def test_first_of_duplicates_in_column_then_row_order(spark):
    sheet = [["t"], ["Grupo Econômico", "Variável", "2015-01", "JAN/2015"],
             ["OI", "M", "n/d", "7"], ["OI", "M", "8", "9"]]
    # Row 2 has no number in the first column, so row 3 of that column comes before 7.
    assert long(spark, ("SMP2015.ods", sheet)) == [("SMP2015.ods", "OI", "M", "2015-01", 8.0)]


def test_duplicates_are_per_file(spark):
    sheet = [["t"], HEADER, ["OI", "M", "1", None]]
    other = [["t"], HEADER, ["OI", "M", "2", None]]
    assert [r[4] for r in long(spark, ("SMP2015.ods", sheet), ("SCM2015.ods", other))] == [2.0, 1.0]


def test_missing_group_is_dropped_and_counted(spark):
    sheet = rows(spark, ("SMP2015.ods", [["t"], HEADER, ["OI", "M", "1", "2"], [None, "M", "3", "4"]]))
    assert grid.grid_to_long(sheet).count() == 2
    report = grid.layout_report(sheet).first()
    assert (report.status, report.sem_grupo) == ("ok", 1)


def test_status_of_each_layout(spark):
    sheets = rows(
        spark, ("A2015.ods", [["t"], HEADER, ["OI", "M", "1", "2"]]), ("B2015.ods", [["t"], ["x"]]),
        ("C2015.ods", [["t"], ["Grupo Econômico", "Nome"], ["OI", "M"]]),
    )
    found = {r.arquivo: r.status for r in grid.layout_report(sheets).collect()}
    assert found == {"A2015.ods": "ok", "B2015.ods": "no_header", "C2015.ods": "unknown_layout"}


def test_empty_input(spark):
    assert grid.grid_to_long(with_status(spark.createDataFrame([], SCHEMA))).count() == 0


def test_cell_table_round_trip(spark):
    sheet = rows(spark, ("A2015.ods", [["t"], HEADER, ["OI", None, "1"], [None, None, "x"]]))
    table = grid.cells(sheet)
    assert table.count() == 8
    back = {(r.row_idx): r.cells for r in grid.rows_from_cells(table).collect()}
    assert back == {0: ["t"], 1: HEADER, 2: ["OI", None, "1"], 3: [None, None, "x"]}
