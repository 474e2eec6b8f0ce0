"""Irregular wide sheets to long rows, one plan for all layouts.

Input are sheet rows (arquivo, row_idx, cells) with one status row per file, as the
workbook reader gives them. What differs between files is kept as data: a layout table holds, per file, the header row, the positions of the two
id columns and an array of period columns. Data rows meet it in one join on the
file and are unpivoted by exploding that array, so id columns are read by position. Cells are
shuffled once, as partial aggregates of their keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import DEFAULT_METRIC, HEADER_SENTINEL, MONTHS, UNNAMED_HEADER
from ..functions import (
    file_service, file_year, month_key, parse_number, parse_period,
)
from ..functions.parsing import strip

LONG_COLUMNS = (
    "grupo_economico", "variavel", "periodo", "valor", "ano", "mes",
    "servico", "arquivo_origem", "ano_mes",
)
# Rows of a sheet meet its layout in blocks of this many rows.
ROWS_PER_BLOCK = 100_000
PERIOD_HEADER = "|".join((r"\d{4}", *MONTHS))


def is_period_header(name: Column) -> Column:
    """Four digits or a month abbreviation anywhere in the name."""
    return F.upper(name).rlike(PERIOD_HEADER)


def is_id_header(name: Column) -> Column:
    return ~is_period_header(name) & ~name.contains(UNNAMED_HEADER) & (strip(name) != "")


def file_status(rows: DataFrame) -> DataFrame:
    """(arquivo, linhas, ultima, largura, erro) of each file; does not touch the cells."""
    return rows.filter(F.col("row_idx").isNull()).select("arquivo", "linhas", "ultima", "largura", "erro")


def header_rows(rows: DataFrame, sentinel: str = HEADER_SENTINEL, skip_rows: int = 1) -> DataFrame:
    """(arquivo, header_row, cells): the first row of each file that holds the sentinel.

    The first sheet row holds the column names of the raw grid and is not searched.
    Few rows pass the filter, so little is sorted or shuffled.
    """
    def is_sentinel(cell: Column) -> Column:
        text = F.upper(cell)
        return text.contains(sentinel) & (strip(text) == sentinel)

    hits = rows.filter((F.col("row_idx") >= skip_rows) & F.exists("cells", is_sentinel))
    first = F.min_by(F.struct(F.col("row_idx").alias("header_row"), "cells"), "row_idx")
    return hits.groupBy("arquivo").agg(first.alias("h")).select("arquivo", "h.*")


def sheet_layouts(rows: DataFrame, sentinel: str = HEADER_SENTINEL, skip_rows: int = 1) -> DataFrame:
    """Per file with a sentinel: header_row, group_pos, metric_pos, periods, recognised.

    periods lists the columns whose header is a period of the file's year, as
    (col_idx, periodo, ano, mes). Files without any id or any period column are
    kept, with recognised = false; files with a reading error are left out, also if
    some of their rows were read.
    """
    whole = file_status(rows).filter(F.col("erro").isNull()).select("arquivo", "ultima", "largura")
    headers = header_rows(rows, sentinel, skip_rows).join(whole, "arquivo")
    columns = F.transform(
        F.sequence(F.lit(0), F.col("largura") - 1),
        lambda i: F.struct(
            i.alias("col_idx"),
            F.coalesce(strip(F.get("cells", i)), F.concat(F.lit("c"), i.cast("string"))).alias("periodo"),
        ),
    )
    year = F.col("ano_arquivo")
    dated = F.transform(
        F.col("candidates"),
        lambda c: F.struct(c.col_idx.alias("col_idx"), c.periodo.alias("periodo"),
                           parse_period(c.periodo, year).alias("p")),
    )
    return (
        headers.select("arquivo", "header_row", "ultima",
                       file_year(F.col("arquivo")).alias("ano_arquivo"), columns.alias("columns"))
        .withColumn("ids", F.filter("columns", lambda c: is_id_header(c.periodo)))
        .withColumn("candidates", F.filter("columns", lambda c: is_period_header(c.periodo)))
        .withColumn("dated", dated)
        .select(
            "arquivo",
            "header_row",
            "ultima",
            F.get("ids", F.lit(0)).col_idx.alias("group_pos"),
            F.get("ids", F.lit(1)).col_idx.alias("metric_pos"),
            ((F.size("ids") > 0) & (F.size("candidates") > 0)).alias("recognised"),
            F.transform(
                F.filter("dated", lambda d: d.p.isNotNull() & (year.isNull() | (d.p.ano == year))),
                lambda d: F.struct(d.col_idx.alias("col_idx"), d.periodo.alias("periodo"),
                                   d.p.ano.alias("ano"), d.p.mes.alias("mes")),
            ).alias("periods"),
        )
    )


def data_rows(rows: DataFrame, layouts: DataFrame) -> DataFrame:
    """Rows below the header of each recognised sheet, with its layout.

    The layout is repeated for each block of the sheet, once for all but the longest
    sheets, so that a file with most of the rows is spread over tasks where the
    layouts are too many to broadcast.
    """
    def block(row: Column) -> Column:
        return F.floor(row / ROWS_PER_BLOCK)

    blocks = layouts.filter("recognised").withColumn(
        "bloco", F.explode(F.sequence(F.lit(0).cast("bigint"), block(F.col("ultima"))))
    )
    return rows.withColumn("bloco", block(F.col("row_idx"))).join(
        blocks, ["arquivo", "bloco"]
    ).filter("row_idx > header_row")


def unpivot_rows(rows: DataFrame, layouts: DataFrame) -> DataFrame:
    """One row per data cell that holds a number, with its group, metric and period."""
    data = data_rows(rows.select("arquivo", "row_idx", "cells"), layouts)
    metric = F.when(F.col("metric_pos").isNull(), F.lit(DEFAULT_METRIC)).otherwise(
        F.get("cells", F.col("metric_pos"))
    )
    # Values are parsed in the array, before it is exploded: once per cell, where a
    # filter on a parsed column would parse it again.
    numbers = F.filter(
        F.transform("periods", lambda p: F.struct(
            p.col_idx.alias("col_idx"), p.periodo.alias("periodo"), p.ano.alias("ano"), p.mes.alias("mes"),
            parse_number(F.get("cells", p.col_idx)).alias("valor"))),
        lambda p: p.valor.isNotNull(),
    )
    group = F.get("cells", F.col("group_pos"))
    return data.filter(group.isNotNull()).select(
        "arquivo", "row_idx", group.alias("grupo_economico"), metric.alias("variavel"), F.inline(numbers)
    )


def keep_first(cells: DataFrame, layouts: DataFrame) -> DataFrame:
    """One value per file, month, group and metric: the first in column, then row order.

    An aggregate of fixed-width values, which is hashed, so copies of one key shrink before the shuffle and nothing is
    sorted. The text of the period follows from the file's column.
    """
    order = F.shiftleft(F.col("col_idx").cast("bigint"), 32) + F.col("row_idx")
    first = cells.groupBy("arquivo", "ano", "mes", "grupo_economico", "variavel").agg(
        F.min(order).alias("ordem"), F.min_by("valor", order).alias("valor")
    )
    names = layouts.filter("recognised").select("arquivo", F.inline("periods")).select("arquivo", "col_idx", "periodo")
    return first.withColumn("col_idx", F.shiftright("ordem", 32).cast("int")).join(names, ["arquivo", "col_idx"]).select(
        "arquivo", "ano", "mes", "grupo_economico", "variavel", "periodo", "valor"
    )


def grid_to_long(rows: DataFrame, sentinel: str = HEADER_SENTINEL, skip_rows: int = 1) -> DataFrame:
    """Long rows of all recognised sheets, tagged with service, source file and month key."""
    layouts = sheet_layouts(rows, sentinel, skip_rows)
    long = keep_first(unpivot_rows(rows, layouts), layouts)
    return (
        long.withColumn("servico", file_service(F.col("arquivo")))
        .withColumn("ano_mes", month_key(F.col("ano"), F.col("mes")))
        .withColumnRenamed("arquivo", "arquivo_origem")
        .select(*LONG_COLUMNS)
    )


def cells(rows: DataFrame) -> DataFrame:
    """Cell table (arquivo, row_idx, col_idx, cell) of the non-blank cells."""
    return (
        rows.filter(F.col("row_idx").isNotNull())
        .select("arquivo", "row_idx", F.posexplode("cells").alias("col_idx", "cell"))
        .filter(F.col("cell").isNotNull())
    )


def rows_from_cells(cell_table: DataFrame) -> DataFrame:
    """Sheet rows from a cell table; a sheet row is no wider than a sheet."""
    per_row = cell_table.groupBy("arquivo", "row_idx").agg(
        F.map_from_entries(F.collect_list(F.struct("col_idx", "cell"))).alias("m")
    )
    width = F.array_max(F.map_keys("m"))
    return per_row.select(
        "arquivo", "row_idx",
        F.transform(F.sequence(F.lit(0), width), lambda i: F.try_element_at("m", i)).alias("cells"),
    )


def layout_report(rows: DataFrame) -> DataFrame:
    """Per file: status (ok, unreadable, no_header, unknown_layout), sheet rows, error.

    Also counts the data rows without a group, which give no long rows.
    """
    layouts = sheet_layouts(rows)
    nameless = (
        data_rows(rows.select("arquivo", "row_idx", "cells"), layouts)
        .filter(F.get("cells", F.col("group_pos")).isNull())
        .groupBy("arquivo").agg(F.count(F.lit(1)).alias("sem_grupo"))
    )
    status = (
        F.when(F.col("erro").isNotNull(), "unreadable")
        .when(F.col("recognised").isNull(), "no_header")
        .when(~F.col("recognised"), "unknown_layout")
        .otherwise("ok")
    )
    return (
        file_status(rows).join(layouts.select("arquivo", "recognised"), "arquivo", "left")
        .join(nameless, "arquivo", "left")
        .select("arquivo", status.alias("status"), "linhas",
                F.coalesce("sem_grupo", F.lit(0).cast("bigint")).alias("sem_grupo"), "erro")
    )
