"""Inputs of the mart derived from the order tables, for queries, tests and benchmark."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import BinaryType

from ..constants import MONTHS
from ..functions import month_key, rounded
from ..sources import with_status

# Spellings given to the first nations; the others keep their name in lower case.
SPELLINGS = (
    "Oi (Nova) **", "Claro  S.A.", "Telefônica Brasil", "CTBC *", "Tim (a)", "Sercomtel (b)",
    "vivo", "Algar",
)
RATE_5D = "Taxa de Resolvidas em 5 dias úteis"
NO_SENTINEL_FILE = "SMP1996.ods"
SINGLE_ID_FILE = "SCM1999.ods"
FOREIGN_MONTH = "1990-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def wide_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by month, service and group: (ano, mes, ano_mes, servico, grupo_economico, q_tot, q_res, q_5d).

    Aggregated on small keys; names are attached to the result.
    """
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_returnflag",
        (F.year("l_shipdate") * 12 + F.month("l_shipdate") - 1).alias("month_no"),
        (F.col("l_quantity") <= 40).alias("resolved"), (F.col("l_quantity") <= 5).alias("fast"),
    )
    owners = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").join(
        table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"),
        F.col("o_custkey") == F.col("c_custkey"),
    ).select("o_orderkey", "c_nationkey")
    counts = (
        lines.join(owners, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("month_no", "l_returnflag", "c_nationkey")
        .agg(F.count(F.lit(1)).alias("q_tot"), F.count_if("resolved").alias("q_res"),
             F.count_if("fast").alias("q_5d"))
    )
    nation = F.col("n_nationkey")
    name = F
    for key, spelling in enumerate(SPELLINGS):
        name = name.when(nation == key, spelling)
    flag = F.col("l_returnflag")
    year, month = F.floor(F.col("month_no") / 12).cast("int"), (F.col("month_no") % 12 + 1).cast("int")
    return counts.join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == nation).select(
        year.alias("ano"), month.alias("mes"), month_key(year, month).alias("ano_mes"),
        F.when(flag == "A", "SMP").when(flag == "N", "STFC").otherwise("SCM").alias("servico"),
        name.otherwise(F.lower("n_name")).alias("grupo_economico"), "q_tot", "q_res", "q_5d",
    )


def _metrics() -> list[tuple[str, Column, Column]]:
    """(metric name, value, condition)"""
    def rate(factor: float, part: str) -> Column:
        return F.lit(factor) * F.col(part) / F.col("q_tot")

    everywhere = F.lit(True)
    return [
        ("Total de Solicitações", F.col("q_tot").cast("double"), everywhere),
        ("Taxa de Resolvidas no Período", rate(100.0, "q_res"), everywhere),
        (RATE_5D, rate(100.0, "q_5d"), everywhere),
        ("Quantidade de resolvidas", F.col("q_res").cast("double"), F.col("servico") == "SCM"),
        ("Índice de Desempenho no Atendimento", rate(200.0, "q_5d"), F.col("servico") == "STFC"),
    ]


def staging_from(wide: DataFrame) -> DataFrame:
    """Long staging rows, all metrics from one pass over the wide rows."""
    metrics = F.array(*[
        F.struct(F.lit(name).alias("variavel"), F.when(cond, value).alias("valor"))
        for name, value, cond in _metrics()
    ])
    return (
        wide.withColumn("m", F.explode(metrics)).filter("m.valor is not null")
        .select("ano", "mes", "ano_mes", "servico", "grupo_economico", "m.variavel", "m.valor",
                F.concat("servico", F.col("ano").cast("string"), F.lit(".ods")).alias("arquivo_origem"))
    )


def staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging_from(wide_base(spark, sf_dir))


def cell_text(metric: Column, value: Column) -> Column:
    """Counts as whole numbers, rates with two digits and a decimal comma."""
    whole = metric.isin("Total de Solicitações", "Quantidade de resolvidas")
    return F.when(whole, value.cast("bigint").cast("string")).otherwise(
        F.replace(rounded(value, 2).cast("string"), F.lit("."), F.lit(","))
    )


def sheet_grid(long: DataFrame) -> DataFrame:
    """Sheets, one per service and year, as sheet rows with status rows.

    Two title rows, the header row, a row per group and metric, and one repeated
    row at the end. Holds text instead of a number, a negative value, a column that
    is no period, one without a header, one of another year, a sheet without the sentinel and one without a metric column.
    """
    name = F.col("arquivo")
    months = [F.max(F.when(F.col("mes") == m, F.col("texto"))).alias(f"m{m}") for m in range(1, 13)]
    table_rows = (
        long.withColumnRenamed("arquivo_origem", "arquivo")
        .filter((name != SINGLE_ID_FILE) | (F.col("variavel") == RATE_5D))
        .withColumn("texto", cell_text(F.col("variavel"), F.col("valor")))
        .groupBy("arquivo", "servico", "ano", "grupo_economico", "variavel").agg(*months)
    )
    # A sheet holds one row per group and metric, far below any size that matters.
    sheet = F.array_sort(F.collect_list(F.struct("grupo_economico", "variavel", F.array(*[f"m{m}" for m in range(1, 13)]).alias("textos"))))
    sheets = table_rows.groupBy("arquivo", "servico", "ano").agg(sheet.alias("rows"))

    def ids(group: Column, metric: Column) -> Column:
        return F.when(name == SINGLE_ID_FILE, F.array(group)).otherwise(F.array(group, metric))

    # Under the column that is no period, the blank header and the month of another year.
    extra = F.array(F.lit("x"), F.lit("7"), F.lit("8"))

    def data(r: Column, i: Column) -> Column:
        texts = F.transform(r.textos, lambda t, m: F.when((i == 0) & (m == 0), "n/d")
                            .when((i == 1) & (m == 1), "-5,5").otherwise(t))
        return F.concat(ids(r.grupo_economico, r.variavel), texts, extra)

    year = F.col("ano")
    headers = [
        F.when(year % 3 == 0, month_key(year, F.lit(m)))
        .when(year % 3 == 1, F.concat(F.lit(abbr + "/"), year.cast("string")))
        .otherwise(abbr.lower())
        for m, abbr in enumerate(MONTHS, 1)
    ]
    sentinel = F.when(name == NO_SENTINEL_FILE, "Operadora").otherwise("Grupo Econômico ")
    top = F.array(
        F.array(F.lit("Indicadores de Atendimento")),
        F.array(F.concat_ws(" ", "servico", year.cast("string"))),
        F.concat(ids(sentinel, F.lit("Variável")), F.array(*headers),
                 F.array(F.lit("OUTROS"), F.when(name == SINGLE_ID_FILE, "OUTROS 2"), F.lit(FOREIGN_MONTH))),
    )
    first = F.get("rows", F.lit(0))
    repeated = F.array(F.concat(ids(first.grupo_economico, first.variavel),
                                F.array_repeat(F.lit("999"), 12), extra))
    grid = F.concat(top, F.transform("rows", data), repeated)
    return with_status(sheets.select("arquivo", F.posexplode(grid).alias("row_idx", "cells")))


_XML_HEAD = (
    '<?xml version="1.0" encoding="UTF-8"?><office:document-content '
    'xmlns:office="urn:oasis:names:tc:opendocument:xmlns:office:1.0" '
    'xmlns:table="urn:oasis:names:tc:opendocument:xmlns:table:1.0" '
    'xmlns:text="urn:oasis:names:tc:opendocument:xmlns:text:1.0">'
    "<office:body><office:spreadsheet><table:table>"
)
_XML_TAIL = "</table:table></office:spreadsheet></office:body></office:document-content>"


@pandas_udf(BinaryType())
def _zipped(documents: pd.Series) -> pd.Series:
    def pack(document: str) -> bytes:
        data = io.BytesIO()
        with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as book:
            book.writestr("content.xml", document)
        return data.getvalue()

    return documents.map(pack)


def workbook_files(rows: DataFrame) -> DataFrame:
    """Workbook files (arquivo, length, modificationTime, content) that hold the sheet rows."""
    def cell(c: Column) -> Column:
        text = F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")),
                         F.lit("  "), F.lit('<text:s text:c="2"/>'))
        return F.when(c.isNull(), "<table:table-cell/>").otherwise(F.concat(
            F.lit('<table:table-cell office:value-type="string"><text:p>'), text,
            F.lit("</text:p></table:table-cell>")))

    row_xml = F.concat(F.lit("<table:table-row>"), F.array_join(F.transform("cells", cell), ""),
                       F.lit("</table:table-row>"))
    ordered = F.array_sort(F.collect_list(F.struct("row_idx", row_xml.alias("xml"))))
    body = F.array_join(F.transform(ordered, lambda r: r.xml), "")
    return (
        rows.filter("row_idx is not null").groupBy("arquivo")
        .agg(F.concat(F.lit(_XML_HEAD), body, F.lit(_XML_TAIL)).alias("xml"))
        .select("arquivo", _zipped("xml").alias("content"))
        .select("arquivo", F.octet_length("content").cast("bigint").alias("length"),
                F.lit("2024-01-01 00:00:00").cast("timestamp").alias("modificationTime"), "content")
    )


def broken_files(long: DataFrame) -> DataFrame:
    """One file per service that is no workbook."""
    return long.select("servico").distinct().select(
        F.concat("servico", F.lit("0000.ods")).alias("arquivo"), F.lit(9).cast("bigint").alias("length"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("modificationTime"),
        F.lit("not a zip").cast("binary").alias("content"),
    )
