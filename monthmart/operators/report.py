"""Report tables: selections, rankings, KPIs, distributions.

The long report (Mes, Operadora, Delta) has a row for every month and group of the
pivot report, so its size is months x groups whatever the size of the fact table.
Selections are plain lists; an empty one selects everything.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import MARKET_COLUMN, OUTLIER_BOUND
from ..functions import clean_report_name, quoted, rounded
from .variation import RATE


def year_of(month: Column) -> Column:
    return F.substring(month, 1, 4)


def selected(col: Column, values: Sequence | None) -> Column:
    return col.isin(*values) if values else F.lit(True)


def signed(delta: Column) -> Column:
    """Own minus market; adding zero turns -0.0 into 0.0."""
    return -delta + F.lit(0.0)


def masked(delta: Column, bound: float = OUTLIER_BOUND) -> Column:
    return F.when(F.abs(delta) <= bound, delta)


def signed_masked(long: DataFrame) -> DataFrame:
    return long.withColumn("Delta", masked(signed(F.col("Delta"))))


def merge_names(long: DataFrame) -> DataFrame:
    """Groups of one report name become one, at their mean without the missing values."""
    return long.groupBy("Mes", clean_report_name(F.col("Operadora")).alias("Operadora")).agg(
        F.avg("Delta").alias("Delta")
    )


def long_cells(delta: DataFrame, dim_grupo: DataFrame, digits: int = 1, fill: float | None = 0) -> DataFrame:
    """(Mes, Operadora, Delta): what the pivot report shows, without its columns.

    Every group of the dimension has a row for every month of the variation rows; one without a value shows ``fill``.
    The months are one list, so groups meet them without a join.
    """
    months = delta.agg(F.array_sort(F.collect_set("ano_mes")).alias("m")).scalar()
    names = dim_grupo.filter(F.col("nome_grupo").isNotNull()).select(F.upper(F.trim("nome_grupo")).alias("Operadora")).distinct()
    cells = names.select(F.explode(months).alias("Mes"), "Operadora")
    found = delta.groupBy(F.col("ano_mes").alias("Mes"), F.col("nome_grupo").alias("Operadora")).agg(
        F.max(rounded(F.col("diferenca"), digits)).cast("double").alias("Delta")
    )
    return cells.join(found, ["Mes", "Operadora"], "left").withColumn("Delta", F.coalesce("Delta", F.lit(fill).cast("double")))


def report_long(delta: DataFrame, dim_grupo: DataFrame) -> DataFrame:
    """Long report from the variation rows."""
    return merge_names(signed_masked(long_cells(delta, dim_grupo)))


def filter_long(
    long: DataFrame,
    years: Sequence[str] = (),
    months: Sequence[str] = (),
    groups: Sequence[str] = (),
) -> DataFrame:
    return long.filter(
        selected(year_of(F.col("Mes")), years) & selected(F.col("Mes"), months)
        & selected(F.col("Operadora"), groups)
    )


def distinct_sorted(df: DataFrame, col: Column, name: str) -> DataFrame:
    return df.select(col.alias(name)).distinct().orderBy(name)


def _last(df: DataFrame, col: Column, k: int) -> DataFrame:
    return df.select(col.alias("valor")).distinct().orderBy(F.desc("valor")).limit(k)


def _first(df: DataFrame, col: Column, k: int) -> DataFrame:
    return df.select(col.alias("valor")).distinct().orderBy("valor").limit(k)


def default_selection(long: DataFrame, n_months: int = 3, n_groups: int = 4) -> DataFrame:
    """(selecao, valor): the latest year, its last months, the first groups by name."""
    months = long.select("Mes").distinct()
    year = months.agg(F.max(year_of(F.col("Mes"))).alias("valor"))
    in_year = months.join(year, year_of(F.col("Mes")) == F.col("valor"), "left_semi")
    parts = [
        year.select(F.lit("ano").alias("selecao"), "valor"),
        _last(in_year, F.col("Mes"), n_months).select(F.lit("mes").alias("selecao"), "valor"),
        _first(long, F.col("Operadora"), n_groups).select(F.lit("grupo").alias("selecao"), "valor"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def default_trend_selection(trend: DataFrame, service: str, n_groups: int = 5, n_years: int = 2) -> DataFrame:
    """(selecao, valor): the first groups by name and the last years of one service."""
    own = trend.filter(F.col("nome_servico") == service)
    return _first(own, F.col("nome_grupo"), n_groups).select(
        F.lit("grupo").alias("selecao"), "valor"
    ).unionByName(
        _last(own, year_of(F.col("ano_mes")), n_years).select(F.lit("ano").alias("selecao"), "valor")
    )


def ranking(long: DataFrame) -> DataFrame:
    """(Operadora, media): mean delta without missing values, lowest first."""
    return long.groupBy("Operadora").agg(F.avg("Delta").alias("media")).orderBy("media", "Operadora")


def best_worst(long: DataFrame) -> DataFrame:
    """One row: first and last group by mean delta, ties by name."""
    place = F.struct((-F.col("media")).alias("m"), F.col("Operadora").alias("g"))
    ranked = long.groupBy("Operadora").agg(F.avg("Delta").alias("media")).filter("media is not null")
    return ranked.agg(F.min(place).alias("b"), F.max(place).alias("w")).select(
        F.col("b.g").alias("melhor"), rounded(-F.col("b.m"), 2).alias("melhor_media"),
        F.col("w.g").alias("pior"), rounded(-F.col("w.m"), 2).alias("pior_media"),
    )


def latest_row(report: DataFrame) -> DataFrame:
    """Last month of the pivot report, as one row."""
    return report.orderBy(F.desc("Mes")).limit(1)


def trend(fact: DataFrame, dim_tempo: DataFrame, dim_servico: DataFrame, dim_grupo: DataFrame | None = None) -> DataFrame:
    """(ano_mes, nome_grupo, nome_servico, ida), names as the reports show them.

    Joins on the surrogate keys if the group dimension is given, else on the names
    and codes in the fact table.
    """
    if dim_grupo is None:
        named = fact.select("id_tempo", "nome_grupo", "codigo_servico", F.col(RATE).alias("ida")).join(
            dim_servico.select("codigo_servico", "nome_servico"), "codigo_servico"
        )
    else:
        named = (
            fact.select("id_tempo", "id_grupo", "id_servico", F.col(RATE).alias("ida"))
            .join(dim_grupo.select("id_grupo", "nome_grupo"), "id_grupo")
            .join(dim_servico.select("id_servico", "nome_servico"), "id_servico")
        )
    return named.join(dim_tempo.select("id_tempo", "ano_mes"), "id_tempo").select(
        "ano_mes", clean_report_name(F.col("nome_grupo")).alias("nome_grupo"), "nome_servico",
        F.col("ida").cast("double").alias("ida"),
    )


def service_series(
    trend_rows: DataFrame, service: str, groups: Sequence[str] = (), years: Sequence[str] = ()
) -> DataFrame:
    """(ano_mes, nome_grupo, ida) of one service, in month order."""
    return (
        trend_rows.filter(
            (F.col("nome_servico") == service) & selected(F.col("nome_grupo"), groups)
            & selected(year_of(F.col("ano_mes")), years)
        )
        .select("ano_mes", "nome_grupo", "ida")
        .orderBy("ano_mes", "nome_grupo")
    )


def market_kpi(trend_rows: DataFrame, years: Sequence[str] = (), months: Sequence[str] = ()) -> DataFrame:
    """One row: last selected month, its market change and the change of that in points.

    The market is the flat mean by month; changes run over the selected months only.
    """
    month = Window.orderBy("ano_mes")
    picked = trend_rows.filter(
        selected(year_of(F.col("ano_mes")), years) & selected(F.col("ano_mes"), months)
    )
    market = picked.groupBy("ano_mes").agg(F.avg("ida").alias("ida"))
    before = F.lag("ida").over(month)
    changes = market.withColumn("var", F.try_divide(F.col("ida") - before, before) * 100).withColumn(
        "antes", F.lag("var").over(month)
    )
    last = changes.agg(F.max(F.struct("ano_mes", "var", "antes")).alias("u"))
    return last.select(
        F.col("u.ano_mes").alias("ultimo_mes"),
        rounded(F.col("u.var"), 1).alias("var_mercado"),
        rounded(F.col("u.var") - F.col("u.antes"), 2).alias("delta_pp"),
    )


def market_column_kpi(
    report: DataFrame, years: Sequence[str] = (), months: Sequence[str] = (),
    market_column: str = MARKET_COLUMN,
) -> DataFrame:
    """The same from the market column of the pivot report."""
    value = quoted(market_column).cast("double")
    rows = report.filter(selected(year_of(F.col("Mes")), years) & selected(F.col("Mes"), months)).select(
        "Mes", value.alias("v")
    ).withColumn("antes", F.lag("v").over(Window.orderBy("Mes")))
    return rows.agg(F.max(F.struct("Mes", "v", "antes")).alias("u")).select(
        F.col("u.Mes").alias("ultimo_mes"),
        rounded(F.col("u.v"), 1).alias("var_mercado"),
        rounded(F.col("u.v") - F.col("u.antes"), 2).alias("delta_pp"),
    )


def kpi_counts(
    long: DataFrame, trend_rows: DataFrame,
    years: Sequence[str] = (), months: Sequence[str] = (), groups: Sequence[str] = (),
) -> DataFrame:
    """(indicador, n): groups shown, months selected, services in the selected years."""
    shown = filter_long(long, years, months, groups).agg(
        F.countDistinct("Operadora").alias("grupos"), F.countDistinct("Mes").alias("meses")
    )
    services = trend_rows.filter(selected(year_of(F.col("ano_mes")), years)).agg(
        F.countDistinct("nome_servico").alias("servicos")
    )
    return shown.unpivot([], ["grupos", "meses"], "indicador", "n").unionByName(
        services.unpivot([], ["servicos"], "indicador", "n")
    )


def distribution(long: DataFrame) -> DataFrame:
    """Box figures per group: extremes and quartiles, linearly interpolated."""
    q = F.percentile("Delta", [0.25, 0.5, 0.75])
    return long.groupBy("Operadora").agg(
        F.min("Delta").alias("minimo"), q.alias("q"), F.max("Delta").alias("maximo"),
        F.count("Delta").alias("n"),
    ).select(
        "Operadora", "minimo", F.get("q", F.lit(0)).alias("q1"), F.get("q", F.lit(1)).alias("mediana"),
        F.get("q", F.lit(2)).alias("q3"), "maximo", "n",
    )


def tabular_extract(long: DataFrame, groups: Sequence[str], digits: int = 2) -> DataFrame:
    """One row per month, one column per chosen group."""
    return long.groupBy("Mes").agg(
        *[rounded(F.max(F.when(F.col("Operadora") == g, F.col("Delta"))), digits).alias(g) for g in groups]
    ).orderBy("Mes")
