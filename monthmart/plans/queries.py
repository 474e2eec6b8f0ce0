"""Registered queries: every operator of the package over the given tables.

Operators downstream of the load read the tables of a mart that is built from the
order tables once per session and folder; the load itself is a query as well.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ..constants import MONTHS, STAGING_COLUMNS
from ..functions import (
    clean_name, clean_report_name, group_name, nonnegative, parse_number, parse_period, quoted, rounded,
)
from ..operators import dimensions, fact, grid, pivot, quality, report, statistics, variation
from ..operators.quality import AcceptedValues, NotNull, Relationship, Unique
from ..sources import (
    append_once, bulk_load, file_metadata, first_existing, headings, inventory, is_workbook, load_summary, loaded_rows,
    materialize, resource_catalog, save_table, save_view, scratch_path, sheet_rows, write_load,
)
from . import fixture
from .carried import read_variation, update_variation
from .ingest import cached_long_rows, files_to_open, merge_runs
from .mart import ConstraintError, Mart, build_mart, open_mart

Query = Callable[[SparkSession, str], DataFrame]

# Selections used by the report queries.
YEAR = "2000"
LAST_MONTHS = ("2000-10", "2000-11", "2000-12")
CHOSEN = ("ALGAR", "OI", "TIM", "VIVO")
SERVICE = "Serviço Móvel Pessoal"
# The pages carry a language and a number in their address, and headings of level 1.
PAGE_CODE = r"/(en|fr|de|es)/(\d+)"


_built: dict[tuple, object] = {}


def build_or_reuse(spark: SparkSession, key: str, build: Callable[[], object]) -> object:
    """Result of ``build`` for this key, made once per Spark application; forget() makes it anew."""
    full = (spark.sparkContext.applicationId, key)
    if full not in _built:
        _built[full] = build()
    return _built[full]


def forget() -> None:
    _built.clear()


def mart(spark: SparkSession, sf_dir: str) -> Mart:
    return build_or_reuse(
        spark, f"mart {sf_dir}",
        lambda: build_mart(fixture.staging(spark, sf_dir), scratch_path(spark, "mart")),
    )


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, the form in which results are compared."""
    return df.select(*[
        quoted(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType)
        else quoted(f.name)
        for f in df.schema.fields
    ])


def six(name: str) -> Column:
    return rounded(F.col(name), 6).alias(name)


# --- sources ---------------------------------------------------------------------------

def headings_catalog(spark, sf_dir):
    found = headings(fixture.table(spark, sf_dir, "pages"), "page_id", "url", level=1)
    return resource_catalog(found, "url", PAGE_CODE).drop("url")


# What a page shows of this is one heading.
TRAPS = (
    "<!-- <h1>old</h1> --><title><h1>none</h1></title><script>var a = '<h1>js</h1>';</script>"
    "<h1 title='a>b' data-x=\"</h1>\">O&apos;Neil<br>&amp; <!-- not --><b>c&#111;</b></h1><style>h1 > b {}</style>"
)


def headings_marked(spark, sf_dir):
    """The headings of pages that begin with marks that only look like some."""
    pages = fixture.table(spark, sf_dir, "pages").withColumn("html", F.concat(F.lit(TRAPS), "html"))
    found = headings(pages, "page_id", "url", level=1)
    return resource_catalog(found, "url", PAGE_CODE).drop("url")


def title_parse(spark, sf_dir):
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    service = F.when(status == "F", "SMP").when(status == "O", "STFC").otherwise("SCM")
    year = F.year("o_orderdate").cast("string")
    title = (
        F.when(priority == "1-URGENT", F.concat(F.lit("Índice - "), service, F.lit(" - "), year))
        .when(priority == "2-HIGH", F.concat(F.lit("Índice "), service, F.lit("-"), year))
        .when(priority == "3-MEDIUM", F.concat(F.lit("Relatório "), year))
        .when(priority == "4-NOT SPECIFIED", F.concat(F.lower(service), F.lit(" - "), year))
        .otherwise(F.concat(F.lit("x"), service, F.lit("  -  "), year, F.lit(" (v2)")))
    )
    titles = fixture.table(spark, sf_dir, "orders").groupBy(title.alias("titulo")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return resource_catalog(titles)


def _files(spark, sf_dir) -> DataFrame:
    """Workbook files that hold the staging rows, and some that are none."""
    staging = mart(spark, sf_dir).staging
    books = fixture.workbook_files(fixture.sheet_grid(staging))
    return books.unionByName(fixture.broken_files(staging))


def workbook_signature(spark, sf_dir):
    return file_metadata(_files(spark, sf_dir)).select(
        "arquivo", "servico", "ano_arquivo", is_workbook(F.col("content")).alias("valido")
    )


def load_count(spark, sf_dir):
    return load_summary(_files(spark, sf_dir), is_workbook(F.col("content")))


def workbook_cells(spark, sf_dir):
    return grid.cells(sheet_rows(_files(spark, sf_dir)))


def load_report(spark, sf_dir):
    rows = materialize(sheet_rows(_files(spark, sf_dir)), "sheet-rows")
    return grid.layout_report(rows).drop("erro")


def workbook_long(spark, sf_dir):
    return grid.grid_to_long(materialize(sheet_rows(_files(spark, sf_dir)), "sheet-rows"))


def cache_incremental(spark, sf_dir):
    """Two runs over one cache: files up to 1998, then all files."""
    path, files = scratch_path(spark, "cache"), materialize(_files(spark, sf_dir), "files")
    early = file_metadata(files).filter("ano_arquivo < 1999").drop("servico", "ano_arquivo")
    first = cached_long_rows(early, path).select("lote").distinct().withColumnRenamed("lote", "primeiro")
    rows = cached_long_rows(files, path)
    per_file = rows.groupBy("arquivo_origem", "lote").agg(F.count(F.lit(1)).alias("linhas"))
    return per_file.join(first, F.col("lote") == F.col("primeiro"), "left").select(
        "arquivo_origem", "linhas", F.col("primeiro").isNotNull().alias("do_cache")
    )


def cache_choice(spark, sf_dir):
    """Which files a load opens if those of one service and the broken ones wait, and three ranges of times may be pushed."""
    year = F.col("ano_arquivo")
    days = F.when(year > 0, (year - 1990) * 365) + F.octet_length("servico") * 7 + F.ascii("servico") + F.ascii(F.substring("servico", 2, 1))
    files = file_metadata(_files(spark, sf_dir)).select(
        "arquivo", (F.lit("1990-01-01").cast("timestamp") + F.make_dt_interval(F.coalesce(days, F.lit(0)))).alias("modificationTime"),
        ((F.col("servico") == "SCM") | (year == 0)).alias("pendente"),
    )
    files = materialize(files, "files")
    opened = files_to_open(files, files.withColumnRenamed("arquivo", "arquivo_origem"), few=0, most=3)
    return files.join(opened.select("arquivo", F.lit(True).alias("aberto")), "arquivo", "left").select(
        "arquivo", "pendente", F.coalesce("aberto", F.lit(False)).alias("aberto")
    )


def cache_merge(spark, sf_dir):
    """Two runs of like size over one cache, merged: the rows of each file and the number of runs they are in."""
    path, files = scratch_path(spark, "cache"), materialize(_files(spark, sf_dir), "files")
    cached_long_rows(file_metadata(files).filter("ano_arquivo < 1996").drop("servico", "ano_arquivo"), path)
    cached_long_rows(files, path)
    merge_runs(files, path, tier=1_000_000, least=2)
    rows = cached_long_rows(files, path)
    per_file = rows.groupBy("arquivo_origem").agg(F.count(F.lit(1)).alias("linhas"))
    runs = rows.select("lote").distinct().count()
    return per_file.withColumn("lotes", F.lit(runs).cast("bigint"))


def staging_load(spark, sf_dir):
    path = scratch_path(spark, "staging")
    bulk_load(fixture.staging(spark, sf_dir), path, truncate=False)
    return plain(spark.read.parquet(path).select(*STAGING_COLUMNS).withColumn("valor", six("valor")))


def staging_append_once(spark, sf_dir):
    """Two loads by id, of which one was killed after it wrote other rows; then both again. How often rows of a year are there."""
    path, staging = scratch_path(spark, "staging"), mart(spark, sf_dir).staging
    early, late = staging.filter("ano < 1997"), staging.filter("ano >= 1997")
    append_once(early, path, "early")
    write_load(staging, path, "late")  # killed before the ledger
    done = [append_once(rows, path, name) for name, rows in (("late", late), ("early", early), ("late", staging))]
    rows = loaded_rows(spark, path, staging.select(*STAGING_COLUMNS)._jdf.schema().toDDL())
    return rows.groupBy("ano", "carga").agg(F.count(F.lit(1)).alias("n")).withColumn("feitas", F.lit(sum(done)))


def table_inventory(spark, sf_dir):
    m = mart(spark, sf_dir)
    named = {"staging_ida": m.staging, "fato_ida": m.fato, "view_variacao": m.pivot_view()}
    for name, df in named.items():
        save_view(df, name)
    return inventory(spark, list(named))


# --- sheets to long rows ---------------------------------------------------------------

def grid_to_long(spark, sf_dir):
    sheets = materialize(fixture.sheet_grid(mart(spark, sf_dir).staging), "sheets")
    return grid.grid_to_long(sheets)


def number_parse(spark, sf_dir):
    price = F.col("l_extendedprice").cast("decimal(12,2)").cast("string")
    comma = F.replace(price, F.lit("."), F.lit(","))
    kind = F.concat("l_returnflag", "l_linestatus")
    text = (
        F.when(kind == "AF", comma).when(kind == "AO", F.concat(F.lit(" "), price, F.lit(" ")))
        .when(kind == "NF", F.concat(comma, F.lit(",5"))).when(kind == "NO", F.lit("n/d"))
        .when(kind == "RF", F.concat(comma, F.lit("e1"))).otherwise(F.concat(F.lit("-"), comma))
    )
    return plain(
        fixture.table(spark, sf_dir, "lineitem").select(kind.alias("forma"), parse_number(text).alias("v"))
        .groupBy("forma").agg(
            F.count(F.lit(1)).alias("n"), F.count("v").alias("lidos"),
            F.sum(F.col("v").cast("decimal(18,2)")).alias("soma"))
    )


def period_parse(spark, sf_dir):
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    year = F.year("o_orderdate")
    y, m = year.cast("string"), F.month("o_orderdate")
    abbr = F.get(F.array(*[F.lit(a) for a in MONTHS]), m - 1)
    text = (
        F.when(priority == "1-URGENT", F.format_string("%d-%02d", year, m))
        .when(priority == "2-HIGH", F.concat(F.lit("ref "), y, F.lit("."), m.cast("string")))
        .when(priority == "3-MEDIUM", F.concat(F.lit("  "), F.lower(abbr), F.lit("/"), y, F.lit(" ")))
        .when(priority == "4-NOT SPECIFIED", abbr)
        .when(status == "F", "OUTROS").when(status == "O", F.concat(F.lit("XYZ/"), y))
        .otherwise(F.concat(F.lit("Total "), y))
    )
    texts = fixture.table(spark, sf_dir, "orders").groupBy(text.alias("texto"), year.alias("ano_arquivo")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return texts.withColumn("p", parse_period(F.col("texto"), F.col("ano_arquivo"))).select(
        "texto", "ano_arquivo", "n", "p.ano", "p.mes"
    )


def nonneg_filter(spark, sf_dir):
    value = F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit(float("nan"))).otherwise(F.col("c_acctbal"))
    return fixture.table(spark, sf_dir, "customer").select("c_custkey", value.alias("valor")).filter(
        nonnegative(F.col("valor"))
    )


# --- names -----------------------------------------------------------------------------

def _spelled(spark, sf_dir) -> DataFrame:
    segment = F.col("c_mktsegment")
    name = (
        F.when(segment == "BUILDING", F.concat(F.lit(" Sercomtel  "), "c_name", F.lit(" (a) (b)")))
        .when(segment == "HOUSEHOLD", F.concat("c_name", F.lit(" **")))
        .when(segment == "MACHINERY", F.lit(None).cast("string"))
        .otherwise(F.concat("c_name", F.lit(" ("), F.lower(segment), F.lit(") *  s.a. ")))
    )
    return fixture.table(spark, sf_dir, "customer").select("c_custkey", name.alias("nome"))


def group_clean(spark, sf_dir):
    return _spelled(spark, sf_dir).select("c_custkey", clean_name(F.col("nome")).alias("nome"))


def group_alias(spark, sf_dir):
    return mart(spark, sf_dir).summary.select("grupo_economico").distinct().withColumn(
        "nome_grupo", group_name(F.col("grupo_economico"))
    )


def report_name_clean(spark, sf_dir):
    return _spelled(spark, sf_dir).select("c_custkey", clean_report_name(F.col("nome")).alias("nome"))


# --- dimensions and fact ---------------------------------------------------------------

def dim_time(spark, sf_dir):
    return dimensions.build_dim_tempo(mart(spark, sf_dir).summary)


def dim_group(spark, sf_dir):
    return dimensions.build_dim_grupo(mart(spark, sf_dir).summary).drop("id_grupo")


def dim_group_keys(spark, sf_dir):
    keys = dimensions.build_dim_grupo(mart(spark, sf_dir).summary)
    return keys.agg(F.count("id_grupo").alias("n"), F.countDistinct("id_grupo").alias("distintos"),
                    F.min("id_grupo").alias("menor"), F.max("id_grupo").alias("maior"))


def dim_service(spark, sf_dir):
    return dimensions.build_dim_servico(mart(spark, sf_dir).summary).drop("id_servico")


def dim_insert_absent(spark, sf_dir):
    m = mart(spark, sf_dir)
    old = m.dim_tempo.filter("ano < 1999")
    both = dimensions.insert_absent(old, dimensions.month_attributes(m.summary), ["ano_mes"])
    return dimensions.assign_keys(both, "id_tempo", "ano_mes", chronological=True)


def dim_upsert(spark, sf_dir):
    new = dimensions.service_attributes(mart(spark, sf_dir).summary)
    code = F.col("codigo_servico")
    old = new.filter(code != "SCM").select(
        F.when(code == "SMP", 7).otherwise(9).alias("id_servico"), "codigo_servico",
        F.lit("antigo").alias("nome_servico"), F.lit("antigo").alias("descricao"),
    )
    return dimensions.assign_keys(
        dimensions.upsert(old, new, ["codigo_servico"], "id_servico"), "id_servico", "codigo_servico"
    )


def mart_load(spark, sf_dir):
    """The whole load from the order tables, into tables of its own."""
    m = build_mart(fixture.staging(spark, sf_dir), scratch_path(spark, "mart"))
    return plain(m.fato.drop("id_grupo", "id_servico", "data_carga"))


def mart_reload(spark, sf_dir):
    """A mart of some groups and years, then all of them under the same path: keys given before stay."""
    path, staging = scratch_path(spark, "mart"), mart(spark, sf_dir).staging
    named = staging.filter("lower(grupo_economico) < 'm' AND ano < 1996")
    before = build_mart(named, path).dim_grupo.select("nome_grupo", F.col("id_grupo").alias("antes"))
    after = build_mart(staging, path)
    groups = after.dim_grupo.join(before, "nome_grupo", "left")
    used = after.fato.select(F.col("id_grupo").alias("usado"), "nome_grupo").distinct()
    return groups.join(used, "nome_grupo").select(
        "nome_grupo", F.col("antes").isNotNull().alias("antiga"),
        F.coalesce(F.col("antes") == F.col("id_grupo"), F.lit(True)).alias("mantida"),
        (F.col("usado") == F.col("id_grupo")).alias("no_fato"),
    )


def mart_partial_reload(spark, sf_dir):
    """Three loads: all rows, then one year with other values and one left out, then the same again. Who wrote what is read last."""
    path, staging = scratch_path(spark, "mart"), mart(spark, sf_dir).staging
    first = build_mart(staging, path)
    again = staging.filter("ano != 1997").withColumn("valor", F.when(F.col("ano") == 1996, F.col("valor") / 2).otherwise(F.col("valor")))
    second = build_mart(again, path)
    third = build_mart(again, path)
    own = {f.carga for f in first.version.folders}
    folders = [(f.tabela, f.ano, f.carga in own, third.version == second.version) for f in open_mart(spark, path).version.folders if f.by_year]
    listed = spark.createDataFrame(folders, "tabela string, ano int, da_primeira boolean, inalterada boolean")
    sums = second.fato.groupBy("ano").agg(F.sum("total_solicitacoes").cast("double").alias("total"), F.sum(variation.RATE).cast("double").alias("taxas"))
    return plain(listed.join(sums, "ano").withColumn("taxas", six("taxas")))


def published_after_reload(spark, sf_dir):
    """Rows by year of the fact table by its name in the catalogue, named before the load that they come from."""
    path, staging = scratch_path(spark, "mart"), mart(spark, sf_dir).staging
    prefix = f"q{uuid.uuid4().hex}_"
    names = build_mart(staging.filter("ano < 1998"), path).publish(prefix)
    build_mart(staging, path)
    try:
        fact_rows = spark.newSession().table(f"{prefix}fato_ida").groupBy("ano").agg(
            F.count(F.lit(1)).alias("n"), F.countDistinct("id_grupo").alias("grupos")).collect()
    finally:
        for name in names:
            spark.sql(f"DROP VIEW IF EXISTS {name}")
    return spark.createDataFrame([tuple(r) for r in fact_rows], "ano int, n bigint, grupos bigint")


def load_guard(spark, sf_dir):
    """Rows of a mart before, after a load without rows, and after one that breaks a constraint."""
    path, staging = scratch_path(spark, "mart"), mart(spark, sf_dir).staging
    build_mart(staging, path)
    counts = []

    def count(step: str) -> None:
        opened = open_mart(spark, path)
        for name in ("staging", "dim_tempo", "dim_grupo", "dim_servico", "fato"):
            counts.append(getattr(opened, name).agg(F.count(F.lit(1)).alias("n")).select(
                F.lit(step).alias("passo"), F.lit(name).alias("tabela"), "n"))

    count("antes")
    build_mart(staging.filter(F.lit(False)), path)
    count("vazia")
    try:
        build_mart(staging.withColumn("servico", F.repeat("servico", F.lit(9))), path)
    except ConstraintError:
        count("recusada")
    return reduce(DataFrame.unionByName, counts)


def mart_reopened(spark, sf_dir):
    """The trend set of a mart that is read back from its path alone."""
    path = scratch_path(spark, "mart")
    build_mart(mart(spark, sf_dir).staging, path)
    return open_mart(spark, path).trend()


def staging_truncate(spark, sf_dir):
    """A truncating load of all rows, one of the first years, then one without rows, which leaves the table as it is."""
    path, rows = scratch_path(spark, "staging"), mart(spark, sf_dir).staging
    bulk_load(rows, path)
    bulk_load(rows.filter("ano < 1998"), path)
    bulk_load(rows.limit(0), path)
    return spark.read.parquet(path).groupBy("ano").agg(F.count(F.lit(1)).alias("n"))


def workbook_mart(spark, sf_dir):
    """From workbook files through the cache to the fact table."""
    files = materialize(_files(spark, sf_dir), "files")
    long = cached_long_rows(files, scratch_path(spark, "cache"))
    m = build_mart(long, scratch_path(spark, "mart"))
    return plain(m.fato.drop("id_grupo", "id_servico", "data_carga"))


def fact_build(spark, sf_dir):
    m = mart(spark, sf_dir)
    summary = fact.summarise_staging(m.staging)
    return plain(fact.build_fact(summary, m.dim_tempo, m.dim_grupo, m.dim_servico))


def fact_reload(spark, sf_dir):
    """All years, then one year again with other values: the other years stay."""
    rows = mart(spark, sf_dir).fato.drop("id_grupo", "id_servico", "data_carga")
    path = scratch_path(spark, "fato")
    save_table(rows, path, ["ano"])
    again = rows.filter(F.col("ano") == int(YEAR)).withColumn(
        "total_solicitacoes", F.col("total_solicitacoes") + 1
    )
    return plain(save_table(again, path, ["ano"], only_partitions=True))


def column_defaults(spark, sf_dir):
    """Groups are active and rows carry their load time unless stated otherwise."""
    groups = dimensions.with_load_time(dimensions.build_dim_grupo(mart(spark, sf_dir).summary))
    return groups.agg(F.count_if("ativo").alias("ativos"), F.count("data_carga").alias("datados"))


def load_gate(spark, sf_dir):
    """Whether a load would go on: with all rows, and with those the value filter takes away."""
    staging = mart(spark, sf_dir).staging
    gates = [("todas", quality.has_rows(staging)),
             ("negativas", quality.has_rows(staging.filter(~nonnegative(F.col("valor")))))]
    return spark.createDataFrame(gates, "linhas string, segue boolean")


# --- variation -------------------------------------------------------------------------

def _rows(spark, sf_dir) -> DataFrame:
    m = mart(spark, sf_dir)
    return variation.rated_rows(m.fato, m.dim_tempo)


def market_mean_groups(spark, sf_dir):
    means = variation.group_means(_rows(spark, sf_dir))
    return plain(variation.market_means(means).select("ano_mes", six("valor_mercado")))


def market_mean_flat(spark, sf_dir):
    return plain(variation.market_means(_rows(spark, sf_dir)).select("ano_mes", six("valor_mercado")))


def variation_market(spark, sf_dir):
    means = variation.group_means(_rows(spark, sf_dir))
    changes = variation.market_variation(variation.market_means(means))
    return plain(changes.select("ano_mes", six("valor_mercado"), six("var_mercado")))


def variation_group(spark, sf_dir):
    own = variation.individual_variation(variation.group_means(_rows(spark, sf_dir)))
    return plain(own.select("ano_mes", "nome_grupo", six("ida"), six("var_individual")))


def variation_group_service(spark, sf_dir):
    own = variation.individual_variation(_rows(spark, sf_dir), ("nome_grupo", "codigo_servico"))
    return plain(own.select("ano_mes", "nome_grupo", "codigo_servico", six("var_individual")))


def variation_group_mixed(spark, sf_dir):
    own = variation.individual_variation(_rows(spark, sf_dir), ("nome_grupo",), ("codigo_servico",))
    return plain(own.select("ano_mes", "nome_grupo", "codigo_servico", six("var_individual")))


def _variation(df: DataFrame) -> DataFrame:
    return plain(df.select("ano_mes", "nome_grupo", six("var_mercado"), six("var_individual"), six("diferenca")))


def variation_month(spark, sf_dir):
    return _variation(mart(spark, sf_dir).variation())


def variation_carried(spark, sf_dir):
    """The variation kept from load to load: after a load with one year wrong, then the right one. Which years the second computed."""
    path, kept, staging = scratch_path(spark, "mart"), scratch_path(spark, "variation"), mart(spark, sf_dir).staging
    wrong = F.when(F.col("ano") == 1996, F.col("valor") / 2).otherwise(F.col("valor"))
    update_variation(build_mart(staging.withColumn("valor", wrong), path), kept)
    right = build_mart(staging, path)
    computed = update_variation(right, kept)
    found = read_variation(right, kept).withColumn("recalculado", F.col("ano").isin(computed))
    return plain(found.select("ano_mes", "nome_grupo", six("var_mercado"), six("var_individual"), six("diferenca"), "recalculado"))


def variation_row_lag(spark, sf_dir):
    return _variation(mart(spark, sf_dir).variation(mode="row"))


def variation_flat_market(spark, sf_dir):
    return _variation(mart(spark, sf_dir).variation(market="flat"))


def long_delta(spark, sf_dir):
    return plain(mart(spark, sf_dir).long_delta())


def long_delta_row_lag(spark, sf_dir):
    return plain(mart(spark, sf_dir).long_delta(mode="row", by_service=False))


def pivot_view(spark, sf_dir):
    return plain(pivot.ordered(mart(spark, sf_dir).pivot_view()))


def pivot_view_row_lag(spark, sf_dir):
    m = mart(spark, sf_dir)
    return plain(pivot.ordered(pivot.pivot_report(m.variation(mode="row"), m.groups)))


def pivot_avg(spark, sf_dir):
    m = mart(spark, sf_dir)
    return plain(pivot.ordered(pivot.pivot_report(m.long_delta(), m.groups, market="avg")))


def pivot_avg_row_lag(spark, sf_dir):
    m = mart(spark, sf_dir)
    delta = m.long_delta(mode="row", by_service=False)
    return plain(pivot.ordered(pivot.pivot_report(delta, m.groups, market="avg")))


def pivot_unfilled(spark, sf_dir):
    m = mart(spark, sf_dir)
    return plain(pivot.ordered(pivot.pivot_report(m.variation(), m.groups, fill=None)))


def report_source(spark, sf_dir):
    """The first report view that exists: the preferred one does not."""
    m = mart(spark, sf_dir)
    save_view(pivot.ordered(pivot.pivot_report(m.long_delta(), m.groups, market="avg")), "variacao_por_linha")
    return plain(first_existing(spark, ["variacao_por_grupo_inexistente", "variacao_por_linha"]))


# --- reports ---------------------------------------------------------------------------

def signed_masked_delta(spark, sf_dir):
    m = mart(spark, sf_dir)
    return report.signed_masked(report.long_cells(m.variation(), m.dim_grupo))


def merged_names(spark, sf_dir):
    """Services of a group noted in brackets after its name, merged into one."""
    rows = mart(spark, sf_dir).long_delta().select(
        F.col("ano_mes").alias("Mes"),
        F.concat("nome_grupo", F.lit(" ("), "codigo_servico", F.lit(") *")).alias("Operadora"),
        F.col("diferenca").cast("double").alias("Delta"),
    )
    return plain(report.merge_names(report.signed_masked(rows)).withColumn("Delta", six("Delta")))


def trend_natural(spark, sf_dir):
    return mart(spark, sf_dir).trend()


def trend_surrogate(spark, sf_dir):
    return mart(spark, sf_dir).trend(surrogate=True)


def service_series(spark, sf_dir):
    return report.service_series(mart(spark, sf_dir).trend(), SERVICE, ["OI", "TIM"], ["1999", YEAR])


def distinct_values(spark, sf_dir):
    trend = mart(spark, sf_dir).trend()
    years = report.distinct_sorted(trend, report.year_of(F.col("ano_mes")), "valor")
    services = report.distinct_sorted(trend, F.col("nome_servico"), "valor")
    return years.select(F.lit("ano").alias("lista"), "valor").unionByName(
        services.select(F.lit("servico").alias("lista"), "valor")
    )


def default_selection(spark, sf_dir):
    return report.default_selection(mart(spark, sf_dir).report_long())


def default_trend_selection(spark, sf_dir):
    return report.default_trend_selection(mart(spark, sf_dir).trend(), SERVICE)


def ranking(spark, sf_dir):
    return plain(report.ranking(mart(spark, sf_dir).report_long()).withColumn("media", six("media")))


def best_worst(spark, sf_dir):
    return plain(report.best_worst(report.filter_long(mart(spark, sf_dir).report_long(), [YEAR])))


def latest_row(spark, sf_dir):
    return plain(report.latest_row(mart(spark, sf_dir).pivot_view()))


def market_kpi(spark, sf_dir):
    return plain(report.market_kpi(mart(spark, sf_dir).trend(), [YEAR], LAST_MONTHS))


def market_column_kpi(spark, sf_dir):
    return plain(report.market_column_kpi(mart(spark, sf_dir).pivot_view(), [YEAR], LAST_MONTHS))


def kpi_counts(spark, sf_dir):
    m = mart(spark, sf_dir)
    return report.kpi_counts(m.report_long(), m.trend(), [YEAR], LAST_MONTHS, CHOSEN)


def delta_long(spark, sf_dir):
    return pivot.to_long(mart(spark, sf_dir).pivot_view(), CHOSEN)


def _year(spark, sf_dir) -> DataFrame:
    return report.filter_long(mart(spark, sf_dir).report_long(), [YEAR], (), CHOSEN)


def heat_matrix(spark, sf_dir):
    return pivot.heat_matrix(_year(spark, sf_dir), LAST_MONTHS)


def tabular_extract(spark, sf_dir):
    return plain(report.tabular_extract(_year(spark, sf_dir), CHOSEN))


def distribution(spark, sf_dir):
    boxes = report.distribution(mart(spark, sf_dir).report_long())
    return plain(boxes.select("Operadora", six("minimo"), six("q1"), six("mediana"), six("q3"), six("maximo"), "n"))


# --- quality ---------------------------------------------------------------------------

def _dirty(spark, sf_dir) -> dict[str, DataFrame]:
    """The mart's tables with known bad rows added."""
    m = mart(spark, sf_dir)

    def plus(clean: DataFrame, *rows: dict[str, Column]) -> DataFrame:
        """Copies of one row with the given columns changed."""
        dirty, model = clean, clean.limit(1)
        for row in rows:
            dirty = dirty.unionByName(model.select(*[
                row.get(f.name, quoted(f.name)).cast(f.dataType).alias(f.name) for f in clean.schema.fields
            ]))
        return dirty

    null = F.lit(None)
    tables = m.tables()
    months = tables["dim_tempo"]
    tables["dim_tempo"] = plus(
        months, {c: null for c in months.columns}
    ).unionByName(months.filter("ano_mes = '1996-01'").withColumn("id_tempo", F.lit(-1)))
    tables["dim_grupo_economico"] = plus(
        tables["dim_grupo_economico"],
        {"id_grupo": F.lit(-1), "nome_grupo": null},
        {"id_grupo": F.lit(-2), "nome_grupo": F.repeat(F.lit("X"), F.lit(101))},
    )
    tables["dim_servico"] = plus(
        tables["dim_servico"], {"id_servico": F.lit(-1), "codigo_servico": F.lit("XXX")}
    )
    tables["fato_ida"] = plus(
        tables["fato_ida"], {"id_grupo": F.lit(-9), "nome_grupo": F.lit("DESCONHECIDO")},
        {"id_servico": null, "codigo_servico": null},
    )
    return tables


def dq_not_null(spark, sf_dir):
    return quality.run_checks(_dirty(spark, sf_dir), [
        NotNull("dim_tempo", "ano_mes"), NotNull("dim_tempo", "ano"),
        NotNull("dim_grupo_economico", "nome_grupo"), NotNull("fato_ida", "codigo_servico"),
    ])


def dq_unique(spark, sf_dir):
    return quality.run_checks(_dirty(spark, sf_dir), [
        Unique("dim_tempo", ("ano_mes",)), Unique("dim_grupo_economico", ("nome_grupo",)),
    ])


def dq_accepted(spark, sf_dir):
    return quality.run_checks(_dirty(spark, sf_dir), [
        AcceptedValues("dim_servico", "codigo_servico", ("SMP", "STFC", "SCM")),
    ])


def dq_relationships(spark, sf_dir):
    return quality.run_checks(_dirty(spark, sf_dir), [
        Relationship("fato_ida", "nome_grupo", "dim_grupo_economico", "nome_grupo"),
        Relationship("fato_ida", "codigo_servico", "dim_servico", "codigo_servico"),
    ])


def dq_summary(spark, sf_dir):
    return quality.run_checks(_dirty(spark, sf_dir), quality.mart_checks())


def dq_constraints(spark, sf_dir):
    return quality.run_checks(_dirty(spark, sf_dir), quality.table_constraints())


def dq_mergeable(spark, sf_dir):
    """The constraints from statistics of parts: each table cut by its rows' hashes into three, merged two and one."""
    checks, taken = quality.table_constraints(), []
    for name, df in _dirty(spark, sf_dir).items():
        part = F.pmod(F.xxhash64(*df.columns), F.lit(3)).cast("int")
        taken.append(statistics.part_statistics(df, name, checks, part, F.lit("c")))
    parts = materialize(reduce(DataFrame.unionByName, taken), "statistics")
    return statistics.checks_from_statistics(parts, checks)


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        headings_catalog, headings_marked, title_parse, workbook_signature, load_count, workbook_cells, load_report,
        workbook_long, cache_incremental, cache_choice, cache_merge, staging_load, staging_append_once, table_inventory,
        grid_to_long, number_parse, period_parse, nonneg_filter,
        group_clean, group_alias, report_name_clean,
        dim_time, dim_group, dim_group_keys, dim_service, dim_insert_absent, dim_upsert,
        mart_load, mart_reload, mart_partial_reload, published_after_reload, load_guard, mart_reopened, staging_truncate, workbook_mart, fact_build, fact_reload, column_defaults, load_gate,
        market_mean_groups, market_mean_flat, variation_market, variation_group,
        variation_group_service, variation_group_mixed, variation_month, variation_carried, variation_row_lag,
        variation_flat_market, long_delta, long_delta_row_lag,
        pivot_view, pivot_view_row_lag, pivot_avg, pivot_avg_row_lag, pivot_unfilled,
        report_source,
        signed_masked_delta, merged_names, trend_natural, trend_surrogate, service_series,
        distinct_values, default_selection, default_trend_selection, ranking, best_worst, latest_row,
        market_kpi, market_column_kpi, kpi_counts, delta_long, heat_matrix, tabular_extract,
        distribution,
        dq_not_null, dq_unique, dq_accepted, dq_relationships, dq_summary, dq_constraints, dq_mergeable,
    )
}
