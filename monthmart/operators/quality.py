"""Declarative data-quality checks.

A check names a table and what must hold; ``run_checks`` gives one row per check
with its number of failures. Checks that only look at single rows (not null,
length) of one table share one pass; key checks work on counts per key, combined
before the shuffle, so a frequent key is one small row by the time it moves.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class NotNull:
    table: str
    column: str
    name = "not_null"

    def failing(self) -> Column:
        return F.col(self.column).isNull()


@dataclass(frozen=True)
class MaxLength:
    table: str
    column: str
    length: int
    name = "max_length"

    def failing(self) -> Column:
        return F.char_length(self.column) > self.length


@dataclass(frozen=True)
class Unique:
    """Non-null keys held by more than one row; each such key is one failure."""

    table: str
    columns: tuple[str, ...]
    name = "unique"

    @property
    def column(self) -> str:
        return ",".join(self.columns)


@dataclass(frozen=True)
class AcceptedValues:
    """Distinct non-null values outside the list; each is one failure."""

    table: str
    column: str
    values: tuple
    name = "accepted_values"


@dataclass(frozen=True)
class Relationship:
    """Rows whose non-null value has no match in the parent; each row is one failure."""

    table: str
    column: str
    parent: str
    field: str
    name = "relationships"


Check = NotNull | MaxLength | Unique | AcceptedValues | Relationship
_SCHEMA = ("checagem", "tabela", "coluna", "failures")


def _key_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    present = F.lit(True)
    for c in columns:
        present = present & F.col(c).isNotNull()
    return df.filter(present).groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows"))


def duplicated_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _key_counts(df, columns).filter("n_rows > 1")


def unexpected_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return _key_counts(df, [column]).filter(~F.col(column).isin(*values))


def orphan_keys(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child keys without a parent, with their number of rows."""
    keys = parent.select(F.col(field).alias(column))
    return _key_counts(child, [column]).join(keys, column, "left_anti")


def _row_checks(df: DataFrame, checks: Sequence[NotNull | MaxLength]) -> DataFrame:
    counted = df.agg(*[F.count_if(c.failing()).alias(f"f{i}") for i, c in enumerate(checks)])
    results = F.array(*[
        F.struct(F.lit(c.name).alias("checagem"), F.lit(c.table).alias("tabela"),
                 F.lit(c.column).alias("coluna"), F.col(f"f{i}").alias("failures"))
        for i, c in enumerate(checks)
    ])
    return counted.select(F.inline(results))


def _key_check(tables: Mapping[str, DataFrame], check: Check) -> DataFrame:
    df = tables[check.table]
    if isinstance(check, Unique):
        failures = duplicated_keys(df, check.columns).agg(F.count(F.lit(1)).alias("failures"))
    elif isinstance(check, AcceptedValues):
        failures = unexpected_values(df, check.column, check.values).agg(F.count(F.lit(1)).alias("failures"))
    else:
        orphans = orphan_keys(df, check.column, tables[check.parent], check.field)
        failures = orphans.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("failures"))
    return failures.select(
        F.lit(check.name).alias("checagem"), F.lit(check.table).alias("tabela"),
        F.lit(check.column).alias("coluna"), "failures",
    )


def run_checks(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """(checagem, tabela, coluna, failures, should_warn, should_error), a row per check."""
    row_wise: dict[str, list] = {}
    results = []
    for check in checks:
        if isinstance(check, (NotNull, MaxLength)):
            row_wise.setdefault(check.table, []).append(check)
        else:
            results.append(_key_check(tables, check))
    results += [_row_checks(tables[t], group) for t, group in row_wise.items()]
    summary = results[0]
    for r in results[1:]:
        summary = summary.unionByName(r)
    failed = F.col("failures") != 0
    return summary.select(*_SCHEMA, failed.alias("should_warn"), failed.alias("should_error"))


def mart_checks() -> list[Check]:
    """What the built mart must satisfy."""
    return [
        NotNull("dim_tempo", "ano_mes"), Unique("dim_tempo", ("ano_mes",)),
        NotNull("dim_tempo", "ano"), NotNull("dim_tempo", "mes"),
        NotNull("dim_grupo_economico", "nome_grupo"), Unique("dim_grupo_economico", ("nome_grupo",)),
        NotNull("dim_servico", "codigo_servico"),
        AcceptedValues("dim_servico", "codigo_servico", ("SMP", "STFC", "SCM")),
        NotNull("fato_ida", "id_tempo"), NotNull("fato_ida", "nome_grupo"),
        Relationship("fato_ida", "nome_grupo", "dim_grupo_economico", "nome_grupo"),
        NotNull("fato_ida", "codigo_servico"),
        Relationship("fato_ida", "codigo_servico", "dim_servico", "codigo_servico"),
        NotNull("fato_ida", "taxa_solicitacoes_resolvidas_5dias"),
        NotNull("long_delta", "ano_mes"), NotNull("long_delta", "nome_grupo"),
        NotNull("long_delta", "diferenca"),
    ]


def table_constraints() -> list[Check]:
    """Keys, required columns, references and text lengths of the mart tables."""
    def required(table: str, *columns: str) -> list[Check]:
        return [NotNull(table, c) for c in columns]

    return [
        *required("dim_tempo", "id_tempo", "ano", "mes", "ano_mes"),
        Unique("dim_tempo", ("id_tempo",)), Unique("dim_tempo", ("ano_mes",)),
        MaxLength("dim_tempo", "ano_mes", 7),
        *required("dim_grupo_economico", "id_grupo", "nome_grupo"),
        Unique("dim_grupo_economico", ("id_grupo",)), Unique("dim_grupo_economico", ("nome_grupo",)),
        MaxLength("dim_grupo_economico", "nome_grupo", 100),
        *required("dim_servico", "id_servico", "codigo_servico", "nome_servico"),
        Unique("dim_servico", ("id_servico",)), Unique("dim_servico", ("codigo_servico",)),
        MaxLength("dim_servico", "codigo_servico", 10), MaxLength("dim_servico", "nome_servico", 100),
        *required("fato_ida", "id_tempo", "id_grupo", "id_servico"),
        Relationship("fato_ida", "id_tempo", "dim_tempo", "id_tempo"),
        Relationship("fato_ida", "id_grupo", "dim_grupo_economico", "id_grupo"),
        Relationship("fato_ida", "id_servico", "dim_servico", "id_servico"),
        *required("staging_ida", "ano", "mes", "ano_mes", "servico", "grupo_economico", "variavel"),
        MaxLength("staging_ida", "ano_mes", 7), MaxLength("staging_ida", "servico", 10),
        MaxLength("staging_ida", "grupo_economico", 100), MaxLength("staging_ida", "variavel", 200),
        MaxLength("staging_ida", "arquivo_origem", 100),
    ]


def has_rows(df: DataFrame) -> bool:
    """Gate before a transformation: false stops the load."""
    return not df.isEmpty()
