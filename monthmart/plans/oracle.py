"""The registered queries as plain SQL over the same tables, to compare results with.

The SQL takes its own way to the results: group names follow from the nation, facts
from the counts by month, service and group, cleaned names and parsed periods from how
the texts were composed, with none of the patterns the operators use.

Each query is a chain of common table expressions from the order tables down;
``_sql`` puts the ones a query needs in front of its select.
"""

from __future__ import annotations

import re

from ..constants import OTHER_SERVICE_DESCRIPTION, SERVICES

GROUPS = (
    "ALGAR", "CLARO", *sorted(f"NATION_{k}" for k in range(8, 25)), "OI", "SERCOMTEL", "TIM", "VIVO",
)
MARKET = "Taxa de Variação Média"
MONTHS = "['JAN','FEV','MAR','ABR','MAI','JUN','JUL','AGO','SET','OUT','NOV','DEZ']"
CHOSEN = ("ALGAR", "OI", "TIM", "VIVO")
LAST_MONTHS = ("2000-10", "2000-11", "2000-12")
RATE = "taxa_solicitacoes_resolvidas_5dias"


def dec(x: str, n: int) -> str:
    return f"CAST(round(CAST(round({x}, 6) AS DECIMAL(18,6)), {n}) AS DECIMAL(18,{n}))"


def num(x: str, n: int = 6) -> str:
    return f"CAST({dec(x, n)} AS DOUBLE)"


def pct(now: str, before: str) -> str:
    return f"CASE WHEN {before} > 0 THEN ({now} - {before}) / {before} * 100 END"


def text_list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


CTES = {
    "w": """SELECT year(l_shipdate)::INTEGER AS ano, month(l_shipdate)::INTEGER AS mes,
        strftime(l_shipdate, '%Y-%m') AS ano_mes,
        CASE l_returnflag WHEN 'A' THEN 'SMP' WHEN 'N' THEN 'STFC' ELSE 'SCM' END AS servico,
        CASE n_nationkey WHEN 0 THEN 'Oi (Nova) **' WHEN 1 THEN 'Claro  S.A.'
          WHEN 2 THEN 'Telefônica Brasil' WHEN 3 THEN 'CTBC *' WHEN 4 THEN 'Tim (a)'
          WHEN 5 THEN 'Sercomtel (b)' WHEN 6 THEN 'vivo' WHEN 7 THEN 'Algar'
          ELSE lower(n_name) END AS grupo_economico,
        CASE n_nationkey WHEN 0 THEN 'OI' WHEN 1 THEN 'CLARO' WHEN 2 THEN 'VIVO' WHEN 3 THEN 'ALGAR'
          WHEN 4 THEN 'TIM' WHEN 5 THEN 'SERCOMTEL' WHEN 6 THEN 'VIVO' WHEN 7 THEN 'ALGAR'
          ELSE n_name END AS nome_grupo,
        count(*) AS q_tot,
        sum(CASE WHEN l_quantity <= 40 THEN 1 ELSE 0 END) AS q_res,
        sum(CASE WHEN l_quantity <= 5 THEN 1 ELSE 0 END) AS q_5d
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey
      JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
      GROUP BY 1, 2, 3, 4, 5, 6""",
    "metrics": """SELECT *, 'Total de Solicitações' AS variavel, CAST(q_tot AS DOUBLE) AS valor FROM w
      UNION ALL SELECT *, 'Taxa de Resolvidas no Período', CAST(100 AS DOUBLE) * q_res / q_tot FROM w
      UNION ALL SELECT *, 'Taxa de Resolvidas em 5 dias úteis', CAST(100 AS DOUBLE) * q_5d / q_tot FROM w
      UNION ALL SELECT *, 'Quantidade de resolvidas', CAST(q_res AS DOUBLE) FROM w WHERE servico = 'SCM'
      UNION ALL SELECT *, 'Índice de Desempenho no Atendimento', CAST(200 AS DOUBLE) * q_5d / q_tot
        FROM w WHERE servico = 'STFC'""",
    "staging": """SELECT ano, mes, ano_mes, servico, grupo_economico, variavel, valor,
        servico || ano || '.ods' AS arquivo_origem FROM metrics""",
    # Sheets.
    "g": f"""SELECT arquivo_origem AS arquivo, servico, ano, mes, grupo_economico, variavel,
        CASE WHEN variavel IN ('Total de Solicitações', 'Quantidade de resolvidas')
          THEN CAST(CAST(valor AS BIGINT) AS VARCHAR)
          ELSE replace(CAST({dec('valor', 2)} AS VARCHAR), '.', ',') END AS texto
      FROM staging
      WHERE arquivo_origem <> 'SCM1999.ods' OR variavel = 'Taxa de Resolvidas em 5 dias úteis'""",
    "k": """SELECT *, row_number() OVER (PARTITION BY arquivo ORDER BY grupo_economico, variavel) AS rn
      FROM (SELECT DISTINCT arquivo, servico, ano, grupo_economico, variavel FROM g)""",
    "m": f"""SELECT k.*, mm.mes, CASE ano % 3 WHEN 0 THEN ano || '-' || lpad(CAST(mm.mes AS VARCHAR), 2, '0')
          WHEN 1 THEN {MONTHS}[mm.mes] || '/' || ano ELSE lower({MONTHS}[mm.mes]) END AS periodo,
        CASE WHEN rn = 1 AND mm.mes = 1 THEN 'n/d' WHEN rn = 2 AND mm.mes = 2 THEN '-5,5'
          ELSE g.texto END AS texto,
        CASE WHEN arquivo = 'SCM1999.ods' THEN 1 ELSE 2 END AS ids
      FROM k CROSS JOIN (SELECT CAST(unnest(range(1, 13)) AS INTEGER) AS mes) mm
      LEFT JOIN g USING (arquivo, servico, ano, grupo_economico, variavel, mes)""",
    "sheets": "SELECT arquivo, servico, ano, ids, max(rn) AS n FROM m GROUP BY ALL",
    "cells": """SELECT arquivo, 0 AS row_idx, 0 AS col_idx, 'Indicadores de Atendimento' AS cell FROM sheets
      UNION ALL SELECT arquivo, 1, 0, servico || ' ' || ano FROM sheets
      UNION ALL SELECT arquivo, 2, 0,
        CASE WHEN arquivo = 'SMP1996.ods' THEN 'Operadora' ELSE 'Grupo Econômico ' END FROM sheets
      UNION ALL SELECT arquivo, 2, 1, 'Variável' FROM sheets WHERE ids = 2
      UNION ALL SELECT DISTINCT arquivo, 2, ids + mes - 1, periodo FROM m
      UNION ALL SELECT arquivo, 2, ids + 12, 'OUTROS' FROM sheets
      UNION ALL SELECT arquivo, 2, ids + 13, 'OUTROS 2' FROM sheets WHERE ids = 1
      UNION ALL SELECT arquivo, 2, ids + 14, '1990-01' FROM sheets
      UNION ALL SELECT DISTINCT arquivo, 2 + rn, 0, grupo_economico FROM m
      UNION ALL SELECT DISTINCT arquivo, 2 + rn, 1, variavel FROM m WHERE ids = 2
      UNION ALL SELECT arquivo, 2 + rn, ids + mes - 1, texto FROM m WHERE texto IS NOT NULL
      UNION ALL SELECT DISTINCT arquivo, 2 + rn, ids + unnest([12, 13, 14]), unnest(['x', '7', '8']) FROM m
      UNION ALL SELECT DISTINCT arquivo, 3 + n, 0, grupo_economico FROM m JOIN sheets USING (arquivo) WHERE rn = 1
      UNION ALL SELECT DISTINCT arquivo, 3 + n, 1, variavel FROM m JOIN sheets USING (arquivo)
        WHERE rn = 1 AND m.ids = 2
      UNION ALL SELECT arquivo, 3 + n, m.ids + mes - 1, '999' FROM m JOIN sheets USING (arquivo) WHERE rn = 1
      UNION ALL SELECT arquivo, 3 + n, ids + unnest([12, 13, 14]), unnest(['x', '7', '8']) FROM sheets""",
    "longrows": """SELECT grupo_economico,
        CASE WHEN ids = 1 THEN 'Valor Único' ELSE variavel END AS variavel, periodo,
        coalesce(TRY_CAST(replace(texto, ',', '.') AS DOUBLE), CASE WHEN rn = 1 THEN 999 END) AS valor,
        ano, mes, servico, arquivo AS arquivo_origem,
        ano || '-' || lpad(CAST(mes AS VARCHAR), 2, '0') AS ano_mes
      FROM m WHERE arquivo <> 'SMP1996.ods'
        AND (rn = 1 OR TRY_CAST(replace(texto, ',', '.') AS DOUBLE) IS NOT NULL)""",
    # Mart.
    "dt": """SELECT CAST(row_number() OVER (ORDER BY ano, mes) AS INTEGER) AS id_tempo, ano, mes, ano_mes,
        CAST((mes + 2) // 3 AS INTEGER) AS trimestre, CAST((mes + 5) // 6 AS INTEGER) AS semestre
      FROM (SELECT DISTINCT ano, mes, ano_mes FROM w)""",
    "svc": "SELECT * FROM (VALUES " + ", ".join(
        f"('{code}', '{name}', '{text}')" for code, (name, text) in SERVICES.items()
    ) + ") AS v(codigo_servico, nome_servico, descricao)",
    "ds": f"""SELECT servico AS codigo_servico, coalesce(nome_servico, servico) AS nome_servico,
        coalesce(descricao, '{OTHER_SERVICE_DESCRIPTION}') AS descricao
      FROM (SELECT DISTINCT servico FROM w) LEFT JOIN svc ON servico = codigo_servico""",
    # Spellings of one group meet at the maximum; fixed-line services publish an index of
    # twice the rate, and only broadband counts its resolved requests.
    "fato": f"""SELECT id_tempo, nome_grupo, servico AS codigo_servico,
        {num("max(CASE servico WHEN 'STFC' THEN 200.0::DOUBLE ELSE 100.0::DOUBLE END * q_5d / q_tot)", 2)} AS {RATE},
        {num("max(100.0::DOUBLE * q_res / q_tot)", 2)} AS taxa_solicitacoes_resolvidas,
        CAST(max(q_tot) AS INTEGER) AS total_solicitacoes,
        CAST(CASE servico WHEN 'SCM' THEN max(q_res)
          ELSE round(max(q_tot) * max(100.0::DOUBLE * q_res / q_tot) / 100) END AS INTEGER) AS solicitacoes_resolvidas,
        dt.ano
      FROM w JOIN dt USING (ano_mes) GROUP BY id_tempo, nome_grupo, servico, dt.ano""",
    # Variation.
    "r": f"SELECT id_tempo, ano_mes, nome_grupo, codigo_servico, {RATE} AS ida FROM fato JOIN dt USING (id_tempo)",
    "gm": "SELECT id_tempo, ano_mes, nome_grupo, avg(ida) AS ida FROM r GROUP BY ALL",
    "mg": "SELECT id_tempo, ano_mes, avg(ida) AS v FROM gm GROUP BY ALL",
    "mf": "SELECT id_tempo, ano_mes, avg(ida) AS v FROM r GROUP BY ALL",
    "vmg": f"SELECT *, {pct('v', 'p')} AS var_mercado FROM (SELECT *, lag(v) OVER (ORDER BY id_tempo) AS p FROM mg)",
    "vmf": f"SELECT *, {pct('v', 'p')} AS var_mercado FROM (SELECT *, lag(v) OVER (ORDER BY id_tempo) AS p FROM mf)",
    "vg": f"""SELECT *, {pct('ida', 'p')} AS var_individual FROM
        (SELECT *, lag(ida) OVER (PARTITION BY nome_grupo ORDER BY id_tempo) AS p FROM gm)""",
    "vgs": f"""SELECT *, {pct('ida', 'p')} AS var_individual FROM
        (SELECT *, lag(ida) OVER (PARTITION BY nome_grupo, codigo_servico ORDER BY id_tempo) AS p FROM r)""",
    "vgx": f"""SELECT *, {pct('ida', 'p')} AS var_individual FROM
        (SELECT *, lag(ida) OVER (PARTITION BY nome_grupo ORDER BY id_tempo, codigo_servico) AS p FROM r)""",
    "delta": """SELECT vg.ano_mes, nome_grupo, var_mercado, var_individual,
        var_mercado - var_individual AS diferenca
      FROM vg JOIN vmg USING (id_tempo) WHERE var_mercado IS NOT NULL""",
    "delta_flat": """SELECT vg.ano_mes, nome_grupo, var_mercado, var_individual,
        var_mercado - var_individual AS diferenca
      FROM vg JOIN vmf USING (id_tempo) WHERE var_mercado IS NOT NULL""",
    "delta_row": f"""SELECT ano_mes, nome_grupo, var_mercado, var_individual,
        var_mercado - var_individual AS diferenca
      FROM (SELECT *, {pct('v', 'pm')} AS var_mercado
        FROM (SELECT vg.ano_mes, nome_grupo, var_individual, v,
            lag(v) OVER (ORDER BY vg.id_tempo, nome_grupo) AS pm FROM vg JOIN mg USING (id_tempo)))
      WHERE var_mercado IS NOT NULL""",
    "ld": f"""SELECT vgs.ano_mes, nome_grupo, codigo_servico, {num('var_mercado', 2)} AS var_mercado,
        {num('var_individual', 2)} AS var_individual, {num('var_mercado - var_individual', 2)} AS diferenca
      FROM vgs JOIN vmf USING (id_tempo) WHERE var_mercado IS NOT NULL AND var_individual IS NOT NULL""",
    "ld_row": f"""SELECT ano_mes, nome_grupo, codigo_servico, {num('var_mercado', 2)} AS var_mercado,
        {num('var_individual', 2)} AS var_individual, {num('var_mercado - var_individual', 2)} AS diferenca
      FROM (SELECT *, {pct('v', 'pm')} AS var_mercado
        FROM (SELECT vgx.ano_mes, nome_grupo, codigo_servico, var_individual, v,
            lag(v) OVER (ORDER BY vgx.id_tempo, nome_grupo, codigo_servico) AS pm
          FROM vgx JOIN mf USING (id_tempo)))
      WHERE var_mercado IS NOT NULL AND var_individual IS NOT NULL""",
}


def pivot(source: str, market: str = "max", fill: bool = True) -> str:
    def shown(x: str) -> str:
        return f"coalesce({num(x, 1)}, 0)" if fill else num(x, 1)

    columns = "".join(
        f""", {shown(f"max(CASE WHEN nome_grupo = '{g}' THEN diferenca END)")} AS "{g}" """ for g in GROUPS
    )
    return (
        f'SELECT ano_mes AS "Mes", {shown(f"{market}(var_mercado)")} AS "{MARKET}"{columns} '
        f"FROM {source} GROUP BY ano_mes"
    )


CTES["pv"] = pivot("delta")
CTES["melted"] = (
    f"""SELECT "Mes", name AS "Operadora", value AS d FROM (UNPIVOT (SELECT * EXCLUDE ("{MARKET}") FROM pv)
      ON {", ".join(f'"{g}"' for g in GROUPS)} INTO NAME name VALUE value)"""
)
CTES["rl"] = """SELECT "Mes", "Operadora", CASE WHEN abs(d) <= 200 THEN 0.0::DOUBLE - d END AS "Delta" FROM melted"""
CTES["tr"] = "SELECT ano_mes, nome_grupo, nome_servico, ida FROM r JOIN ds USING (codigo_servico)"
# Quality: the mart with known bad rows.
CTES["dt_bad"] = """SELECT id_tempo, ano, mes, ano_mes FROM dt UNION ALL SELECT NULL, NULL, NULL, NULL
      UNION ALL SELECT -1, ano, mes, ano_mes FROM dt WHERE ano_mes = '1996-01'"""
CTES["dg_bad"] = """SELECT DISTINCT nome_grupo FROM w UNION ALL SELECT NULL
      UNION ALL SELECT repeat('X', 101)"""
CTES["ds_bad"] = "SELECT codigo_servico FROM ds UNION ALL SELECT 'XXX'"
CTES["f_bad"] = f"""SELECT id_tempo, nome_grupo, codigo_servico, {RATE} FROM fato
      UNION ALL (SELECT id_tempo, 'DESCONHECIDO', codigo_servico, {RATE} FROM fato LIMIT 1)
      UNION ALL (SELECT id_tempo, nome_grupo, NULL, {RATE} FROM fato LIMIT 1)"""


def _needs(text: str) -> list[str]:
    words = set(re.findall(r"\w+", text))
    return [name for name in CTES if name in words]


def _sql(select: str) -> str:
    """The select behind the expressions it names, directly or through others."""
    wanted, todo = set(), _needs(select)
    while todo:
        name = todo.pop()
        if name not in wanted:
            wanted.add(name)
            todo += [n for n in _needs(CTES[name]) if n != name]
    if not wanted:
        return select
    chain = ", ".join(f"{name} AS (\n      {CTES[name]})" for name in CTES if name in wanted)
    return f"WITH {chain}\n{select}"


def _check(name: str, table: str, column: str, failures: str) -> str:
    n = f"({failures})"
    return (
        f"SELECT '{name}' AS checagem, '{table}' AS tabela, '{column}' AS coluna, "
        f"CAST({n} AS BIGINT) AS failures, {n} <> 0 AS should_warn, {n} <> 0 AS should_error"
    )


def _nulls(table: str, source: str, column: str) -> str:
    return _check("not_null", table, column, f"SELECT count(*) FROM {source} WHERE {column} IS NULL")


def _dups(table: str, source: str, column: str) -> str:
    return _check("unique", table, column, f"SELECT count(*) FROM (SELECT {column} FROM {source} "
                  f"WHERE {column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)")


def _orphans(column: str, parent: str) -> str:
    return _check("relationships", "fato_ida", column, f"SELECT count(*) FROM f_bad WHERE {column} IS NOT NULL "
                  f"AND {column} NOT IN (SELECT {column} FROM {parent} WHERE {column} IS NOT NULL)")


def _union(*selects: str) -> str:
    return "\nUNION ALL ".join(selects)


ACCEPTED = _check("accepted_values", "dim_servico", "codigo_servico",
                  "SELECT count(DISTINCT codigo_servico) FROM ds_bad WHERE codigo_servico NOT IN ('SMP', 'STFC', 'SCM')")


def _known(name: str, table: str, column: str, failures: int) -> str:
    return _check(name, table, column, str(failures))


def _constraints() -> str:
    """Failures of the keys and references follow from the rows that were added."""
    def required(table: str, **failures: int) -> list[str]:
        return [_known("not_null", table, c, n) for c, n in failures.items()]

    return _union(
        *[_nulls("dim_tempo", "dt_bad", c) for c in ("id_tempo", "ano", "mes", "ano_mes")],
        _dups("dim_tempo", "dt_bad", "id_tempo"), _dups("dim_tempo", "dt_bad", "ano_mes"),
        _check("max_length", "dim_tempo", "ano_mes", "SELECT count(*) FROM dt_bad WHERE length(ano_mes) > 7"),
        *required("dim_grupo_economico", id_grupo=0), _nulls("dim_grupo_economico", "dg_bad", "nome_grupo"),
        _known("unique", "dim_grupo_economico", "id_grupo", 0),
        _dups("dim_grupo_economico", "dg_bad", "nome_grupo"),
        _check("max_length", "dim_grupo_economico", "nome_grupo",
               "SELECT count(*) FROM dg_bad WHERE length(nome_grupo) > 100"),
        *required("dim_servico", id_servico=0, nome_servico=0), _nulls("dim_servico", "ds_bad", "codigo_servico"),
        _known("unique", "dim_servico", "id_servico", 0), _dups("dim_servico", "ds_bad", "codigo_servico"),
        _check("max_length", "dim_servico", "codigo_servico",
               "SELECT count(*) FROM ds_bad WHERE length(codigo_servico) > 10"),
        _check("max_length", "dim_servico", "nome_servico", "SELECT count(*) FROM ds WHERE length(nome_servico) > 100"),
        _nulls("fato_ida", "f_bad", "id_tempo"), *required("fato_ida", id_grupo=0, id_servico=1),
        _orphans("id_tempo", "dt_bad"), _known("relationships", "fato_ida", "id_grupo", 1),
        _known("relationships", "fato_ida", "id_servico", 0),
        *[_nulls("staging_ida", "staging", c)
          for c in ("ano", "mes", "ano_mes", "servico", "grupo_economico", "variavel")],
        *[_check("max_length", "staging_ida", c, f"SELECT count(*) FROM staging WHERE length({c}) > {n}")
          for c, n in (("ano_mes", 7), ("servico", 10), ("grupo_economico", 100), ("variavel", 200),
                       ("arquivo_origem", 100))],
    )


def _box(q: float) -> str:
    return num(f'quantile_cont("Delta", {q})')


SVC = "CASE o_orderstatus WHEN 'F' THEN 'SMP' WHEN 'O' THEN 'STFC' ELSE 'SCM' END"
ORDER_MONTH = f"{MONTHS}[month(o_orderdate)]"
VARIED = f"{num('var_mercado')} AS var_mercado, {num('var_individual')} AS var_individual, {num('diferenca')} AS diferenca"
IN_YEAR = f""""Mes" LIKE '2000%' AND "Operadora" IN ({text_list(CHOSEN)})"""

_HEADINGS = r"""SELECT page_id, CAST(k - 1 AS INTEGER) AS pos,
        trim(regexp_replace(replace(replace(replace(replace(replace(inner_html, '&quot;', '"'), '&lt;', '<'),
          '&gt;', '>'), '&nbsp;', ' '), '&amp;', '&'), '\s+', ' ', 'g')) AS titulo, servico, ano,
        servico || ano || '.ods' AS filename
      FROM (SELECT page_id, k, split_part(substr(parts[k + 1], strpos(parts[k + 1], '>') + 1), '</h1>', 1) AS inner_html,
          url_parts[4] AS servico, TRY_CAST(regexp_extract(url_parts[5], '^[0-9]+') AS INTEGER) AS ano
        FROM (SELECT *, unnest(range(1, len(parts))) AS k FROM (SELECT page_id, string_split(url, '/') AS url_parts,
          string_split(html, '<h1') AS parts FROM pages)))
      WHERE servico IN ('en', 'fr', 'de', 'es') AND ano IS NOT NULL"""

_SELECTS = {
    "headings_catalog": _HEADINGS,
    "headings_marked": f"""SELECT page_id, pos + 1 AS pos, titulo, servico, ano, filename FROM ({_HEADINGS})
      UNION ALL SELECT page_id, 0, 'O''Neil & co', servico, ano, servico || ano || '.ods' FROM (
        SELECT page_id, split_part(url, '/', 4) AS servico, TRY_CAST(regexp_extract(split_part(url, '/', 5), '^[0-9]+') AS INTEGER) AS ano FROM pages)
      WHERE servico IN ('en', 'fr', 'de', 'es') AND ano IS NOT NULL""",
    "title_parse": f"""SELECT titulo, count(*) AS n, servico, ano, servico || ano || '.ods' AS filename
      FROM (SELECT {SVC} AS servico, CAST(year(o_orderdate) AS INTEGER) AS ano, CASE o_orderpriority
          WHEN '1-URGENT' THEN 'Índice - ' || servico || ' - ' || ano
          WHEN '2-HIGH' THEN 'Índice ' || servico || '-' || ano
          WHEN '5-LOW' THEN 'x' || servico || '  -  ' || ano || ' (v2)' END AS titulo FROM orders)
      WHERE titulo IS NOT NULL GROUP BY ALL""",
    "workbook_signature": """SELECT arquivo, servico, ano AS ano_arquivo, true AS valido FROM sheets
      UNION ALL SELECT DISTINCT servico || '0000.ods', servico, 0, false FROM sheets""",
    "load_count": "SELECT count(*) AS ok, count(*) + count(DISTINCT servico) AS total FROM sheets",
    "workbook_cells": """SELECT arquivo, CAST(row_idx AS INTEGER) AS row_idx, CAST(col_idx AS INTEGER) AS col_idx,
        cell FROM cells""",
    "load_report": """SELECT arquivo, CASE WHEN arquivo = 'SMP1996.ods' THEN 'no_header' ELSE 'ok' END AS status,
        CAST(n + 4 AS BIGINT) AS linhas, CAST(0 AS BIGINT) AS sem_grupo FROM sheets
      UNION ALL SELECT DISTINCT servico || '0000.ods', 'unreadable', 0, 0 FROM sheets""",
    "workbook_long": "SELECT * FROM longrows",
    "cache_incremental": """SELECT arquivo_origem, count(*) AS linhas, ano < 1999 AS do_cache FROM longrows
      GROUP BY arquivo_origem, ano""",
    "cache_choice": """SELECT * FROM (WITH f AS (SELECT arquivo, servico = 'SCM' AS pendente, (ano - 1990) * 365 + length(servico) * 7
          + ascii(servico) + ascii(servico[2]) AS t FROM sheets
        UNION ALL SELECT DISTINCT servico || '0000.ods', true, 0 FROM sheets),
      p AS (SELECT t, lag(t) OVER (ORDER BY t) AS prev FROM (SELECT DISTINCT t FROM f WHERE pendente)),
      g AS (SELECT *, (SELECT count(*) FROM f WHERE NOT pendente AND f.t BETWEEN prev AND p.t) AS held FROM p),
      cut AS (SELECT t, prev FROM g WHERE held > 0 ORDER BY held DESC, t LIMIT 2)
      SELECT arquivo, pendente, t BETWEEN (SELECT min(t) FROM p) AND (SELECT max(t) FROM p)
        AND NOT EXISTS (SELECT 1 FROM cut WHERE f.t > cut.prev AND f.t < cut.t) AS aberto FROM f)""",
    "cache_merge": """SELECT arquivo_origem, count(*) AS linhas, CAST(1 AS BIGINT) AS lotes FROM longrows GROUP BY arquivo_origem""",
    "staging_append_once": """SELECT ano, CASE WHEN ano < 1997 THEN 'early' ELSE 'late' END AS carga, count(*) AS n, 1 AS feitas
      FROM staging WHERE valor >= 0 GROUP BY ano""",
    "staging_load": f"""SELECT ano, mes, ano_mes, servico, grupo_economico, variavel, {num('valor')} AS valor,
        arquivo_origem FROM staging""",
    "table_inventory": """SELECT 'staging_ida' AS tabela, count(*) AS n FROM staging
      UNION ALL SELECT 'fato_ida', count(*) FROM fato UNION ALL SELECT 'view_variacao', count(*) FROM pv""",
    "grid_to_long": "SELECT * FROM longrows",
    "number_parse": """SELECT l_returnflag || l_linestatus AS forma, count(*) AS n,
        CASE WHEN forma IN ('NF', 'NO') THEN 0 ELSE count(*) END AS lidos,
        CAST(CASE WHEN forma IN ('AF', 'AO') THEN sum(p) WHEN forma = 'RF' THEN sum(p * 10)
          WHEN forma = 'RO' THEN -sum(p) END AS DOUBLE) AS soma
      FROM (SELECT *, CAST(l_extendedprice AS DECIMAL(12,2)) AS p FROM lineitem) GROUP BY forma""",
    "period_parse": f"""SELECT texto, CAST(y AS INTEGER) AS ano_arquivo, count(*) AS n,
        CASE WHEN kind IN (1, 2, 3, 4, 6) THEN CAST(y AS INTEGER) END AS ano,
        CASE WHEN kind IN (1, 2, 3, 4) THEN CAST(m AS INTEGER) WHEN kind = 6 THEN 1 END AS mes
      FROM (SELECT *, CASE kind WHEN 1 THEN y || '-' || lpad(CAST(m AS VARCHAR), 2, '0')
          WHEN 2 THEN 'ref ' || y || '.' || m WHEN 3 THEN '  ' || lower(a) || '/' || y || ' ' WHEN 4 THEN a
          WHEN 5 THEN 'OUTROS' WHEN 6 THEN 'XYZ/' || y ELSE 'Total ' || y END AS texto
        FROM (SELECT year(o_orderdate) AS y, month(o_orderdate) AS m, {ORDER_MONTH} AS a,
          CASE WHEN o_orderpriority[1] <> '5' THEN CAST(o_orderpriority[1] AS INTEGER)
            WHEN o_orderstatus = 'F' THEN 5 WHEN o_orderstatus = 'O' THEN 6 ELSE 7 END AS kind FROM orders))
      GROUP BY ALL""",
    "nonneg_filter": """SELECT c_custkey, c_acctbal AS valor FROM customer
      WHERE c_mktsegment <> 'HOUSEHOLD' AND c_acctbal >= 0""",
    "group_clean": """SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'SERCOMTEL ' || upper(c_name)
        WHEN 'HOUSEHOLD' THEN upper(c_name) WHEN 'MACHINERY' THEN NULL
        ELSE upper(c_name) || ' S.A.' END AS nome FROM customer""",
    "group_alias": "SELECT DISTINCT grupo_economico, nome_grupo FROM w",
    "report_name_clean": """SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'SERCOMTEL'
        WHEN 'HOUSEHOLD' THEN upper(c_name) WHEN 'MACHINERY' THEN ''
        ELSE upper(c_name) || ' S.A.' END AS nome FROM customer""",
    "dim_time": "SELECT * FROM dt",
    "dim_group": "SELECT DISTINCT nome_grupo, true AS ativo FROM w",
    "dim_group_keys": """SELECT count(DISTINCT nome_grupo) AS n, count(DISTINCT nome_grupo) AS distintos, 1 AS menor,
        CAST(count(DISTINCT nome_grupo) AS INTEGER) AS maior FROM w""",
    "dim_service": "SELECT * FROM ds",
    "dim_insert_absent": "SELECT * FROM dt",
    "dim_upsert": """SELECT CASE codigo_servico WHEN 'SMP' THEN 7 WHEN 'STFC' THEN 9 ELSE 10 END AS id_servico, *
      FROM ds""",
    "mart_load": "SELECT * FROM fato",
    "fact_build": "SELECT * FROM fato",
    "workbook_mart": f"""SELECT id_tempo, nome_grupo, codigo_servico, {num('coalesce(i, t5, 0)', 2)} AS {RATE},
        {num('coalesce(t, 0)', 2)} AS taxa_solicitacoes_resolvidas,
        CAST(round(coalesce(p, 0)) AS INTEGER) AS total_solicitacoes,
        CAST(round(coalesce(q, round(p * t / 100), 0)) AS INTEGER) AS solicitacoes_resolvidas, ano
      FROM (SELECT ano, CAST(dense_rank() OVER (ORDER BY ano, mes) AS INTEGER) AS id_tempo, nome_grupo,
          servico AS codigo_servico,
          max(valor) FILTER (variavel = 'Índice de Desempenho no Atendimento') AS i,
          max(valor) FILTER (variavel = 'Taxa de Resolvidas em 5 dias úteis') AS t5,
          max(valor) FILTER (variavel = 'Taxa de Resolvidas no Período') AS t,
          max(valor) FILTER (variavel = 'Total de Solicitações') AS p,
          max(valor) FILTER (variavel = 'Quantidade de resolvidas') AS q
        FROM longrows JOIN (SELECT DISTINCT grupo_economico, nome_grupo FROM w) USING (grupo_economico)
        WHERE valor >= 0 GROUP BY ano, mes, nome_grupo, servico)""",
    "fact_reload": "SELECT * REPLACE (CASE WHEN ano = 2000 THEN total_solicitacoes + 1 "
    "ELSE total_solicitacoes END AS total_solicitacoes) FROM fato",
    "mart_reload": """SELECT DISTINCT nome_grupo, nome_grupo IN (SELECT nome_grupo FROM w
          WHERE lower(grupo_economico) < 'm' AND ano < 1996) AS antiga, true AS mantida, true AS no_fato FROM w""",
    "mart_partial_reload": f"""SELECT tabela, CAST(ano AS INTEGER) AS ano, ano <> 1996 AS da_primeira, true AS inalterada, total, taxas
      FROM (VALUES ('staging_ida'), ('resumo_ida'), ('fato_ida')) t(tabela), (
        SELECT ano, CAST(sum(round(q * part)) AS DOUBLE) AS total, {num(f"CAST(sum(CAST({num('x * part', 2)} AS DECIMAL(18,2))) AS DOUBLE)")} AS taxas
        FROM (SELECT ano, ano_mes, nome_grupo, servico, max(q_tot) AS q, CASE ano WHEN 1996 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS part,
            max(CASE servico WHEN 'STFC' THEN 200.0::DOUBLE ELSE 100.0::DOUBLE END * q_5d / q_tot) AS x
          FROM w WHERE ano <> 1997 GROUP BY ALL) GROUP BY ano)""",
    "published_after_reload": """SELECT CAST(fato.ano AS INTEGER) AS ano, count(*) AS n, count(DISTINCT nome_grupo) AS grupos
      FROM fato GROUP BY fato.ano""",
    "dq_mergeable": _constraints(),
    "load_guard": """SELECT passo, tabela, n FROM (VALUES ('antes'), ('vazia'), ('recusada')) p(passo), (
        SELECT 'staging' AS tabela, count(*) AS n FROM staging WHERE valor >= 0
        UNION ALL SELECT 'dim_tempo', count(DISTINCT ano_mes) FROM staging
        UNION ALL SELECT 'dim_grupo', count(DISTINCT nome_grupo) FROM w
        UNION ALL SELECT 'dim_servico', count(DISTINCT servico) FROM staging
        UNION ALL SELECT 'fato', count(*) FROM fato)""",
    "mart_reopened": "SELECT * FROM tr",
    "staging_truncate": "SELECT ano, count(*) AS n FROM staging WHERE ano < 1998 GROUP BY ano",
    "column_defaults": "SELECT count(DISTINCT nome_grupo) AS ativos, count(DISTINCT nome_grupo) AS datados FROM w",
    "load_gate": """SELECT 'todas' AS linhas, count(*) > 0 AS segue FROM staging WHERE valor >= 0
      UNION ALL SELECT 'negativas', count(*) > 0 FROM staging WHERE NOT valor >= 0""",
    "report_source": pivot("ld", "avg") + " ORDER BY 1",
    "market_mean_groups": f"SELECT ano_mes, {num('v')} AS valor_mercado FROM mg",
    "market_mean_flat": f"SELECT ano_mes, {num('v')} AS valor_mercado FROM mf",
    "variation_market": f"SELECT ano_mes, {num('v')} AS valor_mercado, {num('var_mercado')} AS var_mercado FROM vmg",
    "variation_group": f"""SELECT ano_mes, nome_grupo, {num('ida')} AS ida,
        {num('var_individual')} AS var_individual FROM vg""",
    "variation_group_service": f"""SELECT ano_mes, nome_grupo, codigo_servico,
        {num('var_individual')} AS var_individual FROM vgs""",
    "variation_group_mixed": f"""SELECT ano_mes, nome_grupo, codigo_servico,
        {num('var_individual')} AS var_individual FROM vgx""",
    "variation_month": f"SELECT ano_mes, nome_grupo, {VARIED} FROM delta",
    "variation_carried": f"SELECT ano_mes, nome_grupo, {VARIED}, ano_mes[1:4] IN ('1996', '1997') AS recalculado FROM delta",
    "variation_row_lag": f"SELECT ano_mes, nome_grupo, {VARIED} FROM delta_row",
    "variation_flat_market": f"SELECT ano_mes, nome_grupo, {VARIED} FROM delta_flat",
    "long_delta": "SELECT * FROM ld",
    "long_delta_row_lag": "SELECT * FROM ld_row",
    "pivot_view": "SELECT * FROM pv ORDER BY 1",
    "pivot_view_row_lag": pivot("delta_row") + " ORDER BY 1",
    "pivot_avg": pivot("ld", "avg") + " ORDER BY 1",
    "pivot_avg_row_lag": pivot("ld_row", "avg") + " ORDER BY 1",
    "pivot_unfilled": pivot("delta", fill=False) + " ORDER BY 1",
    "signed_masked_delta": "SELECT * FROM rl",
    "merged_names": f"""SELECT ano_mes AS "Mes", nome_grupo AS "Operadora",
        {num('avg(CASE WHEN abs(diferenca) <= 200 THEN -diferenca END)')} AS "Delta" FROM ld GROUP BY 1, 2""",
    "trend_natural": "SELECT * FROM tr",
    "trend_surrogate": "SELECT * FROM tr",
    "service_series": """SELECT ano_mes, nome_grupo, ida FROM tr WHERE nome_servico = 'Serviço Móvel Pessoal'
      AND nome_grupo IN ('OI', 'TIM') AND ano_mes[1:4] IN ('1999', '2000')""",
    "distinct_values": """SELECT DISTINCT 'ano' AS lista, ano_mes[1:4] AS valor FROM tr
      UNION ALL SELECT DISTINCT 'servico', nome_servico FROM tr""",
    "default_selection": """SELECT 'ano' AS selecao, max("Mes")[1:4] AS valor FROM rl
      UNION ALL SELECT 'mes', * FROM (SELECT DISTINCT "Mes" FROM rl
        WHERE "Mes"[1:4] = (SELECT max("Mes")[1:4] FROM rl) ORDER BY 1 DESC LIMIT 3)
      UNION ALL SELECT 'grupo', * FROM (SELECT DISTINCT "Operadora" FROM rl ORDER BY 1 LIMIT 4)""",
    "default_trend_selection": """SELECT 'grupo' AS selecao, valor FROM (SELECT DISTINCT nome_grupo AS valor FROM tr
        WHERE nome_servico = 'Serviço Móvel Pessoal' ORDER BY 1 LIMIT 5)
      UNION ALL SELECT 'ano', * FROM (SELECT DISTINCT ano_mes[1:4] FROM tr
        WHERE nome_servico = 'Serviço Móvel Pessoal' ORDER BY 1 DESC LIMIT 2)""",
    "ranking": f"""SELECT "Operadora", {num('avg("Delta")')} AS media FROM rl GROUP BY 1 ORDER BY 2, 1""",
    "best_worst": f"""SELECT first("Operadora" ORDER BY a DESC, "Operadora") AS melhor, {num('max(a)', 2)} AS melhor_media,
        first("Operadora" ORDER BY a, "Operadora" DESC) AS pior, {num('min(a)', 2)} AS pior_media
      FROM (SELECT "Operadora", avg("Delta") AS a FROM rl WHERE "Mes" LIKE '2000%' GROUP BY 1) WHERE a IS NOT NULL""",
    "latest_row": 'SELECT * FROM pv WHERE "Mes" = (SELECT max("Mes") FROM pv)',
    "market_kpi": f"""SELECT ano_mes AS ultimo_mes, {num('c', 1)} AS var_mercado, {num('c - b', 2)} AS delta_pp
      FROM (SELECT *, lag(c) OVER (ORDER BY ano_mes) AS b FROM
        (SELECT ano_mes, (v - lag(v) OVER (ORDER BY ano_mes)) / lag(v) OVER (ORDER BY ano_mes) * 100 AS c
         FROM mf WHERE ano_mes IN ({text_list(LAST_MONTHS)})))
      WHERE ano_mes = '2000-12'""",
    "market_column_kpi": f"""SELECT "Mes" AS ultimo_mes, {num('v', 1)} AS var_mercado, {num('v - b', 2)} AS delta_pp
      FROM (SELECT "Mes", "{MARKET}" AS v, lag(v) OVER (ORDER BY "Mes") AS b FROM pv
        WHERE "Mes" IN ({text_list(LAST_MONTHS)})) WHERE "Mes" = '2000-12'""",
    "kpi_counts": f"""SELECT 'grupos' AS indicador, count(DISTINCT "Operadora") AS n FROM rl
        WHERE "Mes" IN ({text_list(LAST_MONTHS)}) AND "Operadora" IN ({text_list(CHOSEN)})
      UNION ALL SELECT 'meses', count(DISTINCT "Mes") FROM rl WHERE "Mes" IN ({text_list(LAST_MONTHS)})
      UNION ALL SELECT 'servicos', count(DISTINCT nome_servico) FROM tr WHERE ano_mes[1:4] = '2000'""",
    "delta_long": f"""SELECT "Mes", "Operadora", d AS "Delta" FROM melted WHERE "Operadora" IN ({text_list(CHOSEN)})""",
    "heat_matrix": 'SELECT "Operadora", ' + ", ".join(
        f"""max(CASE WHEN "Mes" = '{m}' THEN "Delta" END) AS "{m}" """ for m in LAST_MONTHS
    ) + f"FROM rl WHERE {IN_YEAR} GROUP BY 1",
    "tabular_extract": 'SELECT "Mes", ' + ", ".join(
        num(f"""max(CASE WHEN "Operadora" = '{g}' THEN "Delta" END)""", 2) + f' AS "{g}"' for g in CHOSEN
    ) + f" FROM rl WHERE {IN_YEAR} GROUP BY 1 ORDER BY 1",
    "distribution": f"""SELECT "Operadora", {num('min("Delta")')} AS minimo, {_box(0.25)} AS q1,
        {_box(0.5)} AS mediana, {_box(0.75)} AS q3, {num('max("Delta")')} AS maximo, count("Delta") AS n
      FROM rl GROUP BY 1""",
    "dq_not_null": _union(
        _nulls("dim_tempo", "dt_bad", "ano_mes"), _nulls("dim_tempo", "dt_bad", "ano"),
        _nulls("dim_grupo_economico", "dg_bad", "nome_grupo"), _nulls("fato_ida", "f_bad", "codigo_servico")),
    "dq_unique": _union(
        _dups("dim_tempo", "dt_bad", "ano_mes"), _dups("dim_grupo_economico", "dg_bad", "nome_grupo")),
    "dq_accepted": ACCEPTED,
    "dq_relationships": _union(_orphans("nome_grupo", "dg_bad"), _orphans("codigo_servico", "ds_bad")),
    "dq_summary": _union(
        _nulls("dim_tempo", "dt_bad", "ano_mes"), _dups("dim_tempo", "dt_bad", "ano_mes"),
        _nulls("dim_tempo", "dt_bad", "ano"), _nulls("dim_tempo", "dt_bad", "mes"),
        _nulls("dim_grupo_economico", "dg_bad", "nome_grupo"), _dups("dim_grupo_economico", "dg_bad", "nome_grupo"),
        _nulls("dim_servico", "ds_bad", "codigo_servico"), ACCEPTED,
        _nulls("fato_ida", "f_bad", "id_tempo"), _nulls("fato_ida", "f_bad", "nome_grupo"),
        _orphans("nome_grupo", "dg_bad"), _nulls("fato_ida", "f_bad", "codigo_servico"),
        _orphans("codigo_servico", "ds_bad"), _nulls("fato_ida", "f_bad", RATE),
        _nulls("long_delta", "ld", "ano_mes"), _nulls("long_delta", "ld", "nome_grupo"),
        _nulls("long_delta", "ld", "diferenca")),
    "dq_constraints": _constraints(),
}

ORACLE: dict[str, str] = {name: _sql(select) for name, select in _SELECTS.items()}
