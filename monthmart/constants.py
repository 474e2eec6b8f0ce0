"""Fixed domain values of the mart: they decide the results, so they are stated as they are."""

# Month abbreviations as spelled in the sheets, January first.
MONTHS = ("JAN", "FEV", "MAR", "ABR", "MAI", "JUN", "JUL", "AGO", "SET", "OUT", "NOV", "DEZ")

# A cell with this text (trimmed, upper case) marks the header row of a sheet.
HEADER_SENTINEL = "GRUPO ECONÔMICO"

# Metric name for sheets that have no metric column.
DEFAULT_METRIC = "Valor Único"

# Placeholder text of unnamed header cells.
UNNAMED_HEADER = "Unnamed"

# Resource titles: service code, dash, year.
TITLE_PATTERN = r"(SCM|SMP|STFC)\s*-\s*(\d{4})"
WORKBOOK_SUFFIX = ".ods"
WORKBOOK_SIGNATURE = "PK"

# code -> (name, description); unknown codes keep the code as name.
SERVICES = {
    "SMP": ("Serviço Móvel Pessoal", "Telefonia Celular"),
    "STFC": ("Serviço Telefônico Fixo Comutado", "Telefonia Fixa"),
    "SCM": ("Serviço de Comunicação Multimídia", "Banda Larga Fixa"),
}
OTHER_SERVICE_DESCRIPTION = "Outros"

# (prefix of the cleaned name, group); the first match wins.
GROUP_ALIASES = (
    ("OI", "OI"),
    ("CLARO", "CLARO"),
    ("VIVO", "VIVO"),
    ("TELEFÔNICA", "VIVO"),
    ("TIM", "TIM"),
    ("CTBC", "ALGAR"),
    ("ALGAR", "ALGAR"),
    ("SERCOMTEL", "SERCOMTEL"),
)
# The report side only merges this one.
REPORT_ALIASES = (("SERCOMTEL", "SERCOMTEL"),)

# Text dropped from group names: bracketed notes and asterisks.
NAME_NOISE = r"\s*\([^)]*\)|\*+"
NAME_NOTE = r"\s*\([^)]*\)"
NAME_STARS = r"\*+"

# Metric names behind each measure of the fact table.
INDEX_PREFIXES = ("Indicador de Desempenho", "Índice de Desempenho")  # any case
RATE_5D_PREFIX = "Taxa de Resolvidas em 5 dias"  # any case
RATE_TOTAL_NAME = "Taxa de Resolvidas no Período"  # any case
REQUEST_NAMES = (  # exact case
    "Total de Solicitações",
    "Quantidade de Solicitações",
    "Quantidade de reclamações",
    "Quantidade de Reclamações",
    "Quantidade de Reclamações no Período",
    "Total de Reclamações",
)
RESOLVED_NAMES = (  # exact case
    "Quantidade de resolvidas",
    "Quantidade de Sol. Resolvidas no Período",
    "Quantidade de Respondidas",
)

# Columns of the staging table, in load order.
STAGING_COLUMNS = (
    "ano", "mes", "ano_mes", "servico", "grupo_economico", "variavel", "valor", "arquivo_origem",
)

# Report: variations beyond this bound (in percent) are shown as missing.
OUTLIER_BOUND = 200.0
MARKET_COLUMN = "Taxa de Variação Média"
