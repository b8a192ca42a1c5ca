"""Fixed values.

These must equal the source pipeline's values for the results to be the same
(labels, domains, patterns, formats and the log page's heading map).  They are
stated here once, in their natural order; the code refers to them by name.
"""

# Text format of dates in the sources (one-digit months and days are dates as well).
DATE_FORMAT = "yyyy-M-d"

# Period text: the tests in the order they are applied, each with its label and
# the pattern whose first group is the period number.  Only the month test is
# anchored, so '2024-Q12' is a quarter.
PERIOD_RULES = [
    (r"-Q[1-4]", "TRIMESTRE", r"Q([1-4])"),
    (r"-S[1-2]", "SEMESTRE", r"S([1-2])"),
    (r"-\d{2}$", "MES", r"-(\d{2})$"),
]
PERIOD_UNKNOWN = "DESCONHECIDO"
VALID_PERIOD_KINDS = ("MES", "TRIMESTRE", "SEMESTRE")

# Invoice taxes, in document order.
TAX_TYPES = ("ISS", "PIS", "COFINS")

# Project status excluded from the performance view.
CANCELLED_STATUS = "Cancelado"

# A valid tax number: exactly fourteen digits.
TAX_NUMBER_PATTERN = r"^\d{14}$"

# Characters removed from IP addresses: all but digits, dots and backslashes.
IP_DROP_PATTERN = r"[^0-9\\.]+"

# Headings of the system-log table and the column each maps to.
LOG_HEADINGS = {
    "ID Log": "id_log",
    "Timestamp": "log_time",
    "Usuário": "usuario",
    "Ação": "acao",
    "Entidade Afetada": "entidade_afetada",
    "Resultado": "resultado",
    "IP": "ip",
}

# The loads of a refresh in their order: operation and bronze table.
LOADS = [
    ("load_raw_csv", "clientes"),
    ("load_raw_txt", "analises_tributarias"),
    ("load_raw_json", "tarefas_projetos"),
    ("load_raw_xml", "notas_fiscais"),
    ("load_raw_html", "logs_sistema"),
    ("load_formated_xml", "notas_fiscais_json"),
    ("load_formated_html", "logs_sistema_table"),
]

# Messages of the load audit.
AUDIT_MESSAGES = {
    "ddl_start": "Executando script {}",
    "ddl_done": "Script {} executado com sucesso",
    "ddl_failed": "Falha ao executar DDL {}: {}",
    "load_start": "Lendo {}",
    "load_done": "{} carregada com sucesso",
    "load_failed": "Falha ao processar {}: {}",
}
