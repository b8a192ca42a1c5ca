"""Declared bronze schemas (the landing tables' DDL), never inferred.

Document tables carry a ``doc_id`` next to the document text: generated keys
are derived from it, so re-runs give the same keys.
"""

from __future__ import annotations

DOCUMENT = "doc_id string, conteudo string"

BRONZE_SCHEMAS = {
    "clientes": ("id_cliente string, razao_social string, cnpj string, porte_empresa string, setor string, "
                 "cidade string, estado string, data_cadastro string"),
    "analises_tributarias": ("id_analise string, cliente_id string, tipo_tributo string, periodo_analise string, "
                             "valor_identificado double, observacoes string"),
    "tarefas_projetos": DOCUMENT,
    "notas_fiscais": DOCUMENT,
    "logs_sistema": DOCUMENT,
    "notas_fiscais_json": DOCUMENT,
    "logs_sistema_table": ("id_log string, log_time timestamp_ntz, usuario string, acao string, "
                           "entidade_afetada string, resultado string, ip string"),
}
