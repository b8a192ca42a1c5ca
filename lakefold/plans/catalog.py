"""The registry of checked datasets: name -> (spark, sf_dir) -> DataFrame, and
the matching oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakefold.functions import (
    clean_ip, digits_only, json_field, lower_trim, period_kind, period_number, period_year, safe_date,
    safe_double, safe_long, strip_ws, surrogate_key, title_case, upper_trim,
)
from lakefold.fixed import LOADS, TAX_TYPES
from lakefold.operators.hot_groups import document_of
from lakefold.operators.integrity import foreign_key_orphans, primary_key_violations
from lakefold.plans import oracle, serving, silver, sinks
from lakefold.plans.layers import Layers
from lakefold.plans.schemas import BRONZE_SCHEMAS, DOCUMENT
from lakefold.plans.standins import LOG_HEADINGS
from lakefold.session import PACKED, brief_shuffles, fresh_path
from lakefold.sources import (
    accepted, html_table, html_table_status, rejected, scan_csv, scan_delimited, scan_documents, scan_json_documents, scan_pipe, scan_xml_documents, scan_xml_records,
    strict_timestamp, xml_to_json,
)
from lakefold.sources.documents import INVOICE_ELEMENT, INVOICE_FIELDS, as_array, invoice_elements, project_elements

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None, stage: bool = True):
    def deco(fn: Callable[[Layers], DataFrame]) -> Callable[[Layers], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: fn(Layers(spark, sf_dir, stage=stage))
        if sql is not None:
            ORACLE[name] = oracle.with_ctes(sql)
        return fn
    return deco


# -- silver --------------------------------------------------------------------
register("customer", "SELECT * FROM cliente")(lambda L: L.customer)
register("tax_analysis", "SELECT * FROM analise")(lambda L: L.tax_analysis)
register("project", "SELECT * FROM projeto", stage=False)(lambda L: L.project)
register("task", "SELECT * FROM tarefa", stage=False)(lambda L: L.task)
register("invoice", "SELECT * FROM nota_fiscal", stage=False)(lambda L: L.invoice)
register("invoice_tax", "SELECT * FROM nota_fiscal_imposto", stage=False)(lambda L: L.invoice_tax)
register("invoice_item", "SELECT * FROM nota_fiscal_item", stage=False)(lambda L: L.invoice_item)
register("system_log", "SELECT * FROM log_sistema")(lambda L: L.system_log)

# -- gold ----------------------------------------------------------------------
register("analysis_detail", "SELECT * FROM vw_anl_analise_tributaria")(lambda L: L.analysis_detail)
register("invoice_totals", "SELECT * FROM vw_anl_nota_fiscal")(lambda L: L.invoice_totals)
register("invoice_totals_exact", "SELECT * FROM invoice_totals_exact")(lambda L: L.invoice_totals_exact)
register("project_detail", "SELECT * FROM vw_anl_projetos")(lambda L: L.project_detail)
register("project_task_hours", "SELECT * FROM vw_snt_projetos_performance")(lambda L: L.project_task_hours)
register("project_longest_task", "SELECT * FROM project_longest_task")(lambda L: L.project_longest_task)
register("analysis_summary", "SELECT * FROM vw_snt_analises_tributarias")(lambda L: L.analysis_summary)
register("invoice_summary", "SELECT * FROM vw_snt_notas_fiscais")(lambda L: L.invoice_summary())

# -- quality -------------------------------------------------------------------
_TS, _DATE = oracle.AS_OF_TS, oracle.AS_OF_DATE
_DQ_SQL = {
    "dq_customer": f"""SELECT 'cliente' AS tabela, count_if(id_cliente IS NULL) AS nulos_id_cliente,
        count_if(cnpj IS NULL OR NOT regexp_matches(cnpj, '^\\d{{14}}$')) AS cnpj_invalido,
        count_if(data_cadastro IS NULL OR data_cadastro > {_DATE}) AS data_cadastro_invalida,
        count(*) - count(DISTINCT id_cliente) AS duplicatas_id_cliente, {_TS} AS data_checagem FROM cliente""",
    "dq_analysis": f"""SELECT 'analise_tributaria' AS tabela, count_if(id_analise IS NULL) AS nulos_id_analise,
        count_if(id_cliente IS NULL) AS nulos_id_cliente, count_if(valor_identificado < 0) AS valores_negativos,
        count_if(periodo_tipo NOT IN ('MES', 'TRIMESTRE', 'SEMESTRE')) AS periodo_tipo_invalido,
        count(*) - count(DISTINCT id_analise) AS duplicatas_id_analise, {_TS} AS data_checagem FROM analise""",
    "dq_project": f"""SELECT 'projeto' AS tabela, count_if(id_projeto IS NULL) AS nulos_id_projeto,
        count_if(id_cliente IS NULL) AS nulos_id_cliente, count_if(data_inicio > data_prevista_fim) AS datas_invertidas,
        count_if(valor_projeto < 0) AS valores_negativos,
        count(*) - count(DISTINCT id_projeto) AS duplicatas_id_projeto, {_TS} AS data_checagem FROM projeto""",
    "dq_task": f"""SELECT 'tarefa' AS tabela, count_if(id_tarefa IS NULL) AS nulos_id_tarefa,
        count_if(id_projeto IS NULL) AS nulos_id_projeto, count_if(data_inicio > data_prevista_fim) AS datas_invertidas,
        count_if(horas_estimadas < 0 OR horas_realizadas < 0) AS horas_negativas,
        count(*) - count(DISTINCT id_tarefa) AS duplicatas_id_tarefa, {_TS} AS data_checagem FROM tarefa""",
    "dq_invoice": f"""SELECT 'nota_fiscal' AS tabela, count_if(id_nota IS NULL) AS nulos_id_nota,
        count_if(id_cliente IS NULL) AS nulos_id_cliente,
        count_if(valor_total < 0 OR valor_servico < 0) AS valores_negativos,
        count_if(data_emissao IS NULL OR data_emissao > {_DATE}) AS data_emissao_invalida,
        count(*) - count(DISTINCT numero_nota) AS duplicatas_numero_nota, {_TS} AS data_checagem FROM nota_fiscal""",
    "dq_invoice_tax": f"""SELECT 'nota_fiscal_imposto' AS tabela, count_if(id_imposto IS NULL) AS nulos_id_imposto,
        count_if(id_nota IS NULL) AS nulos_id_nota, count_if(valor < 0) AS valores_negativos,
        count_if(tipo_imposto NOT IN ('ISS', 'PIS', 'COFINS')) AS tipo_invalido,
        count(*) - count(DISTINCT id_imposto) AS duplicatas_id_imposto, {_TS} AS data_checagem
        FROM nota_fiscal_imposto""",
    "dq_invoice_item": f"""SELECT 'nota_fiscal_item' AS tabela, count_if(id_item IS NULL) AS nulos_id_item,
        count_if(id_nota IS NULL) AS nulos_id_nota,
        count_if(quantidade <= 0 OR valor_unitario < 0) AS valores_invalidos,
        count(*) - count(DISTINCT id_item) AS duplicatas_id_item, {_TS} AS data_checagem FROM nota_fiscal_item""",
}


def _bigint_count_if(sql: str) -> str:
    """Wrap each ``count_if(...)`` in a BIGINT cast (DuckDB returns HUGEINT)."""
    out, i = [], 0
    while (j := sql.find("count_if(", i)) >= 0:
        depth, k = 0, j + len("count_if")
        while True:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
            if depth == 0:
                break
        out.append(sql[i:j] + "CAST(" + sql[j:k] + " AS BIGINT)")
        i = k
    return "".join(out) + sql[i:]


for _name, _sql in _DQ_SQL.items():
    register(_name, _bigint_count_if(_sql), stage=False)(lambda L, _n=_name: L.dq(_n))

# -- integrity -----------------------------------------------------------------


PRIMARY_KEYS = [("cliente", "customer", "id_cliente"), ("analise_tributaria", "tax_analysis", "id_analise"),
                ("projeto", "project", "id_projeto"), ("tarefa", "task", "id_tarefa"),
                ("nota_fiscal", "invoice", "id_nota"), ("nota_fiscal_imposto", "invoice_tax", "id_imposto"),
                ("nota_fiscal_item", "invoice_item", "id_item"), ("log_sistema", "system_log", "id_log")]
_ORACLE_TABLE = {"customer": "cliente", "tax_analysis": "analise", "project": "projeto", "task": "tarefa",
                 "invoice": "nota_fiscal", "invoice_tax": "nota_fiscal_imposto",
                 "invoice_item": "nota_fiscal_item", "system_log": "log_sistema"}
FOREIGN_KEYS = [("analise_tributaria.id_cliente", "tax_analysis", "id_cliente", "customer", "id_cliente"),
                ("projeto.id_cliente", "project", "id_cliente", "customer", "id_cliente"),
                ("tarefa.id_projeto", "task", "id_projeto", "project", "id_projeto"),
                ("nota_fiscal.id_cliente", "invoice", "id_cliente", "customer", "id_cliente"),
                ("nota_fiscal_imposto.id_nota", "invoice_tax", "id_nota", "invoice", "id_nota"),
                ("nota_fiscal_item.id_nota", "invoice_item", "id_nota", "invoice", "id_nota")]


def _union_all(frames):
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


# Rows that the checks below see twice (keys) or not at all (parents), so that every check has
# something to find: conditions that both SQL dialects read.
_TWICE = {"customer": "id_cliente LIKE '%77'", "tax_analysis": "id_analise LIKE '%77'", "project": "id_projeto LIKE '%77'",
          "task": "id_tarefa LIKE '%7-1'", "invoice": "numero_nota LIKE '%77'", "invoice_tax": "valor > 240",
          "invoice_item": "quantidade = 7", "system_log": "id_log LIKE '%77'"}
_GONE = {"project": "id_projeto LIKE '%33'", "invoice": "numero_nota LIKE '%33'"}


def _seeded(df, condition: str):
    again = F.when(F.expr(condition), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return df.withColumn("_again", F.explode(again)).drop("_again")


_MADE_OF = (("cliente", "analise", "log"), ("projeto", "tarefa"), ("nota",))


def _checked(L: Layers, checks: dict):
    """Violations by table, written for the tables of a source at a time: those share what they read, and
    leave the room of their shuffle files to the next ones."""
    written = []
    for tables in _MADE_OF:
        found = _union_all([df for table, df in checks.items() if table.startswith(tables)])
        path = fresh_path(L.spark, "violations")
        with brief_shuffles(L.spark):
            found.write.options(**PACKED).parquet(path)
        written.append(L.spark.read.schema(found.schema).parquet(path))
    return _union_all(written)


@register("check_primary_key", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, '{k}' AS key_column, {k} AS key_value, count(*) AS n_rows "
    f"FROM (SELECT * FROM {_ORACLE_TABLE[attr]} UNION ALL SELECT * FROM {_ORACLE_TABLE[attr]} WHERE {_TWICE[attr]}) "
    f"GROUP BY {k} HAVING count(*) > 1 OR {k} IS NULL" for t, attr, k in PRIMARY_KEYS))
def _check_primary_key(L: Layers):
    L.stage_documents()
    return _checked(L, {t: primary_key_violations(_seeded(getattr(L, attr), _TWICE[attr]), k, t) for t, attr, k in PRIMARY_KEYS})


@register("check_foreign_key", "\nUNION ALL\n".join(
    f"SELECT '{rel}' AS relation, c.{fk} AS key_value, count(*) AS n_rows FROM {_ORACLE_TABLE[child]} c "
    f"WHERE c.{fk} IS NOT NULL AND c.{fk} NOT IN (SELECT {pk} FROM {_ORACLE_TABLE[parent]} WHERE {pk} IS NOT NULL "
    f"AND NOT ({_GONE.get(parent, 'false')})) "
    f"GROUP BY c.{fk}" for rel, child, fk, parent, pk in FOREIGN_KEYS))
def _check_foreign_key(L: Layers):
    L.stage_documents()
    return _checked(L, {rel: foreign_key_orphans(getattr(L, child), fk, getattr(L, parent).where(f"NOT ({_GONE.get(parent, 'false')})"), pk, rel)
                        for rel, child, fk, parent, pk in FOREIGN_KEYS})


# -- scalar expressions ----------------------------------------------------------
_s, _t = oracle.strip, oracle.title


@register("text_standardise", f"""SELECT id_cliente, upper({_s('razao_social')}) AS razao_social_std,
    lower({_s('setor')}) AS setor_std, lower({_s('cidade')}) AS cidade_std FROM customer_raw""")
def _text_standardise(L: Layers):
    return L.customer_raw.select("id_cliente", upper_trim("razao_social").alias("razao_social_std"),
                                 lower_trim("setor").alias("setor_std"), lower_trim("cidade").alias("cidade_std"))


@register("title_case", f"""SELECT 'cliente' AS source, razao_social AS raw, {_t(_s('razao_social'))} AS titled
    FROM customer_raw
    UNION ALL SELECT 'analise', observacoes, {_t(_s('observacoes'))} FROM analysis_raw
    UNION ALL SELECT 'log', acao, {_t(_s('acao'))} FROM log_raw""")
def _title_case(L: Layers):
    def one(df, label, col):
        return df.select(F.lit(label).alias("source"), F.col(col).alias("raw"),
                         title_case(strip_ws(col)).alias("titled"))
    return _union_all([one(L.customer_raw, "cliente", "razao_social"), one(L.analysis_raw, "analise", "observacoes"),
                       one(L.log_raw, "log", "acao")])


@register("digits_only", """SELECT id_cliente, cnpj, regexp_replace(cnpj, '\\D', '', 'g') AS cnpj_digits,
    length(regexp_replace(cnpj, '\\D', '', 'g')) AS n_digits FROM customer_raw""")
def _digits_only(L: Layers):
    d = digits_only("cnpj")
    return L.customer_raw.select("id_cliente", "cnpj", d.alias("cnpj_digits"),
                                 F.length(d).cast("bigint").alias("n_digits"))


@register("clean_ip", """SELECT id_log, ip, regexp_replace(coalesce(ip, ''), '[^0-9\\\\.]+', '', 'g') AS ip_clean
    FROM log_raw""")
def _clean_ip(L: Layers):
    return L.log_raw.select("id_log", "ip", clean_ip("ip").alias("ip_clean"))


_PA = "periodo_analise"


@register("period_parse", f"""SELECT id_analise, {_PA}, TRY_CAST(substr({_PA}, 1, 4) AS BIGINT) AS ano,
    CASE WHEN regexp_matches({_PA}, '-Q[1-4]') THEN 'TRIMESTRE' WHEN regexp_matches({_PA}, '-S[1-2]') THEN 'SEMESTRE'
         WHEN regexp_matches({_PA}, '-\\d{{2}}$') THEN 'MES' ELSE 'DESCONHECIDO' END AS periodo_tipo,
    CASE WHEN regexp_matches({_PA}, '-Q[1-4]') THEN TRY_CAST(regexp_extract({_PA}, 'Q([1-4])', 1) AS BIGINT)
         WHEN regexp_matches({_PA}, '-S[1-2]') THEN TRY_CAST(regexp_extract({_PA}, 'S([1-2])', 1) AS BIGINT)
         WHEN regexp_matches({_PA}, '-\\d{{2}}$') THEN TRY_CAST(regexp_extract({_PA}, '-(\\d{{2}})$', 1) AS BIGINT)
    END AS periodo_valor FROM analysis_raw""")
def _period_parse(L: Layers):
    p = F.col(_PA)
    return L.analysis_raw.select("id_analise", _PA, period_year(p).alias("ano"), period_kind(p).alias("periodo_tipo"),
                                 period_number(p).alias("periodo_valor"))


@register("safe_cast", """SELECT 'PRJ' || CAST(o_orderkey AS VARCHAR) AS id_projeto,
    CASE WHEN o_orderkey % 211 = 5 THEN '2024-13-45' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS data_inicio_text,
    CASE WHEN o_orderkey % 211 = 5 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS data_inicio,
    CASE WHEN o_orderkey % 101 = 13 THEN -o_totalprice ELSE o_totalprice END AS valor_projeto,
    o_orderkey % 500 + 10 AS horas_totais_estimadas, TRY_CAST('abc' || CAST(o_orderkey AS VARCHAR) AS BIGINT) AS bad_long
    FROM orders""")
def _safe_cast(L: Layers):
    el = L.project_elements.dropDuplicates(["id_projeto"])
    return el.select("id_projeto", F.col("data_inicio").alias("data_inicio_text"),
                     safe_date("data_inicio").alias("data_inicio"), safe_double("valor_projeto").alias("valor_projeto"),
                     safe_long("horas_totais_estimadas").alias("horas_totais_estimadas"),
                     safe_long(F.concat(F.lit("abc"), F.substring("id_projeto", 4, 30))).alias("bad_long"))


@register("json_field", """SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
    json_extract_string(props, '$.missing') AS missing FROM events""")
def _json_field(L: Layers):
    ev = L.table("events")
    return ev.select("event_id", json_field("props", "$.k", "bigint").alias("k"),
                     json_field("props", "$.missing").alias("missing"))


@register("surrogate_key", """SELECT 'nf-doc-' || CAST(o_orderkey AS VARCHAR) AS document,
    CAST(0 AS BIGINT) AS pos, id_nota FROM nf_base""")
def _surrogate_key(L: Layers):
    return L.invoice_elements.select(document_of().alias("document"), F.col("pos").cast("bigint").alias("pos"),
                                     silver.invoice_key().alias("id_nota")).distinct()


@register("distinct_rows", "SELECT DISTINCT * FROM customer_raw")
def _distinct_rows(L: Layers):
    return L.customer_raw.distinct()


_PRJ_DOCS = """(SELECT 'prj-doc-' || CAST(o.o_orderkey AS VARCHAR) AS document,
      'PRJ' || CAST(o.o_orderkey AS VARCHAR) AS id_projeto, CAST(coalesce(p.n, 0) AS BIGINT) AS n_tarefas
    FROM orders o LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey) p
      ON o.o_orderkey = p.l_orderkey)"""


@register("json_array_rows", f"SELECT document, CAST(0 AS BIGINT) AS pos, id_projeto, n_tarefas FROM {_PRJ_DOCS}")
def _json_array_rows(L: Layers):
    from lakefold.sources.documents import json_array_rows
    rows = json_array_rows(L.project_docs)
    return (rows.groupBy(document_of().alias("document"), F.col("pos").cast("bigint").alias("pos"),
                         F.col("element")["id_projeto"].alias("id_projeto"))
                .agg(F.sum(F.size(F.col("element")["tarefas"])).alias("n_tarefas")))

# -- file sources ------------------------------------------------------------------


CUSTOMER_RAW_SCHEMA = BRONZE_SCHEMAS["clientes"]
ANALYSIS_RAW_SCHEMA = BRONZE_SCHEMAS["analises_tributarias"]


def _write_delimited(df, path: str, sep: str) -> None:
    # Keep blanks and tabs at the edges of values: they are part of the raw data.
    (df.write.mode("overwrite").option("header", True).option("sep", sep)
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


@register("scan_csv", "SELECT * FROM customer_raw")
def _scan_csv(L: Layers):
    path = fresh_path(L.spark, "customers-csv")
    _write_delimited(L.customer_raw, path, ",")
    return scan_csv(L.spark, path, CUSTOMER_RAW_SCHEMA)


@register("scan_pipe", "SELECT * FROM analysis_raw")
def _scan_pipe(L: Layers):
    path = fresh_path(L.spark, "analyses-txt")
    _write_delimited(L.analysis_raw, path, "|")
    return scan_pipe(L.spark, path, ANALYSIS_RAW_SCHEMA)


ELEMENTS_OF_FILE = 20_000  # projects or invoices that a source file is given
# Files of documents are compressed: the same texts take up to ten times the room.  A compressed file is read by one task,
# so it is given few enough elements.
COMPRESSED = {"compression": "gzip"}
FILE_OPTIONS = {**COMPRESSED, "maxRecordsPerFile": ELEMENTS_OF_FILE}


def _written_text(L: Layers, texts, path: str) -> None:
    with brief_shuffles(L.spark):
        texts.write.options(**FILE_OPTIONS).text(path)


@register("scan_documents", f"SELECT id_projeto, n_tarefas FROM {_PRJ_DOCS}")
def _scan_documents(L: Layers):
    path = fresh_path(L.spark, "projects-jsonl")
    _written_text(L, L.project_docs.select("conteudo"), path)
    docs = scan_documents(L.spark, path, by_line=True)
    return (docs.groupBy(F.get_json_object("conteudo", "$.projetos[0].id_projeto").alias("id_projeto"))
                .agg(F.sum(F.json_array_length(F.get_json_object("conteudo", "$.projetos[0].tarefas")))
                      .alias("n_tarefas")))


_NF_DOCS = """(SELECT nf.numero_nota, nf.data_emissao, nf.id_cliente, nf.valor_servico, nf.valor_total,
      coalesce(i.n, 0) AS n_itens, nf.id_nota
    FROM nota_fiscal nf LEFT JOIN (SELECT id_nota, count(*) AS n FROM nota_fiscal_item GROUP BY id_nota) i
      ON nf.id_nota = i.id_nota)"""


@register("xml_records", f"""SELECT numero_nota, data_emissao, id_cliente, valor_servico, valor_total, n_itens
    FROM {_NF_DOCS}""")
def _xml_records(L: Layers):
    from lakefold.plans.standins import invoice_nodes
    path = fresh_path(L.spark, "invoices-xml")
    nodes = invoice_nodes(L.table("orders"), L.table("lineitem"), L.hot_orders).select("NotaFiscal.*")
    with brief_shuffles(L.spark):
        (nodes.write.mode("overwrite").option("rowTag", "NotaFiscal").option("rootTag", "NotasFiscais").option("indent", "").options(**FILE_OPTIONS).xml(path))
    rows = scan_xml_records(L.spark, path, "NotaFiscal", INVOICE_ELEMENT[len("struct<"):-1].replace(":", " "))
    return (rows.groupBy(F.col("NumeroNota").alias("numero_nota"),
                         F.to_date("DataEmissao", "yyyy-MM-dd").alias("data_emissao"),
                         F.col("ClienteID").alias("id_cliente"),
                         F.col("ValorServico").cast("double").alias("valor_servico"),
                         F.col("ValorTotal").cast("double").alias("valor_total"))
                .agg(F.sum(F.coalesce(F.size("Itens.Item"), F.lit(0))).alias("n_itens")))


_XML_LEAVES = """SELECT 'nf-doc-' || CAST(nf.o_orderkey AS VARCHAR) AS document, '2' AS versao, '00A' AS serie,
    'NF' || CAST(nf.o_orderkey AS VARCHAR) AS numero_nota, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS data_emissao,
    'CLI' || CAST(o_custkey AS VARCHAR) AS id_cliente, o_totalprice - o_orderkey % 100 AS valor_servico, o_totalprice AS valor_total,
    iss, pis, cofins, descricao, quantidade, valor_unitario
    FROM nf_base nf LEFT JOIN (SELECT id_nota AS nid, max(CASE WHEN tipo_imposto = 'ISS' THEN valor END) AS iss,
        max(CASE WHEN tipo_imposto = 'PIS' THEN valor END) AS pis, max(CASE WHEN tipo_imposto = 'COFINS' THEN valor END) AS cofins
      FROM nota_fiscal_imposto GROUP BY id_nota) t ON nf.id_nota = t.nid
    LEFT JOIN nota_fiscal_item i ON nf.id_nota = i.id_nota"""


@register("xml_to_json", _XML_LEAVES)
def _xml_to_json(L: Layers):
    """Every leaf of the trees, with an attribute of the root and an element that no schema declares."""
    extended = F.replace(F.replace("conteudo", F.lit("<NotasFiscais>"), F.lit('<NotasFiscais versao="2">')),
                         F.lit("<NotaFiscal>"), F.lit("<NotaFiscal><Serie>00A</Serie>"))
    js = xml_to_json(L.invoice_docs.withColumn("conteudo", extended))
    note = "struct<Serie:string," + ",".join(f"{f}:string" for f in INVOICE_FIELDS) + ",Impostos:struct<ISS:string,PIS:string,COFINS:string>,Itens:struct<Item:string>>"
    top = js.select("doc_id", F.from_json("conteudo", f"NotasFiscais struct<`@versao`:string,NotaFiscal:{note}>")["NotasFiscais"].alias("t"))
    n = F.col("t")["NotaFiscal"]
    item = F.explode_outer(F.from_json(as_array(n["Itens"]["Item"]), "array<struct<Descricao:string,Quantidade:string,ValorUnitario:string>>"))
    rows = top.select("doc_id", F.col("t")["@versao"].alias("versao"), n.alias("n"), item.alias("i"))
    return rows.select(document_of().alias("document"), "versao", F.col("n.Serie").alias("serie"), F.col("n.NumeroNota").alias("numero_nota"),
                       F.col("n.DataEmissao").alias("data_emissao"), F.col("n.ClienteID").alias("id_cliente"),
                       F.col("n.ValorServico").cast("double").alias("valor_servico"), F.col("n.ValorTotal").cast("double").alias("valor_total"),
                       *[F.col(f"n.Impostos.{t}").cast("double").alias(t.lower()) for t in TAX_TYPES],
                       F.col("i.Descricao").alias("descricao"), F.col("i.Quantidade").cast("bigint").alias("quantidade"),
                       F.col("i.ValorUnitario").cast("double").alias("valor_unitario"))


@register("html_table", """SELECT id_log, CAST(log_time AS VARCHAR) AS log_time, usuario, acao,
    entidade_afetada, resultado, ip FROM log_raw""")
def _html_table(L: Layers):
    return html_table(L.log_pages, LOG_HEADINGS).drop("doc_id", "row_pos")


@register("html_table_rejects", """SELECT DISTINCT 'log-page-' || CAST(event_day AS VARCHAR) AS document,
      CASE WHEN extract('day' FROM event_day) = 7 THEN 'missing_columns' ELSE 'ok' END AS status,
      CASE WHEN extract('day' FROM event_day) = 7 THEN 'log_time' ELSE '' END AS missing FROM log_raw
    UNION ALL
    SELECT 'page-' || CAST(page_id AS VARCHAR), CASE WHEN regexp_matches(html, '(?is)<table\\b.*?</table>') THEN NULL
      ELSE 'missing_table' END, '' FROM pages""")
def _html_table_rejects(L: Layers):
    pages = L.table("pages").select(F.concat(F.lit("page-"), F.col("page_id").cast("string")).alias("doc_id"),
                                    F.col("html").alias("conteudo"))
    # the pages of every 7th of a month come without the heading of the time column
    renamed = F.when(F.col("doc_id").rlike("-07#"), F.replace("conteudo", F.lit("<th>Timestamp</th>"), F.lit("<th>Hora</th>")))
    logs = L.log_pages.withColumn("conteudo", F.coalesce(renamed, F.col("conteudo")))
    st = html_table_status(logs.unionByName(pages), LOG_HEADINGS)
    return st.select(document_of().alias("document"), "status", F.array_join("missing", ", ").alias("missing")).distinct()


@register("timestamp_gate", "SELECT id_log, log_time FROM log_raw")
def _timestamp_gate(L: Layers):
    rows = html_table(L.log_pages, LOG_HEADINGS)
    return rows.select("id_log", strict_timestamp("log_time").alias("log_time"))


# -- sinks -------------------------------------------------------------------------


@register("land_bronze", "SELECT * FROM customer_raw")
def _land_bronze(L: Layers):
    schema = StructType.fromDDL(CUSTOMER_RAW_SCHEMA)
    return sinks.land_bronze(L.customer_raw, schema, fresh_path(L.spark, "bronze-clientes"))


@register("refresh_table", "SELECT * FROM cliente")
def _refresh_table(L: Layers):
    path = fresh_path(L.spark, "silver-cliente")
    sinks.refresh_table(L.customer.limit(0), path)  # an earlier, different state of the table
    return sinks.refresh_table(L.customer, path)


@register("partitioned_write", "SELECT * FROM nota_fiscal")
def _partitioned_write(L: Layers):
    path = fresh_path(L.spark, "silver-nota-fiscal")
    earlier = (L.invoice.where(F.month("data_emissao") == 1)
               .withColumn("data_emissao", F.date_add("data_emissao", 20000)))  # dates that are gone later
    sinks.partitioned_write(earlier, path, "data_emissao")
    return sinks.partitioned_write(L.invoice, path, "data_emissao")


@register("clustered_write", "SELECT * FROM tarefa")
def _clustered_write(L: Layers):
    return sinks.clustered_write(L.task, fresh_path(L.spark, "silver-tarefa"), ["id_projeto"])


_LANDED = {"clientes": "SELECT count(*) FROM customer_raw", "analises_tributarias": "SELECT count(*) FROM analysis_raw",
           "tarefas_projetos": "SELECT count(*) FROM orders", "notas_fiscais": "SELECT count(*) FROM nf_base",
           "logs_sistema": "SELECT count(DISTINCT event_day) FROM log_raw",
           "notas_fiscais_json": "SELECT count(*) FROM nf_base", "logs_sistema_table": "SELECT count(*) FROM log_raw"}
_LOADS = [(op, table, _LANDED[table]) for op, table in LOADS] + [("load_formated_html", "paginas_web_table", None),
                                                                ("load_raw_xml", "notas_truncadas", None)]


def _audit_sql() -> str:
    rows = ["SELECT 1 AS seq, 'run_ddl_script' AS operation, 'bronze_schemas' AS table_id, 'START' AS status, "
            "CAST(NULL AS BIGINT) AS n_rows",
            "SELECT 2, 'run_ddl_script', 'bronze_schemas', 'SUCCESS', CAST(NULL AS BIGINT)"]
    for i, (op, table, count_sql) in enumerate(_LOADS, start=1):
        rows.append(f"SELECT {2 * i + 1} AS seq, '{op}' AS operation, '{table}' AS table_id, 'START' AS status, "
                    f"CAST(NULL AS BIGINT) AS n_rows")
        if count_sql is None:
            rows.append(f"SELECT {2 * i + 2}, '{op}', '{table}', 'ERROR', CAST(NULL AS BIGINT)")
        else:
            rows.append(f"SELECT {2 * i + 2}, '{op}', '{table}', 'SUCCESS', ({count_sql})")
    return ("SELECT CAST(seq AS BIGINT) AS seq, operation, table_id, status, n_rows FROM ("
            + "\nUNION ALL\n".join(rows) + ")")


@register("load_audit", _audit_sql())
def _load_audit(L: Layers):
    """Schema setup, the seven bronze loads, and two that must fail: web pages
    without a table, and invoices whose document is cut off."""
    from lakefold.plans.refresh import loaders as load_list
    root = fresh_path(L.spark, "bronze")
    schemas = dict(BRONZE_SCHEMAS, paginas_web_table=BRONZE_SCHEMAS["logs_sistema_table"],
                   notas_truncadas="NumeroNota string")
    web = L.table("pages").select(F.concat(F.lit("page-"), F.col("page_id").cast("string")).alias("doc_id"),
                                  F.col("html").alias("conteudo"))

    def cut_off():
        landed = sinks.read_table(L.spark, f"{root}/notas_fiscais")
        return invoice_elements(landed.withColumn("conteudo", F.expr("left(conteudo, length(conteudo) - 9)"))).select("NumeroNota")
    loaders = [*load_list(L.spark, L, root, "stand-in"),
               sinks.Loader("load_formated_html", "paginas_web_table", "stand-in:paginas_web_table",
                            lambda: sinks.conform(silver.log_table(web, LOG_HEADINGS), schemas["paginas_web_table"])),
               sinks.Loader("load_raw_xml", "notas_truncadas", "stand-in:notas_truncadas", cut_off, after="notas_fiscais")]
    sinks.run_loads(L.spark, loaders, root, f"{root}/_audit",
                    setup=("bronze_schemas", lambda: sinks.setup_tables(L.spark, root, schemas)))
    audit = L.spark.read.schema(sinks.AUDIT_SCHEMA).parquet(f"{root}/_audit")
    # a large document is stored in several rows: documents are counted, not rows
    landed = _union_all([sinks.read_table(L.spark, f"{root}/{t}").select(F.lit(t).alias("_t"), document_of().alias("document"))
                         for t, ddl in BRONZE_SCHEMAS.items() if ddl == DOCUMENT])
    documents = landed.groupBy("_t").agg(F.countDistinct("document").alias("_n"))
    whole = audit.join(documents, F.col("table_id") == F.col("_t"), "left")
    return whole.select(F.col("seq").cast("bigint").alias("seq"), "operation", "table_id", "status",
                        F.when(F.col("n_rows").isNotNull(), F.coalesce("_n", "n_rows")).alias("n_rows"))


# -- refresh and serving --------------------------------------------------------
def _views(L: Layers):
    return {name: (lambda n=name: L.gold_view(n)) for name in L.GOLD_VIEWS}


@register("read_view", "SELECT * FROM vw_snt_notas_fiscais ORDER BY id_cliente LIMIT 100")
def _read_view(L: Layers):
    return serving.read_view(_views(L), "VW_SNT_NOTAS_FISCAIS", 100, order_by=("id_cliente",))


# The columns of the six views; amounts are compared as text with four places.
_SERVED = {
    "vw_anl_analise_tributaria": ("id_analise cliente tipo_tributo ano_analise tipo_periodo_analise periodo_valor observacoes", "valor_identificado"),
    "vw_anl_nota_fiscal": ("id_nota id_cliente numero_nota data_emissao", "valor_total valor_servico valor_itens valor_iss valor_pis valor_cofins"),
    "vw_anl_projetos": ("id_projeto nome_projeto responsavel nome_cliente status data_inicio data_prevista_fim horas_totais_estimadas "
                        "horas_totais_realizadas id_tarefa descricao responsavel_tarefa status_tarefa data_inicio_tarefa "
                        "data_prevista_fim_tarefa horas_estimadas_tarefa horas_realizadas_tarefa", ""),
    "vw_snt_projetos_performance": ("id_projeto id_cliente nome_cliente responsavel status horas_totais_estimadas horas_totais_realizadas "
                                    "tarefa_longa hrs_tarefa", ""),
    "vw_snt_analises_tributarias": ("id_cliente nome_cliente qtd_analises qtd_tipos_tributos ultimo_ano_analisado",
                                    "valor_total_identificado maior_valor_identificado menor_valor_identificado"),
    "vw_snt_notas_fiscais": ("id_cliente nome_cliente qtd_notas ultima_emissao",
                             "valor_total_notas valor_total_servicos total_iss total_pis total_cofins"),
}


def _served_text(view: str, text: str) -> str:
    """A row as text, in words that both SQL dialects read (``text``: the type of text)."""
    columns, amounts = (part.split() for part in _SERVED[view])
    return ", ".join([*[f"coalesce(CAST({c} AS {text}), '')" for c in columns],
                      *[f"coalesce(CAST(CAST({c} AS DECIMAL(18,4)) AS {text}), '')" for c in amounts]])


@register("serve_views", " UNION ALL ".join(f"SELECT '{v}' AS view, concat_ws('|', {_served_text(v, 'VARCHAR')}) AS row_text FROM {v}" for v in _SERVED))
def _serve_views(L: Layers):
    """Refresh a warehouse, open it again, and read every row of every gold view from its stored tables
    and definitions."""
    from lakefold.plans.refresh import open_warehouse, refresh_all
    wh = open_warehouse(L.spark, refresh_all(L.spark, L.sf_dir, as_of=L.as_of).root, L.as_of)
    return _union_all([wh.views[v].select(F.lit(v).alias("view"), F.expr(f"concat_ws('|', {_served_text(v, 'STRING')})").alias("row_text"))
                       for v in _SERVED])


def _n_files(L: Layers) -> int:
    return max(1, -(-L.table("orders").count() // ELEMENTS_OF_FILE))


def _write_projects(L: Layers, path: str) -> None:
    """JSON files, each one object with an array of many projects."""
    n = _n_files(L)
    along = Window.partitionBy("file").orderBy("doc_id")
    objects = L.project_docs.select("doc_id", F.regexp_extract("conteudo", r'(?s)^\{"projetos":\[(.*)\]\}$', 1).alias("o"),
                                    F.pmod(F.xxhash64("doc_id"), F.lit(n)).alias("file")).repartition(n, "file")
    lines = objects.withColumns({"nth": F.row_number().over(along), "last": F.lead("doc_id").over(along).isNull()})
    text = F.concat(F.when(F.col("nth") == 1, F.lit('{"versao": 2, "projetos": [\n')).otherwise(F.lit(",")), "o", F.when(F.col("last"), F.lit("\n]}")).otherwise(F.lit("")))
    with brief_shuffles(L.spark):
        lines.sortWithinPartitions("file", "nth").select(text.alias("value")).write.options(**COMPRESSED).text(path)


def _write_invoices(L: Layers, path: str) -> None:
    """XML files, each one root with many invoices."""
    from lakefold.plans.standins import invoice_nodes
    nodes = invoice_nodes(L.table("orders"), L.table("lineitem"), L.hot_orders).select("NotaFiscal.*")
    with brief_shuffles(L.spark):
        (nodes.repartition(_n_files(L)).write.option("rowTag", "NotaFiscal").option("rootTag", "NotasFiscais").option("declaration", "").option("indent", "")
         .options(**COMPRESSED).xml(path))


def write_source_files(L: Layers, folder: str) -> None:
    """The five kinds of source files, made of the driver tables: many projects or invoices in a JSON or XML
    file, one page in an HTML file."""
    _write_delimited(L.customer_raw, f"{folder}/clientes", ",")
    _write_delimited(L.analysis_raw, f"{folder}/analises", "|")
    _write_projects(L, f"{folder}/projetos")
    _write_invoices(L, f"{folder}/notas")
    with brief_shuffles(L.spark):
        L.log_pages.select("conteudo").write.option("maxRecordsPerFile", 1).options(**COMPRESSED).text(f"{folder}/logs")


@register("split_json_file", """SELECT 'PRJ' || CAST(o_orderkey AS VARCHAR) AS id_projeto, CAST(coalesce(p.n, 0) AS BIGINT) AS n_tarefas
    FROM orders o LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey) p ON o.o_orderkey = p.l_orderkey""")
def _split_json_file(L: Layers):
    """Projects of large JSON files, read in as many tasks as the files are split into."""
    path = fresh_path(L.spark, "projects-json")
    _write_projects(L, path)
    rows = project_elements(scan_json_documents(L.spark, path, "projetos"))
    return rows.groupBy("id_projeto").agg(F.sum(F.size("tarefas")).alias("n_tarefas"))


@register("split_xml_file", f"SELECT numero_nota, data_emissao, id_cliente, valor_servico, valor_total, n_itens FROM {_NF_DOCS}")
def _split_xml_file(L: Layers):
    """Invoices of large XML files, read in as many tasks as the files are split into."""
    path = fresh_path(L.spark, "invoices-xml-files")
    _write_invoices(L, path)
    rows = invoice_elements(scan_xml_documents(L.spark, path, "NotaFiscal"))
    return (rows.groupBy(F.col("NumeroNota").alias("numero_nota"), F.to_date("DataEmissao").alias("data_emissao"), F.col("ClienteID").alias("id_cliente"),
                         F.col("ValorServico").cast("double").alias("valor_servico"), F.col("ValorTotal").cast("double").alias("valor_total"))
                .agg(F.sum(F.coalesce(F.size("Itens"), F.lit(0))).alias("n_itens")))


@register("refresh_from_files", "SELECT * FROM vw_snt_notas_fiscais")
def _refresh_from_files(L: Layers):
    """The invoice summary of a warehouse that was refreshed from a folder of source files."""
    from lakefold.plans.refresh import refresh_all
    folder = fresh_path(L.spark, "source-files")
    write_source_files(L, folder)
    return refresh_all(L.spark, files=folder, as_of=L.as_of).views["vw_snt_notas_fiscais"]


@register("document_rejects", """SELECT 'prj-doc-' || CAST(o_orderkey AS VARCHAR) AS document, 'malformed' AS reason
    FROM orders WHERE o_orderkey % 97 = 3
    UNION ALL SELECT 'nf-doc-' || CAST(o_orderkey AS VARCHAR), 'malformed' FROM orders WHERE o_orderkey % 89 = 5""")
def _document_rejects(L: Layers):
    """Documents whose last characters are lost are reported, and no others."""
    from lakefold.sources.documents import document_rejects

    def cut(docs, rest, of):
        number = F.regexp_extract(document_of(), r"(\d+)$", 1).cast("bigint")
        return docs.withColumn("conteudo", F.when(number % of == rest, F.expr("left(conteudo, length(conteudo) - 12)"))
                               .otherwise(F.col("conteudo")))
    found = document_rejects(cut(L.project_docs, 3, 97), "json").unionByName(document_rejects(cut(L.invoice_docs, 5, 89), "xml"))
    return found.select(document_of().alias("document"), "reason").distinct()


@register("html_row_headers", """SELECT id_log, CAST(log_time AS VARCHAR) AS log_time, usuario, acao,
    entidade_afetada, resultado, ip FROM log_raw""")
def _html_row_headers(L: Layers):
    """Rows that start with a row header are data, and a table in a comment is none."""
    first = F.regexp_replace("conteudo", r"<tr><td>([^<]*)</td>", "<tr><th>$1</th>")
    hidden = F.replace(first, F.lit("<body>"), F.lit("<body><!-- <table><tr><th>x</th></tr></table> -->"))
    return html_table(L.log_pages.withColumn("conteudo", hidden), LOG_HEADINGS).drop("doc_id", "row_pos")


@register("delimited_rejects", """SELECT id_analise, CASE event_id % 83 WHEN 7 THEN 'short' WHEN 11 THEN 'long' WHEN 13 THEN 'ill_typed' END AS reason,
      CASE WHEN event_id % 83 IN (7, 11, 13) THEN NULL ELSE valor_identificado END AS valor_identificado
    FROM (SELECT *, CAST(substr(id_analise, 5) AS BIGINT) AS event_id FROM analysis_raw)""")
def _delimited_rejects(L: Layers):
    """Lines with a field too few or too many, or a word for an amount, are set aside with a reason; the others load."""
    path = fresh_path(L.spark, "analyses-misfits")
    rest = F.substring("id_analise", 5, 30).cast("bigint") % 83
    value = F.when(rest == 13, F.lit("muito")).otherwise(F.coalesce(F.col("valor_identificado").cast("string"), F.lit("")))
    fields = [F.coalesce(c, F.lit("")) for c in ("id_analise", "cliente_id", "tipo_tributo", "periodo_analise")] + [value]
    line = F.concat(F.concat_ws("|", *fields), F.when(rest == 7, F.lit("")).otherwise(F.concat(F.lit("|"), "observacoes")),
                    F.when(rest == 11, F.lit("|x")).otherwise(F.lit("")))
    L.analysis_raw.select(F.struct(line.alias("id_analise|cliente_id|tipo_tributo|periodo_analise|valor_identificado|observacoes")).alias("l")).select("l.*") \
        .write.option("header", True).option("sep", "\u0001").option("quote", "").option("ignoreLeadingWhiteSpace", False) \
        .option("ignoreTrailingWhiteSpace", False).csv(path)
    rows = scan_delimited(L.spark, path, ANALYSIS_RAW_SCHEMA, "|")
    good = accepted(rows).select("id_analise", F.lit(None).cast("string").alias("reason"), "valor_identificado")
    bad = rejected(rows, "|").select(F.substring_index("line", "|", 1).alias("id_analise"), "reason", F.lit(None).cast("double").alias("valor_identificado"))
    return good.unionByName(bad)


_SPANS = """SELECT id_log, CAST(log_time AS VARCHAR) AS log_time, usuario, acao, entidade_afetada, resultado, ip, id_log AS copia,
    chr(8364) || ' <' || id_log || '>' AS nota FROM log_raw"""


@register("html_table_grid", _SPANS)
def _html_table_grid(L: Layers):
    """Pages whose cells span columns and rows, with numeric and named entities, read as the plain pages do."""
    wide = F.regexp_replace("conteudo", r"<tr><td>([^<]*)</td>", r"<tr><td colspan=2>$1</td><td>&#8364;&#x20;&lt;$1&gt;</td>")
    wide = F.replace(wide, F.lit("<tr><th>ID Log</th>"), F.lit("<tr><th>ID Log</th><th>Copia</th><th>Nota</th>"))
    # a page-wide cell that hangs down from the first data row to the last one
    tall = F.regexp_replace(wide, r"<tbody><tr>", '<tbody><tr><td rowspan="65534">&Aacute;&#0;rea</td>')
    tall = F.replace(tall, F.lit("<tr><th>ID Log</th>"), F.lit("<tr><th>Area</th><th>ID Log</th>"))
    cut = F.replace(tall, F.lit('rowspan="65534"'), F.concat(F.lit('rowspan="'), F.size(F.split("conteudo", "<tr>")) - 2, F.lit('"')))
    pages = L.log_pages.withColumn("conteudo", cut)
    rows = html_table(pages, {"Area": "area", **LOG_HEADINGS, "Copia": "copia", "Nota": "nota"})
    return rows.where(F.col("area") == "\u00C1\uFFFDrea").drop("doc_id", "row_pos", "area")


@register("rows_as_json", """SELECT id_cliente, nome_cliente, qtd_notas, CAST(ultima_emissao AS VARCHAR) AS ultima_emissao,
    valor_total_notas, valor_total_servicos, total_iss, total_pis, total_cofins FROM vw_snt_notas_fiscais""")
def _rows_as_json(L: Layers):
    js = serving.rows_as_json(L.invoice_summary())
    return js.select(F.get_json_object("json", "$.id_cliente").alias("id_cliente"),
                     F.get_json_object("json", "$.nome_cliente").alias("nome_cliente"),
                     F.get_json_object("json", "$.qtd_notas").cast("bigint").alias("qtd_notas"),
                     F.get_json_object("json", "$.ultima_emissao").alias("ultima_emissao"),
                     *[F.get_json_object("json", f"$.{c}").cast("double").alias(c)
                       for c in ("valor_total_notas", "valor_total_servicos", "total_iss", "total_pis", "total_cofins")])
