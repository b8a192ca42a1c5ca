"""Bronze inputs derived from the driver tables.

The reference lands a customer CSV, a pipe-delimited analyses file, one JSON
document of projects and tasks, one XML document of invoices and one HTML page
of system logs.  Here every one of them is derived by Spark from the given
tables, so each query's work grows with the data:

* customers      <- customer + nation
* tax analyses   <- events
* projects/tasks <- orders / lineitem, serialised as JSON documents
* invoices       <- orders + lineitem, serialised as XML documents
* system logs    <- events, serialised as HTML table pages

Field derivations use only integer arithmetic, string building and date
formatting, so an independent SQL engine can recompute the same records.
Edge cases (NULLs, duplicates, malformed periods, inverted dates, negative
amounts, IPv6 addresses, escaped characters) are placed by fixed rules on the
keys.  Documents are built per bounded group (see ``split_hot_groups``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakefold.fixed import LOG_HEADINGS as FIXED_LOG_HEADINGS
from lakefold.operators.hot_groups import attach_groups, hot_keys, split_hot_groups

# Group bounds for the nested documents (rows per document part).
MAX_LINES_PER_DOCUMENT = 64          # tasks per project document, items per invoice
MAX_TASKS_PER_DOCUMENT = MAX_ITEMS_PER_INVOICE = MAX_LINES_PER_DOCUMENT
MAX_ROWS_PER_LOG_PAGE = 256

# The log page headings (a fixed value, stated in lakefold.fixed).
LOG_HEADINGS = FIXED_LOG_HEADINGS


def _dstr(c) -> F.Column:
    # ISO date text by casting (no session time zone involved, unlike date_format).
    return F.to_date(c).cast("string")


def _id(prefix: str, c) -> F.Column:
    return F.concat(F.lit(prefix), F.col(c).cast("string"))


# ---------------------------------------------------------------------------
# customers (delimited)
# ---------------------------------------------------------------------------
def customer_records(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Raw customer rows, all STRING, as a comma-delimited file would hold them.

    ``nation`` is small; it is broadcast if its measured size allows.
    """
    k = F.col("c_custkey")
    digits = F.when(k % 97 == 5, F.lpad(k.cast("string"), 13, "0")).otherwise(
        F.lpad(k.cast("string"), 14, "0"))
    cnpj = F.concat(F.substring(digits, 1, 2), F.lit("."), F.substring(digits, 3, 3), F.lit("."),
                    F.substring(digits, 6, 3), F.lit("/"), F.substring(digits, 9, 4), F.lit("-"),
                    F.substring(digits, 13, 2))
    signup = F.when(k % 89 == 11, F.date_add(F.lit("2031-01-01").cast("date"), (k % 300).cast("int"))) \
              .otherwise(F.date_add(F.lit("2023-01-01").cast("date"), ((k * 7) % 700).cast("int")))
    base = (customer.join(nation.select("n_nationkey", "n_name"),
                          F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .select(
                k.alias("_k"),
                F.when(k % 101 == 100, F.lit(None).cast("string")).otherwise(_id("CLI", "c_custkey")).alias("id_cliente"),
                F.concat(F.when(k % 10 == 3, F.lit("\t")).otherwise(F.lit("  ")), F.col("c_name"),
                         F.lit(" comércio-"), F.lower("c_mktsegment"), F.lit(" ")).alias("razao_social"),
                cnpj.alias("cnpj"),
                F.col("c_mktsegment").alias("porte_empresa"),
                F.concat(F.lit(" "), F.col("c_mktsegment"), F.lit(" ")).alias("setor"),
                F.concat(F.col("n_name"), F.lit("  ")).alias("cidade"),
                F.substring("n_name", 1, 2).alias("estado"),
                _dstr(signup).alias("data_cadastro"),
            ))
    # Re-sent rows, added on top of every input row (nothing is dropped): for one
    # customer in 37 a second record, an exact copy or the same id with another city.
    copies = (base.where(F.col("_k") % 37 == 0)
                  .withColumn("cidade", F.when(F.col("_k") % 74 == 0,
                                               F.concat(F.col("cidade"), F.lit("(filial)")))
                                         .otherwise(F.col("cidade"))))
    return base.unionByName(copies).drop("_k")


# ---------------------------------------------------------------------------
# tax analyses (pipe-delimited)
# ---------------------------------------------------------------------------
def analysis_records(events: DataFrame) -> DataFrame:
    e = F.col("event_id")
    year = F.year("ts").cast("string")
    period = (F.when(e % 101 == 41, F.lit(None).cast("string"))
               .when(e % 101 == 17, F.concat(year, F.lit("-Q12")))
               .when(e % 101 == 29, year)
               .when(e % 3 == 0, F.substring(F.col("ts").cast("string"), 1, 7))
               .when(e % 3 == 1, F.concat(year, F.lit("-Q"), F.quarter("ts").cast("string")))
               .otherwise(F.concat(year, F.lit("-S"),
                                   F.when(F.month("ts") <= 6, F.lit("1")).otherwise(F.lit("2")))))
    value = (F.when(e % 59 == 4, F.lit(None).cast("double"))
              .when(e % 53 == 3, -F.col("value"))
              .otherwise(F.col("value")))
    return events.select(
        _id("ANLS", "event_id").alias("id_analise"),
        _id("CLI", "user_id").alias("cliente_id"),
        F.concat(F.lit(" "), F.col("event_type"), F.lit(" ")).alias("tipo_tributo"),
        period.alias("periodo_analise"),
        value.alias("valor_identificado"),
        F.concat(F.lit("  crédito "), F.col("event_type"), F.lit("-fiscal em REVISÃO ")).alias("observacoes"),
    )


# ---------------------------------------------------------------------------
# projects and tasks (JSON documents)
# ---------------------------------------------------------------------------
def project_records(orders: DataFrame, *more: str) -> DataFrame:
    """The project of each order, with the columns ``more``."""
    k = F.col("o_orderkey")
    start = F.to_date("o_orderdate")
    status = (F.when(k % 61 == 7, F.lit(None).cast("string"))
               .when(F.col("o_orderstatus") == "F", F.lit("Concluido"))
               .when(F.col("o_orderstatus") == "O", F.lit("Em andamento"))
               .otherwise(F.lit("Cancelado")))
    return orders.select(
        k.alias("o_orderkey"),
        _id("PRJ", "o_orderkey").alias("id_projeto"),
        F.concat(F.lit("Projeto "), F.col("o_orderpriority")).alias("nome_projeto"),
        _id("CLI", "o_custkey").alias("cliente_id"),
        F.concat(F.lit("Analista "), (F.col("o_custkey") % 17).cast("string")).alias("responsavel"),
        F.when(k % 211 == 5, F.lit("2024-13-45")).otherwise(_dstr(start)).alias("data_inicio"),
        _dstr(F.date_add(start, ((k % 120) - 10).cast("int"))).alias("data_prevista_fim"),
        status.alias("status"),
        F.when(k % 101 == 13, -F.col("o_totalprice")).otherwise(F.col("o_totalprice")).alias("valor_projeto"),
        (k % 500 + 10).alias("horas_totais_estimadas"),
        ((k * 7) % 600).alias("horas_totais_realizadas"),
        *more,
    )


_LINE_IDENTITY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
_LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey"]  # of the lines within a document, before their fields
_NOT_SOUGHT = object()
_LINE_COLUMNS = [*_LINE_IDENTITY, "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate"]


def order_lines(lineitem: DataFrame) -> DataFrame:
    """The columns of the order lines that documents are made of."""
    return lineitem.select(*_LINE_COLUMNS)


def hot_orders(lineitem: DataFrame) -> DataFrame | None:
    """Orders with more lines than one document holds.  Project documents (tasks) and invoice
    documents (items) split them in the same way, so one table serves both."""
    return hot_keys(order_lines(lineitem), "l_orderkey", MAX_LINES_PER_DOCUMENT)


def _with_lines(orders: DataFrame, lineitem: DataFrame, hot, item, name: str) -> DataFrame:
    """Orders, as they are (their records are longer, and made of them afterwards), with the array of their lines; ``hot`` is what ``hot_orders`` found, if it was sought already."""
    hot = hot_orders(lineitem) if hot is _NOT_SOUGHT else hot
    return attach_groups(orders, "o_orderkey", order_lines(lineitem), "l_orderkey", item, name, MAX_LINES_PER_DOCUMENT, hot)


def task_fields() -> dict[str, F.Column]:
    """The fields of the task that an order line is."""
    qty = F.col("l_quantity").cast("bigint")
    ship = F.to_date("l_shipdate")
    return {
        "id_tarefa": F.concat(F.lit("TRF"), F.col("l_orderkey").cast("string"), F.lit("-"),
                              F.col("l_linenumber").cast("string")),
        "descricao": (F.when(F.col("l_returnflag") == "R", F.lit("Revisão fiscal"))
                       .when(F.col("l_returnflag") == "A", F.lit("Apuração de créditos"))
                       .otherwise(F.lit("Levantamento"))),
        "data_inicio": _dstr(ship),
        "data_prevista_fim": _dstr(F.date_add(ship, (F.col("l_linenumber") * 3 - 5).cast("int"))),
        "responsavel_tarefa": F.concat(F.lit("Consultor "), F.col("l_suppkey").cast("string")),
        "status_tarefa": F.when(F.col("l_linestatus") == "O", F.lit("Aberta")).otherwise(F.lit("Finalizada")),
        "horas_estimadas": qty,
        "horas_realizadas": qty + F.col("l_linenumber") - 3,
    }


def project_documents(orders: DataFrame, lineitem: DataFrame, hot=_NOT_SOUGHT) -> DataFrame:
    """JSON documents ``{"projetos": [{..., "tarefas": [...]}]}``.

    One document per (project, part): a project with many tasks is repeated in
    several documents, each holding a bounded share of its tasks; the silver
    DISTINCT folds the repeats back into one project row.
    """
    fields = task_fields()
    docs = project_records(_with_lines(orders, lineitem, hot, F.struct(
        *_LINE_ORDER, F.struct(*[c.alias(f) for f, c in fields.items()]).alias("made")), "_tasks"), "part", "_tasks")
    project_fields = ["id_projeto", "nome_projeto", "cliente_id", "responsavel", "data_inicio",
                      "data_prevista_fim", "status", "valor_projeto", "horas_totais_estimadas",
                      "horas_totais_realizadas"]
    tarefas = F.coalesce(
        F.col("_tasks")["made"],
        F.array().cast("array<struct<" + ",".join(
            f"{f}:{'bigint' if f.startswith('horas') else 'string'}" for f in fields) + ">>"))
    project = F.struct(*[F.col(f) for f in project_fields], tarefas.alias("tarefas"))
    return docs.select(
        F.concat(F.lit("prj-doc-"), F.col("o_orderkey").cast("string"), F.lit("#"), F.col("part").cast("string")).alias("doc_id"),
        F.to_json(F.struct(F.array(project).alias("projetos"))).alias("conteudo"))


# ---------------------------------------------------------------------------
# invoices (XML documents)
# ---------------------------------------------------------------------------
def item_fields() -> dict[str, F.Column]:
    """The fields of the invoice item that an order line is."""
    return {
        "Descricao": (F.when(F.col("l_linenumber") == 1,
                             F.concat(F.lit("Peça "), F.col("l_partkey").cast("string"), F.lit(" & Cia <lote>")))
                       .otherwise(F.concat(F.lit("Serviço "), F.col("l_partkey").cast("string")))),
        "Quantidade": F.col("l_quantity").cast("bigint"),
        "ValorUnitario": F.col("l_extendedprice"),
    }


def invoice_records(orders: DataFrame, *more: str) -> DataFrame:
    """The invoice of each order, with the columns ``more``.

    An order that comes in parts repeats the same invoice (number, amounts, taxes) with
    its share of the items, and the silver tables fold them into one.
    """
    k = F.col("o_orderkey")
    quarter = lambda c: c.cast("double") / F.lit(4.0)
    iss = (F.when(k % 13 == 0, F.lit(None).cast("double"))
            .when(k % 173 == 1, -quarter(k % 997))
            .otherwise(quarter(k % 997)))
    pis = F.when(k % 7 == 0, F.lit(None).cast("double")).otherwise(quarter(F.col("o_custkey") % 300))
    cofins = F.when(k % 11 == 0, F.lit(None).cast("double")).otherwise((k % 1999).cast("double") / F.lit(8.0))
    return orders.select(
        k.alias("o_orderkey"),
        F.concat(F.lit("NF"), k.cast("string")).alias("NumeroNota"),
        _dstr("o_orderdate").alias("DataEmissao"),
        _id("CLI", "o_custkey").alias("ClienteID"),
        (F.col("o_totalprice") - (k % 100)).alias("ValorServico"),
        F.col("o_totalprice").alias("ValorTotal"),
        iss.alias("ISS"), pis.alias("PIS"), cofins.alias("COFINS"),
        *more,
    )


def invoice_nodes(orders: DataFrame, lineitem: DataFrame, hot=_NOT_SOUGHT) -> DataFrame:
    """One ``NotaFiscal`` struct per (order, part), with its items: (doc_id, NotaFiscal)."""
    fields = item_fields()
    inv = invoice_records(_with_lines(orders, lineitem, hot, F.struct(
        *_LINE_ORDER, F.struct(*[c.alias(f) for f, c in fields.items()]).alias("made")), "_items"), "part", "_items")
    nota = F.struct("NumeroNota", "DataEmissao", "ClienteID", "ValorServico", "ValorTotal",
                    F.struct("ISS", "PIS", "COFINS").alias("Impostos"),
                    F.struct(F.col("_items")["made"].alias("Item")).alias("Itens"))
    return inv.select(
        F.concat(F.lit("nf-doc-"), F.col("o_orderkey").cast("string"), F.lit("#"),
                 F.col("part").cast("string")).alias("doc_id"),
        nota.alias("NotaFiscal"))


def invoice_documents(orders: DataFrame, lineitem: DataFrame, hot=_NOT_SOUGHT) -> DataFrame:
    """XML documents ``<NotasFiscais><NotaFiscal>...</NotaFiscal></NotasFiscais>``.

    Values are escaped by ``to_xml``; an absent tax is an absent element; no
    indentation (whitespace between elements only costs parse time).
    """
    nodes = invoice_nodes(orders, lineitem, hot)
    return nodes.select(
        "doc_id",
        F.concat(F.lit("<NotasFiscais>"), F.to_xml("NotaFiscal", {"rowTag": "NotaFiscal", "indent": ""}),
                 F.lit("</NotasFiscais>")).alias("conteudo"))


# ---------------------------------------------------------------------------
# system logs (HTML pages)
# ---------------------------------------------------------------------------
def log_records(events: DataFrame) -> DataFrame:
    k = F.col("event_id")
    action = (F.when(F.col("event_type") == "view", F.lit("visualizar REGISTRO"))
               .when(F.col("event_type") == "click", F.lit("clicar-botão"))
               .when(F.col("event_type") == "purchase", F.lit("efetuar compra"))
               .when(F.col("event_type") == "signup", F.lit("criar CONTA"))
               .otherwise(F.lit("erro de sistema")))
    entity = (F.when(k % 4 == 0, F.lit("nota fiscal"))
               .when(k % 4 == 1, F.lit("cliente & parceiro"))
               .when(k % 4 == 2, F.lit("projeto"))
               .otherwise(F.lit("tarefa")))
    ip = (F.when(k % 41 == 0, F.lit(None).cast("string"))
           .when(k % 43 == 0, F.concat(F.lit("fe80::"), F.col("user_id").cast("string")))
           .when(k % 47 == 0, F.concat(F.lit("192.168.x"), (F.col("user_id") % 256).cast("string"), F.lit(".5")))
           .otherwise(F.concat(F.lit("10."), (F.col("user_id") % 256).cast("string"), F.lit("."),
                               (k % 256).cast("string"), F.lit(".1"))))
    return events.select(
        k.alias("event_id"), F.to_date("ts").alias("event_day"),
        _id("LOG", "event_id").alias("id_log"),
        F.col("ts").cast("string").alias("log_time"),
        F.concat(F.lit("  User"), F.col("user_id").cast("string"), F.lit(" ")).alias("usuario"),
        action.alias("acao"),
        entity.alias("entidade_afetada"),
        F.when(F.col("event_type") == "error", F.lit(" falha ")).otherwise(F.lit("sucesso ")).alias("resultado"),
        ip.alias("ip"),
    )


def _html_escape(c) -> F.Column:
    c = F.replace(c, F.lit("&"), F.lit("&amp;"))
    c = F.replace(c, F.lit("<"), F.lit("&lt;"))
    return F.replace(c, F.lit(">"), F.lit("&gt;"))


def log_pages(events: DataFrame) -> DataFrame:
    """HTML pages, one per (day, part), each with one table of log rows.

    Some entity cells carry inline markup, and an empty cell is a missing IP.
    """
    logs = split_hot_groups(log_records(events), ["event_day"], MAX_ROWS_PER_LOG_PAGE)
    cols = list(LOG_HEADINGS.values())

    def cell(name: str) -> F.Column:
        text = F.coalesce(_html_escape(F.col(name)), F.lit(""))
        if name == "entidade_afetada":
            text = F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("<b>"), text, F.lit("</b>"))).otherwise(text)
        return F.concat(F.lit("<td>"), text, F.lit("</td>"))

    row = F.concat(F.lit("<tr>"), *[cell(c) for c in cols], F.lit("</tr>"))
    header = "<tr>" + "".join(f"<th>{h}</th>" for h in LOG_HEADINGS) + "</tr>"
    pages = (logs.groupBy("event_day", "part")
                 .agg(F.array_sort(F.collect_list(F.struct("event_id", row.alias("html")))).alias("_rows")))
    body = F.array_join(F.transform("_rows", lambda r: r["html"]), "")
    return pages.select(
        F.concat(F.lit("log-page-"), F.coalesce(F.col("event_day").cast("string"), F.lit("unknown")), F.lit("#"),
                 F.col("part").cast("string")).alias("doc_id"),
        F.concat(F.lit("<html><head><title>Logs do sistema</title></head><body><h1>Logs</h1>"
                       "<table class=\"logs\"><thead>" + header + "</thead><tbody>"),
                 body, F.lit("</tbody></table></body></html>")).alias("conteudo"))
