"""Silver: typed, standardised, de-duplicated tables.

Whole-row DISTINCT as in the reference (duplicate keys with differing columns
survive; the quality views measure them), applied before the processing
stamp is added.  ``as_of`` fixes the stamp for reproducible runs; by default it
is the query's current time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakefold.fixed import TAX_TYPES
from lakefold.functions.keys import surrogate_key
from lakefold.functions.parsing import (
    period_kind, period_number, period_year, safe_date, safe_double, safe_long, strict_date,
    strict_double, strict_long,
)
from lakefold.functions.text import clean_ip, digits_only, lower_trim, strip_ws, title_case, upper_trim
from lakefold.operators.hot_groups import document_of, part_of
from lakefold.operators.reshape import unpivot_columns
from lakefold.sources.documents import project_elements, task_elements
from lakefold.sources.gates import gate_timestamp
from lakefold.sources.html import html_table


def stamp(as_of: str | None) -> Column:
    if as_of is None:
        return F.current_timestamp().cast("timestamp_ntz")
    return F.lit(as_of).cast("timestamp_ntz")


def customer(raw: DataFrame, as_of: str | None = None) -> DataFrame:
    return (raw.where(F.col("id_cliente").isNotNull())
               .select("id_cliente",
                       upper_trim("razao_social").alias("razao_social"),
                       digits_only("cnpj").alias("cnpj"),
                       lower_trim("setor").alias("setor"),
                       lower_trim("cidade").alias("cidade"),
                       "estado",
                       strict_date("data_cadastro").alias("data_cadastro"))
               .distinct()
               .withColumn("data_tratamento", stamp(as_of)))


def tax_analysis(raw: DataFrame, as_of: str | None = None) -> DataFrame:
    p = F.col("periodo_analise")
    return (raw.where(F.col("id_analise").isNotNull() & F.col("cliente_id").isNotNull()
                      & F.col("valor_identificado").isNotNull())
               .select(F.col("id_analise").cast("string").alias("id_analise"),
                       F.col("cliente_id").cast("string").alias("id_cliente"),
                       upper_trim("tipo_tributo").alias("tipo_tributo"),
                       period_year(p).alias("ano"),
                       period_kind(p).alias("periodo_tipo"),
                       period_number(p).alias("periodo_valor"),
                       safe_double("valor_identificado").alias("valor_identificado"),
                       title_case(strip_ws("observacoes")).alias("observacoes"))
               .distinct()
               .withColumn("data_tratamento", stamp(as_of)))


def project(docs: DataFrame) -> DataFrame:
    """One row per distinct project object of the JSON documents (or of parsed elements)."""
    elements = docs if "tarefas" in docs.columns else project_elements(docs)
    return (elements
            .where(F.col("id_projeto").isNotNull())
            .select("id_projeto", "nome_projeto",
                    F.col("cliente_id").alias("id_cliente"),
                    "responsavel",
                    safe_date("data_inicio").alias("data_inicio"),
                    safe_date("data_prevista_fim").alias("data_prevista_fim"),
                    "status",
                    safe_double("valor_projeto").alias("valor_projeto"),
                    safe_long("horas_totais_estimadas").alias("horas_totais_estimadas"),
                    safe_long("horas_totais_realizadas").alias("horas_totais_realizadas"))
            .distinct())


def task(docs: DataFrame) -> DataFrame:
    """One row per distinct task object nested in the projects (documents or parsed elements)."""
    return (task_elements(docs)
            .where(F.col("id_tarefa").isNotNull())
            .select("id_projeto", "id_tarefa", "descricao",
                    safe_date("data_inicio").alias("data_inicio"),
                    safe_date("data_prevista_fim").alias("data_prevista_fim"),
                    "responsavel_tarefa", "status_tarefa",
                    safe_long("horas_estimadas").alias("horas_estimadas"),
                    safe_long("horas_realizadas").alias("horas_realizadas"))
            .distinct())


def invoice_key() -> Column:
    """Key of an invoice element; the parts of a large document share it."""
    return surrogate_key(document_of(), "pos")


def invoice(elements: DataFrame) -> DataFrame:
    """One row per invoice; strict casts fail the refresh.  DISTINCT folds the parts
    of an invoice that is stored in several."""
    return elements.select(
        invoice_key().alias("id_nota"),
        F.col("NumeroNota").alias("numero_nota"),
        strict_date("DataEmissao").alias("data_emissao"),
        F.col("ClienteID").alias("id_cliente"),
        strict_double("ValorServico").alias("valor_servico"),
        strict_double("ValorTotal").alias("valor_total")).distinct()


def invoice_tax(elements: DataFrame) -> DataFrame:
    """One row per invoice and present tax (ISS, PIS, COFINS unpivoted)."""
    typed = elements.select(invoice_key().alias("id_nota"),
                            *[strict_double(t).alias(t) for t in TAX_TYPES]).distinct()
    taxes = unpivot_columns(typed, ["id_nota"], {t: t for t in TAX_TYPES}, "tipo_imposto", "valor")
    return taxes.select(surrogate_key("id_nota", "tipo_imposto").alias("id_imposto"),
                        "id_nota", "tipo_imposto", "valor")


def invoice_item(elements: DataFrame) -> DataFrame:
    """One row per item of each invoice element.  Children carry the parent key; their
    own key is made of it, the part they are stored in, and their place there."""
    items = elements.select(invoice_key().alias("id_nota"), part_of().alias("part"),
                            F.posexplode("Itens").alias("item_pos", "it"))
    return items.select(surrogate_key("id_nota", "part", "item_pos").alias("id_item"),
                        "id_nota",
                        F.col("it")["Descricao"].alias("descricao"),
                        strict_long(F.col("it")["Quantidade"]).alias("quantidade"),
                        strict_double(F.col("it")["ValorUnitario"]).alias("valor_unitario"))


def log_table(pages: DataFrame, heading_map) -> DataFrame:
    """Bronze log rows: the pages' first tables, with every timestamp valid."""
    rows = html_table(pages, heading_map, strict=True).select(*heading_map.values())
    return gate_timestamp(rows, "log_time")


def _truncate_to_second(c: str) -> Column:
    """Zone-free truncation of a TIMESTAMP_NTZ (``date_trunc`` returns a zoned TIMESTAMP)."""
    return F.substring(F.col(c).cast("string"), 1, 19).cast("timestamp_ntz")


def system_log(bronze: DataFrame, as_of: str | None = None) -> DataFrame:
    return (bronze.where(F.col("id_log").isNotNull())
                  .select(F.col("id_log").cast("string").alias("id_log"),
                          F.to_date("log_time").alias("data_evento"),
                          _truncate_to_second("log_time").alias("log_time"),
                          lower_trim("usuario").alias("usuario"),
                          title_case(strip_ws("acao")).alias("acao"),
                          title_case(strip_ws("entidade_afetada")).alias("entidade_afetada"),
                          upper_trim("resultado").alias("resultado"),
                          clean_ip("ip").alias("ip"))
                  .distinct()
                  .withColumn("data_tratamento", stamp(as_of)))


__all__ = ["customer", "tax_analysis", "project", "task", "invoice", "invoice_tax", "invoice_item",
           "log_table", "system_log", "invoice_key", "stamp"]
