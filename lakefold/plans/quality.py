"""Data-quality views: one row of violation counts per silver table.

Each view is a single global aggregate (partial counts per task, one tiny
final merge).  ``as_of`` is the check time; future-date tests compare with its
date.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakefold.fixed import TAX_NUMBER_PATTERN, TAX_TYPES, VALID_PERIOD_KINDS
from lakefold.operators.integrity import duplicate_excess
from lakefold.plans.silver import stamp


def _today(as_of: str | None) -> Column:
    return F.to_date(stamp(as_of))


def _view(df: DataFrame, table: str, as_of: str | None, *metrics: Column) -> DataFrame:
    return df.agg(*metrics).select(F.lit(table).alias("tabela"), "*", stamp(as_of).alias("data_checagem"))


def _count_if(cond: Column) -> Column:
    # COUNTIF counts TRUE only: a NULL comparison is not counted.
    return F.count_if(F.coalesce(cond, F.lit(False)))


def dq_customer(customer: DataFrame, as_of: str | None = None) -> DataFrame:
    c = F.col
    return _view(customer, "cliente", as_of,
                 _count_if(c("id_cliente").isNull()).alias("nulos_id_cliente"),
                 _count_if(c("cnpj").isNull() | ~c("cnpj").rlike(TAX_NUMBER_PATTERN)).alias("cnpj_invalido"),
                 _count_if(c("data_cadastro").isNull() | (c("data_cadastro") > _today(as_of)))
                 .alias("data_cadastro_invalida"),
                 duplicate_excess("id_cliente").alias("duplicatas_id_cliente"))


def dq_analysis(analysis: DataFrame, as_of: str | None = None) -> DataFrame:
    c = F.col
    return _view(analysis, "analise_tributaria", as_of,
                 _count_if(c("id_analise").isNull()).alias("nulos_id_analise"),
                 _count_if(c("id_cliente").isNull()).alias("nulos_id_cliente"),
                 _count_if(c("valor_identificado") < 0).alias("valores_negativos"),
                 _count_if(~c("periodo_tipo").isin(*VALID_PERIOD_KINDS)).alias("periodo_tipo_invalido"),
                 duplicate_excess("id_analise").alias("duplicatas_id_analise"))


def dq_project(project: DataFrame, as_of: str | None = None) -> DataFrame:
    c = F.col
    return _view(project, "projeto", as_of,
                 _count_if(c("id_projeto").isNull()).alias("nulos_id_projeto"),
                 _count_if(c("id_cliente").isNull()).alias("nulos_id_cliente"),
                 _count_if(c("data_inicio") > c("data_prevista_fim")).alias("datas_invertidas"),
                 _count_if(c("valor_projeto") < 0).alias("valores_negativos"),
                 duplicate_excess("id_projeto").alias("duplicatas_id_projeto"))


def dq_task(task: DataFrame, as_of: str | None = None) -> DataFrame:
    c = F.col
    return _view(task, "tarefa", as_of,
                 _count_if(c("id_tarefa").isNull()).alias("nulos_id_tarefa"),
                 _count_if(c("id_projeto").isNull()).alias("nulos_id_projeto"),
                 _count_if(c("data_inicio") > c("data_prevista_fim")).alias("datas_invertidas"),
                 _count_if((c("horas_estimadas") < 0) | (c("horas_realizadas") < 0)).alias("horas_negativas"),
                 duplicate_excess("id_tarefa").alias("duplicatas_id_tarefa"))


def dq_invoice(invoice: DataFrame, as_of: str | None = None) -> DataFrame:
    c = F.col
    return _view(invoice, "nota_fiscal", as_of,
                 _count_if(c("id_nota").isNull()).alias("nulos_id_nota"),
                 _count_if(c("id_cliente").isNull()).alias("nulos_id_cliente"),
                 _count_if((c("valor_total") < 0) | (c("valor_servico") < 0)).alias("valores_negativos"),
                 _count_if(c("data_emissao").isNull() | (c("data_emissao") > _today(as_of)))
                 .alias("data_emissao_invalida"),
                 duplicate_excess("numero_nota").alias("duplicatas_numero_nota"))


def dq_invoice_tax(tax: DataFrame, as_of: str | None = None) -> DataFrame:
    c = F.col
    return _view(tax, "nota_fiscal_imposto", as_of,
                 _count_if(c("id_imposto").isNull()).alias("nulos_id_imposto"),
                 _count_if(c("id_nota").isNull()).alias("nulos_id_nota"),
                 _count_if(c("valor") < 0).alias("valores_negativos"),
                 _count_if(~c("tipo_imposto").isin(*TAX_TYPES)).alias("tipo_invalido"),
                 duplicate_excess("id_imposto").alias("duplicatas_id_imposto"))


def dq_invoice_item(item: DataFrame, as_of: str | None = None) -> DataFrame:
    c = F.col
    return _view(item, "nota_fiscal_item", as_of,
                 _count_if(c("id_item").isNull()).alias("nulos_id_item"),
                 _count_if(c("id_nota").isNull()).alias("nulos_id_nota"),
                 _count_if((c("quantidade") <= 0) | (c("valor_unitario") < 0)).alias("valores_invalidos"),
                 duplicate_excess("id_item").alias("duplicatas_id_item"))
