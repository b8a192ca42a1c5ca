"""Gold: detail and summary datasets over the silver tables.

Amounts are doubles and their sums exact (``functions/sums.py``), so totals do not
depend on the order in which partitions are combined, and NaN shows.  Children are
always aggregated to one row per parent *before* joining, so no join fans out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakefold.fixed import CANCELLED_STATUS, TAX_TYPES
from lakefold.functions.sums import add_parts, sum_parts, total
from lakefold.functions.text import title_case

def analysis_detail(analysis: DataFrame, customer: DataFrame) -> DataFrame:
    cli = customer.select("id_cliente", "razao_social")
    return (analysis.join(cli, "id_cliente")
                    .select("id_analise",
                            title_case("razao_social").alias("cliente"),
                            "tipo_tributo",
                            F.col("ano").alias("ano_analise"),
                            F.col("periodo_tipo").alias("tipo_periodo_analise"),
                            "periodo_valor", "valor_identificado", "observacoes"))


def invoice_totals(invoice: DataFrame, item: DataFrame, tax: DataFrame, exact: bool = False) -> DataFrame:
    """Invoice with item total and ISS/PIS/COFINS columns.

    ``exact=False`` reproduces the reference's result, whose two left joins of
    child tables multiply each item total by the invoice's number of tax rows
    and each tax by its number of items; the same numbers are computed here
    from per-invoice aggregates (a multiplication, no fan-out).  ``exact=True``
    returns plain totals.  No items -> item total NULL; no taxes -> 0.
    """
    items = (item.groupBy("id_nota")
                 .agg(*sum_parts(F.col("quantidade") * F.col("valor_unitario"), "_items"), F.count(F.lit(1)).alias("_n_items")))

    def tax_sum(kind: str) -> list[Column]:
        return sum_parts(F.when(F.col("tipo_imposto") == kind, F.col("valor")).otherwise(F.lit(0.0)), f"_{kind.lower()}")

    taxes = (tax.groupBy("id_nota")
                .agg(*[c for kind in TAX_TYPES for c in tax_sum(kind)], F.count(F.lit(1)).alias("_n_taxes")))
    joined = invoice.join(items, "id_nota", "left").join(taxes, "id_nota", "left")

    def times(count: str) -> Column | None:
        return None if exact else F.greatest(F.coalesce(F.col(count), F.lit(0)), F.lit(1))

    return joined.select(
        "id_nota", "id_cliente", "numero_nota", "data_emissao", "valor_total", "valor_servico",
        total("_items", times("_n_taxes")).alias("valor_itens"),
        *[F.coalesce(total(f"_{t.lower()}", times("_n_items")), F.lit(0.0)).alias(f"valor_{t.lower()}") for t in TAX_TYPES])


def project_detail(project: DataFrame, task: DataFrame, customer: DataFrame) -> DataFrame:
    """Task grain with its project and customer.

    The customer is joined to the projects first, so only project-sized data
    is shuffled by customer and the task-sized side is shuffled once, by project.
    """
    pro = project.select("id_projeto", "nome_projeto", "responsavel", "id_cliente", "status", "data_inicio",
                         "data_prevista_fim", "horas_totais_estimadas", "horas_totais_realizadas")
    trf = task.select("id_projeto", "id_tarefa", "descricao", "responsavel_tarefa", "status_tarefa",
                      F.col("data_inicio").alias("data_inicio_tarefa"),
                      F.col("data_prevista_fim").alias("data_prevista_fim_tarefa"),
                      F.col("horas_estimadas").alias("horas_estimadas_tarefa"),
                      F.col("horas_realizadas").alias("horas_realizadas_tarefa"))
    cli = customer.select("id_cliente", "razao_social")
    return (pro.join(cli, "id_cliente").join(trf, "id_projeto")
               .select("id_projeto", "nome_projeto", "responsavel",
                       title_case("razao_social").alias("nome_cliente"),
                       "status", "data_inicio", "data_prevista_fim", "horas_totais_estimadas",
                       "horas_totais_realizadas", "id_tarefa", "descricao", "responsavel_tarefa", "status_tarefa",
                       "data_inicio_tarefa", "data_prevista_fim_tarefa", "horas_estimadas_tarefa",
                       "horas_realizadas_tarefa"))


_PROJECT_KEYS = ["id_projeto", "id_cliente", "razao_social", "responsavel", "status",
                 "horas_totais_estimadas", "horas_totais_realizadas"]


def _hours_by_description(project: DataFrame, task: DataFrame, customer: DataFrame) -> DataFrame:
    """Task hours summed per (project, description) first, then joined.

    Projects meet customers first; the hours then join on the project id, and
    the grouping that follows (keys include the project id) reuses that
    partitioning instead of shuffling again.  A NULL status is dropped by
    ``<> 'Cancelado'``, as in the reference.
    """
    hours = (task.groupBy("id_projeto", "descricao")
                 .agg(F.sum("horas_realizadas").alias("tot_hr_tarefa")))
    pro = (project.where(F.col("status") != CANCELLED_STATUS)
                  .select("id_projeto", "id_cliente", "responsavel", "status",
                          "horas_totais_estimadas", "horas_totais_realizadas"))
    cli = customer.select("id_cliente", "razao_social")
    return pro.join(cli, "id_cliente").join(hours, "id_projeto")


def _project_columns(*extra: Column) -> list:
    return ["id_projeto", "id_cliente", title_case("razao_social").alias("nome_cliente"), "responsavel",
            "status", "horas_totais_estimadas", "horas_totais_realizadas", *extra]


def project_task_hours(project: DataFrame, task: DataFrame, customer: DataFrame) -> DataFrame:
    """The reference's performance view: one row per project and task description."""
    agg = (_hours_by_description(project, task, customer)
           .groupBy(*_PROJECT_KEYS, "descricao")
           .agg(F.max("tot_hr_tarefa").alias("hrs_tarefa")))
    return agg.select(*_project_columns(F.col("descricao").alias("tarefa_longa"), "hrs_tarefa"))


def project_longest_task(project: DataFrame, task: DataFrame, customer: DataFrame) -> DataFrame:
    """The stated intent: per project, the description with the most hours.

    Ties go to the greatest description (``max_by`` over (hours, description)).
    """
    agg = (_hours_by_description(project, task, customer)
           .groupBy(*_PROJECT_KEYS)
           .agg(F.max_by("descricao", F.struct("tot_hr_tarefa", "descricao")).alias("tarefa_longa"),
                F.max("tot_hr_tarefa").alias("hrs_tarefa")))
    return agg.select(*_project_columns("tarefa_longa", "hrs_tarefa"))


def _per_customer(facts: DataFrame, customer: DataFrame, distinct: dict[str, str],
                  sums: dict[str, str], maxes: dict[str, str], mins: dict[str, str]) -> DataFrame:
    """Summaries grouped by (customer id, name) over facts joined to customers.

    The facts are aggregated per customer id *before* the join, so only one
    row per customer reaches the join.  This equals aggregating the joined
    rows: a customer id present in k customer rows with the same name repeats
    each fact k times, so its sums are multiplied by k (``sum`` over the k
    joined partial rows), while distinct counts, maxima and minima are
    unchanged by repetition.
    """
    pre = facts.groupBy("id_cliente").agg(
        *[F.count_distinct(c).alias(out) for out, c in distinct.items()],
        *[part for out, c in sums.items() for part in sum_parts(c, out)],
        *[F.max(c).alias(out) for out, c in maxes.items()],
        *[F.min(c).alias(out) for out, c in mins.items()])
    cli = customer.select("id_cliente", "razao_social")
    return (pre.join(cli, "id_cliente")
               .groupBy("id_cliente", "razao_social")
               .agg(*[F.max(o).alias(o) for o in distinct],
                    *[part for o in sums for part in add_parts(o)],
                    *[F.max(o).alias(o) for o in maxes],
                    *[F.min(o).alias(o) for o in mins])
               .select("id_cliente", "razao_social", *distinct, *[total(o).alias(o) for o in sums], *maxes, *mins))


def analysis_summary(analysis: DataFrame, customer: DataFrame) -> DataFrame:
    agg = _per_customer(analysis, customer,
                        distinct={"qtd_analises": "id_analise", "qtd_tipos_tributos": "tipo_tributo"},
                        sums={"valor_total_identificado": "valor_identificado"},
                        maxes={"maior_valor_identificado": "valor_identificado", "ultimo_ano_analisado": "ano"},
                        mins={"menor_valor_identificado": "valor_identificado"})
    return agg.select("id_cliente", title_case("razao_social").alias("nome_cliente"), "qtd_analises",
                      "qtd_tipos_tributos", "valor_total_identificado", "maior_valor_identificado",
                      "menor_valor_identificado", "ultimo_ano_analisado")


def invoice_summary(totals: DataFrame, customer: DataFrame) -> DataFrame:
    """Per customer over ``invoice_totals`` (pass its parity or exact form)."""
    agg = _per_customer(totals, customer,
                        distinct={"qtd_notas": "id_nota"},
                        sums={"valor_total_notas": "valor_total", "valor_total_servicos": "valor_servico",
                              "total_iss": "valor_iss", "total_pis": "valor_pis", "total_cofins": "valor_cofins"},
                        maxes={"ultima_emissao": "data_emissao"}, mins={})
    return agg.select("id_cliente", title_case("razao_social").alias("nome_cliente"), "qtd_notas",
                      "valor_total_notas", "valor_total_servicos", "total_iss", "total_pis", "total_cofins",
                      "ultima_emissao")
