"""The published views as SQL text, for storage in a warehouse.

The same datasets as ``gold.py`` and ``quality.py`` (tests compare them row by row),
stated over the silver tables by name, with the SQL functions they need.  A warehouse
keeps these texts, so a later session defines the views from the warehouse alone.
``as_of()`` is the check time, defined when a warehouse is opened.
"""

from __future__ import annotations

from lakefold.fixed import CANCELLED_STATUS, TAX_NUMBER_PATTERN, TAX_TYPES, VALID_PERIOD_KINDS

# -- sums of doubles (see functions/sums.py): parts at fixed binary places ---------
_LIMIT, _UNIT, _MASK, _PARTS = "18014398509481984D", "134217728", "134217727L", 5
_HELD = f"(CASE WHEN abs(x) < {_LIMIT} THEN x ELSE 0D END)"
_WHOLE = f"CAST({_HELD} AS BIGINT)"
_FRACTION = f"(({_HELD} - {_WHOLE}) * {_LIMIT})"
_HIGH = f"CAST({_FRACTION} AS BIGINT)"
_REST = f"(({_FRACTION} - {_HIGH}) * {_UNIT}D)"
_LOW = f"CAST({_REST} AS BIGINT)"
_FITS = f"(abs(x) < {_LIMIT} AND {_REST} = {_LOW})"

FUNCTIONS = [
    ("title_case", "(s STRING) RETURNS STRING RETURN array_join(transform(regexp_extract_all(s, r'[\\p{L}\\p{N}]+|[^\\p{L}\\p{N}]+', 0), w -> initcap(w)), '')"),
    ("sum_part", f"""(x DOUBLE, i INT) RETURNS BIGINT RETURN CASE WHEN x IS NULL OR NOT {_FITS} THEN 0L
        WHEN i = 0 THEN shiftright({_WHOLE}, 27) WHEN i = 1 THEN {_WHOLE} & {_MASK}
        WHEN i = 2 THEN shiftright({_HIGH}, 27) WHEN i = 3 THEN {_HIGH} & {_MASK} ELSE {_LOW} END"""),
    ("sum_rest", f"(x DOUBLE) RETURNS DOUBLE RETURN CASE WHEN {_FITS} THEN 0D ELSE x END"),
    ("sum_digits", f"""(p ARRAY<BIGINT>) RETURNS STRUCT<carry: BIGINT, digits: ARRAY<BIGINT>> RETURN
        reduce(reverse(p), CAST(named_struct('carry', 0L, 'digits', array()) AS STRUCT<carry: BIGINT, digits: ARRAY<BIGINT>>),
               (s, x) -> CAST(named_struct('carry', shiftright(x + s.carry, 27), 'digits', concat(s.digits, array((x + s.carry) & {_MASK})))
                              AS STRUCT<carry: BIGINT, digits: ARRAY<BIGINT>>))"""),
    ("sum_value", f"""(d STRUCT<carry: BIGINT, digits: ARRAY<BIGINT>>, sign BIGINT) RETURNS DOUBLE RETURN CAST(sign AS DOUBLE) * (
        (CAST(d.carry AS DOUBLE) * {_LIMIT} + CAST(d.digits[4] * {_UNIT}L + d.digits[3] AS DOUBLE))
        + (CAST(d.digits[2] * {_UNIT}L + d.digits[1] AS DOUBLE) / {_LIMIT} + CAST(d.digits[0] AS DOUBLE) / {_LIMIT} / {_UNIT}D))"""),
    ("sum_signed", "(p ARRAY<BIGINT>, sign BIGINT) RETURNS DOUBLE RETURN sum_value(sum_digits(transform(p, x -> x * sign)), sign)"),
    ("sum_total", """(p ARRAY<BIGINT>, rest DOUBLE, n BIGINT, times BIGINT) RETURNS DOUBLE RETURN CASE WHEN n > 0 THEN
        sum_signed(transform(p, x -> x * times), CASE WHEN sum_digits(p).carry < 0 THEN -1L ELSE 1L END) + rest * CAST(times AS DOUBLE) END"""),
]


def _parts(x: str, name: str) -> str:
    """Select list: the parts of the sum of x."""
    return ", ".join([*[f"sum(sum_part({x}, {i})) AS {name}_{i}" for i in range(_PARTS)], f"sum(sum_rest({x})) AS {name}_rest", f"count({x}) AS {name}_n"])


def _total(name: str, times: str = "1L") -> str:
    return f"sum_total(array({', '.join(f'{name}_{i}' for i in range(_PARTS))}), {name}_rest, {name}_n, {times})"


def _again(name: str) -> str:
    """The total of parts that are added once more."""
    return f"sum_total(array({', '.join(f'sum({name}_{i})' for i in range(_PARTS))}), sum({name}_rest), sum({name}_n), 1L)"


def _tax(kind: str) -> str:
    return f"CASE WHEN tipo_imposto = '{kind}' THEN valor ELSE 0D END"


def _at_least_one(count: str) -> str:
    return f"greatest(coalesce({count}, 0L), 1L)"


_PROJECT = "id_projeto, id_cliente, razao_social, responsavel, status, horas_totais_estimadas, horas_totais_realizadas"

VIEWS = [
    ("vw_anl_analise_tributaria", ["analise_tributaria", "cliente"], """
SELECT id_analise, title_case(razao_social) AS cliente, tipo_tributo, ano AS ano_analise, periodo_tipo AS tipo_periodo_analise,
       periodo_valor, valor_identificado, observacoes
FROM analise_tributaria JOIN cliente USING (id_cliente)"""),
    ("vw_anl_nota_fiscal", ["nota_fiscal", "nota_fiscal_item", "nota_fiscal_imposto"], f"""
SELECT nf.id_nota, id_cliente, numero_nota, data_emissao, valor_total, valor_servico,
       {_total("itens", _at_least_one("n_impostos"))} AS valor_itens,
       {", ".join(f"coalesce({_total(t.lower(), _at_least_one('n_itens'))}, 0D) AS valor_{t.lower()}" for t in TAX_TYPES)}
FROM nota_fiscal nf
LEFT JOIN (SELECT id_nota, {_parts("quantidade * valor_unitario", "itens")}, count(*) AS n_itens FROM nota_fiscal_item GROUP BY id_nota) i
  ON nf.id_nota = i.id_nota
LEFT JOIN (SELECT id_nota, {", ".join(_parts(_tax(t), t.lower()) for t in TAX_TYPES)}, count(*) AS n_impostos FROM nota_fiscal_imposto GROUP BY id_nota) t
  ON nf.id_nota = t.id_nota"""),
    ("vw_anl_projetos", ["projeto", "tarefa", "cliente"], """
SELECT p.id_projeto, p.nome_projeto, p.responsavel, title_case(p.razao_social) AS nome_cliente, p.status, p.data_inicio, p.data_prevista_fim,
       p.horas_totais_estimadas, p.horas_totais_realizadas, t.id_tarefa, t.descricao, t.responsavel_tarefa, t.status_tarefa,
       t.data_inicio AS data_inicio_tarefa, t.data_prevista_fim AS data_prevista_fim_tarefa, t.horas_estimadas AS horas_estimadas_tarefa,
       t.horas_realizadas AS horas_realizadas_tarefa
FROM (SELECT * FROM projeto JOIN cliente USING (id_cliente)) p JOIN tarefa t ON p.id_projeto = t.id_projeto"""),
    ("vw_snt_projetos_performance", ["projeto", "tarefa", "cliente"], f"""
SELECT id_projeto, id_cliente, title_case(razao_social) AS nome_cliente, responsavel, status, horas_totais_estimadas, horas_totais_realizadas,
       descricao AS tarefa_longa, max(horas) AS hrs_tarefa
FROM (SELECT * FROM projeto JOIN cliente USING (id_cliente) WHERE status <> '{CANCELLED_STATUS}')
JOIN (SELECT id_projeto, descricao, sum(horas_realizadas) AS horas FROM tarefa GROUP BY id_projeto, descricao) USING (id_projeto)
GROUP BY {_PROJECT}, descricao"""),
    ("vw_snt_analises_tributarias", ["analise_tributaria", "cliente"], f"""
SELECT id_cliente, title_case(razao_social) AS nome_cliente, max(n_analises) AS qtd_analises, max(n_tipos) AS qtd_tipos_tributos,
       {_again("valor")} AS valor_total_identificado, max(maior) AS maior_valor_identificado, min(menor) AS menor_valor_identificado,
       max(ultimo) AS ultimo_ano_analisado
FROM (SELECT id_cliente, count(DISTINCT id_analise) AS n_analises, count(DISTINCT tipo_tributo) AS n_tipos, {_parts("valor_identificado", "valor")},
             max(valor_identificado) AS maior, min(valor_identificado) AS menor, max(ano) AS ultimo FROM analise_tributaria GROUP BY id_cliente)
JOIN cliente USING (id_cliente) GROUP BY id_cliente, razao_social"""),
    ("vw_snt_notas_fiscais", ["vw_anl_nota_fiscal", "cliente"], f"""
SELECT id_cliente, title_case(razao_social) AS nome_cliente, max(n_notas) AS qtd_notas, {_again("total")} AS valor_total_notas,
       {_again("servico")} AS valor_total_servicos, {", ".join(f"{_again(t.lower())} AS total_{t.lower()}" for t in TAX_TYPES)},
       max(ultima) AS ultima_emissao
FROM (SELECT id_cliente, count(DISTINCT id_nota) AS n_notas, {_parts("valor_total", "total")}, {_parts("valor_servico", "servico")},
             {", ".join(_parts(f"valor_{t.lower()}", t.lower()) for t in TAX_TYPES)}, max(data_emissao) AS ultima
      FROM vw_anl_nota_fiscal GROUP BY id_cliente)
JOIN cliente USING (id_cliente) GROUP BY id_cliente, razao_social"""),
]


def _quality(table: str, metrics: dict[str, str], key: str) -> tuple[str, list[str], str]:
    counts = ", ".join(f"count_if({rule}) AS {name}" for name, rule in metrics.items())
    return (f"vw_dq_{table}", [table], f"SELECT '{table}' AS tabela, {counts}, count(*) - count(DISTINCT {key}) AS duplicatas_{key}, "
                                       f"as_of() AS data_checagem FROM {table}")


def _listed(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


VIEWS += [
    _quality("cliente", {"nulos_id_cliente": "id_cliente IS NULL", "cnpj_invalido": f"cnpj IS NULL OR NOT cnpj RLIKE r'{TAX_NUMBER_PATTERN}'",
                         "data_cadastro_invalida": "data_cadastro IS NULL OR data_cadastro > CAST(as_of() AS DATE)"}, "id_cliente"),
    _quality("analise_tributaria", {"nulos_id_analise": "id_analise IS NULL", "nulos_id_cliente": "id_cliente IS NULL",
                                    "valores_negativos": "valor_identificado < 0",
                                    "periodo_tipo_invalido": f"periodo_tipo NOT IN ({_listed(VALID_PERIOD_KINDS)})"}, "id_analise"),
    _quality("projeto", {"nulos_id_projeto": "id_projeto IS NULL", "nulos_id_cliente": "id_cliente IS NULL",
                         "datas_invertidas": "data_inicio > data_prevista_fim", "valores_negativos": "valor_projeto < 0"}, "id_projeto"),
    _quality("tarefa", {"nulos_id_tarefa": "id_tarefa IS NULL", "nulos_id_projeto": "id_projeto IS NULL",
                        "datas_invertidas": "data_inicio > data_prevista_fim", "horas_negativas": "horas_estimadas < 0 OR horas_realizadas < 0"}, "id_tarefa"),
    _quality("nota_fiscal", {"nulos_id_nota": "id_nota IS NULL", "nulos_id_cliente": "id_cliente IS NULL",
                             "valores_negativos": "valor_total < 0 OR valor_servico < 0",
                             "data_emissao_invalida": "data_emissao IS NULL OR data_emissao > CAST(as_of() AS DATE)"}, "numero_nota"),
    _quality("nota_fiscal_imposto", {"nulos_id_imposto": "id_imposto IS NULL", "nulos_id_nota": "id_nota IS NULL", "valores_negativos": "valor < 0",
                                     "tipo_invalido": f"tipo_imposto NOT IN ({_listed(TAX_TYPES)})"}, "id_imposto"),
    _quality("nota_fiscal_item", {"nulos_id_item": "id_item IS NULL", "nulos_id_nota": "id_nota IS NULL",
                                  "valores_invalidos": "quantidade <= 0 OR valor_unitario < 0"}, "id_item"),
]
