"""Independent SQL for every checked dataset (DuckDB dialect).

The oracle does not parse documents: it recomputes the records the stand-in
documents were built from, straight from the driver tables, so a document
round trip (rows -> JSON/XML/HTML text -> rows) must be the identity for the
results to match.  Doubles are summed exactly, as whole numbers of 2^-60;
integer sums are cast back to BIGINT.
"""

from __future__ import annotations

from lakefold.plans.layers import AS_OF


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def title(x: str) -> str:
    return (rf"array_to_string(list_transform(regexp_extract_all({x}, '[\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}]+'), "
            rf"lambda t: upper(t[1]) || lower(t[2:])), '')")


AS_OF_TS = f"TIMESTAMP '{AS_OF}'"
AS_OF_DATE = f"CAST({AS_OF_TS} AS DATE)"

# Every derived relation as a CTE; a query references the ones it needs.
CTES: dict[str, str] = {}

CTES["customer_raw0"] = f"""
  SELECT c_custkey AS _k,
    CASE WHEN c_custkey % 101 = 100 THEN NULL ELSE 'CLI' || CAST(c_custkey AS VARCHAR) END AS id_cliente,
    CASE WHEN c_custkey % 10 = 3 THEN chr(9) ELSE '  ' END || c_name || ' comércio-' || lower(c_mktsegment) || ' '
      AS razao_social,
    substr(d, 1, 2) || '.' || substr(d, 3, 3) || '.' || substr(d, 6, 3) || '/' || substr(d, 9, 4) || '-'
      || substr(d, 13, 2) AS cnpj,
    c_mktsegment AS porte_empresa,
    ' ' || c_mktsegment || ' ' AS setor,
    n_name || '  ' AS cidade,
    substr(n_name, 1, 2) AS estado,
    strftime(CASE WHEN c_custkey % 89 = 11 THEN DATE '2031-01-01' + CAST(c_custkey % 300 AS INTEGER)
                  ELSE DATE '2023-01-01' + CAST((c_custkey * 7) % 700 AS INTEGER) END, '%Y-%m-%d') AS data_cadastro
  FROM (SELECT *, CASE WHEN c_custkey % 97 = 5 THEN lpad(CAST(c_custkey AS VARCHAR), 13, '0')
                       ELSE lpad(CAST(c_custkey AS VARCHAR), 14, '0') END AS d
        FROM customer) c
  LEFT JOIN nation ON c_nationkey = n_nationkey"""

CTES["customer_raw"] = """
  SELECT id_cliente, razao_social, cnpj, porte_empresa, setor, cidade, estado, data_cadastro FROM customer_raw0
  UNION ALL
  SELECT id_cliente, razao_social, cnpj, porte_empresa, setor,
         CASE WHEN _k % 74 = 0 THEN cidade || '(filial)' ELSE cidade END, estado, data_cadastro
  FROM customer_raw0 WHERE _k % 37 = 0"""

CTES["cliente"] = f"""
  SELECT *, {AS_OF_TS} AS data_tratamento FROM (
    SELECT DISTINCT id_cliente, upper({strip('razao_social')}) AS razao_social,
      regexp_replace(cnpj, '\\D', '', 'g') AS cnpj, lower({strip('setor')}) AS setor,
      lower({strip('cidade')}) AS cidade, estado, CAST(data_cadastro AS DATE) AS data_cadastro
    FROM customer_raw WHERE id_cliente IS NOT NULL)"""

CTES["analysis_raw"] = """
  SELECT 'ANLS' || CAST(event_id AS VARCHAR) AS id_analise,
    'CLI' || CAST(user_id AS VARCHAR) AS cliente_id,
    ' ' || event_type || ' ' AS tipo_tributo,
    CASE WHEN event_id % 101 = 41 THEN NULL
         WHEN event_id % 101 = 17 THEN CAST(year(ts) AS VARCHAR) || '-Q12'
         WHEN event_id % 101 = 29 THEN CAST(year(ts) AS VARCHAR)
         WHEN event_id % 3 = 0 THEN strftime(ts, '%Y-%m')
         WHEN event_id % 3 = 1 THEN CAST(year(ts) AS VARCHAR) || '-Q' || CAST(quarter(ts) AS VARCHAR)
         ELSE CAST(year(ts) AS VARCHAR) || '-S' || CASE WHEN month(ts) <= 6 THEN '1' ELSE '2' END END
      AS periodo_analise,
    CASE WHEN event_id % 59 = 4 THEN NULL WHEN event_id % 53 = 3 THEN -value ELSE value END AS valor_identificado,
    '  crédito ' || event_type || '-fiscal em REVISÃO ' AS observacoes
  FROM events"""

_P = "periodo_analise"
CTES["analise"] = f"""
  SELECT *, {AS_OF_TS} AS data_tratamento FROM (
    SELECT DISTINCT CAST(id_analise AS VARCHAR) AS id_analise, CAST(cliente_id AS VARCHAR) AS id_cliente,
      upper({strip('tipo_tributo')}) AS tipo_tributo,
      TRY_CAST(substr({_P}, 1, 4) AS BIGINT) AS ano,
      CASE WHEN regexp_matches({_P}, '-Q[1-4]') THEN 'TRIMESTRE'
           WHEN regexp_matches({_P}, '-S[1-2]') THEN 'SEMESTRE'
           WHEN regexp_matches({_P}, '-\\d{{2}}$') THEN 'MES' ELSE 'DESCONHECIDO' END AS periodo_tipo,
      CASE WHEN regexp_matches({_P}, '-Q[1-4]') THEN TRY_CAST(regexp_extract({_P}, 'Q([1-4])', 1) AS BIGINT)
           WHEN regexp_matches({_P}, '-S[1-2]') THEN TRY_CAST(regexp_extract({_P}, 'S([1-2])', 1) AS BIGINT)
           WHEN regexp_matches({_P}, '-\\d{{2}}$') THEN TRY_CAST(regexp_extract({_P}, '-(\\d{{2}})$', 1) AS BIGINT)
      END AS periodo_valor,
      CAST(valor_identificado AS DOUBLE) AS valor_identificado,
      {title(strip('observacoes'))} AS observacoes
    FROM analysis_raw
    WHERE id_analise IS NOT NULL AND cliente_id IS NOT NULL AND valor_identificado IS NOT NULL)"""

CTES["projeto"] = """
  SELECT DISTINCT 'PRJ' || CAST(o_orderkey AS VARCHAR) AS id_projeto,
    'Projeto ' || o_orderpriority AS nome_projeto,
    'CLI' || CAST(o_custkey AS VARCHAR) AS id_cliente,
    'Analista ' || CAST(o_custkey % 17 AS VARCHAR) AS responsavel,
    CASE WHEN o_orderkey % 211 = 5 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS data_inicio,
    CAST(o_orderdate AS DATE) + CAST(o_orderkey % 120 - 10 AS INTEGER) AS data_prevista_fim,
    CASE WHEN o_orderkey % 61 = 7 THEN NULL WHEN o_orderstatus = 'F' THEN 'Concluido'
         WHEN o_orderstatus = 'O' THEN 'Em andamento' ELSE 'Cancelado' END AS status,
    CASE WHEN o_orderkey % 101 = 13 THEN -o_totalprice ELSE o_totalprice END AS valor_projeto,
    o_orderkey % 500 + 10 AS horas_totais_estimadas,
    (o_orderkey * 7) % 600 AS horas_totais_realizadas
  FROM orders"""

CTES["tarefa"] = """
  SELECT DISTINCT 'PRJ' || CAST(l_orderkey AS VARCHAR) AS id_projeto,
    'TRF' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS id_tarefa,
    CASE l_returnflag WHEN 'R' THEN 'Revisão fiscal' WHEN 'A' THEN 'Apuração de créditos'
                      ELSE 'Levantamento' END AS descricao,
    CAST(l_shipdate AS DATE) AS data_inicio,
    CAST(l_shipdate AS DATE) + CAST(l_linenumber * 3 - 5 AS INTEGER) AS data_prevista_fim,
    'Consultor ' || CAST(l_suppkey AS VARCHAR) AS responsavel_tarefa,
    CASE WHEN l_linestatus = 'O' THEN 'Aberta' ELSE 'Finalizada' END AS status_tarefa,
    CAST(l_quantity AS BIGINT) AS horas_estimadas,
    CAST(l_quantity AS BIGINT) + l_linenumber - 3 AS horas_realizadas
  FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders)"""


CTES["nf_base"] = """
  SELECT o.*, sha256('nf-doc-' || CAST(o.o_orderkey AS VARCHAR) || '|0') AS id_nota FROM orders o"""

CTES["nota_fiscal"] = """
  SELECT id_nota, 'NF' || CAST(o_orderkey AS VARCHAR) AS numero_nota,
    CAST(o_orderdate AS DATE) AS data_emissao, 'CLI' || CAST(o_custkey AS VARCHAR) AS id_cliente,
    o_totalprice - o_orderkey % 100 AS valor_servico, o_totalprice AS valor_total
  FROM nf_base"""

CTES["nota_fiscal_imposto"] = """
  SELECT sha256(id_nota || '|' || tipo_imposto) AS id_imposto, id_nota, tipo_imposto, valor FROM (
    SELECT id_nota, 'ISS' AS tipo_imposto,
      CASE WHEN o_orderkey % 13 = 0 THEN NULL
           WHEN o_orderkey % 173 = 1 THEN -(CAST(o_orderkey % 997 AS DOUBLE) / 4.0)
           ELSE CAST(o_orderkey % 997 AS DOUBLE) / 4.0 END AS valor FROM nf_base
    UNION ALL
    SELECT id_nota, 'PIS', CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_custkey % 300 AS DOUBLE) / 4.0 END
    FROM nf_base
    UNION ALL
    SELECT id_nota, 'COFINS', CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(o_orderkey % 1999 AS DOUBLE) / 8.0 END
    FROM nf_base) WHERE valor IS NOT NULL"""

CTES["nota_fiscal_item"] = """
  SELECT sha256(id_nota || '|0|' || CAST(item_pos AS VARCHAR)) AS id_item, id_nota, descricao, quantidade,
         valor_unitario FROM (
    SELECT sha256('nf-doc-' || CAST(l_orderkey AS VARCHAR) || '|0') AS id_nota, descricao, quantidade, valor_unitario,
      row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, descricao,
                         quantidade, valor_unitario) - 1 AS item_pos
    FROM (SELECT *, CASE WHEN l_linenumber = 1 THEN 'Peça ' || CAST(l_partkey AS VARCHAR) || ' & Cia <lote>'
                         ELSE 'Serviço ' || CAST(l_partkey AS VARCHAR) END AS descricao,
            CAST(l_quantity AS BIGINT) AS quantidade, l_extendedprice AS valor_unitario FROM lineitem)
    WHERE l_orderkey IN (SELECT o_orderkey FROM orders))"""

CTES["log_raw"] = """
  SELECT event_id, CAST(ts AS DATE) AS event_day, 'LOG' || CAST(event_id AS VARCHAR) AS id_log, ts AS log_time,
    'User' || CAST(user_id AS VARCHAR) AS usuario,
    CASE event_type WHEN 'view' THEN 'visualizar REGISTRO' WHEN 'click' THEN 'clicar-botão'
         WHEN 'purchase' THEN 'efetuar compra' WHEN 'signup' THEN 'criar CONTA' ELSE 'erro de sistema' END AS acao,
    CASE event_id % 4 WHEN 0 THEN 'nota fiscal' WHEN 1 THEN 'cliente & parceiro' WHEN 2 THEN 'projeto'
         ELSE 'tarefa' END AS entidade_afetada,
    CASE WHEN event_type = 'error' THEN 'falha' ELSE 'sucesso' END AS resultado,
    CASE WHEN event_id % 41 = 0 THEN NULL
         WHEN event_id % 43 = 0 THEN 'fe80::' || CAST(user_id AS VARCHAR)
         WHEN event_id % 47 = 0 THEN '192.168.x' || CAST(user_id % 256 AS VARCHAR) || '.5'
         ELSE '10.' || CAST(user_id % 256 AS VARCHAR) || '.' || CAST(event_id % 256 AS VARCHAR) || '.1' END AS ip
  FROM events"""

CTES["log_sistema"] = f"""
  SELECT *, {AS_OF_TS} AS data_tratamento FROM (
    SELECT DISTINCT id_log, CAST(log_time AS DATE) AS data_evento, date_trunc('second', log_time) AS log_time,
      lower({strip('usuario')}) AS usuario, {title(strip('acao'))} AS acao,
      {title(strip('entidade_afetada'))} AS entidade_afetada, upper({strip('resultado')}) AS resultado,
      regexp_replace(coalesce(ip, ''), '[^0-9\\\\.]+', '', 'g') AS ip
    FROM log_raw WHERE id_log IS NOT NULL)"""

# -- gold ---------------------------------------------------------------------


def fsum(x: str) -> str:
    """The sum of doubles in whole units of 2^-60 (amounts of a cent or more have no lower bits), as a double."""
    t = f"sum(CAST(({x}) * 1152921504606846976.0 AS HUGEINT))"
    fraction = f"(abs({t}) % 1152921504606846976)"
    return (f"(CASE WHEN {t} < 0 THEN -1.0::DOUBLE ELSE 1.0::DOUBLE END * (CAST(abs({t}) // 1152921504606846976 AS DOUBLE)"
            f" + (CAST({fraction} // 64 AS DOUBLE) / 18014398509481984.0::DOUBLE + CAST({fraction} % 64 AS DOUBLE) / 1152921504606846976.0::DOUBLE)))")


def _invoice_totals(children: str, group: str) -> str:
    taxes = ", ".join(f"{fsum(f"CASE WHEN imp.tipo_imposto = '{t}' THEN imp.valor ELSE 0 END")} AS valor_{t.lower()}" for t in ("ISS", "PIS", "COFINS"))
    return f"""
  SELECT nf.id_nota, nf.id_cliente, nf.numero_nota, nf.data_emissao, nf.valor_total, nf.valor_servico,
    {fsum("it.quantidade * it.valor_unitario")} AS valor_itens, {taxes}
  FROM nota_fiscal nf {children} GROUP BY {group}"""


_NF = "nf.id_nota, nf.id_cliente, nf.numero_nota, nf.data_emissao, nf.valor_total, nf.valor_servico"

# both children are joined before they are summed, so they multiply each other
CTES["vw_anl_nota_fiscal"] = _invoice_totals("""LEFT JOIN nota_fiscal_item it ON it.id_nota = nf.id_nota
  LEFT JOIN nota_fiscal_imposto imp ON imp.id_nota = nf.id_nota""", _NF)

# each child is summed by itself: rows of one have nothing of the other
CTES["invoice_totals_exact"] = _invoice_totals("""LEFT JOIN (
    SELECT id_nota AS nid, quantidade, valor_unitario, NULL AS tipo_imposto, NULL AS valor FROM nota_fiscal_item
    UNION ALL SELECT id_nota, NULL, NULL, tipo_imposto, valor FROM nota_fiscal_imposto) it ON it.nid = nf.id_nota""", _NF).replace("imp.", "it.")

CTES["vw_anl_analise_tributaria"] = f"""
  SELECT ant.id_analise, {title('cli.razao_social')} AS cliente, ant.tipo_tributo, ant.ano AS ano_analise,
    ant.periodo_tipo AS tipo_periodo_analise, ant.periodo_valor, ant.valor_identificado, ant.observacoes
  FROM analise ant JOIN cliente cli ON ant.id_cliente = cli.id_cliente"""

CTES["vw_anl_projetos"] = f"""
  SELECT pro.id_projeto, pro.nome_projeto, pro.responsavel, {title('cli.razao_social')} AS nome_cliente,
    pro.status, pro.data_inicio, pro.data_prevista_fim, pro.horas_totais_estimadas, pro.horas_totais_realizadas,
    trf.id_tarefa, trf.descricao, trf.responsavel_tarefa, trf.status_tarefa,
    trf.data_inicio AS data_inicio_tarefa, trf.data_prevista_fim AS data_prevista_fim_tarefa,
    trf.horas_estimadas AS horas_estimadas_tarefa, trf.horas_realizadas AS horas_realizadas_tarefa
  FROM projeto pro JOIN tarefa trf ON pro.id_projeto = trf.id_projeto
  JOIN cliente cli ON pro.id_cliente = cli.id_cliente"""

CTES["perf_base"] = """
  SELECT pro.id_projeto, cli.id_cliente, cli.razao_social, pro.responsavel, pro.status,
    pro.horas_totais_estimadas, pro.horas_totais_realizadas, tar.descricao, tar.tot_hr_tarefa
  FROM projeto pro
  JOIN (SELECT descricao, CAST(sum(horas_realizadas) AS BIGINT) AS tot_hr_tarefa, id_projeto
        FROM tarefa GROUP BY descricao, id_projeto) tar ON pro.id_projeto = tar.id_projeto
  JOIN cliente cli ON pro.id_cliente = cli.id_cliente
  WHERE pro.status <> 'Cancelado'"""

_PK = ("id_projeto, id_cliente, razao_social, responsavel, status, horas_totais_estimadas, "
       "horas_totais_realizadas")

CTES["vw_snt_projetos_performance"] = f"""
  SELECT id_projeto, id_cliente, {title('razao_social')} AS nome_cliente, responsavel, status,
    horas_totais_estimadas, horas_totais_realizadas, descricao AS tarefa_longa, max(tot_hr_tarefa) AS hrs_tarefa
  FROM perf_base GROUP BY {_PK}, descricao"""

CTES["project_longest_task"] = f"""
  SELECT id_projeto, id_cliente, {title('razao_social')} AS nome_cliente, responsavel, status,
    horas_totais_estimadas, horas_totais_realizadas, tarefa_longa, hrs_tarefa FROM (
    SELECT {_PK}, descricao AS tarefa_longa, max(tot_hr_tarefa) OVER w AS hrs_tarefa,
      row_number() OVER (PARTITION BY {_PK} ORDER BY tot_hr_tarefa DESC NULLS LAST, descricao DESC) AS rn
    FROM perf_base WINDOW w AS (PARTITION BY {_PK})) WHERE rn = 1"""

CTES["vw_snt_analises_tributarias"] = f"""
  SELECT cli.id_cliente, {title('cli.razao_social')} AS nome_cliente,
    count(DISTINCT ant.id_analise) AS qtd_analises, count(DISTINCT ant.tipo_tributo) AS qtd_tipos_tributos,
    {fsum("ant.valor_identificado")} AS valor_total_identificado,
    max(ant.valor_identificado) AS maior_valor_identificado, min(ant.valor_identificado) AS menor_valor_identificado,
    max(ant.ano) AS ultimo_ano_analisado
  FROM analise ant JOIN cliente cli ON ant.id_cliente = cli.id_cliente
  GROUP BY cli.id_cliente, cli.razao_social"""


def _invoice_summary(source: str) -> str:
    return f"""
  SELECT cli.id_cliente, {title('cli.razao_social')} AS nome_cliente, count(DISTINCT nf.id_nota) AS qtd_notas,
    {fsum("nf.valor_total")} AS valor_total_notas,
    {fsum("nf.valor_servico")} AS valor_total_servicos,
    {fsum("nf.valor_iss")} AS total_iss,
    {fsum("nf.valor_pis")} AS total_pis,
    {fsum("nf.valor_cofins")} AS total_cofins,
    max(nf.data_emissao) AS ultima_emissao
  FROM {source} nf JOIN cliente cli ON nf.id_cliente = cli.id_cliente
  GROUP BY cli.id_cliente, cli.razao_social"""


CTES["vw_snt_notas_fiscais"] = _invoice_summary("vw_anl_nota_fiscal")
CTES["invoice_summary_exact"] = _invoice_summary("invoice_totals_exact")


def with_ctes(body: str) -> str:
    """Prefix ``body`` with the CTEs it needs (transitively), in definition order."""
    import re
    names = list(CTES)
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in names:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(CTES[name])

    visit(body)
    parts = [f"{n} AS ({CTES[n]}\n)" for n in names if n in needed]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body
