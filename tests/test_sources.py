"""Sources: HTML tables, gates, document round trips and file scans."""

import pytest

from lakefold.plans.standins import LOG_HEADINGS
from lakefold.session import fresh_path
from lakefold.sources import (
    html_table, html_table_status, invoice_elements, project_elements, scan_csv, scan_documents, task_elements,
)
from lakefold.sources.documents import INVOICE_COLUMNS, INVOICE_FIELDS, TAX_FIELDS
from lakefold.sources.gates import gate_timestamp
from lakefold.plans import silver

HEAD = "<tr>" + "".join(f"<th>{h}</th>" for h in LOG_HEADINGS) + "</tr>"


def page(rows, head=HEAD):
    body = "".join("<tr>" + "".join(f"<td>{c}</td>" for c in r) + "</tr>" for r in rows)
    return f"<html><body><p>x</p><table><thead>{head}</thead><tbody>{body}</tbody></table>" \
           f"<table><tr><th>other</th></tr></table></body></html>"


def test_html_table_cells_entities_tags_and_empty(spark):
    doc = page([["L1", "2024-01-02 03:04:05.5", " Ana ", "<b>Criar</b>", "nota &amp; item", "ok", ""],
                ["L2", "2024-01-02 03:04:06", "bob", "x", "&lt;y&gt;", "fail", "10.0.0.1"]])
    df = spark.createDataFrame([("d1", doc)], "doc_id string, conteudo string")
    rows = html_table(df, LOG_HEADINGS).orderBy("row_pos").collect()
    assert [r.id_log for r in rows] == ["L1", "L2"]
    assert rows[0].usuario == "Ana" and rows[0].acao == "Criar" and rows[0].entidade_afetada == "nota & item"
    assert rows[0].ip is None and rows[1].entidade_afetada == "<y>"


def test_html_table_status_and_strict_failure(spark):
    missing_ip = HEAD.replace("<th>IP</th>", "").replace("<th>Usuário</th>", "<th>User</th>")
    docs = [("ok", page([["L1", "2024-01-01 00:00:00", "a", "b", "c", "d", "e"]])),
            ("nt", "<html><body><p>no table here</p></body></html>"),
            ("mc", page([["L1", "2024-01-01 00:00:00", "a", "b", "c", "d"]], head=missing_ip))]
    df = spark.createDataFrame(docs, "doc_id string, conteudo string")
    st = {r.doc_id: (r.status, r.missing) for r in html_table_status(df, LOG_HEADINGS).collect()}
    assert st == {"ok": ("ok", []), "nt": ("missing_table", []), "mc": ("missing_columns", ["ip", "usuario"])}
    assert html_table(df, LOG_HEADINGS, strict=False).count() == 1
    with pytest.raises(Exception, match="missing_table|missing_columns"):
        html_table(df, LOG_HEADINGS).count()


def test_timestamp_gate(spark):
    good = spark.createDataFrame([("2024-01-01 10:00:00.123456",)], "t string")
    assert str(gate_timestamp(good, "t").first().t) == "2024-01-01 10:00:00.123456"
    bad = spark.createDataFrame([("2024-01-01 10:00:00",), ("yesterday",)], "t string")
    with pytest.raises(Exception, match="invalid values in column t"):
        gate_timestamp(bad, "t").count()      # fails even though no column is read


def test_log_table_rejects_page_without_table(spark):
    df = spark.createDataFrame([("p", "<html><body>nothing</body></html>")], "doc_id string, conteudo string")
    with pytest.raises(Exception, match="missing_table"):
        silver.log_table(df, LOG_HEADINGS).count()


XML = ("<NotasFiscais>"
       "<NotaFiscal><NumeroNota>1</NumeroNota><DataEmissao>2024-01-02</DataEmissao><ClienteID>C</ClienteID>"
       "<ValorServico>10.5</ValorServico><ValorTotal>12</ValorTotal><Impostos><ISS>1.25</ISS><COFINS>2</COFINS>"
       "</Impostos><Itens><Item><Descricao>a &amp; &lt;b&gt;</Descricao><Quantidade>2</Quantidade>"
       "<ValorUnitario>3.5</ValorUnitario></Item></Itens></NotaFiscal>"
       "<NotaFiscal><NumeroNota>2</NumeroNota><DataEmissao>2024-01-03</DataEmissao><ClienteID>C</ClienteID>"
       "<ValorServico>1</ValorServico><ValorTotal>1</ValorTotal><Itens/></NotaFiscal>"
       "</NotasFiscais>")


def test_xml_invoice_singleton_item_kept_and_absent_tax_dropped(spark):
    docs = spark.createDataFrame([("d", XML)], "doc_id string, conteudo string")
    el = invoice_elements(docs)
    inv = silver.invoice(el).orderBy("numero_nota").collect()
    assert [r.numero_nota for r in inv] == ["1", "2"] and inv[0].valor_servico == 10.5
    items = silver.invoice_item(el).collect()
    assert len(items) == 1 and items[0].descricao == "a & <b>" and items[0].quantidade == 2
    taxes = {(r.tipo_imposto, r.valor) for r in silver.invoice_tax(el).collect()}
    assert taxes == {("ISS", 1.25), ("COFINS", 2.0)}
    assert len({r.id_nota for r in inv}) == 2


def test_xml_to_json_route_gives_the_same_elements(spark):
    from lakefold.sources import invoice_elements_from_json, xml_to_json
    docs = spark.createDataFrame([("d", XML)], "doc_id string, conteudo string")
    js = xml_to_json(docs)
    assert js.first().conteudo.startswith('{"NotasFiscais":{"NotaFiscal":[{') and '"NumeroNota":"1"' in js.first().conteudo
    a = sorted(map(tuple, invoice_elements(docs).collect()))
    b = sorted(map(tuple, invoice_elements_from_json(js).collect()))
    assert a == b


def test_repeated_invoice_number_keeps_children_with_their_own_element(spark):
    repeated = XML.replace("<NumeroNota>2</NumeroNota>", "<NumeroNota>1</NumeroNota>")
    docs = spark.createDataFrame([("d", repeated)], "doc_id string, conteudo string")
    el = invoice_elements(docs)
    inv = silver.invoice(el).collect()
    assert [r.numero_nota for r in inv] == ["1", "1"] and len({r.id_nota for r in inv}) == 2
    items = silver.invoice_item(el).collect()
    assert len(items) == 1                      # not multiplied by the repeated number


def test_xml_strict_cast_fails_on_bad_amount(spark):
    docs = spark.createDataFrame([("d", XML.replace("<ValorTotal>12</ValorTotal>", "<ValorTotal>12,0</ValorTotal>"))],
                                 "doc_id string, conteudo string")
    with pytest.raises(Exception):
        silver.invoice(invoice_elements(docs)).collect()


def test_json_projects_and_nested_tasks(spark):
    doc = ('{"projetos": [{"id_projeto": "P1", "cliente_id": "C", "data_inicio": "2024", "horas_totais_estimadas": 4,'
           ' "valor_projeto": 1.5, "tarefas": [{"id_tarefa": "T1", "horas_realizadas": "40.0"}, {"id_tarefa": "T2"}]},'
           ' {"id_projeto": "P2", "tarefas": []}, {"id_projeto": "P3"}]}')
    docs = spark.createDataFrame([("d", doc)], "doc_id string, conteudo string")
    assert [r.id_projeto for r in project_elements(docs).orderBy("pos").collect()] == ["P1", "P2", "P3"]
    proj = {r.id_projeto: r for r in silver.project(docs).collect()}
    assert proj["P1"].data_inicio is None and proj["P1"].horas_totais_estimadas == 4 and proj["P1"].valor_projeto == 1.5
    tasks = {r.id_tarefa: r for r in silver.task(docs).collect()}
    assert set(tasks) == {"T1", "T2"} and tasks["T1"].horas_realizadas is None and tasks["T1"].id_projeto == "P1"
    assert task_elements(docs).count() == 2


def test_scan_csv_keeps_edge_whitespace_and_nulls(spark):
    path = fresh_path(spark, "t-csv")
    df = spark.createDataFrame([("1", "  a\t", None), ("2", "b,c", "x")], "id string, name string, v string")
    (df.write.option("header", True).option("ignoreLeadingWhiteSpace", False)
       .option("ignoreTrailingWhiteSpace", False).csv(path))
    got = sorted(tuple(r) for r in scan_csv(spark, path, "id string, name string, v string").collect())
    assert got == [("1", "  a\t", None), ("2", "b,c", "x")]


def test_scan_documents_whole_file(spark):
    path = fresh_path(spark, "t-docs")
    spark.createDataFrame([("line1",), ("line2",)], "v string").coalesce(1).write.text(path)
    whole = scan_documents(spark, path).collect()
    assert len(whole) == 1 and whole[0].conteudo.splitlines() == ["line1", "line2"]
    assert scan_documents(spark, path, by_line=True).count() == 2


def test_malformed_documents_fail_and_are_reported(spark):
    from lakefold.sources.documents import document_rejects
    json_docs = spark.createDataFrame([("a", '{"projetos": [{"id_projeto": "1"}]}'), ("b", '{"projetos": [{"id_pro'), ("c", None)],
                                      "doc_id string, conteudo string")
    xml_docs = spark.createDataFrame([("a", "<NotasFiscais><NotaFiscal><NumeroNota>1</NumeroNota></NotaFiscal></NotasFiscais>"),
                                      ("b", "<NotasFiscais><NotaFiscal><NumeroNota>1</Num")], "doc_id string, conteudo string")
    assert {(r.doc_id, r.reason) for r in document_rejects(json_docs, "json").collect()} == {("b", "malformed"), ("c", "missing")}
    assert {(r.doc_id, r.reason) for r in document_rejects(xml_docs, "xml").collect()} == {("b", "malformed")}
    for broken in (project_elements(json_docs), invoice_elements(xml_docs)):
        with pytest.raises(Exception, match="(?i)malformed|failfast"):
            broken.collect()


def test_html_rows_that_start_with_a_header_are_data(spark):
    page = ("<!-- <table><tr><th>other</th></tr></table> --><table><tr><th>A</th><th>B</th></tr>"
            "<tr><th>1</th><td>2</td></tr><tr><td>3</td><td>4</td></tr><tr><th>5</th><th>6</th></tr></table>")
    df = spark.createDataFrame([("p", page)], "doc_id string, conteudo string")
    got = sorted((r.a, r.b) for r in html_table(df, {"A": "a", "B": "b"}).collect())
    assert got == [("1", "2"), ("3", "4"), ("5", "6")]


def test_html_grid(spark):
    from lakefold.sources import html_table
    head = "<tr><th>A</th><th>B</th><th>C</th></tr>"
    tables = [
        "<tr><td rowspan=2>1</td><td>2</td><td>3</td></tr><tr><td>4</td><td>5</td></tr><tr><td>6</td><td colspan='2'>7</td></tr>",
        "<tr><td>1</td><td rowspan=\"3\">2</td><td>3</td></tr><tr><td rowspan=2>4</td><td>5</td></tr><tr><td>6</td></tr>",
        "<tr><td colspan=2 rowspan=2>1</td><td>3</td></tr><tr><td>4</td></tr><tr><td>5</td><td>6</td><td rowspan=3>7</td></tr>",
        "<tr><td>1</td><td>2</td><td>3</td></tr>",
    ]
    pages = spark.createDataFrame([(str(i), f"<table>{head}{t}</table>") for i, t in enumerate(tables)], "doc_id string, conteudo string")
    rows = html_table(pages, {"A": "a", "B": "b", "C": "c"}).collect()
    got = {i: [tuple(r[2:]) for r in sorted((r for r in rows if r.doc_id == str(i)), key=lambda r: r.row_pos)] for i in range(len(tables))}
    assert got[0] == [("1", "2", "3"), ("1", "4", "5"), ("6", "7", "7")]
    assert got[1] == [("1", "2", "3"), ("4", "2", "5"), ("4", "2", "6")]
    assert got[2] == [("1", "1", "3"), ("1", "1", "4"), ("5", "6", "7"), ("7", None, None), ("7", None, None)]
    assert got[3] == [("1", "2", "3")]


def test_html_entities(spark):
    import html

    from pyspark.sql import functions as F

    from lakefold.sources.html import decode_entities
    texts = ["plain", "a &amp; b", "&lt;&#60;&#x3C;&#X3c;&gt;", "&euro;&Aacute;&hearts;&nbsp;x", "&#8364;&#128512;", "&unknown; & &; &#; a&b", "&amp;lt;",
             "&NotEqualTilde;", "&#0;&#xD800;&#1114112;", None]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1).select(decode_entities(F.col("t"))).collect()]
    assert got[:-2] == [html.unescape(t).replace(" ", " ") for t in texts[:-2]]
    assert got[-2:] == ["���", None]


_ITEM = "<Item><Descricao>a</Descricao><Quantidade>2</Quantidade><ValorUnitario>1.5</ValorUnitario></Item>"
_NOTE = "<NotaFiscal><NumeroNota>1</NumeroNota><Impostos><ISS>2</ISS></Impostos><Itens>%s</Itens></NotaFiscal>"


@pytest.mark.parametrize("columns", [INVOICE_FIELDS, TAX_FIELDS, ["Itens"]])
def test_invoice_elements_of_some_columns_are_those_of_all(spark, columns):
    bodies = [_NOTE % (_ITEM * 2) + _NOTE % "", "<NotaFiscal/>", "<NotaFiscal><Itens/></NotaFiscal><NotaFiscal><Impostos/></NotaFiscal>", "",
              "<NotaFiscal><Impostos><ISS/></Impostos><Impostos><PIS>3</PIS></Impostos><Outro><ISS>9</ISS></Outro></NotaFiscal>", "<Outro/>"]
    docs = spark.createDataFrame([(f"d{i}", f"<NotasFiscais>{b}</NotasFiscais>") for i, b in enumerate(bodies)] + [("none", None)], "doc_id string, conteudo string")
    some, whole = invoice_elements(docs, columns), invoice_elements(docs).select("doc_id", "pos", *columns)
    assert some.columns == whole.columns and sorted(map(str, some.collect())) == sorted(map(str, whole.collect()))


@pytest.mark.parametrize("columns", [INVOICE_FIELDS, TAX_FIELDS])
@pytest.mark.parametrize("item", ["<Item><Descricao>a</Item>", "<Item><Descricao>a & b</Descricao></Item>", "<Item>&unknown;</Item>", "<Item>\u0001</Item>", "<Item"])
def test_a_malformed_item_fails_tables_without_items_too(spark, columns, item):
    docs = spark.createDataFrame([("d", f"<NotasFiscais>{_NOTE % item}</NotasFiscais>")], "doc_id string, conteudo string")
    for wanted in (columns, INVOICE_COLUMNS):
        with pytest.raises(Exception, match="(?i)malformed"):
            invoice_elements(docs, wanted).collect()
