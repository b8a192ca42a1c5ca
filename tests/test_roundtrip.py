"""Round-trip properties: rows -> document text -> rows is the identity."""

import string

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakefold.fixed import LOG_HEADINGS
from lakefold.plans.standins import _html_escape
from lakefold.sources import html_table, invoice_elements

ALPHABET = string.ascii_letters + string.digits + " &<>\"'#;/=-_.,:çãéÁÕ"
texts = st.lists(st.text(alphabet=ALPHABET, max_size=30), min_size=1, max_size=25)
SLOW = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SLOW
@given(values=texts)
def test_html_cells_round_trip(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, v string")
    cells = {name: F.concat(F.lit("<td>"), _html_escape(F.col("v")) if name == "acao" else
                            F.concat(F.lit("x"), F.col("i").cast("string")), F.lit("</td>"))
             for name in LOG_HEADINGS.values()}
    rows = df.select(F.col("i"), F.concat(F.lit("<tr>"), *cells.values(), F.lit("</tr>")).alias("r"))
    head = "<tr>" + "".join(f"<th>{h}</th>" for h in LOG_HEADINGS) + "</tr>"
    page = rows.agg(F.concat(F.lit(f"<html><table>{head}"), F.array_join(F.collect_list("r"), ""),
                             F.lit("</table></html>")).alias("conteudo")).select(F.lit("p").alias("doc_id"), "conteudo")
    got = {r.id_log: r.acao for r in html_table(page, LOG_HEADINGS).collect()}
    want = {f"x{i}": (v.strip() or None) for i, v in enumerate(values)}
    assert got == want


@SLOW
@given(values=st.lists(st.text(alphabet=ALPHABET, min_size=1, max_size=30).map(str.strip).filter(bool),
                       min_size=1, max_size=25))
def test_xml_items_round_trip(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, v string")
    items = df.agg(F.array_sort(F.collect_list(F.struct(F.col("i").alias("Pos"), F.col("v").alias("Descricao"))))
                   .alias("it"))
    nota = F.struct(F.lit("1").alias("NumeroNota"),
                    F.struct(F.transform("it", lambda t: F.struct(t["Descricao"].alias("Descricao"))).alias("Item"))
                    .alias("Itens"))
    docs = items.select(F.lit("d").alias("doc_id"),
                        F.concat(F.lit("<NotasFiscais>"), F.to_xml(nota, {"rowTag": "NotaFiscal", "indent": ""}),
                                 F.lit("</NotasFiscais>")).alias("conteudo"))
    el = invoice_elements(docs).select(F.posexplode("Itens").alias("p", "t")).orderBy("p").collect()
    assert [r.t.Descricao for r in el] == values
