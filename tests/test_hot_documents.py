"""Documents built when one order holds a third of all lines, or one line is
copied many times: every document stays bounded and nothing is lost."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakefold.operators import split_hot_groups
from lakefold.plans import gold, silver, standins
from lakefold.sources import invoice_elements

LINE = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz")
ORDER = ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
         "o_orderpriority string")


def fixture(spark):
    ts = dt.datetime(2000, 1, 1)
    hot = [(1, p, 1, p, 1.0, 10.0, 0.0, 0.0, "A", "O", ts) for p in range(300)]          # one hot order
    copies = [(2, 7, 1, 1, 2.0, 5.0, 0.0, 0.0, "R", "F", ts)] * 200                      # one line copied
    cold = [(k, k, 1, 1, 1.0, 1.0, 0.0, 0.0, "N", "O", ts) for k in range(3, 403)]        # 400 small orders
    orders = [(k, k, "F", 100.0, ts, "1-URGENT") for k in range(0, 403)]                  # order 0: no lines
    return spark.createDataFrame(hot + copies + cold, LINE), spark.createDataFrame(orders, ORDER)


def test_invoice_documents_stay_bounded(spark):
    lines, orders = fixture(spark)
    docs = standins.invoice_documents(orders, lines)
    el = invoice_elements(docs)
    sizes = [r.n for r in el.select(F.coalesce(F.size("Itens"), F.lit(0)).alias("n")).collect()]
    assert max(sizes) <= 3 * standins.MAX_ITEMS_PER_INVOICE
    items = silver.invoice_item(el)
    assert items.count() == lines.count() == 900
    assert items.where("descricao like 'Peça 7 %' or descricao = 'Serviço 7'").count() >= 200
    rows = {r.o: r.n for r in el.groupBy(F.substring("NumeroNota", 3, 9).alias("o")).agg(F.count(F.lit(1)).alias("n")).collect()}
    assert rows["1"] >= 300 // (2 * standins.MAX_ITEMS_PER_INVOICE)   # the hot order is stored in several documents
    assert rows["0"] == 1                                              # an order without lines: one document
    assert silver.invoice(el).count() == 403                           # and all of them are one invoice each
    assert items.select("id_item").distinct().count() == 900


def totals(spark, n, bound, monkeypatch):
    monkeypatch.setattr(standins, "MAX_LINES_PER_DOCUMENT", bound)
    ts = dt.datetime(2000, 1, 1)
    lines = spark.createDataFrame([(1, p, 1, p, 1.0, 10.0, 0.0, 0.0, "A", "O", ts) for p in range(n)], LINE)
    orders = spark.createDataFrame([(1, 1, "F", 1000.0, ts, "1-URGENT")], ORDER)
    el = invoice_elements(standins.invoice_documents(orders, lines))
    row = gold.invoice_totals(silver.invoice(el), silver.invoice_item(el), silver.invoice_tax(el), exact=True).collect()
    taxes = sorted((r.tipo_imposto, r.valor) for r in silver.invoice_tax(el).collect())
    return [tuple(r) for r in row], taxes


@pytest.mark.parametrize("n", [60, 64, 65, 200])
def test_one_invoice_whatever_its_size(spark, monkeypatch, n):
    rows, taxes = totals(spark, n, 64, monkeypatch)
    assert len(rows) == 1 and rows[0][4] == 1000.0 and rows[0][6] == 10.0 * n
    assert (rows, taxes) == totals(spark, n, 7, monkeypatch) == totals(spark, n, 1000, monkeypatch)


def test_rows_without_a_key_are_kept(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), (1, 2)], "k long, i long")
    out = split_hot_groups(df, ["k"], 64)
    assert sorted(((r.k, r.i) for r in out.collect()), key=str) == sorted([(None, 1), (None, 1), (1, 2)], key=str)


def test_equal_identities_do_not_share_a_part(spark):
    df = spark.range(5000).select(F.lit(1).alias("k"), F.lit(7).alias("name"), F.col("id").alias("v"))
    sizes = [r["count"] for r in split_hot_groups(df, ["k"], 64).groupBy("part").count().collect()]
    assert sum(sizes) == 5000 and max(sizes) < 3 * 64


def test_project_documents_fold_back(spark):
    lines, orders = fixture(spark)
    docs = standins.project_documents(orders, lines)
    assert docs.select(F.length("conteudo").alias("n")).agg(F.max("n")).first()[0] < 64 * 400
    assert silver.project(docs).count() == 403            # repeats of a split project fold into one row
    assert silver.task(docs).count() == lines.distinct().count()
