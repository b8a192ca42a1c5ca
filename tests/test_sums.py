"""Sums of doubles: exact, the same in any order, NaN and infinity as they come."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from lakefold.functions.sums import add_parts, sum_parts, total
from lakefold.plans import gold


def engine(spark, groups, parts, factor=None):
    rows = [(k, x) for k, xs in groups.items() for x in xs]
    random.Random(parts).shuffle(rows)
    df = spark.createDataFrame(rows, "k string, x double").repartition(parts)
    out = df.groupBy("k").agg(*sum_parts("x", "s")).select("k", total("s", factor and F.lit(factor)).alias("s"))
    return {r.k: r.s for r in out.collect()}


def groups():
    draw = random.Random(3)
    return {
        "money": [round(draw.uniform(-1e5, 1e6), 2) for _ in range(300)], "places": [1.00004, 1.00004, 0.00001, 2.00003],
        "tenths": [0.1] * 10, "cancel": [1e15, 0.125, -1e15, -0.0625], "negative": [-0.3, 0.1, 0.1], "tiny": [3e-300, 4e-300],
        "huge": [1e300, 1e300], "small": [-1e-3, 1e-9], "null": [None, None], "some": [None, 2.5], "zero": [0.0, -0.0],
        "nan": [1.00004, math.nan, 1.0], "inf": [math.inf, 1.0], "both": [math.inf, -math.inf], "wide": [2.0 ** 53, 1.0, 2.0 ** -60, -(2.0 ** 53)]}


@pytest.mark.parametrize("factor", [None, 7])
def test_sums_are_exact_in_any_order(spark, factor):
    data = groups()
    first = engine(spark, data, 1, factor)
    for parts in (3, 11):
        assert {k: repr(v) for k, v in engine(spark, data, parts, factor).items()} == {k: repr(v) for k, v in first.items()}
    for k, xs in data.items():
        xs = [x for x in xs if x is not None]
        if not xs:
            assert first[k] is None
        elif any(math.isnan(x) or math.isinf(x) for x in xs):
            want = sum(xs)
            assert math.isnan(first[k]) if math.isnan(want) else first[k] == want
        else:
            exact = sum(map(Fraction, xs)) * (factor or 1)
            assert abs(Fraction(first[k]) - exact) <= Fraction(math.ulp(float(exact))), k
    if factor is None:
        assert first["places"] == 4.00012 and first["tenths"] == math.fsum([0.1] * 10) and first["wide"] == 1.0 + 2.0 ** -60


def test_sums_of_parts(spark):
    df = spark.createDataFrame([(i % 3, i % 7, x) for i, x in enumerate(groups()["money"])], "a int, b int, x double")
    once = df.groupBy("a").agg(*sum_parts("x", "s")).select("a", total("s").alias("s"))
    twice = df.groupBy("a", "b").agg(*sum_parts("x", "s")).groupBy("a").agg(*add_parts("s")).select("a", total("s").alias("s"))
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_totals_show_nan_and_places(spark):
    invoice = spark.createDataFrame([("n1", "c"), ("n2", "c"), ("n3", "c")], "id_nota string, id_cliente string").selectExpr(
        "*", "id_nota AS numero_nota", "DATE'2024-01-01' AS data_emissao", "1.00004D AS valor_total", "CASE WHEN id_nota = 'n3' THEN double('NaN') ELSE 1.0D END AS valor_servico")
    item = spark.createDataFrame([("n1", 2, 1.00004), ("n1", 1, math.nan), ("n2", 3, 0.00001)], "id_nota string, quantidade bigint, valor_unitario double")
    tax = spark.createDataFrame([("n1", "ISS", 0.1), ("n1", "PIS", 0.2)], "id_nota string, tipo_imposto string, valor double")
    rows = {r.id_nota: r for r in gold.invoice_totals(invoice, item, tax).collect()}
    assert math.isnan(rows["n1"].valor_itens) and rows["n1"].valor_iss == 0.2 and rows["n1"].valor_pis == 0.4
    assert rows["n2"].valor_itens == 3 * 0.00001 and rows["n3"].valor_itens is None and rows["n3"].valor_cofins == 0.0
    customer = spark.createDataFrame([("c", "X")], "id_cliente string, razao_social string")
    summary = gold.invoice_summary(gold.invoice_totals(invoice, item, tax), customer).first()
    assert summary.valor_total_notas == 3.00012 and math.isnan(summary.valor_total_servicos)
