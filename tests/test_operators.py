"""Operators: hot-group splitting, unpivot, key checks; gold invariants."""

from collections import Counter

from pyspark.sql import functions as F

from lakefold.operators import duplicate_excess, foreign_key_orphans, primary_key_violations, split_hot_groups
from lakefold.operators.reshape import unpivot_columns
from lakefold.plans import gold


def test_split_hot_groups_bounds_every_part(spark):
    # key 1: 2000 distinct rows; key 3: one row copied 1000 times (a hot group of copies)
    rows = [(1, i) for i in range(2000)] + [(2, i) for i in range(5)] + [(3, 7)] * 1000
    df = spark.createDataFrame(rows, "k long, i long")
    out = split_hot_groups(df, ["k"], 64).collect()
    assert Counter((r.k, r.i) for r in out) == Counter(rows)          # nothing dropped or repeated
    sizes = Counter((r.k, r.part) for r in out)
    hot = [n for (k, _), n in sizes.items() if k == 1]
    assert len(hot) == 32 and max(hot) < 3 * 64                        # ceil(2000/64) parts, none huge
    assert {p for (k, p) in sizes if k == 2} == {0}
    copies = [n for (k, _), n in sizes.items() if k == 3]
    assert sum(copies) == 1000 and len(copies) > 4 and max(copies) <= 4 * 64


def test_attach_parts_equals_left_join(spark):
    from lakefold.operators import attach_parts
    parents = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k long, v string")
    # parent 3 has two parts but only part 1 holds rows: part 0 is not invented
    parts = spark.createDataFrame([(1, 0, 10, 2), (1, 1, 11, 2), (3, 1, 30, 2)],
                                  "pk long, part long, x long, part_count long")
    got = sorted(tuple(r) for r in attach_parts(parents, "k", parts, "pk").select("k", "v", "part", "x").collect())
    assert got == [(1, "a", 0, 10), (1, "a", 1, 11), (2, "b", None, None), (3, "c", 1, 30)]


def test_unpivot_drops_nulls(spark):
    df = spark.createDataFrame([("a", 1.0, None, 3.0)], "id string, x double, y double, z double")
    out = unpivot_columns(df, ["id"], {"X": "x", "Y": "y", "Z": "z"}, "kind", "v").collect()
    assert {(r.kind, r.v) for r in out} == {("X", 1.0), ("Z", 3.0)}


def test_key_checks(spark):
    t = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "k string")
    v = {(r.key_value, r.n_rows) for r in primary_key_violations(t, "k", "t").collect()}
    assert v == {("a", 2), (None, 1)}
    assert t.agg(duplicate_excess("k")).first()[0] == 2                 # NULL counts as a duplicate
    child = spark.createDataFrame([("a",), ("z",), ("z",), (None,)], "fk string")
    o = {(r.key_value, r.n_rows) for r in foreign_key_orphans(child, "fk", t, "k", "c->t").collect()}
    assert o == {("z", 2)}


def test_invoice_totals_parity_and_exact(spark):
    inv = spark.createDataFrame([("n1", "c", "1", None, 10.0, 9.0), ("n2", "c", "2", None, 5.0, 5.0),
                                 ("n3", "c", "3", None, 1.0, 1.0)],
                                "id_nota string, id_cliente string, numero_nota string, data_emissao date, "
                                "valor_total double, valor_servico double")
    items = spark.createDataFrame([("i1", "n1", "a", 2, 1.5), ("i2", "n1", "b", 1, 4.0), ("i3", "n3", "c", 1, 1.0)],
                                  "id_item string, id_nota string, descricao string, quantidade long, "
                                  "valor_unitario double")
    taxes = spark.createDataFrame([("t1", "n1", "ISS", 0.5), ("t2", "n1", "PIS", 0.25), ("t3", "n1", "COFINS", 1.0),
                                   ("t4", "n2", "ISS", 2.0)],
                                  "id_imposto string, id_nota string, tipo_imposto string, valor double")
    par = {r.id_nota: r for r in gold.invoice_totals(inv, items, taxes).collect()}
    exa = {r.id_nota: r for r in gold.invoice_totals(inv, items, taxes, exact=True).collect()}
    # n1: 2 items x 3 taxes -> items total x3, each tax x2
    assert par["n1"].valor_itens == 21.0 and par["n1"].valor_iss == 1.0 and par["n1"].valor_cofins == 2.0
    assert exa["n1"].valor_itens == 7.0 and exa["n1"].valor_iss == 0.5
    # n2: no items -> NULL item total; n3: no taxes -> 0
    assert par["n2"].valor_itens is None and par["n2"].valor_iss == 2.0
    assert par["n3"].valor_itens == 1.0 and par["n3"].valor_pis == 0.0


def test_longest_task_breaks_ties_by_description(spark):
    proj = spark.createDataFrame([("p1", "c1", "r", "Ativo", 1, 2), ("p2", "c1", "r", "Cancelado", 1, 2),
                                  ("p3", "c1", "r", None, 1, 2)],
                                 "id_projeto string, id_cliente string, responsavel string, status string, "
                                 "horas_totais_estimadas long, horas_totais_realizadas long")
    task = spark.createDataFrame([("p1", "b", 5), ("p1", "a", 3), ("p1", "a", 2), ("p1", "c", 4), ("p2", "x", 9),
                                  ("p3", "y", 1)],
                                 "id_projeto string, descricao string, horas_realizadas long")
    cli = spark.createDataFrame([("c1", "ACME LTDA")], "id_cliente string, razao_social string")
    longest = gold.project_longest_task(proj, task, cli).collect()
    assert [(r.id_projeto, r.tarefa_longa, r.hrs_tarefa, r.nome_cliente) for r in longest] == \
        [("p1", "b", 5, "Acme Ltda")]                                   # tie a=5,b=5 -> 'b'; cancelled/NULL dropped
    hours = {(r.tarefa_longa, r.hrs_tarefa) for r in gold.project_task_hours(proj, task, cli).collect()}
    assert hours == {("a", 5), ("b", 5), ("c", 4)}


def test_exact_totals_equal_item_sums(spark):
    from lakefold.plans.layers import Layers
    L = Layers(spark, "/root/testdata/sf0.001")
    exact = L.invoice_totals_exact.agg(F.sum(F.col("valor_itens").cast("decimal(20,4)"))).first()[0]
    direct = L.invoice_item.agg(F.sum((F.col("quantidade") * F.col("valor_unitario")).cast("decimal(18,4)"))).first()[0]
    assert exact == direct
    # every child has a parent
    assert L.invoice_item.join(L.invoice, "id_nota", "left_anti").count() == 0
