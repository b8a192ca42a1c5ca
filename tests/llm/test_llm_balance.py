"""Entropy balancing of several families against iterative proportional fitting."""

import random

import numpy as np
import pytest

from lakefold.llm import balance


def goals(spark, family, values):
    return spark.createDataFrame(list(values.items()), f"{family} string, target double")


def found(df):
    return {(r.source, r.lang): r for r in df.collect()}


def test_two_families_by_proportional_fitting(spark):
    draw = random.Random(4)
    rows = [(draw.choice("abc"), draw.choice(["en", "de", None]), draw.randint(0, 400)) for _ in range(300)]
    rows += [("a", "fr", 50), ("d", "en", 70), ("z", "en", 10)]  # a language of one source, a source of one language, one without target
    table = spark.createDataFrame(rows, "source string, lang string, size bigint")
    source, lang = {"a": 9000.0, "b": 5000.0, "c": 20000.0, "d": 300.0, "y": 5.0}, {"en": 3.0, "de": 2.0, None: 1.0, "fr": 0.02}
    got = found(balance.balanced_rates(table, "size", {"source": goals(spark, "source", source), "lang": goals(spark, "lang", lang)}))
    mass = {}
    for s, l, n in rows:
        if s in source:
            mass[s, l] = mass.get((s, l), 0.0) + n
    whole = sum(v for k, v in source.items() if k != "y")
    want = ({k: v for k, v in source.items() if k != "y"}, {k: v * whole / sum(lang.values()) for k, v in lang.items()})
    fitted = dict(mass)
    for _ in range(5000):
        for i, goal in enumerate(want):
            for k, t in goal.items():
                own = sum(v for c, v in fitted.items() if c[i] == k)
                fitted.update({c: v * t / own for c, v in fitted.items() if c[i] == k})
    assert got["z", "en"].rate == 0.0 and got["a", "en"].gap < 1e-8
    for c, v in fitted.items():
        assert got[c].rate * mass[c] == pytest.approx(v, rel=1e-5)


def test_one_family_is_a_ratio(spark):
    table = spark.createDataFrame([("a", 10), ("a", 30), ("b", 5), (None, 7), ("c", 0)], "source string, size bigint")
    rates = balance.balanced_rates(table, "size", {"source": goals(spark, "source", {"a": 20.0, "b": 20.0, None: 0.0})})
    assert {r.source: r.rate for r in rates.collect()} == pytest.approx({"a": 0.5, "b": 4.0, None: 0.0, "c": 0.0})


def test_targets_that_cannot_be_met_are_told(spark):
    table = spark.createDataFrame([("a", "en", 10), ("b", "de", 10)], "source string, lang string, size bigint")
    rates = balance.balanced_rates(table, "size", {"source": goals(spark, "source", {"a": 10.0, "b": 10.0}),
                                                   "lang": goals(spark, "lang", {"en": 15.0, "de": 5.0})})
    assert all(r.gap > 0.1 and np.isfinite(r.rate) for r in rates.collect())


def test_empty_tables_and_native_plan(spark):
    empty = spark.createDataFrame([], "source string, size bigint")
    none = balance.balanced_rates(empty, "size", {"source": goals(spark, "source", {"a": 1.0})})
    assert none.count() == 0 and none.columns == ["source", "size", "rate", "gap"]
    plan = none._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
