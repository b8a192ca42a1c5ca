"""Stored tables and views: what a session reads without the code that built them."""

import subprocess
import sys
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lakefold.plans.layers import Layers
from lakefold.plans.refresh import refresh_all
from lakefold.plans.warehouse import bucketed_write, open_table, open_warehouse
from lakefold.session import fresh_path

SF = "/root/testdata/sf0.001"
AS_OF = "2025-06-30 12:00:00"


def bag(df):
    return Counter(tuple(r) for r in df.select(sorted(df.columns)).collect())


@pytest.fixture(scope="module")
def root(spark):
    return refresh_all(spark, SF, as_of=AS_OF, buckets=4).root


def test_all_views_equal_the_datasets(spark, root):
    L, wh = Layers(spark, SF, as_of=AS_OF), open_warehouse(spark, root, AS_OF)
    assert len(wh.views) == 13
    for name in L.GOLD_VIEWS:
        assert dict(wh.views[name].dtypes) == dict(L.gold_view(name).dtypes), name
        assert bag(wh.views[name]) == bag(L.gold_view(name)), name
    for name in ("dq_customer", "dq_analysis", "dq_project", "dq_task", "dq_invoice", "dq_invoice_tax", "dq_invoice_item"):
        want = L.dq(name)
        found = wh.views[f"vw_dq_{want.first().tabela}"]
        assert found.columns == want.columns and bag(found) == bag(want), name


def test_joins_of_stored_invoices_do_not_shuffle(spark, root):
    plan = open_warehouse(spark, root, AS_OF).views["vw_anl_nota_fiscal"]._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("Bucketed: true") == 3


def test_another_process_reads_the_views_from_the_warehouse_alone(root):
    code = f"""
import sys; sys.path.insert(0, {str(Path(__file__).resolve().parents[1])!r})
from lakefold.session import build_session
from lakefold.plans.warehouse import open_warehouse
spark = build_session("local[2]")
wh = open_warehouse(spark, {root!r}, {AS_OF!r})
assert not [m for m in sys.modules if m in ("lakefold.plans.gold", "lakefold.plans.quality", "lakefold.plans.view_sql")]
print("ROWS", sorted((n, spark.table(n).count()) for n in wh.views))
spark.stop()
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=600)
    assert "ROWS" in out.stdout, out.stderr[-2000:]
    rows = dict(eval(out.stdout.split("ROWS ")[1].splitlines()[0]))
    assert len(rows) == 13 and rows["vw_anl_nota_fiscal"] == 1500


def test_a_hot_key_is_not_put_in_a_bucket(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    path = fresh_path(spark, "t-hot-bucket")
    assert bag(bucketed_write(df, path, "k", 4, most_rows=100)) == bag(df)
    assert "Bucketed: true" not in open_table(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert bag(bucketed_write(df, path, "k", 4)) == bag(df)
    plan = open_table(spark, path).groupBy("k").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
