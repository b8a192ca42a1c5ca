"""Plan hygiene for every registered dataset: no cross products, no Python in
the data path, pruned scans, partition filters."""

import datetime as dt

import pytest

from lakefold import session
from lakefold.plans import sinks
from lakefold.plans.catalog import QUERIES
from lakefold.plans.layers import Layers
from lakefold.session import fresh_path, scratch_mark

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas")


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_products_and_no_python(spark, name):
    plan = physical(QUERIES[name](spark, SF))
    assert not [op for op in FORBIDDEN if op in plan], plan[:2000]


def test_scans_read_only_used_columns(spark):
    L = Layers(spark, SF)
    plan = physical(L.customer)
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line and "customer.parquet" in line][0]
    assert "c_acctbal" not in scan and "c_mktsegment" in scan


def test_date_filter_prunes_partitions(spark):
    df = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 2))], "k int, d date")
    out = sinks.partitioned_write(df, fresh_path(spark, "t-prune"), "d")
    plan = physical(out.where("d = DATE'2024-01-02'"))
    assert "PartitionFilters: [isnotnull(d" in plan and "2024-01-02" in plan


def _nodes_with(plan: str, needle: str) -> list[str]:
    return [line.strip().split(" ", 2)[1] if line.strip().startswith(("+-", ":-")) else line.strip().split(" ")[0]
            for line in plan.splitlines() if needle in line]


def test_both_document_sets_from_one_written_split(spark):
    together, apart = Layers(spark, SF).stage_documents(), Layers(spark, SF)
    assert "line-parts" in physical(together.project_docs) and "line-parts" in physical(together.invoice_docs)
    assert "line-parts" not in physical(apart.project_docs)
    for name in ("project", "task", "invoice", "invoice_tax", "invoice_item"):
        one, other = getattr(together, name), getattr(apart, name)
        assert one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty(), name


def test_parser_runs_once_per_document(spark):
    # Each parser sits in one projection per input branch (a union of the
    # documents of parents with and without parts) and never in a filter,
    # where an inferred or pushed-down predicate would run it a second time.
    L = Layers(spark, SF, stage=False)
    plan = L.invoice_elements._jdf.queryExecution().optimizedPlan().toString()
    nodes = _nodes_with(plan, "from_xml(")
    assert nodes and all(n == "Project" for n in nodes), nodes
    assert len(nodes) <= plan.count("Union") + 1
    plan = L.log_raw._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("(?is)<table") == 1            # the page-wide table regex
    assert plan.count("(?is)<tr") == 1               # rows split once
    assert plan.count("(?is)<t[hd]") == 2            # heading cells and data cells, once each
    assert not [n for n in _nodes_with(plan, "(?is)<t") if n == "Filter"]


@pytest.mark.parametrize("name", ["task", "invoice_tax", "dq_invoice"])
def test_one_table_is_made_while_its_documents_are_parsed(spark, name):
    mark = scratch_mark()
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert not [p for p in session._CREATED[mark:] if "staging-" in p]
    parser = "from_json(" if name == "task" else "from_xml("
    nodes = _nodes_with(plan, parser)
    assert nodes and all(n == "Project" for n in nodes) and len(nodes) <= plan.count("Union") + 1
    if parser == "from_xml(":  # the items of an invoice are not made into values
        assert "StructField(Quantidade" not in plan
