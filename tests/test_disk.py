"""What queries leave on disk while they run: shuffle files and passing tables go when they have been
read, and files of documents are compressed."""

import json
import time
from pathlib import Path

import pytest

from lakefold import session
from lakefold.plans import sinks
from lakefold.plans.catalog import QUERIES
from lakefold.plans.standins import invoice_records, project_documents
from lakefold.session import brief_shuffles, scratch_mark
from lakefold.sources.records import scan_json_documents

SF = "/root/testdata/sf0.001"


def shuffle_files(spark) -> set[str]:
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().mkString("\n")
    return {name for name in found.splitlines() if name.startswith("shuffle_")}


def test_shuffle_files_go_when_their_table_is_written(spark, tmp_path):
    before = shuffle_files(spark)
    sinks.refresh_table(spark.range(1000).repartition(4, "id"), str(tmp_path / "t"))
    until = time.time() + 20
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert sinks.read_table(spark, str(tmp_path / "t")).count() == 1000
    name = session._REMOVE_SHUFFLES
    with brief_shuffles(spark), brief_shuffles(spark):
        assert spark.conf.get(name) == "true"
    assert spark.conf.get(name, "false") == "false"


@pytest.mark.parametrize("name", ["scan_documents", "xml_records", "split_json_file", "split_xml_file"])
def test_files_of_documents_are_compressed(spark, name):
    mark = scratch_mark()
    QUERIES[name](spark, SF)
    files = [p for folder in session._CREATED[mark:] if folder.rsplit("/", 1)[1].startswith(("projects-", "invoices-"))
             for p in Path(folder.removeprefix("file:")).rglob("part-*")]
    assert files and all(p.suffix == ".gz" for p in files)


def test_stretches_are_gone_once_their_elements_are_written(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(json.dumps({"projetos": [{"n": i, "t": "{[}\"" * i} for i in range(50)]}))
    mark = scratch_mark()
    docs = scan_json_documents(spark, str(tmp_path / "in"), "projetos")
    left = [p for p in session._CREATED[mark:] if Path(p.removeprefix("file:")).exists()]
    assert left and not [p for p in left if "json-stretches" in p]
    assert sorted(json.loads(r.conteudo)["projetos"][0]["n"] for r in docs.collect()) == list(range(50))
    scan_json_documents(spark, str(tmp_path / "in"), "projetos", str(tmp_path / "scratch"))
    assert [p.name.rsplit("-", 5)[0] for p in (tmp_path / "scratch").iterdir()]


@pytest.mark.parametrize("name", ["check_primary_key", "check_foreign_key"])
def test_key_checks_are_written_source_by_source(spark, name):
    mark = scratch_mark()
    QUERIES[name](spark, SF)
    assert len([p for p in session._CREATED[mark:] if "violations" in p]) == 3


def test_orders_are_moved_before_their_records_are_made(spark):
    orders, lines = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("orders", "lineitem"))
    plan = project_documents(orders, lines, None)._jdf.queryExecution().optimizedPlan().toString()
    join = next(i for i, line in enumerate(plan.splitlines()) if "Join LeftOuter" in line)
    assert not [line for line in plan.splitlines()[join:] if "Analista" in line]
    assert invoice_records(orders, "o_custkey").columns[-1] == "o_custkey"
