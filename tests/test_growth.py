"""Plans whose work must grow no faster than their input: rows move once."""

import datetime as dt
import time

from pyspark.sql import functions as F

from lakefold.operators.hot_groups import attach_groups, hot_keys
from lakefold.plans import sinks, standins
from lakefold.plans.refresh import bucket_count
from lakefold.sources.documents import xml_to_json
from lakefold.sources.records import scan_xml_documents


ROWS = [(k, i) for k in (1, 2) for i in range(5)] + [(3, i) for i in range(200)] + [(None, i) for i in range(90)] + [(9, 0)]
PARENTS = [(1, "a"), (1, "b"), (2, "c"), (3, "d"), (3, "e"), (4, "f"), (None, "g")]


def test_groups_of_all_sizes_are_attached(spark):
    rows, parents = spark.createDataFrame(ROWS, "k long, i long"), spark.createDataFrame(PARENTS, "p long, v string")
    hot = hot_keys(rows, "k", 64)
    assert [r.k for r in hot.collect()] == [3]
    got = attach_groups(parents, "p", rows, "k", F.struct("i"), "items", 64, hot).collect()
    found: dict = {}
    for r in got:
        found.setdefault((r.p, r.v), []).extend(x.i for x in r["items"] or [])
        assert len(r["items"] or []) < 3 * 64
    assert found == {(p, v): found[p, v] for p, v in PARENTS}
    for p, v in PARENTS:
        assert sorted(found[p, v]) == sorted(i for k, i in ROWS if k == p and p is not None)
    assert hot_keys(rows, "k", 500) is None


def test_lines_of_ordinary_orders_move_once(spark):
    ts = dt.datetime(2000, 1, 1)
    lines = spark.createDataFrame([(1, 1, 1, p, 1.0, 10.0, "A", "O", ts) for p in range(9)],
                                  "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                                  "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz")
    orders = spark.createDataFrame([(1, 1, "F", 1.0, ts, "1")], "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
                                                                "o_orderdate timestamp_ntz, o_orderpriority string")
    for docs in (standins.project_documents(orders, lines), standins.invoice_documents(orders, lines)):
        assert docs._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2  # lines, orders


def test_files_of_a_date_do_not_shrink_with_more_dates():
    for invoices in (1_000, 600_000, 9_000_000, 54_000_000):
        buckets = bucket_count(invoices, 2405, 1000)
        assert buckets == 1 or invoices / (2405 * (buckets - 1)) >= 400
    assert bucket_count(600_000, 30, 200) == 6 and bucket_count(10**9, 30, 200) == 200 and bucket_count(0, 0, 8) == 1


def test_records_are_not_moved_to_their_root(spark, tmp_path):
    (tmp_path / "a.xml").write_text("<R v='1'><N><A>1</A></N>\n<N><A>2</A></N></R>")
    docs = scan_xml_documents(spark, str(tmp_path), "N")
    assert sorted(r.conteudo for r in docs.collect()) == ["<R v='1'><N><A>1</A></N></R>", "<R v='1'><N><A>2</A></N></R>"]
    assert "SortMergeJoin" not in docs._jdf.queryExecution().executedPlan().toString()


def test_keys_are_stored_in_half_their_digits(spark, tmp_path):
    n = 20_000
    keys = spark.range(n).select(F.sha2(F.col("id").cast("string"), 256).alias("k"))
    sinks.refresh_table(keys.coalesce(1), str(tmp_path / "t"))
    assert sum(f.stat().st_size for f in (tmp_path / "t").rglob("*.parquet")) < 0.75 * 64 * n


def test_plain_texts_do_not_fail_as_numbers_first(spark):
    """Trees of plain texts take less time than those of the same texts in a document with a comment, which
    the parser tries as numbers, dates and timestamps; both are the same."""
    leaves = "".join(f"<a><t> texto {i} </t><u>007</u>x &amp; <v k='1'>2024-01-{i}é</v>y</a>" for i in range(40))
    docs = spark.range(0, 600, 1, 1).select(F.col("id").cast("string").alias("doc_id"), F.concat(F.lit("<R><n>"), F.col("id").cast("string"), F.lit(f"</n>{leaves}</R>")).alias("conteudo"))
    commented = docs.withColumn("conteudo", F.replace("conteudo", F.lit("<R>"), F.lit("<R><!-- c -->")))

    def run(d):
        t0 = time.perf_counter()
        rows = {r.doc_id: r.conteudo for r in xml_to_json(d).collect()}
        return time.perf_counter() - t0, rows
    run(docs), run(commented)
    (fast, got), (slow, want) = min(run(docs), run(docs), key=lambda x: x[0]), min(run(commented), run(commented), key=lambda x: x[0])
    assert got == want and fast < 0.8 * slow


def test_items_of_groups_are_made_before_the_aggregate(spark):
    # an aggregate's own input is evaluated row by row, interpreted
    rows, parents = spark.createDataFrame(ROWS, "k long, i long"), spark.createDataFrame(PARENTS, "p long, v string")
    item = F.struct((F.col("i") * 2).alias("twice"))
    for hot in (None, hot_keys(rows, "k", 64)):
        plan = attach_groups(parents, "p", rows, "k", item, "items", 64, hot)._jdf.queryExecution().optimizedPlan().toString()
        lists = [line for line in plan.splitlines() if "collect_list(" in line]
        assert len(lists) == (1 if hot is None else 2) and not [line for line in lists if "named_struct(" in line or "struct(twice" in line]
