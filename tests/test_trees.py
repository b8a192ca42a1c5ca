"""Trees of XML documents read in batches are those of the parser that reads any document."""

import json

from pyspark.sql import functions as F

from lakefold.sources.documents import _tree_json, xml_to_json, xml_tree

SF = "/root/testdata/sf0.001"
ODD = ["<a><b>1</b><b/><c k='v'>x</c></a>", "<a> x <b> y </b>z<b>w</b> </a>", "<a><b>x &amp; y &lt;z&gt;</b>&quot;q&quot;</a>", "<a k='1' j='x y'/>",
       "<a><B>1</B><b>2</b></a>", "<a><b> </b></a>", "<a>\n <b>x\ny</b>\n</a>", "<a><b>\\ \" / é ü 😀</b></a>", "<a>only</a>", "<a/>", "<a k=' v '><b/></a>",
       "<é><b>1</b></é>", "<a><!-- c --><b>007</b></a>", "<a><b><![CDATA[<x>]]></b></a>", "<?xml version='1.0'?><a><b>1</b></a>", "<a><b>&#65;</b></a>",
       "<a><b>2024-01-01</b><b>1e5</b><b>true</b></a>", "<a k=\"it's\"><b>[1]</b><c>{}</c></a>"]


def test_trees_read_in_batches_are_those_of_the_other_parser(spark):
    docs = spark.createDataFrame([*enumerate(ODD), (-1, None)], "doc_id long, conteudo string")
    got = xml_to_json(docs)
    assert got.schema["doc_id"].dataType.simpleString() == "bigint"
    assert {r.doc_id: r.conteudo for r in got.collect()} == {r.doc_id: r.t for r in docs.select("doc_id", xml_tree("conteudo").alias("t")).collect()}
    assert json.loads(_tree_json(ODD[0])) == {"a": {"b": ["1", None], "c": {"#text": "x", "@k": "v"}}}
    assert [_tree_json(x) for x in ("<a><b></a>", "<a><b>&nope;</b></a>", "<a:b><c>1</c></a:b>", "<a><b>1</b></a><c/>", "", None)] == [None] * 6


def test_plain_invoices_are_all_read_in_batches(spark):
    from lakefold.plans.layers import Layers
    docs = Layers(spark, SF).invoice_docs
    assert all(_tree_json(r.conteudo) for r in docs.limit(300).collect())
    plan = xml_to_json(docs.withColumn("_n", F.lit(1)))._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan
