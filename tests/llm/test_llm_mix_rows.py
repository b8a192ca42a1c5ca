"""The mix of tables whose rows repeat or share an id."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from lakefold.llm import mixing

SMALL = "/root/testdata/sf0.001"


def close(spark, docs):
    rows = mixing.mix(docs).collect()
    assert len(rows) == docs.count()
    assert all(0 <= r.copies <= mixing.MOST and r.taken == r.copies * r["size"] for r in rows)
    want, got, largest = {}, Counter(), Counter()
    for r in rows:
        want[r.source] = r.target
        got[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r["size"])
    for source, target in want.items():
        assert abs(got[source] - target) <= max(1, largest[source]), source
    again = Counter(tuple(r) for r in mixing.mix(docs.repartition(5)).collect())
    assert again == Counter(tuple(r) for r in rows)


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame([(i, " ".join(["w"] * (i % 37 + 1)) + f" {i}", "abc"[i % 3]) for i in range(400)], "doc_id bigint, text string, source string")


def test_rows_three_times(spark, texts):
    close(spark, texts.unionByName(texts).unionByName(texts))


def test_null_ids(spark, texts):
    close(spark, texts.withColumn("doc_id", F.lit(None).cast("bigint")))


def test_one_id_for_all(spark, texts):
    close(spark, texts.withColumn("doc_id", F.lit(7).cast("bigint")))


def test_one_row_very_often(spark, texts):
    close(spark, texts.unionByName(texts.filter("doc_id = 5").crossJoin(spark.range(3000)).drop("id")))


def test_edge_rows(spark, edge):
    close(spark, edge.filter("doc_id IS NULL OR doc_id NOT IN (10, 11)"))


def test_documents_as_before(spark):
    close(spark, spark.read.parquet(f"{SMALL}/documents.parquet"))
