"""Registered queries: names, columns, and DuckDB where SQL can express the result."""

import re
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline
from lakefold.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = {
    2: {"doc_id": "bigint", "n_chars": "bigint", "edited_sha256": "string", "fingerprint": "string", "edited_fingerprint": "string",
        "near_edited": "double", "near_next": "double"},
    3: {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint",
        "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean"},
    5: {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    6: {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    7: {"page_id": "bigint", "payload_bytes": "bigint", "payload_digest": "string", "record_type": "string", "refers_to": "bigint"},
    8: {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    9: {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"},
    10: {"doc_id": "bigint", "n_assign": "bigint", "n_access": "bigint", "n_hex": "bigint", "base_sha256": "string", "spans": "string"},
    11: {"doc_id": "bigint", "n_runs": "bigint", "start": "bigint", "length": "bigint", "period": "bigint", "exponent_milli": "bigint",
         "runs_sha256": "string", "collapsed_sha256": "string"},
    12: {"conv_id": "bigint", "depth": "bigint", "parent_conv_id": "bigint", "n_convs": "bigint", "n_children": "bigint", "n_leaves": "bigint",
         "saved_tokens": "bigint", "ends_sha256": "string"},
    13: {"doc_id": "bigint", "n_email": "bigint", "n_ip": "bigint", "n_card": "bigint", "n_phone": "bigint", "base_sha256": "string",
         "spans": "string"},
}


def test_one_query_for_each_operator():
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(E.queries())
    assert set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_columns_and_whole_table(spark, name):
    found = QUERIES[name](spark, SF)
    n = int(re.match(r"op(\d+)_", name)[1])
    types = dict(found.dtypes)
    for column, kind in COLUMNS.get(n, {"doc_id": "bigint"}).items():
        assert types[column] == kind
    if n > 1 and n != 12:  # whose rows are nodes
        whole = spark.read.parquet(f"{SF}/{'pages' if n == 7 else 'documents'}.parquet").count()
        assert found.count() == whole


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_duckdb(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    found = QUERIES[name](spark, SF)
    result = con.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    expected = Counter(tuple(r[columns.index(c)] for c in found.columns) for r in result.fetchall())
    assert Counter(tuple(r) for r in found.collect()) == expected


def test_pipeline_keeps_columns_and_ends_in_tokens(spark):
    from lakefold.llm.common import staged
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names, before = docs.columns, docs.count()
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = staged(stage(spark, docs, SF), "test-stage")
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == names
        if k < 3:
            assert 0 < docs.count() <= before
            before = docs.count()
    assert docs.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_pipeline_by_brute_force(spark):
    """Every stage decides as the operators' own results say, on the rows the stage before kept."""
    from lakefold.llm import bpe, jaccard, lines, mixing, quality
    from lakefold.llm.common import staged
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    made = [docs]
    for _, stage in corpus_pipeline.STAGES:
        made.append(staged(stage(spark, made[-1], SF), "test-stage"))
    good = {r.doc_id for r in quality.quality_report(made[0]).filter("kept").collect()}
    assert {r.doc_id for r in made[1].collect()} == good
    left = {r.doc_id: r.n_chars_left for r in lines.line_report(made[1]).collect()}
    assert {r.doc_id: r.n_chars for r in made[2].collect()} == {k: v for k, v in left.items() if v}
    heads = {r.component_id for r in jaccard.near_duplicates(made[2]).collect()}
    assert sorted(r.doc_id for r in made[3].collect()) == sorted(heads)
    copies = {r.doc_id: r.copies for r in mixing.mix(made[3]).collect()}
    assert Counter(r.doc_id for r in made[4].collect()) == Counter(copies)
    assert all(n <= 2 for n in copies.values())
    assert made[5].count() == made[4].count()
    assert made[5].columns == bpe.round_trip(made[4], *_vocabulary()).columns


def _vocabulary():
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
