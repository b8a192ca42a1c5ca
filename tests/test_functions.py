"""Scalar expressions, one literal row per edge case of the semantics contract."""

import hashlib

import pytest
from pyspark.sql import functions as F

from lakefold.functions import (
    clean_ip, digits_only, hash_bucket, lower_trim, period_kind, period_number, period_year, safe_date, safe_long,
    strict_date, strip_ws, surrogate_key, title_case, upper_trim,
)


def one_col(spark, values, expr):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_title_case_splits_on_punctuation(spark):
    got = one_col(spark, ["CENTRO-OESTE", "  indústria metalúrgica ", "o'brien&sons", "a1b c", "", None],
                  lambda c: title_case(strip_ws(c)))
    assert got == ["Centro-Oeste", "Indústria Metalúrgica", "O'Brien&Sons", "A1b C", "", None]


def test_trim_strips_tabs_and_newlines(spark):
    assert one_col(spark, ["\t abc \n", None], upper_trim) == ["ABC", None]
    assert one_col(spark, ["\tCuiabá  "], lower_trim) == ["cuiabá"]


def test_digits_only(spark):
    assert one_col(spark, ["71.620.270/0001-11", None], digits_only) == ["71620270000111", None]


def test_clean_ip_keeps_digits_dots_and_backslashes(spark):
    got = one_col(spark, ["192.168.0.1", None, "fe80::1", "192.168.x1.5", "10\\0.1"], clean_ip)
    assert got == ["192.168.0.1", "", "801", "192.168.1.5", "10\\0.1"]


@pytest.mark.parametrize("period,year,kind,number", [
    ("2024-09", 2024, "MES", 9),
    ("2024-Q4", 2024, "TRIMESTRE", 4),
    ("2024-S2", 2024, "SEMESTRE", 2),
    ("2024-Q12", 2024, "TRIMESTRE", 1),   # the quarter test is not anchored
    ("2024", 2024, "DESCONHECIDO", None),
    ("abcd-09", None, "MES", 9),
    (None, None, "DESCONHECIDO", None),
])
def test_period_parse(spark, period, year, kind, number):
    df = spark.createDataFrame([(period,)], "p string")
    row = df.select(period_year("p"), period_kind("p"), period_number("p")).first()
    assert tuple(row) == (year, kind, number)


def test_safe_casts_are_tolerant(spark):
    assert one_col(spark, ["40", "40.0", "x", None], safe_long) == [40, None, None, None]
    got = one_col(spark, ["2024-01-05", "2024", "2024-13-45"], safe_date)
    assert [str(d) if d else None for d in got] == ["2024-01-05", None, None]


def test_strict_date_fails_the_job(spark):
    df = spark.createDataFrame([("2024-13-45",)], "x string")
    with pytest.raises(Exception):
        df.select(strict_date("x")).collect()


def test_surrogate_key_is_sha256_of_parts(spark):
    df = spark.createDataFrame([("doc-1", 3)], "d string, p int")
    got = df.select(surrogate_key("d", "p")).first()[0]
    assert got == hashlib.sha256(b"doc-1|3").hexdigest()


def test_hash_bucket_matches_md5_prefix(spark):
    df = spark.createDataFrame([(12, 3, 7)], "a long, b int, n long")
    got = df.select(hash_bucket(F.col("n"), "a", "b")).first()[0]
    want = int(hashlib.md5(b"12|3").hexdigest()[:8], 16) % 7
    assert got == want


def test_safe_timestamp_formats(spark):
    from lakefold.functions import safe_timestamp
    got = one_col(spark, ["2024-01-02 03:04:05.5", "2024-01-02T03:04:05", "2024/1/2 03:04", "01/02/2024 03:04:05",
                          " 2024-01-02 ", "yesterday", None], safe_timestamp)
    assert [str(v) if v else None for v in got] == [
        "2024-01-02 03:04:05.500000", "2024-01-02 03:04:05", "2024-01-02 03:04:00", "2024-01-02 03:04:05",
        "2024-01-02 00:00:00", None, None]
