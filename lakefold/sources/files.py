"""File scans with declared schemas (never inferred)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def scan_csv(spark: SparkSession, path: str, schema: StructType | str, sep: str = ",",
             null_value: str | None = None) -> DataFrame:
    """Header row, declared schema, no transformation.  Splittable by Spark."""
    reader = spark.read.schema(schema).option("header", True).option("sep", sep) \
        .option("encoding", "UTF-8").option("mode", "FAILFAST")
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    return reader.csv(path)


CORRUPT = "_corrupt"


def scan_delimited(spark: SparkSession, path: str, schema: StructType | str, sep: str = ",") -> DataFrame:
    """All rows of delimited files in one pass: the declared columns, and the text of the line in ``_corrupt``
    for a row that does not fit them (too few or too many fields, or a value of another type)."""
    st = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return (spark.read.schema(StructType([*st.fields, StructField(CORRUPT, StringType())])).option("header", True).option("sep", sep)
            .option("encoding", "UTF-8").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
            .option("columnPruning", False).csv(path))  # else a query on some columns would not see that fields are missing


def accepted(rows: DataFrame) -> DataFrame:
    """The rows of ``scan_delimited`` that fit the declared columns."""
    return rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def rejected(rows: DataFrame, sep: str = ",") -> DataFrame:
    """The others: ``line`` and ``reason`` (``short``, ``long`` or ``ill_typed``)."""
    unquoted = F.regexp_replace(CORRUPT, r'"(?:[^"\\]|\\.|"")*+"', "")
    n = F.size(F.split(unquoted, re.escape(sep)))
    declared = len(rows.columns) - 1
    reason = F.when(n < declared, F.lit("short")).when(n > declared, F.lit("long")).otherwise(F.lit("ill_typed"))
    # Spark fills the line only in a scan that reads declared columns as well
    read = F.length(F.concat_ws("", *[F.col(c).cast("string") for c in rows.columns if c != CORRUPT])) >= 0
    return rows.where(F.col(CORRUPT).isNotNull() & read).select(F.col(CORRUPT).alias("line"), reason.alias("reason"))


def scan_pipe(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return scan_csv(spark, path, schema, sep="|")


def scan_documents(spark: SparkSession, path: str, by_line: bool = False) -> DataFrame:
    """Documents: ``doc_id``, ``source_file`` and the text in ``conteudo``.

    A file is a document, and its path the id.  ``by_line`` is for files with one
    document in each line, which are split over tasks; the id is then the path
    and the hash of the line, so it does not depend on how files are split.
    """
    df = spark.read.text(path, wholetext=not by_line)
    file = F.col("_metadata.file_path")
    own = F.concat(file, F.lit("|"), F.sha2("value", 256)) if by_line else file
    return df.select(own.alias("doc_id"), file.alias("source_file"), F.col("value").alias("conteudo"))


def scan_xml_records(spark: SparkSession, path: str, row_tag: str, schema: StructType | str) -> DataFrame:
    """One row per ``row_tag`` element across XML files, with a declared schema."""
    df = spark.read.option("rowTag", row_tag).option("mode", "FAILFAST").schema(schema).xml(path)
    return df.select("*", F.col("_metadata.file_path").alias("source_file"))
