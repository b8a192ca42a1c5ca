"""Load gates: validations that fail a load instead of passing bad rows on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakefold.functions.parsing import safe_timestamp
from lakefold.functions.text import _c


def strict_timestamp(col, what: str = "log_time") -> Column:
    """Parse to TIMESTAMP_NTZ; a missing or invalid value fails the job.

    The check rides along with the projection (no extra pass over the data):
    the first bad row raises in its task.
    """
    parsed = safe_timestamp(col)
    return F.when(parsed.isNull(), F.raise_error(F.concat(F.lit(f"invalid values in column {what}: "),
                                                         F.coalesce(_c(col), F.lit("NULL"))))
                  ).otherwise(parsed)


def gate_timestamp(df: DataFrame, col: str) -> DataFrame:
    """Replace ``col`` by its TIMESTAMP_NTZ value; any missing or invalid value fails the job.

    The check is a filter, so it runs even when a later projection drops the
    column.
    """
    parsed = safe_timestamp(col)
    checked = df.where(F.when(parsed.isNull(), F.raise_error(F.concat(
        F.lit(f"invalid values in column {col}: "), F.coalesce(F.col(col), F.lit("NULL"))))).otherwise(F.lit(True)))
    return checked.withColumn(col, parsed)
