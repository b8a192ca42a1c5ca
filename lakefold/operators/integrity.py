"""Declared-but-unenforced keys, re-aimed as checks that return the violations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def primary_key_violations(df: DataFrame, key: str, table: str) -> DataFrame:
    """Key values that occur more than once or are NULL, with their row counts."""
    return (df.groupBy(F.col(key).alias("key_value"))
              .agg(F.count(F.lit(1)).alias("n_rows"))
              .where((F.col("n_rows") > 1) | F.col("key_value").isNull())
              .select(F.lit(table).alias("table_name"), F.lit(key).alias("key_column"),
                      "key_value", "n_rows"))


def foreign_key_orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str,
                        relation: str) -> DataFrame:
    """Child key values with no parent (a NULL foreign key is not an orphan).

    The child is pre-aggregated per key before the anti-join, so each side
    shuffles at most one row per key value and map-side combine absorbs hot keys.
    """
    child_keys = (child.where(F.col(fk).isNotNull())
                       .groupBy(F.col(fk).alias("key_value"))
                       .agg(F.count(F.lit(1)).alias("n_rows")))
    parent_keys = parent.select(F.col(pk).alias("key_value")).distinct()
    return (child_keys.join(parent_keys, "key_value", "left_anti")
                      .select(F.lit(relation).alias("relation"), "key_value", "n_rows"))


def duplicate_excess(key) -> Column:
    """COUNT(*) - COUNT(DISTINCT key): NULL keys count as duplicates."""
    k = F.col(key) if isinstance(key, str) else key
    return F.count(F.lit(1)) - F.count_distinct(k)
