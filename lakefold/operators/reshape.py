"""Unpivot fixed columns into (name, value) rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unpivot_columns(df: DataFrame, ids: Sequence[str], columns: dict[str, str],
                    name_col: str, value_col: str, drop_nulls: bool = True) -> DataFrame:
    """One row per (id, listed column); ``columns`` maps output name -> source column.

    A single ``explode`` over an inline array: no shuffle, stays in codegen.
    """
    pairs = F.array(*[F.struct(F.lit(label).alias(name_col), F.col(src).alias(value_col))
                      for label, src in columns.items()])
    out = df.select(*ids, F.inline(pairs))
    return out.where(F.col(value_col).isNotNull()) if drop_nulls else out
