"""Serving: limited, allow-listed reads of the gold views, and rows as JSON."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_LIMIT = 100
MAX_LIMIT = 1000


class ViewNotFound(KeyError):
    pass


def read_view(views: Mapping[str, Callable[[], DataFrame]], name: str, limit: int = DEFAULT_LIMIT,
              order_by: tuple[str, ...] = ()) -> DataFrame:
    """``SELECT * FROM view LIMIT n`` for an allow-listed view.

    The name is lower-cased; the limit must be within 1..1000.  The reference
    leaves row order undefined; ``order_by`` makes the returned rows stable
    (Spark plans it as a top-k, not a full sort).
    """
    if not isinstance(limit, int) or isinstance(limit, bool) or not 1 <= limit <= MAX_LIMIT:
        raise ValueError(f"limit must be an integer between 1 and {MAX_LIMIT}")
    key = name.lower()
    if key not in views:
        raise ViewNotFound(f"view '{key}' is not available")
    df = views[key]()
    if order_by:
        df = df.orderBy(*order_by)
    return df.limit(limit)


def list_views(views: Mapping[str, object]) -> list[str]:
    return sorted(views)


def _json_number(c) -> Column:
    """A decimal as a JSON number: integral values as integers, others as floats
    (a VARIANT keeps the per-value choice inside one column)."""
    text = F.when(c == F.floor(c), c.cast("decimal(38,0)").cast("string")).otherwise(c.cast("double").cast("string"))
    return F.parse_json(text)


def _coerced(c: Column, dtype) -> Column:
    """``c`` with every decimal inside it (at any depth) turned into a JSON number."""
    from pyspark.sql.types import ArrayType, DecimalType, MapType, StructType, TimestampNTZType, TimestampType
    if isinstance(dtype, (TimestampType, TimestampNTZType)):  # ISO text, with a fraction only where there is one
        whole = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
        return F.when(F.extract(F.lit("SECOND"), c) == F.second(c), whole).otherwise(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    if isinstance(dtype, DecimalType):
        return _json_number(c)
    if isinstance(dtype, StructType):
        return F.when(c.isNull(), F.lit(None)).otherwise(
            F.struct(*[_coerced(c[f.name], f.dataType).alias(f.name) for f in dtype.fields]))
    if isinstance(dtype, ArrayType):
        return F.transform(c, lambda x: _coerced(x, dtype.elementType))
    if isinstance(dtype, MapType):
        return F.transform_values(c, lambda _, v: _coerced(v, dtype.valueType))
    return c


def rows_as_json(df: DataFrame) -> DataFrame:
    """One JSON object per row; dates as ISO text; decimals as numbers, integral
    ones as integers (``3``), others as floats (``3.5``), also inside nested
    structs, arrays and maps."""
    cols = [_coerced(F.col(f.name), f.dataType).alias(f.name) for f in df.schema.fields]
    return df.select(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias("json"))
