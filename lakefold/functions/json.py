"""Ad hoc JSON path access (typed ``from_json`` is preferred for documents)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakefold.functions.text import _c


def json_field(col, path: str, type_: str = "string") -> Column:
    """Scalar at ``path``; cast tolerantly to ``type_`` (NULL when absent or invalid)."""
    raw = F.get_json_object(_c(col), path)
    return raw if type_ == "string" else raw.try_cast(type_)
