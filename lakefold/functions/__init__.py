"""Scalar column expressions (all built-in, JVM-side, codegen-friendly)."""

from lakefold.functions.text import (  # noqa: F401
    clean_ip, digits_only, lower_trim, strip_ws, title_case, upper_trim,
)
from lakefold.functions.parsing import (  # noqa: F401
    period_kind, period_number, period_year, safe_date, safe_double, safe_long, safe_timestamp,
    strict_date, strict_double, strict_long,
)
from lakefold.functions.keys import hash_bucket, surrogate_key  # noqa: F401
from lakefold.functions.json import json_field  # noqa: F401
