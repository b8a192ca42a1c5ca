"""Text standardisation.

Trimming strips any whitespace (tabs and newlines too), not only blanks, and
title case starts a new word after every character that is neither a letter
nor a digit, so ``CENTRO-OESTE`` becomes ``Centro-Oeste``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakefold.fixed import IP_DROP_PATTERN

_EDGE_WS = r"^\s+|\s+$"
# A run of word characters or a run of separators; concatenating the runs
# gives back the input, so title-casing each run is safe.
_RUNS = r"[\p{L}\p{N}]+|[^\p{L}\p{N}]+"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_ws(col) -> Column:
    return F.regexp_replace(_c(col), _EDGE_WS, "")


def upper_trim(col) -> Column:
    return F.upper(strip_ws(col))


def lower_trim(col) -> Column:
    return F.lower(strip_ws(col))


def title_case(col) -> Column:
    """Upper-case the first letter of every word, lower-case the rest."""
    runs = F.regexp_extract_all(_c(col), F.lit(_RUNS), 0)
    return F.when(_c(col).isNull(), F.lit(None).cast("string")).otherwise(
        F.array_join(F.transform(runs, lambda r: F.initcap(r)), ""))


def digits_only(col) -> Column:
    return F.regexp_replace(_c(col), r"\D", "")


def clean_ip(col) -> Column:
    """Keep digits, dots and backslashes; a missing address becomes ''.

    The character class matches the reference's, which escapes a backslash and
    therefore also keeps it.  Letters and colons (IPv6) are dropped.
    """
    return F.regexp_replace(F.coalesce(_c(col), F.lit("")), IP_DROP_PATTERN, "")
