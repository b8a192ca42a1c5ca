"""Deterministic keys and hash buckets.

Generated keys are SHA-256 over a source identity instead of random UUIDs, so a
re-run (or a retried task after a lost executor) yields the same keys.  The
bucket hash uses the first 32 bits of MD5 so that a plain SQL engine can
recompute it exactly.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakefold.functions.text import _c


def surrogate_key(*parts) -> Column:
    return F.sha2(F.concat_ws("|", *[_c(p).cast("string") for p in parts]), 256)


def hash32(*parts) -> Column:
    """Unsigned 32-bit hash of the parts (first eight hex digits of MD5)."""
    text = F.concat_ws("|", *[_c(p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def hash_bucket(n_buckets, *parts) -> Column:
    return F.pmod(hash32(*parts), _c(n_buckets) if not isinstance(n_buckets, int) else F.lit(n_buckets))
