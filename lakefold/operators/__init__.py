"""Relational building blocks composed from DataFrame operations."""

from lakefold.operators.hot_groups import attach_parts, split_hot_groups  # noqa: F401
from lakefold.operators.integrity import (  # noqa: F401
    duplicate_excess, foreign_key_orphans, primary_key_violations,
)
from lakefold.operators.reshape import unpivot_columns  # noqa: F401
