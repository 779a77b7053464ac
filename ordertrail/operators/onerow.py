"""Values of the whole table next to every row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ident


def with_totals(df: DataFrame, *totals: Column) -> DataFrame:
    """Add global aggregates to every row; the broadcast side is exactly one row."""
    return df.crossJoin(F.broadcast(df.agg(*totals)))


def with_overall_max(grouped: DataFrame, column: str, name: str) -> DataFrame:
    """Add the maximum of ``column`` over a grouped table.

    The maximum is taken of a struct that starts with ``column`` and holds all others. Both uses of
    ``grouped`` then need the same columns, so Spark runs its shuffle once and reads it twice.
    """
    others = [ident(c) for c in grouped.columns if c != column]
    first = ident(column)
    top = F.expr(f"max(CASE WHEN {first} IS NOT NULL THEN struct({', '.join([first, *others])}) END).{first}")
    return grouped.crossJoin(F.broadcast(grouped.agg(top.alias(name))))
