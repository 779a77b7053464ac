"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import ident


def dedup_first(df: DataFrame, key: str, order_by: Sequence[str] | None = None) -> DataFrame:
    """Keep the first row of every key in the stated order (default: the smallest of the other columns).

    Written as an aggregation, so a key with very many copies is reduced inside each task before
    anything is shuffled. NULL counts as a key of its own.
    """
    rest = [ident(c) for c in df.columns if c != key]
    if not rest:
        return df.distinct()
    # the remaining columns close the order, so that it is total
    ranked = [f"{ident(c)} AS o{i}" for i, c in enumerate(order_by or [])] + rest
    first = df.groupBy(key).agg(F.expr(f"min(struct({', '.join(ranked)}))").alias("_first"))
    return first.selectExpr(*[ident(c) if c == key else f"_first.{ident(c)}" for c in df.columns])
