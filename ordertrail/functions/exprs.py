"""Column expressions shared by the operators. All are JVM-side built-ins.

Arguments named ``text`` (and the like) are SQL expressions, most often just a column name; they are
parsed by Spark in one step. Arguments of type ``ColumnOrName`` may also be columns.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ident(name: str) -> str:
    """A column name as SQL text."""
    return "`" + name.replace("`", "``") + "`"


def text_literal(value: str) -> str:
    """A string value as SQL text."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def parse_ts(text: str) -> Column:
    """Zone-less timestamp; text that is none becomes NULL instead of an error."""
    return F.expr(f"TRY_CAST({text} AS TIMESTAMP_NTZ)")


def whole_days(later: str, earlier: str) -> Column:
    """Whole days from ``earlier`` to ``later``, rounded toward minus infinity.

    Six hours early is -1 and eighteen hours late is 0. The difference is taken as an interval, so
    no time zone enters.
    """
    gap = f"(({later}) - ({earlier}))"
    toward_zero = f"extract(DAY FROM {gap})"
    return F.expr(f"{toward_zero} - CAST({gap} < make_dt_interval({toward_zero}) AS INT)")


def days_before(x: ColumnOrName, days: int) -> Column:
    """The timestamp moved back by ``days`` (forward if negative)."""
    return _c(x) - F.make_dt_interval(F.lit(days))


def date_parts(text: str) -> tuple[Column, Column, Column]:
    """Year, month and day of week with Monday as 0."""
    return F.expr(f"year({text})"), F.expr(f"month({text})"), F.expr(f"weekday({text})")


def year_month(text: str) -> Column:
    """Calendar month of a date or zone-less timestamp as ``yyyy-MM`` text."""
    return F.expr(f"left(CAST({text} AS STRING), 7)")


def moment(text: str) -> Column:
    """A date or time literal in ISO form as a zone-less timestamp. It is passed as text, since a Python
    datetime would be read in the driver's own zone."""
    return F.lit(datetime.fromisoformat(text).isoformat()).cast("timestamp_ntz")


def half_up(x: ColumnOrName, places: int = 2) -> Column:
    """Rounding of the SQL reports: halves go away from zero. Meant for decimals."""
    return F.round(_c(x), places)


def half_even(x: ColumnOrName, places: int = 0) -> Column:
    """Rounding of the customer tables: halves go to the even neighbour."""
    return F.bround(_c(x), places)


def ratio(numerator: ColumnOrName, denominator: ColumnOrName) -> Column:
    """Exact decimal quotient with ten places; NULL where the denominator is 0.

    The two widths are chosen so that Spark keeps ten fractional digits; the natural widths of sums
    would leave six, which is too close to the two-place rounding that follows.
    """
    bottom = F.nullif(_c(denominator).cast("decimal(20,2)"), F.lit(0))
    return _c(numerator).cast("decimal(28,2)") / bottom


def percent(part: ColumnOrName, whole: ColumnOrName) -> Column:
    """``part`` as a percentage of ``whole``, two places, halves away from zero."""
    return half_up(ratio(_c(part) * 100, whole), 2)


def sum_or_zero(text: str) -> Column:
    """Aggregate: sum that is 0 for a group without any value."""
    return F.expr(f"coalesce(sum({text}), 0)")


def first_nonnull(text: str, order_by: Sequence[str]) -> Column:
    """Aggregate: the first non-NULL value in the stated order.

    A distributed table has no row order, so the order is an argument and should be total.
    """
    order = ", ".join(f"{o} AS o{i}" for i, o in enumerate(order_by))
    return F.expr(f"min(CASE WHEN {text} IS NOT NULL THEN struct({order}, {text} AS value) END).value")


def most_frequent(text: str) -> Column:
    """Aggregate: the most frequent non-NULL value, the smallest one on ties, NULL if there is none.

    The buffer holds one counter per distinct value, so this is for closed vocabularies such as a
    payment type or a category.
    """
    return F.expr(f"mode({text}, true)")


def mode_or(text: str, default: str = "unknown") -> Column:
    """Aggregate: ``most_frequent`` with a default for groups that have no value."""
    return F.expr(f"coalesce(mode({text}, true), {text_literal(default)})")
