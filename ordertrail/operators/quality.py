"""Checks and filters that stand for the constraints of the star tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import text_literal
from ..schemas import NOT_NULL, PRIMARY_KEY
from ..session import stored
from .members import keep_members

# (column of the fact, dimension, whether NULL is allowed); the dimension has a column of the same name
Reference = tuple[str, DataFrame, bool]


def fk_marks(fact: DataFrame, refs: Sequence[Reference], unique: bool = False) -> tuple[DataFrame, dict[str, Column]]:
    """The fact next to the keys it refers to, and per reference whether it dangles: it has no such key, or is NULL where
    that is not allowed.

    One left join per reference. The keys are written once, so that Catalyst broadcasts them if they are small, and else
    adaptive execution splits a key, or the NULLs, that many rows hold. With ``unique`` the dimensions are tables whose
    keys are known to be different, and are joined as they are.
    """
    marked, marks = fact, {}
    for key, dim, nullable in refs:
        keys = dim.select(F.col(key).alias(f"_key_{key}"))
        if not unique:
            keys = stored(keys.where(keys[f"_key_{key}"].isNotNull()).distinct(), f"keys-{key}")
        marked = marked.join(keys, F.col(key) == F.col(f"_key_{key}"), "left")
        dangles = F.col(f"_key_{key}").isNull()
        marks[key] = dangles & F.col(key).isNotNull() if nullable else dangles
    return marked, marks


def _reasons(marks: Mapping[str, Column]) -> list[Column]:
    """Rows per reason, and in total: one with two dangling references counts for both but once in the total."""
    total = reduce(Column.__or__, marks.values(), F.lit(False))
    return [F.count_if(mark).alias(name) for name, mark in [*marks.items(), ("any", total)]]


def fk_drop(fact: DataFrame, refs: Sequence[Reference], lost: Observation, unique: bool = False) -> DataFrame:
    """What ``fk_filter`` keeps; ``lost`` has the counts of ``fk_report`` once the result was computed, in the same pass."""
    marked, marks = fk_marks(fact, refs, unique)
    dropped = reduce(Column.__or__, marks.values(), F.lit(False))
    return marked.observe(lost, *_reasons(marks)).where(~dropped).select(fact.columns)


def fk_filter(fact: DataFrame, refs: Sequence[Reference]) -> DataFrame:
    """Keep the fact rows whose every reference exists in its dimension, or is NULL where allowed.

    A semi join per reference, which repeated keys of a dimension do not multiply: nothing is written for it.
    """
    for key, dim, nullable in refs:
        fact = keep_members(fact, key, dim, allow_null=nullable)
    return fact


def fk_report(fact: DataFrame, refs: Sequence[Reference]) -> DataFrame:
    """Fact rows that ``fk_filter`` drops, per reference and in total: (reason, dropped_rows).

    One pass over the referring columns counts all reasons.
    """
    marked, marks = fk_marks(fact.select(*dict.fromkeys(key for key, _, _ in refs)), refs)
    counts = marked.agg(*_reasons(marks))
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("reason"), F.col(name).alias("dropped_rows")) for name in counts.columns])))


def null_key_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number of NULLs per column, as one wide row."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns])


def pk_check(df: DataFrame, key: str) -> DataFrame:
    """Key values held by more than one row; empty if the key is unique."""
    return df.groupBy(key).agg(F.count("*").alias("copies")).filter("copies > 1")


def notnull_check(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a NULL in a column that must have a value."""
    return df.filter(reduce(Column.__or__, [F.col(c).isNull() for c in columns]))


def constraint_report(tables: Mapping[str, DataFrame], keys: Mapping[str, str] = PRIMARY_KEY,
                      required: Mapping[str, Sequence[str]] = NOT_NULL) -> DataFrame:
    """Violations per table and constraint: key values that repeat, and rows that lack a required value."""
    parts = []
    for name, df in tables.items():
        checks = {f"unique {keys[name]}": pk_check(df, keys[name])}
        checks |= {f"not null {c}": notnull_check(df.select(c), [c]) for c in required[name]}
        parts += [bad.agg(F.count("*").alias("violations")).selectExpr(
            f"{text_literal(name)} AS table_name", f"{text_literal(what)} AS constraint", "violations")
            for what, bad in checks.items()]
    return reduce(DataFrame.unionByName, parts)


def _width(kind: str) -> int | None:
    return int(kind[kind.index("(") + 1:-1]) if kind.startswith(("varchar(", "char(")) else None


def _violations(df: DataFrame, kinds: Mapping[str, str]) -> Column:
    """Names of the columns whose value does not fit the stated type."""
    tests = []
    for col, kind in kinds.items():
        width = _width(kind)
        value = F.col(col)
        bad = F.length(value.cast("string")) > width if width else value.isNotNull() & value.try_cast(kind).isNull()
        tests.append(F.when(bad, F.lit(col)))
    return F.array_compact(F.array(*tests))


def type_conform(df: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """Cast to the stated types, strictly: text that is too long or a number that does not fit is an
    error, and decimals are rounded to their places."""
    out = []
    for col, kind in kinds.items():
        width = _width(kind)
        if width:
            text = F.col(col).cast("string")
            too_long = F.raise_error(F.concat(F.lit(f"{col}: longer than {width}: "), text)).cast("string")
            out.append(F.when(F.length(text) > width, too_long).otherwise(text).alias(col))
        else:
            # the same whether or not the session casts strictly
            value, cast = F.col(col), F.col(col).try_cast(kind)
            misfit = F.raise_error(F.concat(F.lit(f"{col}: no {kind}: "), value.cast("string"))).cast(kind)
            out.append(F.when(value.isNotNull() & cast.isNull(), misfit).otherwise(cast).alias(col))
    return df.select(*out)


def type_quarantine(df: DataFrame, kinds: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """Lenient form: (rows that fit, cast to the stated types; rows that do not, untouched, with the
    offending columns in ``violations``)."""
    checked = df.withColumn("violations", _violations(df, kinds))
    fits = F.size("violations") == 0
    good = checked.filter(fits).select(
        *[F.col(c).cast("string" if _width(k) else k).alias(c) for c, k in kinds.items()])
    return good, checked.filter(~fits)
