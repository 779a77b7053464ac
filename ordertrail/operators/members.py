"""Semi join that keeps working when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_members(df: DataFrame, key: str, members: DataFrame, allow_null: bool = False) -> DataFrame:
    """Rows of ``df`` whose ``key`` occurs in the column of the same name in ``members``.

    Keys are compared NULL-safe, and with ``allow_null`` one NULL row joins the members. That keeps the
    join a hash or sort-merge semi join; an ``OR IS NULL`` in the condition would make it a nested loop.
    It also gives both sides a shuffle of the join's own, whatever partitioning they come with, which is
    what adaptive execution needs to split a key that holds many rows.
    """
    return df.join(member_keys(members, key, allow_null), F.col(key).eqNullSafe(F.col("_member")), "left_semi")


def member_keys(members: DataFrame, key: str, allow_null: bool) -> DataFrame:
    """The values of ``key`` as ``_member``; with ``allow_null`` NULL is one of them, else it is none."""
    keys = members.select(F.col(key).alias("_member")).filter("_member IS NOT NULL")
    if allow_null:
        absent = members.sparkSession.range(1).select(F.lit(None).cast(keys.schema["_member"].dataType).alias("_member"))
        keys = keys.unionByName(absent)
    return keys
