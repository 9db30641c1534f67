"""Semi-joins, anti-joins and ordered picks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_members(df: DataFrame, column: str, members: DataFrame, member_column: str | None = None) -> DataFrame:
    """Rows whose value is not listed; a null value is never listed, so it stays."""
    ids = members.select(F.col(member_column or column).alias(column)).distinct()
    return df.join(ids, column, "left_anti")


def keep_known_names(df: DataFrame, names: DataFrame, column: str = "name") -> DataFrame:
    """Membership by display name, where a missing name reads as the empty text."""
    listed = names.select(F.coalesce(F.col(column), F.lit("")).alias("_name")).distinct()
    return df.join(listed, F.coalesce(df[column], F.lit("")) == F.col("_name"), "left_semi")


def not_in(df: DataFrame, column: str, listed: DataFrame, listed_column: str) -> DataFrame:
    """SQL ``NOT IN``: one null in the list empties the result, an empty list keeps every row.

    The null rule is a one-row scalar subquery and the rest a plain anti-join, so the list never
    has to be broadcast as Spark's own null-aware anti-join requires.
    """
    ids = listed.select(F.col(listed_column).alias(column))
    is_empty = ids.agg(F.count(F.lit(1)) == 0).scalar()
    has_null = ids.agg(F.count(F.when(F.col(column).isNull(), 1)) > 0).scalar()
    kept = df.join(ids.filter(F.col(column).isNotNull()).distinct(), column, "left_anti")
    return kept.filter(is_empty | (F.col(column).isNotNull() & ~has_null))


def drop_own(df: DataFrame, authors: str, person: str) -> DataFrame:
    """Drop rows whose person is one of the row's authors; a null person is kept."""
    listed = F.array_contains(F.coalesce(F.col(authors), F.array().cast("array<string>")), F.col(person))
    return df.filter(~F.coalesce(listed, F.lit(False)))


def pick_in_order(df: DataFrame, keys: Sequence[str], ids: str, details: DataFrame, id_column: str) -> DataFrame:
    """One row per listed id that has details, with its position; repeats in the list are kept."""
    listed = df.select(*keys, F.posexplode(ids).alias("position", id_column))
    return listed.join(details, id_column)
