"""Newest row per key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def latest_per_key(df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column]) -> DataFrame:
    """Keep the first row per key in the given order.

    The rank filter becomes a group limit on both sides of the shuffle, so at most one row per
    key and task is moved and a hot key costs no more than any other.
    """
    order = Window.partitionBy(*keys).orderBy(*newest_first)
    return df.withColumn("_rank", F.row_number().over(order)).filter("_rank = 1").drop("_rank")


def latest_import(df: DataFrame, keys: Sequence[str], *ties: str) -> DataFrame:
    """Newest row by ``provenance.imported_timestamp``; ``ties`` make equal times deterministic."""
    order = [F.desc_nulls_last("provenance.imported_timestamp"), *[F.desc_nulls_last(t) for t in ties]]
    return latest_per_key(df, keys, order)


def newest_import_rows(df: DataFrame, keys: Sequence[str], *ties: str) -> DataFrame:
    """All rows of the newest import of each key: those with its latest time, ties settled by ``ties``.

    An import may have any number of rows. Only its time and ties are compared, one value per key and task; the
    rows themselves stay where they are, so Spark may split a key that has most of them. Null keys are keys.
    """
    mark = F.struct(F.col("provenance.imported_timestamp").alias("_time"), *[F.col(t).alias(f"_tie{i}") for i, t in enumerate(ties)])
    marked = df.withColumn("_mark", mark)
    newest = marked.groupBy(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)]).agg(F.max("_mark").alias("_newest"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)])
    return marked.join(newest, same & F.col("_mark").eqNullSafe(F.col("_newest"))).select(*df.columns)
