"""Building blocks that keep plans safe when one key holds a large share of the rows."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

CHECKPOINT_SETTING = "spark.checkpoint.dir"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# rows of one key that one task takes; a key with more is hot and spread over as many tasks as it needs
ROWS_PER_TASK = 1_000_000
# hot keys that are broadcast at most: some ten megabytes
MOST_HOT_KEYS = 100_000


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new folder name below the shared folder that the session names; it is required and never set here."""
    root = spark.conf.get(CHECKPOINT_SETTING, None)
    if not root:
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder shared by the driver and all executors")
    app = spark.sparkContext.applicationId
    return f"{root.rstrip('/')}/deskmatch/{app}/{label}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a write in here go when the write has ended, not when the driver happens to collect its garbage:
    jobs of many steps hold the files of one step at a time."""
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write once, read back: cuts lineage, survives lost executors, and gives the optimizer real sizes."""
    path = scratch_folder(df.sparkSession, label)
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hot_keys(sizes: DataFrame, key: str, size: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """From one row per key with its row count: the hot keys and the number of salts for each.

    There are at most (all rows / ``rows_per_task``) hot keys, one per million rows by default.
    """
    salts = F.ceil(F.col(size) / F.lit(rows_per_task)).cast("int")
    return sizes.filter(F.col(size) > rows_per_task).select(key, salts.alias("salts"))


def salted_join(
    large: DataFrame, small: DataFrame, hot: DataFrame, key: str, spread_by: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Equi-join on ``key`` where hot keys of ``large`` are spread over several tasks.

    Rows of ``large`` take a salt from ``spread_by``; the matching rows of ``small`` are repeated
    once per salt. ``hot`` comes from :func:`hot_keys` and is stored and counted first: none makes a plain join, up
    to ``MOST_HOT_KEYS`` are broadcast, so that no task gets all rows of a key before they are salted. With more, a
    key has a small share of the rows, and Spark's own split of large partitions does for the join with the list.
    """
    hot = materialise(hot.select(F.col(key), F.col("salts").alias("_salts")), "hot-keys")
    known = hot.limit(MOST_HOT_KEYS + 1).count()
    if not known:
        return large.join(small, key, how)
    hot = F.broadcast(hot) if known <= MOST_HOT_KEYS else hot
    salt = F.when(F.col("_salts") > 1, F.pmod(F.xxhash64(*spread_by), F.col("_salts")).cast("int")).otherwise(0)
    left = large.join(hot, key, "left").withColumn("_salt", salt).drop("_salts")
    last = F.coalesce(F.col("_salts"), F.lit(1)) - 1
    right = small.join(hot, key, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), last))).drop("_salts")
    return left.join(right, [key, "_salt"], how).drop("_salt")


def spread_nulls(key: Column, *by: str) -> Column:
    """A string join key whose null values land in different partitions and match nothing."""
    return F.coalesce(key, F.concat(F.lit("\u0000"), F.xxhash64(*by).cast("string")))


def number_rows(df: DataFrame, key: str) -> DataFrame:
    """Distinct keys with their position (from 0) in ascending order, without a single-task window.

    The keys are range partitioned once and stored; positions are the position inside the
    partition plus the number of rows in the partitions before it.
    """
    stored = materialise(
        df.select(key).distinct().repartitionByRange(F.col(key)).withColumn("_part", F.spark_partition_id()),
        "numbered",
    )
    sizes = stored.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    # one row per partition, so this ordered sum and its broadcast are bounded by the partition count
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_part").orderBy(key)
    return (
        stored.withColumn("_rank", F.row_number().over(inside))
        .join(F.broadcast(offsets), "_part")
        .select(key, (F.col("_offset") + F.col("_rank") - 1).alias("position"))
    )
