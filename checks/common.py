"""Shared readers of the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as manuscripts: the source is the editor, the space-separated words are the keywords."""
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.col("source").alias("name"),
        F.concat(F.lit("p-"), "source").alias("person_id"),
        F.split("text", " ").alias("keywords"),
        "lang",
    )


def rounded(column: str, digits: int = 6):
    return F.round(F.col(column).cast("double"), digits).alias(column)
