"""Delimited and JSON-lines files; the name decides separator and compression."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from deskmatch.sources.cleaning import as_json_lines


def separator_for(path: str) -> str:
    return "\t" if path.endswith((".tsv", ".tsv.gz")) else ","


def compression_for(path: str) -> str:
    return "gzip" if path.endswith(".gz") else "none"


def read_delimited(
    spark: SparkSession, path: str, schema: StructType | None = None, multi_line: bool = False
) -> DataFrame:
    """``multi_line`` is for files with line breaks inside quotes; such files cannot be split over tasks."""
    reader = spark.read.option("header", True).option("sep", separator_for(path)).option("multiLine", multi_line)
    reader = reader.option("escape", '"')
    return (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)


def write_delimited(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    writer = df.write.mode(mode).option("header", True).option("sep", separator_for(path)).option("escape", '"')
    writer.option("compression", compression_for(path)).csv(path)


def read_json_lines(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Without a schema the types are inferred; quoted values stay text."""
    return (spark.read.schema(schema) if schema else spark.read).json(path)


def inferred_schema(spark: SparkSession, path: str) -> StructType:
    return spark.read.json(path).schema


def write_json_lines(df: DataFrame, path: str, mode: str = "errorifexists", compression: str = "gzip") -> None:
    as_json_lines(df).write.mode(mode).option("compression", compression).text(path)
