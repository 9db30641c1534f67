"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deskmatch.operators.scale import materialise

#: the characters that end a word in all operators that name `[^\x20\x09-\x0D]+`
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Written once to the shared folder and read back, so that a lost executor costs no recomputation."""
    return materialise(df, label)


def id_and_text(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Only the two columns an operator reads; a null text is the empty text."""
    return docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text")
    )


def id_remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the decimal text of an id, modulo ``divisor``; null for a null id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(divisor))


def columns(batches: Iterable[pa.RecordBatch], *names: str) -> Iterator[tuple[list, ...]]:
    """Python lists of the named columns, batch by batch."""
    for batch in batches:
        yield tuple(batch.column(batch.schema.get_field_index(name)).to_pylist() for name in names)


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, learn: Column, per_class: int,
    id_column: str = "doc_id", text_column: str = "text",
) -> tuple[DataFrame, dict[int, int]]:
    """At most ``per_class`` labelled texts of either class as a stored (doc_id, label, text), and all label counts.

    Rows count where ``learn``, a condition on doc_id, holds and the label is 0 or 1; of several label
    rows of a document the highest counts, of several texts the first in order. Documents are taken in the
    order of a hash of their id, so the choice does not depend on where rows are stored.
    """
    by_doc = (
        labels.select(F.col(id_column).cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)).filter(learn)
        .groupBy("doc_id").agg(F.max("label").alias("label"))
    )
    totals = {r["label"]: r["n"] for r in by_doc.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    chosen = [by_doc.filter(F.col("label") == v).orderBy(*order).limit(per_class) for v in (0, 1)]
    # at most twice per_class ids
    ids = F.broadcast(chosen[0].unionByName(chosen[1]))
    texts = id_and_text(docs, id_column, text_column).join(ids, "doc_id")
    return stored(texts.groupBy("doc_id").agg(F.max("label").alias("label"), F.min("text").alias("text")), "sample"), totals
