"""Fixed-size batches of ids and the search text for each batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskmatch.functions.text import author_name
from deskmatch.operators.scale import number_rows

# fixed values: ids per search and the search source
IDS_PER_BATCH = 1000
SOURCE_CLAUSE = 'AND (SRC:"MED")'


def id_batches(ids: DataFrame, column: str, size: int = IDS_PER_BATCH) -> DataFrame:
    """Distinct ids in ascending order, ``size`` per batch: (batch, ids). A list never exceeds ``size``."""
    if size < 1:
        raise ValueError("batch size must be positive")
    numbered = number_rows(ids.filter(F.col(column).isNotNull()), column)
    return (
        numbered.groupBy(F.floor(F.col("position") / size).cast("bigint").alias("batch"))
        .agg(F.array_sort(F.collect_list(column)).alias("ids"))
    )


def _any_of(field: str, values: Column) -> Column:
    quoted = F.transform(values, lambda v: F.concat(F.lit(f'{field}:"'), v.cast("string"), F.lit('"')))
    return F.concat(F.lit("("), F.array_join(quoted, " OR "), F.lit(f") {SOURCE_CLAUSE}"))


def _required(values: Column, text: Column) -> Column:
    return F.when(F.size(values) > 0, text).otherwise(F.raise_error(F.lit("values required")).cast("string"))


def id_search(ids: Column) -> Column:
    """Search text for a list of article ids; an empty list is an error."""
    return _required(ids, _any_of("EXT_ID", ids))


def author_search(names: Column) -> Column:
    """Search text for a list of author names, normalised; an empty list is an error."""
    return _required(names, _any_of("AUTH", F.transform(names, author_name)))
