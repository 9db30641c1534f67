"""Schema merge for appends: existing fields win, names compare without case, structs merge inside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructField, StructType


def merge_types(old: DataType, new: DataType) -> DataType:
    if isinstance(old, StructType) and isinstance(new, StructType):
        return merge_schemas(old, new)
    if isinstance(old, ArrayType) and isinstance(new, ArrayType):
        return ArrayType(merge_types(old.elementType, new.elementType), True)
    return old


def merge_schemas(old: StructType, new: StructType, nested: bool = True) -> StructType:
    """All fields of ``old`` in place, then the new ones; ``nested`` also merges inside structs."""
    arriving = {f.name.lower(): f for f in new.fields}
    fields = []
    for field in old.fields:
        other = arriving.pop(field.name.lower(), None)
        kind = merge_types(field.dataType, other.dataType) if other is not None and nested else field.dataType
        fields.append(StructField(field.name, kind, True))
    fields.extend(StructField(f.name, f.dataType, True) for f in arriving.values())
    return StructType(fields)


def _fitted(value: Column, have: DataType, want: DataType) -> Column:
    if isinstance(want, StructType) and isinstance(have, StructType):
        present = {f.name.lower(): f for f in have.fields}
        parts = []
        for field in want.fields:
            source = present.get(field.name.lower())
            part = F.lit(None) if source is None else _fitted(value[source.name], source.dataType, field.dataType)
            parts.append(part.cast(field.dataType).alias(field.name))
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(want, ArrayType) and isinstance(have, ArrayType) and have.elementType != want.elementType:
        return F.transform(value, lambda x: _fitted(x, have.elementType, want.elementType))
    return value if have == want else value.cast(want)


def align_to(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns and nested fields of ``schema``, in its order and types; missing ones are null."""
    present = {f.name.lower(): f for f in df.schema.fields}
    columns = []
    for field in schema.fields:
        source = present.get(field.name.lower())
        value = F.lit(None).cast(field.dataType)
        if source is not None:
            value = _fitted(df[source.name], source.dataType, field.dataType)
        columns.append(value.alias(field.name))
    return df.select(*columns)


def append_parquet(df: DataFrame, path: str, schema: StructType | None) -> StructType:
    """Append to a folder whose schema so far is ``schema``; returns the schema to read it with."""
    wanted = df.schema if schema is None else merge_schemas(schema, df.schema)
    align_to(df, wanted).write.mode("append").parquet(path)
    return wanted


def read_merged(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)
