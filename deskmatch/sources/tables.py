"""Named tables: reading, write modes, snapshots, provenance."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from deskmatch.sources.evolve import align_to, merge_schemas
from deskmatch.sources.versions import VersionedTable

LOG = logging.getLogger(__name__)

REPLACE, APPEND, FAIL = "replace", "append", "fail"


@dataclass(frozen=True)
class Tables:
    """Resolves short names: upstream tables of the catalog, and the jobs' own, versioned tables with a prefix below
    ``folder`` (by default one of the warehouse named after ``output_db``)."""

    spark: SparkSession
    source_db: str
    output_db: str
    prefix: str = "desk_"
    folder: str | None = None

    def source_name(self, name: str) -> str:
        return f"{self.source_db}.{name}"

    def own(self, name: str) -> VersionedTable:
        folder = self.folder or f"{self.spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{self.output_db}.versions"
        return VersionedTable(self.spark, f"{folder}/{self.prefix}{name}")

    def source(self, name: str) -> DataFrame:
        return self.spark.table(self.source_name(name))

    def output(self, name: str) -> DataFrame:
        return self.own(name).read()

    def first_existing(self, names: Sequence[str], schema: str) -> DataFrame:
        """First of the jobs' own tables that exists, else an empty frame with the given columns."""
        for name in names:
            if self.own(name).exists():
                return self.output(name)
        return self.spark.createDataFrame([], schema)

    def save(self, df: DataFrame, name: str, mode: str = FAIL) -> int:
        """Rows written; modes as in :func:`save_table`. An append writes its own rows only, also where it brings new
        nested fields, and one without rows changes nothing."""
        if mode not in (REPLACE, APPEND, FAIL):
            raise ValueError(f"unknown write mode: {mode}")
        table = self.own(name)
        if mode == FAIL and table.exists() and not table.read().isEmpty():
            raise ValueError(f"table is not empty: {name}")
        started = time.monotonic()
        rows = table.append(df) if mode == APPEND else table.replace(df)
        LOG.info("wrote %d rows to %s in %.1f seconds", rows, name, time.monotonic() - started)
        return rows

    def snapshot(self, df: DataFrame, name: str) -> DataFrame:
        """Temporary view ``v_name`` and its stored copy ``mv_name``."""
        df.createOrReplaceTempView(f"v_{self.prefix}{name}")
        self.save(df, f"mv_{name}", REPLACE)
        return self.output(f"mv_{name}")

    def refreshed_snapshot(
        self, name: str, newest: Callable[[DataFrame], DataFrame], keys: Sequence[str]
    ) -> DataFrame:
        """The stored copy ``mv_name`` of the newest rows of ``name``, brought up to date.

        ``newest`` picks the rows that hold, one or more per key. Only imports after the last refresh are read, and
        only their keys are replaced; all other rows stay in the files they are in.
        """
        table, copy, marks = self.own(name), self.own(f"mv_{name}"), self.own(f"mv_{name}_refreshed")
        version = table.version()
        replaced = max((e.version for e in table.log() if e.action != APPEND), default=0)
        done = marks.read().agg(F.max("version")).first()[0] if marks.exists() else None
        if done is None or done < replaced:
            copy.replace(newest(table.read()))
        elif done < version:
            arrived = table.since(done)
            same = reduce(lambda a, b: a & b, [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys])
            known = copy.read().alias("a").join(arrived.select(*keys).distinct().alias("b"), same, "left_semi")
            copy.merge(newest(arrived.unionByName(known, allowMissingColumns=True)), keys)
        marks.replace(self.spark.createDataFrame([(version,)], "version long"))
        return copy.read()


def limited(df: DataFrame, limit: int | None, *order: str) -> DataFrame:
    """At most ``limit`` rows in the given order; none or 0 keeps all rows."""
    if not limit:
        return df
    return df.orderBy(*(order or df.columns)).limit(limit)


def with_provenance(df: DataFrame, source: str, as_of: Column | None = None) -> DataFrame:
    stamp = F.current_timestamp() if as_of is None else as_of
    return df.withColumn(
        "provenance", F.struct(F.lit(source).alias("source"), stamp.cast("timestamp").alias("imported_timestamp"))
    )


def save_table(df: DataFrame, name: str, mode: str = FAIL) -> int:
    """Write a catalog table and return the number of rows written.

    ``replace`` overwrites, ``append`` adds rows, new columns and new nested fields, ``fail`` writes only when the
    table is missing or empty. The row count is observed during the write.
    """
    if mode not in (REPLACE, APPEND, FAIL):
        raise ValueError(f"unknown write mode: {mode}")
    spark = df.sparkSession
    exists = spark.catalog.tableExists(name)
    if mode == FAIL and exists and not spark.table(name).isEmpty():
        raise ValueError(f"table is not empty: {name}")
    started = time.monotonic()
    counted = Observation()
    observe = lambda frame: frame.observe(counted, F.count(F.lit(1)).alias("rows"))
    if mode == APPEND and exists:
        existing = spark.table(name).schema
        wanted = merge_schemas(existing, df.schema)
        known = {f.name.lower(): f for f in existing.fields}
        if any(f.name.lower() in known and f.dataType != known[f.name.lower()].dataType for f in wanted.fields):
            # a catalog cannot add fields inside a column, so the table is written anew with the merged schema
            # under another name first; the jobs' own tables (Tables.save) need no such copy
            whole = align_to(df, wanted)
            observe(whole).unionByName(align_to(spark.table(name), wanted)).write.mode("overwrite").saveAsTable(f"{name}__new")
            spark.sql(f"DROP TABLE {name}")
            spark.sql(f"ALTER TABLE {name}__new RENAME TO {name}")
        else:
            added = [f for f in wanted.fields if f.name.lower() not in known]
            if added:
                columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
                spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")
            observe(align_to(df, spark.table(name).schema)).write.mode("append").insertInto(name)
    else:
        observe(df).write.mode("overwrite").saveAsTable(name)
    rows = counted.get["rows"]
    LOG.info("wrote %d rows to %s in %.1f seconds", rows, name, time.monotonic() - started)
    return rows
