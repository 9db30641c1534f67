"""Append-only tables: every write is a folder of its own, and a log says which folders make up a version.

A write counts from the moment its log entry is there, a single file that Spark's committer moves into place.
What a job that was lost before that has written is never read, and no old file is ever touched, also where a
write brings new columns or new fields inside old ones: files without them read as null.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from deskmatch.sources.evolve import align_to, merge_schemas

_REPLACE, _APPEND, _MERGE = "replace", "append", "merge"
_LOG = "version long, id string, action string, folder string, rows long, keys array<string>, schema string"
#: merged layers after which the next merge writes the table in one piece
MOST_LAYERS = 8


@dataclass(frozen=True)
class VersionedTable:
    """A table below ``folder``, which all executors share."""

    spark: SparkSession
    folder: str

    def log(self) -> list[Row]:
        """One entry per version, oldest first. Of two writers of one version the one with the smaller id holds."""
        try:
            entries = self.spark.read.schema(_LOG).json(f"{self.folder}/log").collect()  # one row per write
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            entries = []
        held: dict[int, Row] = {}
        for entry in sorted(entries, key=lambda e: (e.version, e.id)):
            held.setdefault(entry.version, entry)
        return list(held.values())

    def exists(self) -> bool:
        return bool(self.log())

    def version(self) -> int:
        """Of the newest version; 0 before the first write."""
        return max((entry.version for entry in self.log()), default=0)

    def _layers(self, version: int | None) -> list[Row]:
        entries = [e for e in self.log() if version is None or e.version <= version]
        starts = [k for k, entry in enumerate(entries) if entry.action == _REPLACE]
        return entries[starts[-1] if starts else 0 :]

    def schema(self, version: int | None = None) -> StructType:
        layers = self._layers(version)
        if not layers:
            raise LookupError(f"no table at {self.folder}")
        return StructType.fromJson(json.loads(layers[-1].schema))

    def read(self, version: int | None = None) -> DataFrame:
        """The newest version, or an older one."""
        schema, layers = self.schema(version), self._layers(version)
        rows, plain = None, []
        for layer in layers:
            if layer.action == _MERGE:
                rows, plain = self._files(rows, plain, schema), []
                new = self._files(None, [layer.folder], schema)
                same = reduce(lambda a, b: a & b, [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in layer["keys"]])
                rows = rows.alias("a").join(new.select(*layer["keys"]).distinct().alias("b"), same, "left_anti").unionByName(new)
            else:
                plain.append(layer.folder)
        return self._files(rows, plain, schema)

    def since(self, version: int) -> DataFrame:
        """Rows of the appends after a version; no file of an older one is read."""
        folders = [e.folder for e in self._layers(None) if e.version > version and e.action != _MERGE]
        return self._files(None, folders, self.schema())

    def _files(self, rows: DataFrame | None, folders: Sequence[str], schema: StructType) -> DataFrame:
        paths = [f"{self.folder}/data/{name}" for name in folders]
        if not paths and rows is not None:
            return rows
        new = self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)
        return new if rows is None else rows.unionByName(new)

    def replace(self, df: DataFrame) -> int:
        """A version of these rows alone; older versions stay readable."""
        return self._write(df, _REPLACE, _nullable(df.schema), ())

    def append(self, df: DataFrame) -> int:
        """Adds rows, new columns and new nested fields; existing definitions hold. No rows make no version."""
        if not self.exists():
            return self.replace(df)
        wanted = merge_schemas(self.schema(), df.schema)
        return self._write(align_to(df, wanted), _APPEND, wanted, ())

    def merge(self, df: DataFrame, keys: Sequence[str]) -> int:
        """Replaces the rows of all keys that occur in ``df``, null keys included; all others stay where they are."""
        layers = self._layers(None)
        if not layers:
            return self.replace(df)
        wanted = merge_schemas(self.schema(), df.schema)
        rows = self._write(align_to(df, wanted), _MERGE, wanted, keys)
        if sum(layer.action == _MERGE for layer in layers) >= MOST_LAYERS:
            self.replace(self.read())
        return rows

    def _write(self, df: DataFrame, action: str, schema: StructType, keys: Sequence[str]) -> int:
        name, counted = uuid.uuid4().hex, Observation()
        df.observe(counted, F.count(F.lit(1)).alias("rows")).write.parquet(f"{self.folder}/data/{name}")
        rows = counted.get["rows"]
        if rows or action == _REPLACE:
            self._commit(action, name, rows, schema, keys)
        return rows

    def _commit(self, action: str, name: str, rows: int, schema: StructType, keys: Sequence[str]) -> None:
        while True:
            version = self.version() + 1
            if action != _REPLACE and version > 1:  # another writer may have brought fields meanwhile
                schema = merge_schemas(self.schema(), schema)
            # ids grow with time: a writer that comes later does not take the version of one that has already returned
            mark = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
            entry = [(version, mark, action, name, rows, list(keys), schema.json())]
            self.spark.createDataFrame(entry, _LOG).coalesce(1).write.mode("append").json(f"{self.folder}/log")
            if any(e.folder == name for e in self.log()):
                return


def _nullable(schema: StructType) -> StructType:
    return merge_schemas(schema, StructType([]))
