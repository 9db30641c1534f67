import os

import pytest
from pyspark.sql import functions as F

from deskmatch.operators.latest import latest_import
from deskmatch.sources.tables import APPEND, FAIL, REPLACE, Tables
from deskmatch.sources.versions import MOST_LAYERS, VersionedTable


def files(folder):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(folder) for f in names if f.endswith((".parquet", ".json"))}


def test_appends_write_their_own_rows_only(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    assert not table.exists() and table.version() == 0
    assert table.append(spark.range(1000).select("id", F.struct(F.col("id").alias("x")).alias("s"), F.array(F.struct("id")).alias("a"))) == 1000
    old = files(table.folder)
    wide = spark.range(1000, 1003).select(
        F.col("id").cast("int").alias("ID"), F.struct(F.lit("new").alias("y"), F.col("id").cast("string").alias("X")).alias("s"),
        F.array(F.struct(F.lit(1).alias("more"))).alias("a"), F.lit("z").alias("extra"))
    assert table.append(wide) == 3
    now = files(table.folder)
    assert all(now[f] == old[f] for f in old) and sum(os.path.getsize(f) for f in set(now) - set(old) if f.endswith("parquet")) < 20_000
    rows = {r.id: r for r in table.read().collect()}
    assert len(rows) == 1003 and rows[5].s.asDict() == {"x": 5, "y": None} and rows[1001].s.asDict() == {"x": 1001, "y": "new"}
    assert rows[5].a[0].asDict() == {"id": 5, "more": None} and rows[1001].a[0].asDict() == {"id": None, "more": 1}
    assert rows[5].extra is None and table.read(1).count() == 1000 and table.read(1).columns == ["id", "s", "a"]
    assert table.since(1).count() == 3
    assert table.append(wide.limit(0)) == 0 and table.version() == 2


def test_what_a_lost_job_left_is_never_read(spark, tmp_path, monkeypatch):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.append(spark.range(3))

    def lost(*_):
        raise RuntimeError("driver gone")

    with monkeypatch.context() as patched:
        patched.setattr(VersionedTable, "_commit", lost)
        for write in (table.append, table.replace):
            with pytest.raises(RuntimeError):
                write(spark.range(10))
    assert table.read().count() == 3 and table.append(spark.range(2)) == 2 and table.read().count() == 5


def test_two_writers_of_one_version_both_count(spark, tmp_path, monkeypatch):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.append(spark.range(3))
    first = table.version

    def late(self):  # sees the table as it was before the other writer
        monkeypatch.undo()
        number = first()
        table.append(spark.range(5).select("id", F.lit("b").alias("b")))
        return number

    monkeypatch.setattr(VersionedTable, "version", late)
    assert table.append(spark.range(7)) == 7
    assert table.read().count() == 15 and table.version() == 3 and table.read().columns == ["id", "b"]


def test_merges_replace_keys(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    rows = {k: 0 for k in range(20)} | {None: 0}
    table.replace(spark.createDataFrame(list(rows.items()), "k long, v long"))
    for step in range(1, MOST_LAYERS + 4):
        change = {step: step, None: step, 100 + step: step}
        assert table.merge(spark.createDataFrame(list(change.items()), "k long, v long"), ["k"]) == 3
        rows |= change
        assert dict(map(tuple, table.read().collect())) == rows
    assert sum(e.action == "merge" for e in table._layers(None)) <= MOST_LAYERS


def test_write_modes_of_own_tables(spark, tmp_path):
    tables = Tables(spark, "default", "default", "own_", str(tmp_path))
    one, two = spark.range(1), spark.range(2)
    assert tables.save(one, "t", FAIL) == 1 and tables.save(two, "t", APPEND) == 2 and tables.output("t").count() == 3
    with pytest.raises(ValueError):
        tables.save(one, "t", FAIL)
    with pytest.raises(ValueError):
        tables.save(one, "t", "other")
    assert tables.save(one.limit(0), "t", REPLACE) == 0 and tables.save(one, "t", FAIL) == 1
    assert tables.first_existing(["none", "t"], "x long").count() == 1 and tables.first_existing(["none"], "x long").columns == ["x"]


def test_a_refresh_reads_new_imports_only(spark, tmp_path):
    tables = Tables(spark, "default", "default", "own_", str(tmp_path))
    newest = lambda rows: latest_import(rows, ["person_id"], "v")

    def imports(*rows):
        return spark.createDataFrame(rows, "person_id string, v long, day string").select(
            "person_id", "v", F.struct(F.to_timestamp("day").alias("imported_timestamp")).alias("provenance"))

    tables.save(imports(("a", 1, "2024-01-02"), ("b", 1, "2024-01-02"), (None, 1, "2024-01-02")), "ids", APPEND)
    first = tables.refreshed_snapshot("ids", newest, ["person_id"])
    assert first.count() == 3 and first.schema.simpleString().startswith("struct<person_id:string")
    before = files(tables.own("mv_ids").folder)
    tables.save(imports(("a", 2, "2024-02-02"), ("b", 0, "2023-01-01"), ("c", 5, "2024-02-02")), "ids", APPEND)
    again = tables.refreshed_snapshot("ids", newest, ["person_id"])
    assert {r.person_id: r.v for r in again.collect()} == {"a": 2, "b": 1, "c": 5, None: 1}
    assert all(files(tables.own("mv_ids").folder)[f] == t for f, t in before.items())
    version = tables.own("mv_ids").version()
    assert tables.refreshed_snapshot("ids", newest, ["person_id"]).count() == 4 and tables.own("mv_ids").version() == version
    tables.save(imports(("z", 9, "2024-03-03")), "ids", REPLACE)
    assert [r.person_id for r in tables.refreshed_snapshot("ids", newest, ["person_id"]).collect()] == ["z"]
