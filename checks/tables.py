"""Catalog tables and what is built on their provenance."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.common import table
from deskmatch.operators.latest import latest_import, newest_import_rows
from deskmatch.plans import daily
from deskmatch.sources.tables import APPEND, REPLACE, Tables, limited, with_provenance

DATABASE = "default"


def _tables(spark) -> Tables:
    """Names of their own for each run: another session may have left tables in the same warehouse."""
    return Tables(spark, DATABASE, DATABASE, f"check_{uuid.uuid4().hex}_")


def _stamp(text: str):
    return F.lit(text).cast("timestamp")


def table_append_nested(spark, sf_dir) -> DataFrame:
    """Orders saved in three steps; the second brings new nested fields and a new column. Read back with the
    provenance of each step; a missing table reads as an empty one."""
    tables = _tables(spark)
    orders = table(spark, sf_dir, "orders")
    plain = orders.select("o_orderkey", F.struct("o_orderstatus").alias("state"), F.array(F.struct("o_custkey")).alias("people"))
    wide = orders.select(
        "o_orderkey", F.struct("o_orderstatus", F.col("o_orderpriority").alias("priority")).alias("state"),
        F.array(F.struct("o_custkey", F.col("o_orderkey").alias("again"))).alias("people"), F.to_date("o_orderdate").cast("string").alias("day"),
    )
    steps = ((plain, 0, REPLACE, "first"), (wide, 1, APPEND, "second"), (plain, 2, APPEND, "third"))
    written = 0
    for rows, part, mode, source in steps:
        part_rows = rows.filter(F.col("o_orderkey") % 3 == part)
        written += tables.save(with_provenance(part_rows, source, _stamp("2024-01-01")), "orders", mode)
    back = tables.first_existing(["missing", "orders"], "o_orderkey long")
    return back.select(
        "o_orderkey", "state.o_orderstatus", F.col("state.priority").alias("priority"), F.get("people", F.lit(0))["o_custkey"].alias("o_custkey"),
        F.get("people", F.lit(0))["again"].alias("again"), "day", F.col("provenance.source").alias("source"),
        F.lit(written).cast("long").alias("written"),
    )


APPEND_SQL = """SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 3 = 1 THEN o_orderpriority END AS priority, o_custkey,
  CASE WHEN o_orderkey % 3 = 1 THEN o_orderkey END AS again, CASE WHEN o_orderkey % 3 = 1 THEN o_orderdate::DATE::VARCHAR END AS day,
  ['first', 'second', 'third'][o_orderkey % 3 + 1] AS source, (SELECT count(*) FROM orders) AS written
FROM orders"""


def latest_ids(spark, sf_dir) -> DataFrame:
    """Newest import per customer; imports of one day are settled by their source, then by their number."""
    imports = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("person_id"), F.array("o_orderkey").alias("pubmed_ids"), F.col("o_orderkey").alias("number"),
        F.struct(F.col("o_orderpriority").alias("source"), F.col("o_orderdate").cast("timestamp").alias("imported_timestamp")).alias("provenance"),
    )
    newest = latest_import(imports, ["person_id"], "provenance.source", "number")
    return newest.select("person_id", F.array_join("pubmed_ids", ",").alias("ids"), F.col("provenance.source").alias("source"))


LATEST_SQL = """SELECT person_id, ids, source FROM (
  SELECT o_custkey AS person_id, o_orderkey::VARCHAR AS ids, o_orderpriority AS source,
    row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderpriority DESC, o_orderkey DESC) AS place
  FROM orders) WHERE place = 1"""


def latest_id_rows(spark, sf_dir) -> DataFrame:
    """All ids of the newest import per customer, one row each: an import is what came in one year with one priority."""
    imports = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("person_id"), F.col("o_orderkey").alias("pmid"),
        F.struct(F.col("o_orderpriority").alias("source"), F.date_trunc("year", "o_orderdate").alias("imported_timestamp")).alias("provenance"),
    )
    newest = newest_import_rows(imports, ["person_id"], "provenance.source")
    return newest.select("person_id", "pmid", F.col("provenance.source").alias("source"))


ID_ROWS_SQL = """SELECT person_id, pmid, source FROM (
  SELECT o_custkey AS person_id, o_orderkey AS pmid, o_orderpriority AS source,
    rank() OVER (PARTITION BY o_custkey ORDER BY date_trunc('year', o_orderdate) DESC, o_orderpriority DESC) AS place
  FROM orders) WHERE place = 1"""


def snapshot_refresh(spark, sf_dir) -> DataFrame:
    """Orders come in three imports, one of them empty; after each the copy with the newest order per customer is
    brought up to date from what is new. ``version`` counts the writes to the copy: an empty import makes none."""
    tables = _tables(spark)
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("person_id"), F.col("o_orderkey").alias("number"), F.col("o_orderdate").cast("timestamp").alias("day"))
    stamped = orders.select("person_id", "number", F.struct(F.lit("orders").alias("source"), F.col("day").alias("imported_timestamp")).alias("provenance"))
    newest = lambda rows: latest_import(rows, ["person_id"], "number")
    for part in (F.col("number") % 4 > 0, F.col("number") < 0, F.col("number") % 4 == 0):
        tables.save(stamped.filter(part), "imports", APPEND)
        copy = tables.refreshed_snapshot("imports", newest, ["person_id"])
    return copy.select("person_id", "number", F.lit(tables.own("mv_imports").version()).cast("long").alias("version"))


REFRESHED_SQL = """SELECT person_id, number, 2 AS version FROM (
  SELECT o_custkey AS person_id, o_orderkey AS number,
    row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS place FROM orders) WHERE place = 1"""


def snapshot_limited(spark, sf_dir) -> DataFrame:
    """The fifty costliest orders, as a view and its stored copy."""
    tables = _tables(spark)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", (-F.col("o_totalprice")).alias("falling"))
    return tables.snapshot(limited(orders, 50, "falling", "o_orderkey").drop("falling"), "costliest")


SNAPSHOT_SQL = "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50"


def series_shape(spark, sf_dir) -> DataFrame:
    """Events per type and day as a checked series."""
    days = table(spark, sf_dir, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return daily.as_series(days, ["event_type"])


SERIES_SQL = "SELECT event_type, ts::DATE AS ds, count(*) AS y FROM events GROUP BY ALL"

QUERIES = {
    "table_append_nested": table_append_nested, "latest_ids": latest_ids, "snapshot_limited": snapshot_limited, "series_shape": series_shape,
    "latest_id_rows": latest_id_rows, "snapshot_refresh": snapshot_refresh,
}
SQL = {
    "table_append_nested": APPEND_SQL, "latest_ids": LATEST_SQL, "snapshot_limited": SNAPSHOT_SQL, "series_shape": SERIES_SQL,
    "latest_id_rows": ID_ROWS_SQL, "snapshot_refresh": REFRESHED_SQL,
}
