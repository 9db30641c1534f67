import os

import duckdb
import pytest
from pyspark.sql import functions as F

from checks import series
from checks.common import table
from deskmatch.plans import stats
from tools.compare import sorted_rows

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_request_that_grows_to_the_whole_table(spark):
    ids = table(spark, SF, "customer").select(F.col("c_custkey").alias("person_id"))
    wanted = ids.unionByName(ids.filter("person_id % 2 = 0"))
    found = stats.requested_person_details(
        *series._person_tables(spark, SF), series._workload(spark, SF), wanted, F.lit("2024-01-20").cast("timestamp"))
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in ("customer", "events"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    expected = con.execute(series.STATS_SQL)
    names = [c[0] for c in expected.description]
    rows = expected.fetchall()
    assert rows
    assert sorted_rows(found.columns, found.collect()) == sorted_rows(names, rows)
