import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from deskmatch.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    active = session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g",
        "spark.ui.showConsoleProgress": "false", "spark.sql.warehouse.dir": str(folder / "warehouse"),
        "spark.checkpoint.dir": str(folder / "checkpoint"),
    })
    active.sparkContext.setLogLevel("ERROR")
    yield active
    active.stop()


@pytest.fixture
def value(spark):
    """Value of one column expression over one row."""

    def run(column):
        return spark.range(1).select(column.alias("v")).first()["v"]

    return run
