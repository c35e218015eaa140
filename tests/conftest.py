"""One local session for all tests, on a host that is not in UTC."""

import os
import sys
import time
from datetime import datetime, timezone
from pathlib import Path

os.environ["TZ"] = "Europe/Madrid"
time.tzset()
sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import pytest  # noqa: E402

from contrail import spark_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    options = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "4",
        "spark.driver.memory": "6g",
        "spark.sql.maxMetadataStringLength": "2000",
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    }
    session = spark_session("tests", "local[8]", options)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def at():
    """Timestamps on the first of January 2024, given hours in UTC."""
    return lambda hour, day=1: datetime(2024, 1, day, hour, tzinfo=timezone.utc)


@pytest.fixture
def rows():
    """Collected rows as sorted tuples."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return collect


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="session")
def plan():
    return plan_of
