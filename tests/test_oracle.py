"""Every registered query against its SQL counterpart on whole sample tables."""

import math
import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_point
from contrail.oracle import ORACLE
from contrail.queries import QUERIES

SAMPLES = Path(os.environ.get("SAMPLES_DIR", "/root/testdata/sf0.001"))
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "tinyint": "TINYINT", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP",
}

pytestmark = pytest.mark.skipif(not SAMPLES.exists(), reason="sample tables not present")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in SAMPLES.glob("*.parquet"):
        connection.sql(f"create view {file.stem} as select * from '{file}'")
    return connection


def text(value):
    return "nan" if isinstance(value, float) and math.isnan(value) else str(value)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(ORACLE) <= set(entry_point.oracle_sql())


def test_entry(spark):
    assert entry_point.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, str(SAMPLES))
    expected = duck.sql(ORACLE[name])
    columns = sorted(df.columns)
    assert columns == sorted(expected.columns)
    types = {f.name: TYPES.get(f.dataType.simpleString()) for f in df.schema.fields}
    assert types == dict(zip(expected.columns, map(str, expected.types)))

    # Timestamps travel as text: collected ones are in the zone of this host.
    as_text = [
        f"cast({c} as string) as {c}" if types[c] == "TIMESTAMP" else c for c in columns
    ]
    actual = sorted(tuple(text(v) for v in r) for r in df.selectExpr(*as_text).collect())
    order = [expected.columns.index(c) for c in columns]
    wanted = sorted(tuple(text(r[i]) for i in order) for r in expected.fetchall())
    strip = [c for c in columns if types[c] == "TIMESTAMP"]
    if strip:
        at = [columns.index(c) for c in strip]
        wanted = sorted(
            tuple(v.rstrip("0").rstrip(".") if i in at and "." in v else v for i, v in enumerate(r)) for r in wanted
        )
    assert actual == wanted
