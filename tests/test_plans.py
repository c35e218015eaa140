"""Physical plans: what reaches the scan, what is shuffled, what is skew-proof."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from contrail import samples
from contrail.functions import checks
from contrail.operators import dedupe
from contrail.plans import measures, silver
from contrail.sources import tables

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="sample tables not present")


def test_one_per_key_is_limited_before_the_shuffle(spark, plan):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    text = plan(dedupe.latest_per_key(df, ["k"], ["id"]))
    assert re.search(r"WindowGroupLimit.*Final.*Exchange hashpartitioning\(k.*WindowGroupLimit.*Partial", text, re.S)


def test_facts_read_the_lines_once_and_share_one_partitioning(spark, plan):
    """Both feeds come from one join of lines with orders; two dedupes use one shuffle."""
    text = plan(entry_point.queries()["fact_flights"](spark, SF))
    assert text.count("Generate explode(filter") == 1
    assert len([s for s in re.findall(r"ReadSchema: struct<([^>]*)>", text) if "l_partkey" in s]) == 1
    assert text.count("Exchange hashpartitioning(flight_id") == 1
    assert "Exchange" not in text.split("Generate explode(filter")[0]


def test_no_python_in_any_plan(spark, plan):
    for name in ("fact_states", "silver_flights", "kpi_cards", "decode_positional", "turnaround"):
        text = plan(entry_point.queries()[name](spark, SF))
        assert "Python" not in text and "Pandas" not in text and "CartesianProduct" not in text
        assert "BroadcastNestedLoopJoin" not in text


def test_box_filter_reaches_the_scan(spark, tmp_path, plan):
    path = str(tmp_path / "states")
    samples.pings(spark, SF).write.parquet(path)
    text = plan(tables.read(spark, path).where(checks.in_box("latitude", "longitude")).select("icao24"))
    assert "GreaterThanOrEqual(latitude,35.0)" in text and "LessThanOrEqual(longitude,4.0)" in text
    assert re.search(r"ReadSchema: struct<icao24:string,latitude:double,longitude:double>", text)


def test_dates_prune_partitions(spark, tmp_path, plan):
    path = str(tmp_path / "states")
    states = silver.silver_states(samples.pings(spark, SF), samples.RUN_TS)
    tables.replace_partitions(states, path, ["event_date_utc"])
    text = plan(tables.read(spark, path).where("event_date_utc = date'2024-01-05'").select("icao24"))
    assert re.search(r"PartitionFilters: \[isnotnull\(event_date_utc", text)
    sliced = measures.slice_flights(
        tables.read(spark, path).withColumnRenamed("event_date_utc", "dep_date_utc"),
        dates=(samples.RUN_TS.date(), samples.RUN_TS.date()),
    )
    assert "PartitionFilters: [isnotnull(event_date_utc" in plan(sliced)


def test_unused_columns_are_not_read(spark, plan):
    text = plan(samples.legs(spark, SF).select("icao24"))
    lines = [s for s in re.findall(r"ReadSchema: struct<([^>]*)>", text) if "l_partkey" in s]
    assert lines and "l_shipdate" not in lines[0]


def test_counts_per_group_combine_before_the_shuffle(spark, plan):
    text = plan(entry_point.queries()["fact_states"](spark, SF))
    assert "partial_percentile_approx" in text and "partial_count" in text
