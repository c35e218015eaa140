"""Column functions on literal rows: blanks, NULLs, edges."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from contrail.functions import checks, paths, text, times
from contrail.functions.vectors import STATE_VECTOR_FIELDS
from contrail.sources.files import decode_states


def evaluate(spark, column, ddl, *values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {ddl}")
    return [r[0] for r in df.orderBy("i").select(column.alias("y")).collect()]


def test_text(spark):
    values = (" ab c ", "", "  ", None)
    assert evaluate(spark, text.normalize_str("x"), "string", *values) == ["AB C", "", "", None]
    assert evaluate(spark, text.normalize_callsign("x"), "string", *values) == ["AB C", None, None, None]
    assert evaluate(spark, text.clean_name("x"), "string", "KLM royal D'OR/x", " ") == ["Klm Royal D'or/x", None]
    assert evaluate(spark, text.lower_str("x"), "string", " MIL ") == ["mil"]


def test_codes(spark):
    icao = text.matching("x", text.ICAO_PATTERN)
    assert evaluate(spark, icao, "string", "LEMD", "LE1D", "LEM", "lemd", None) == ["LEMD", "LE1D", None, None, None]
    prefix = text.ref_prefix("x")
    assert evaluate(spark, prefix, "string", "IBE", "IBERIA", "I", "1IB", None) == ["IBE", "IBER", None, None, None]


def test_callsign_prefix(spark):
    values = ("IBE123", "123", None, "ABCDEFG")
    assert evaluate(spark, text.callsign_prefix("x"), "string", *values) == ["IBE", "", None, "ABCDEFG"]
    assert evaluate(spark, text.airline_prefix("x"), "string", *values) == ["IBE", None, None, "ABCDEFG"]


def test_keys(spark):
    df = spark.createDataFrame([("X", None), (None, "X"), ("X", "")], "a string, b string")
    old = [r[0] for r in df.select(text.joined_key("a", "b")).collect()]
    new = [r[0] for r in df.select(text.slot_key("a", "b")).collect()]
    assert old[0] == old[1]
    assert new[0] != new[1] and new[0] == new[2]
    routes = [r[0] for r in df.select(text.route_key("a", "b")).collect()]
    assert routes == ["X", "X", "X→"]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_epochs_do_not_depend_on_the_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        seconds = F.unix_timestamp(times.epoch_to_ts("x"))
        values = (1_700_000_000, 1_700_000_000_999, 10_000_000_000, 10_000_000_001, None)
        assert evaluate(spark, seconds, "bigint", *values) == [1700000000, 1700000000, 10000000000, 10000000, None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_calendar_in_utc(spark):
    # 2025-12-29 is a Monday in ISO week 1; 23:30 UTC is already Tuesday in Madrid.
    row = spark.range(1).select(F.lit("2025-12-29T23:30:00Z").cast("timestamp").alias("t"))
    got = times.add_calendar(row, "t", "dep").drop("t").first()
    assert tuple(got) == (date(2025, 12, 29), 23, 0, 1, "2025-12")
    leap = spark.range(1).select(F.lit("2024-02-29T00:00:00Z").cast("timestamp").alias("t"))
    assert times.add_calendar(leap, "t", "d").first()["d_date_utc"] == date(2024, 2, 29)


def test_flags_are_three_valued(spark):
    flag = checks.outside("x", checks.VELOCITY_RANGE_MPS)
    assert evaluate(spark, flag, "double", -0.1, 0.0, 350.0, 350.1, None) == [True, False, False, True, None]
    heading = checks.wrap_heading("x")
    assert evaluate(spark, heading, "double", 359.0, 360.0, 725.0, None) == [359.0, 0.0, 5.0, None]
    latitude = checks.within_or_null("x", checks.LATITUDE_RANGE)
    assert evaluate(spark, latitude, "double", 90.0, 90.1, -91.0) == [90.0, None, None]


def test_paths(spark):
    full = "/raw/flights_x/tag=lemd/date=2025-09-19/flights_x_lemd_20250920T082017Z.json.gz"
    no_stamp = "/raw/date=2025-09-19/f.json.gz"
    broken = "/raw/date=2025-99-19/f_20259920T082017Z.json.gz"
    day = paths.download_date(F.col("x"), F.lit(date(2025, 1, 1)))
    got = evaluate(spark, day, "string", full, no_stamp, broken, "/raw/f.json.gz")
    assert got == [date(2025, 9, 20), date(2025, 9, 19), date(2025, 1, 1), date(2025, 1, 1)]
    assert evaluate(spark, paths.path_tag(F.col("x")), "string", full, no_stamp) == ["LEMD", ""]
    stamp = F.date_format(paths.download_ts(F.col("x")), "HH:mm:ss")
    assert evaluate(spark, stamp, "string", full, no_stamp, broken) == ["08:20:17", None, None]


def test_state_vectors(spark):
    base = ["abc", " ibe1 \t", "Spain", "1", "2", "3.5", None, None, "true", "x", "1", "1", "[1,2]", "9", "77", "false", "0"]
    df = spark.createDataFrame([(7, [base, [*base, "4"], base[:3]])], "t int, states array<array<string>>")
    got = decode_states(df, keep=["t"]).collect()
    assert got[0].asDict() | {"t": 7} == got[0].asDict()
    assert got[0]["callsign"] == "IBE1" and got[0]["velocity"] is None and got[0]["sensors"] == [1, 2]
    assert got[0]["category"] is None and got[1]["category"] == 4
    assert got[2]["origin_country"] == "Spain" and got[2]["spi"] is None
    assert len(got[0]) == len(STATE_VECTOR_FIELDS) + 1
