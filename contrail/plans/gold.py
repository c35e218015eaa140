"""Gold: facts and dimensions of the star schema (FCT-*, DIM-*)."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from contrail.functions import text, times
from contrail.operators.dedupe import distinct_values, latest_per_key, latest_per_key_counted
from contrail.operators.project import (
    add_layer_metadata,
    require_keys,
    select_allowlist,
    union_by_name,
)
from contrail.operators.rollup import EXPECTED_PINGS_PER_DAY, daily_states
from contrail.plans.silver import FLIGHTS_COLUMNS

STATES_KEY = ("icao24", "event_date_utc")
DAYS_PER_YEAR = 365


def _stamp(df: DataFrame, source: str, job: str, run_ts: datetime, version: str, run_id: str):
    return add_layer_metadata(df, "gold", source, run_ts, version, run_id, job)


def fact_flights(
    departures: DataFrame,
    arrivals: DataFrame,
    run_ts: datetime,
    version: str = "v1.0.0",
    run_id: str = "manual",
    counted: str | None = None,
) -> DataFrame:
    """FCT-01: both feeds by name, the freshest row per flight."""
    both = union_by_name(
        select_allowlist(departures, FLIGHTS_COLUMNS), select_allowlist(arrivals, FLIGHTS_COLUMNS)
    )
    return freshest_flights(both, run_ts, version, run_id, counted)


def freshest_flights(
    both: DataFrame, run_ts: datetime, version: str = "v1.0.0", run_id: str = "manual", counted: str | None = None
) -> DataFrame:
    """FCT-01 from one frame of all feeds; ``counted`` names a column for the rows of a flight."""
    order = [
        c
        for c in ("_silver_ts", "_ingest_ts", "_source_file", "callsign_norm")
        if c in both.columns
    ]
    keys = ["flight_id"]
    unique = latest_per_key_counted(both, keys, order, counted) if counted else latest_per_key(both, keys, order)
    source = "silver.flights_departure+arrival"
    return _stamp(unique, source, "build_fact_flights", run_ts, version, run_id)


def fact_states(
    states: DataFrame,
    run_ts: datetime,
    version: str = "v1.0.0",
    run_id: str = "manual",
    expected: int = EXPECTED_PINGS_PER_DAY,
) -> DataFrame:
    """FCT-02: telemetry per aircraft and UTC day."""
    daily = daily_states(require_keys(states, *STATES_KEY), expected)
    return _stamp(daily, "silver.states", "build_fact_states", run_ts, version, run_id)


def dim_airports(
    airports: DataFrame, run_ts: datetime, version: str = "v1.0.0", run_id: str = "manual"
) -> DataFrame:
    """DIM-01: one row per ICAO code, the newest and not any (D22)."""
    carried = ("_ingest_ts", "download_date", "_silver_version", "_silver_ts")
    columns = ("icao", "iata", "name", "city", "region", "type", *carried)
    clean = require_keys(select_allowlist(airports, columns), "icao").withColumns(
        {"icao": text.normalize_str("icao"), "iata": text.normalize_str("iata")}
    )
    order = [c for c in ("_silver_ts", "_ingest_ts", "type", "name", "city") if c in clean.columns]
    unique = latest_per_key(clean, ["icao"], order)
    return _stamp(unique, "silver.ref_airports", "build_dim_airports", run_ts, version, run_id)


def dim_prefixes(
    airlines: DataFrame, run_ts: datetime, version: str = "v1.0.0", run_id: str = "manual"
) -> DataFrame:
    """DIM-02: one row per callsign prefix."""
    carried = ("_ingest_ts", "download_date", "_silver_version", "_silver_ts")
    clean = require_keys(
        select_allowlist(airlines, ("prefix", "airline_name", *carried)), "prefix"
    ).withColumns(
        {"prefix": text.normalize_str("prefix"), "airline_name": text.title_str("airline_name")}
    )
    order = [c for c in ("_silver_ts", "_ingest_ts", "airline_name") if c in clean.columns]
    unique = latest_per_key(clean, ["prefix"], order)
    source = "silver.ref_airlines_prefixes"
    return _stamp(unique, source, "build_dim_prefixes", run_ts, version, run_id)


def dim_airlines(
    flights: DataFrame, run_ts: datetime, version: str = "v1.0.0", run_id: str = "manual"
) -> DataFrame:
    """DIM-03: airlines that occur in the flights.  Not sorted: a stored table has
    no order, ``sorted_airlines`` is the report."""
    named = flights.where(F.col("airline_name").isNotNull())
    pairs = distinct_values(named, "airline_prefix", "airline_name")
    return _stamp(pairs, "gold.fact_flights", "build_dim_airlines", run_ts, version, run_id)


def sorted_airlines(airlines: DataFrame) -> DataFrame:
    """SRT-01."""
    return airlines.orderBy("airline_name", "airline_prefix")


def calendar_between(bounds: DataFrame, first: str, last: str) -> DataFrame:
    """ARR-01 and DAT-07: every date from ``first`` to ``last`` with its parts.
    ``bounds`` is one row."""
    days = F.sequence(F.col(first), F.col(last), F.expr("interval 1 day"))
    return bounds.select(F.explode(days).alias("date")).select(
        "date",
        times.day_of_week("date").alias("dow"),
        F.weekofyear("date").alias("week"),
        F.date_format("date", "yyyy-MM").alias("month"),
        F.quarter("date").alias("quarter"),
        F.year("date").alias("year"),
        (F.weekday("date") >= 5).alias("is_weekend"),
    )


def dates_around(as_of: DataFrame, column: str, years_back: int = 3, years_fwd: int = 1) -> DataFrame:
    """Calendar of whole 365-day years before and after the one date in ``as_of``."""
    bounds = as_of.select(
        F.date_sub(column, DAYS_PER_YEAR * years_back).alias("first"),
        F.date_add(column, DAYS_PER_YEAR * years_fwd).alias("last"),
    )
    return calendar_between(bounds, "first", "last")


def dim_dates(
    spark: SparkSession,
    as_of: date,
    run_ts: datetime,
    years_back: int = 3,
    years_fwd: int = 1,
    version: str = "v1.0.0",
    run_id: str = "manual",
) -> DataFrame:
    """DIM-04 around a given day."""
    today = spark.range(1).select(F.lit(as_of).alias("as_of"))
    dates = dates_around(today, "as_of", years_back, years_fwd)
    return _stamp(dates, "generated.dim_dates", "build_dim_dates", run_ts, version, run_id)
