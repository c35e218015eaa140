"""Silver: normalised, keyed, enriched (SLV-*)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from contrail.functions import checks, text, times
from contrail.operators.dedupe import latest_per_key, latest_per_key_counted
from contrail.operators.enrich import Dimension, join_dimension
from contrail.operators.project import add_layer_metadata, require_keys, select_allowlist

# Columns of the published tables.
STATES_COLUMNS = (
    "icao24", "time_ts", "event_date_utc", "hour_of_day",
    "velocity_mps", "geo_alt_m", "flag_velocity_outlier", "flag_alt_outlier",
    "_ingest_id", "_ingest_ts", "_source_file", "download_ts", "download_date",
    "_silver_version", "_silver_ts",
)
FLIGHTS_COLUMNS = (
    "flight_id", "icao24", "callsign_norm", "airline_prefix", "airline_name",
    "dep_icao", "dep_iata", "arr_icao", "arr_iata", "unknown_dep", "unknown_arr",
    "first_seen_ts", "last_seen_ts", "block_time_s",
    "dep_date_utc", "arr_date_utc", "dep_hour", "arr_hour", "dep_dow", "arr_dow",
    "dep_week", "arr_week", "dep_month", "arr_month", "route_key",
    "_ingest_ts", "_source_file", "download_ts", "download_date",
    "_silver_version", "_silver_ts",
)
AIRLINES_COLUMNS = (
    "prefix", "airline_name",
    "_ingest_ts", "_source_file", "download_ts", "download_date",
    "_silver_version", "_silver_ts",
)
AIRPORTS_COLUMNS = (
    "city", "region", "icao", "iata", "name", "type",
    "_ingest_ts", "_source_file", "download_ts", "download_date",
    "_silver_version", "_silver_ts",
)
LINEAGE = (
    "_ingest_id", "_ingest_ts", "_source_file", "download_ts", "download_date",
    "_silver_version", "_silver_ts",
)

STATES_KEY = ("icao24", "time_ts")
FLIGHTS_KEY = ("flight_id",)


def _present(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c in df.columns]


def clean_states(bronze: DataFrame) -> DataFrame:
    """Rename, time, calendar, flags and key filter; before the dedupe."""
    named = bronze.select(
        text.normalize_str("icao24").alias("icao24"),
        F.col("velocity").cast("double").alias("velocity_mps"),
        F.col("geo_altitude").cast("double").alias("geo_alt_m"),
        times.epoch_to_ts(F.coalesce("time_position", "last_contact")).alias("time_ts"),
        *_present(bronze, LINEAGE),
    )
    derived = named.withColumns(
        {
            "event_date_utc": F.to_date("time_ts"),
            "hour_of_day": F.hour("time_ts").cast("tinyint"),
            "flag_velocity_outlier": checks.outside("velocity_mps", checks.VELOCITY_RANGE_MPS),
            "flag_alt_outlier": checks.outside("geo_alt_m", checks.ALTITUDE_RANGE_M),
        }
    )
    return require_keys(derived, *STATES_KEY)


def _latest(df: DataFrame, keys: Sequence[str], order: Sequence[str], counted: str | None) -> DataFrame:
    return latest_per_key_counted(df, keys, order, counted) if counted else latest_per_key(df, keys, order)


def _published(df: DataFrame, columns: Sequence[str], counted: str | None) -> DataFrame:
    return select_allowlist(df, [*columns, counted] if counted else columns)


def silver_states(
    bronze: DataFrame, run_ts: datetime, version: str = "v1.0.0", counted: str | None = None
) -> DataFrame:
    """SLV-01: one row per aircraft and second, the last ingested.  ``counted`` (here and below)
    names a column for the number of rows that the row stands for."""
    clean = clean_states(bronze)
    order = _present(clean, ["_ingest_ts", "_source_file", "velocity_mps", "geo_alt_m"])
    unique = _latest(clean, STATES_KEY, order, counted)
    stamped = add_layer_metadata(unique, "silver", "bronze.states", run_ts, version)
    return _published(stamped, STATES_COLUMNS, counted)


def identify_flights(bronze: DataFrame) -> DataFrame:
    """Normalised columns, times and key: all that the dedupe needs."""
    named = bronze.select(
        text.normalize_str("icao24").alias("icao24"),
        text.normalize_callsign("callsign").alias("callsign_norm"),
        text.normalize_str("estDepartureAirport").alias("dep_icao"),
        text.normalize_str("estArrivalAirport").alias("arr_icao"),
        times.epoch_to_ts("firstSeen").alias("first_seen_ts"),
        times.epoch_to_ts("lastSeen").alias("last_seen_ts"),
        *_present(bronze, LINEAGE),
    )
    key = text.slot_key(
        "icao24",
        "dep_icao",
        "arr_icao",
        F.unix_timestamp("first_seen_ts"),
        F.unix_timestamp("last_seen_ts"),
    )
    return require_keys(named, "first_seen_ts", "last_seen_ts").withColumn("flight_id", key)


def derive_flights(identified: DataFrame) -> DataFrame:
    """Block time, route, airline prefix and both calendars."""
    return identified.withColumns(
        {
            "block_time_s": times.block_time_s("first_seen_ts", "last_seen_ts"),
            "route_key": text.route_key("dep_icao", "arr_icao"),
            "airline_prefix": text.airline_prefix("callsign_norm"),
            **times.calendar_columns("first_seen_ts", "dep"),
            **times.calendar_columns("last_seen_ts", "arr"),
        }
    )


def enrich_airline(flights: DataFrame, airlines: DataFrame | Dimension) -> DataFrame:
    """JOIN-01: airline name by callsign prefix."""
    return join_dimension(
        flights, airlines, {"airline_prefix": "prefix"}, {"airline_name": "airline_name"}
    )


def enrich_airports(flights: DataFrame, airports: DataFrame | Dimension) -> DataFrame:
    """JOIN-02 and FLT-05: IATA codes of both ends and the unknown flags."""
    airports = Dimension.of(airports)
    for role in ("dep", "arr"):
        flights = join_dimension(
            flights, airports, {f"{role}_icao": "icao"}, {"iata": f"{role}_iata"}
        )
    return flights.withColumns(
        {
            f"unknown_{role}": checks.unknown_code(f"{role}_icao", f"{role}_iata")
            for role in ("dep", "arr")
        }
    )


def silver_flights(
    bronze: DataFrame,
    airlines: DataFrame | Dimension,
    airports: DataFrame | Dimension,
    source: str,
    run_ts: datetime,
    version: str = "v1.0.0",
    counted: str | None = None,
) -> DataFrame:
    """SLV-02 for one feed.  ``airlines`` and ``airports`` are the clean silver
    references, unique on their keys, so the row count does not change (D5, D6).

    Duplicates go first and everything that follows from a flight's own columns
    is derived after them: the shuffle carries few columns, and repeated rows are
    neither derived nor enriched."""
    flights = _unique_flights(bronze, airlines, airports, counted)
    stamped = add_layer_metadata(flights, "silver", source, run_ts, version)
    return _published(stamped, FLIGHTS_COLUMNS, counted)


def silver_flight_feeds(
    bronze: DataFrame,
    airlines: DataFrame | Dimension,
    airports: DataFrame | Dimension,
    feeds: Mapping[str, str],
    run_ts: datetime,
    version: str = "v1.0.0",
) -> DataFrame:
    """SLV-02 for flights that are not yet split into feeds: one pass for all of them.

    ``feeds`` maps the name of a feed to the end (``dep_icao``, ``arr_icao``) that must be known
    for a flight to be in it.  The ends are part of the flight's key, so copies of a flight are in
    the same feeds: duplicates go once, before a flight is emitted to each of its feeds, and what
    follows by flight finds the partitioning it needs."""
    flights = _unique_flights(bronze, airlines, airports)
    named = F.array(*[F.when(F.col(end).isNotNull(), F.lit(name)) for name, end in feeds.items()])
    feed = F.explode(F.filter(named, lambda name: name.isNotNull()))
    emitted = flights.drop("_source_file").withColumn("_source_file", feed)
    source = F.concat(F.lit("bronze."), F.col("_source_file"))
    stamped = add_layer_metadata(emitted, "silver", source, run_ts, version)
    return select_allowlist(stamped, FLIGHTS_COLUMNS)


def _unique_flights(
    bronze: DataFrame, airlines: DataFrame | Dimension, airports: DataFrame | Dimension, counted: str | None = None
) -> DataFrame:
    identified = identify_flights(bronze)
    order = _present(identified, ["_ingest_ts", "_source_file", "callsign_norm"])
    unique = _latest(identified, FLIGHTS_KEY, order, counted)
    return enrich_airports(enrich_airline(derive_flights(unique), airlines), airports)


def clean_ref_airlines(bronze: DataFrame) -> DataFrame:
    named = bronze.select(
        text.ref_prefix(text.normalize_str("prefix")).alias("prefix"),
        text.clean_name("airline").alias("airline_name"),
        *_present(bronze, LINEAGE),
    )
    return require_keys(named, "prefix")


def silver_ref_airlines(
    bronze: DataFrame, run_ts: datetime, version: str = "v1.0.0", counted: str | None = None
) -> DataFrame:
    """SLV-03."""
    clean = clean_ref_airlines(bronze)
    unique = _latest(clean, ["prefix"], _present(clean, ["_ingest_ts", "airline_name"]), counted)
    stamped = add_layer_metadata(unique, "silver", "bronze.ref_airlines_prefixes", run_ts, version)
    return _published(stamped, AIRLINES_COLUMNS, counted)


def clean_ref_airports(bronze: DataFrame) -> DataFrame:
    named = bronze.select(
        text.title_str("city").alias("city"),
        text.normalize_str("region").alias("region"),
        text.matching(text.normalize_str("icao"), text.ICAO_PATTERN).alias("icao"),
        text.matching(text.normalize_str("iata"), text.IATA_PATTERN).alias("iata"),
        text.title_str("name").alias("name"),
        text.lower_str("type").alias("type"),
        *_present(bronze, LINEAGE),
    )
    return require_keys(named, "icao")


def silver_ref_airports(
    bronze: DataFrame, run_ts: datetime, version: str = "v1.0.0", counted: str | None = None
) -> DataFrame:
    """SLV-04."""
    clean = clean_ref_airports(bronze)
    order = _present(clean, ["_ingest_ts", "type", "name", "city", "iata", "region"])
    unique = _latest(clean, ["icao"], order, counted)
    stamped = add_layer_metadata(unique, "silver", "bronze.ref_airports", run_ts, version)
    return _published(stamped, AIRPORTS_COLUMNS, counted)
