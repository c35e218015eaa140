"""Input contracts and ledger schemas, as DDL text for ``read.schema``."""

from __future__ import annotations

from contrail.functions.vectors import STATE_VECTOR_FIELDS

CORRUPT = "_corrupt_record"

# Column names and types of the raw feeds.
STATES = ", ".join(f"{name} {type_name}" for name, type_name in STATE_VECTOR_FIELDS)

STATE_PAYLOAD = "time bigint, states array<array<string>>"

FLIGHTS = """
    icao24 string, firstSeen bigint, estDepartureAirport string, lastSeen bigint,
    estArrivalAirport string, callsign string,
    estDepartureAirportHorizDistance int, estDepartureAirportVertDistance int,
    estArrivalAirportHorizDistance int, estArrivalAirportVertDistance int,
    departureAirportCandidatesCount int, arrivalAirportCandidatesCount int
"""

REF_AIRLINES = "prefix string, airline string"

REF_AIRPORTS = "city string, region string, icao string, iata string, name string, type string"

MANIFEST = """
    dataset string, source_file string, ingest_id string, processed_ts timestamp,
    status string, file_hash string, version string
"""

METRICS = """
    dataset string, source_key string, ingest_id string, processed_ts timestamp,
    rows_in bigint, rows_out bigint, corrupt_rows bigint,
    nulls_json string, columns_json string,
    dup_ratio double, unknown_pct double, freshness_lag_minutes double,
    extras_json string, status string, notes string
"""


def with_corrupt(ddl: str) -> str:
    """The contract plus the column that keeps the text of a malformed record."""
    return f"{ddl}, {CORRUPT} string"
