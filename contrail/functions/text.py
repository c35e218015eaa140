"""String normalisation, code validation and keys (STR-*, FLT-02, FLT-03)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Formats of the published code systems.
ICAO_PATTERN = "^[A-Z0-9]{4}$"
IATA_PATTERN = "^[A-Z0-9]{3}$"
REF_PREFIX_PATTERN = "^[A-Z]{2,4}"
CALLSIGN_PREFIX_PATTERN = "^[A-Z]+"
ROUTE_SEPARATOR = "→"
KEY_SEPARATOR = "|"
# Whitespace stripped from raw payload text: space, tab, line breaks, VT, FF.
RAW_WHITESPACE = " \t\n\r\x0b\x0c"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_str(c: Column | str) -> Column:
    """STR-01: trimmed, upper case."""
    return F.upper(F.trim(_col(c)))


def lower_str(c: Column | str) -> Column:
    """STR-04: trimmed, lower case."""
    return F.lower(F.trim(_col(c)))


def title_str(c: Column | str) -> Column:
    """STR-03: trimmed, first letter of each blank-separated word in upper case."""
    return F.initcap(F.trim(_col(c)))


def blank_to_null(c: Column | str) -> Column:
    """STR-02: trimmed, NULL when nothing is left."""
    return F.nullif(F.trim(_col(c)), F.lit(""))


def normalize_callsign(c: Column | str) -> Column:
    return F.upper(blank_to_null(c))


def clean_name(c: Column | str) -> Column:
    return F.initcap(blank_to_null(c))


def matching(c: Column | str, pattern: str) -> Column:
    """FLT-02: the value where it matches ``pattern``, else NULL."""
    return F.when(_col(c).rlike(pattern), _col(c))


def ref_prefix(c: Column | str) -> Column:
    """FLT-03: leading 2-4 letters, NULL if there are none; longer text is cut."""
    return F.nullif(F.regexp_extract(_col(c), REF_PREFIX_PATTERN, 0), F.lit(""))


def callsign_prefix(c: Column | str) -> Column:
    """STR-05: leading letters; '' without a match, NULL for NULL."""
    return F.regexp_extract(_col(c), CALLSIGN_PREFIX_PATTERN, 0)


def airline_prefix(c: Column | str) -> Column:
    """Join form of STR-05 (D12): no leading letters means no airline."""
    return F.nullif(callsign_prefix(c), F.lit(""))


def route_key(dep: Column | str, arr: Column | str) -> Column:
    """STR-06: ``dep→arr``; an absent side is left out."""
    return F.concat_ws(ROUTE_SEPARATOR, _col(dep), _col(arr))


def joined_key(*parts: Column | str) -> Column:
    """STR-07 as first published: absent parts are left out, so keys can collide."""
    texts = [_col(p).cast("string") for p in parts]
    return F.sha2(F.concat_ws(KEY_SEPARATOR, *texts), 256)


def slot_key(*parts: Column | str) -> Column:
    """STR-07 with one slot per part (D7): an absent part keeps its place."""
    slots = [F.coalesce(_col(p).cast("string"), F.lit("")) for p in parts]
    return F.sha2(F.concat_ws(KEY_SEPARATOR, *slots), 256)
