"""Positional state vectors -> named, typed fields (ARR-03)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from contrail.functions.text import RAW_WHITESPACE

# Field order of a state vector and the type of each field; the
# last one is only present in extended vectors.
STATE_VECTOR_FIELDS = (
    ("icao24", "string"),
    ("callsign", "string"),
    ("origin_country", "string"),
    ("time_position", "bigint"),
    ("last_contact", "bigint"),
    ("longitude", "double"),
    ("latitude", "double"),
    ("baro_altitude", "double"),
    ("on_ground", "boolean"),
    ("velocity", "double"),
    ("true_track", "double"),
    ("vertical_rate", "double"),
    ("sensors", "array<int>"),
    ("geo_altitude", "double"),
    ("squawk", "string"),
    ("spi", "boolean"),
    ("position_source", "int"),
    ("category", "int"),
)


def vector_fields(vector: Column) -> list[Column]:
    """One typed column per position; short vectors give NULLs at the end."""
    fields = []
    for position, (name, type_name) in enumerate(STATE_VECTOR_FIELDS, start=1):
        text = F.try_element_at(vector, F.lit(position))
        if name == "callsign":
            value = F.nullif(F.upper(F.btrim(text, F.lit(RAW_WHITESPACE))), F.lit(""))
        elif type_name.startswith("array"):
            value = F.from_json(text, type_name)
        elif type_name == "string":
            value = text
        else:
            value = text.try_cast(type_name)
        fields.append(value.alias(name))
    return fields
