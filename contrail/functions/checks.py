"""Validity rules and three-valued quality flags (FLT-*)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Physical limits of the published rules.
VELOCITY_RANGE_MPS = (0.0, 350.0)
ALTITUDE_RANGE_M = (-500.0, 20000.0)
LATITUDE_RANGE = (-90.0, 90.0)
LONGITUDE_RANGE = (-180.0, 180.0)
# South, north, west, east of the peninsula box.
PENINSULA_BOX = (35.0, 45.0, -10.0, 4.0)


def outside(c: Column | str, limits: tuple[float, float]) -> Column:
    """FLT-04: NULL stays NULL, so absent readings are neither in nor out."""
    c = F.col(c) if isinstance(c, str) else c
    low, high = limits
    return (c < low) | (c > high)


def within_or_null(c: Column | str, limits: tuple[float, float]) -> Column:
    """FLT-06: the value if inside the closed range, else NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.between(*limits), c)


def wrap_heading(c: Column | str) -> Column:
    """FLT-06: headings of 360 degrees and more start again at 0."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c >= 360, c % 360).otherwise(c)


def in_box(lat: str, lon: str, box: tuple[float, float, float, float] = PENINSULA_BOX) -> Column:
    """FLT-08: plain comparisons on stored columns, so Parquet can skip row groups."""
    south, north, west, east = box
    return F.col(lat).between(south, north) & F.col(lon).between(west, east)


def unknown_code(code: str, mapped: str) -> Column:
    """FLT-05: no code, or a code the reference data does not know."""
    return F.col(code).isNull() | F.col(mapped).isNull()


def keys_present(*keys: str) -> Column:
    """FLT-01: every key column is set."""
    condition = F.col(keys[0]).isNotNull()
    for key in keys[1:]:
        condition = condition & F.col(key).isNotNull()
    return condition
