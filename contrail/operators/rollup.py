"""Grouped aggregates (AGG-01..06, AGG-16)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Fixed value: one reading each 90 seconds for 24 hours.
EXPECTED_PINGS_PER_DAY = 960


def p95(c: Column | str) -> Column:
    """AGG-03: an element of the group, default accuracy; the sketch merges, so
    groups of any size are aggregated map-side first."""
    return F.percentile_approx(F.col(c) if isinstance(c, str) else c, 0.95)


def true_ratio(flag: Column | str) -> Column:
    """AGG-04: share of TRUE among the non-NULL flags, 0..1."""
    flag = F.col(flag) if isinstance(flag, str) else flag
    return F.avg(flag.cast("double"))


def coverage_pct(count: Column | str, expected: int = EXPECTED_PINGS_PER_DAY) -> Column:
    """AGG-06: per cent of the expected readings, above 100 when there are more."""
    count = F.col(count) if isinstance(count, str) else count
    return count / F.lit(float(expected)) * F.lit(100.0)


def daily_states(states: DataFrame, expected: int = EXPECTED_PINGS_PER_DAY) -> DataFrame:
    """AGG-01: one row per aircraft and UTC day.  Lineage columns are rolled up
    where the input has them (AGG-05)."""
    lineage = [c for c in ("_ingest_ts", "_silver_ts", "download_date") if c in states.columns]
    return (
        states.groupBy("icao24", "event_date_utc")
        .agg(
            F.count(F.lit(1)).alias("pings_count"),
            p95("velocity_mps").alias("p95_velocity"),
            p95("geo_alt_m").alias("p95_altitude"),
            true_ratio("flag_velocity_outlier").alias("pct_velocity_outlier"),
            true_ratio("flag_alt_outlier").alias("pct_alt_outlier"),
            *[F.max(c).alias(c) for c in lineage],
        )
        .withColumn("coverage_pct", coverage_pct("pings_count", expected))
    )
