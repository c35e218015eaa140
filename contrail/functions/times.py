"""Epochs, calendar columns, durations (DAT-*)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Fixed value: larger epochs are milliseconds.
MILLIS_ABOVE = 10_000_000_000


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_seconds(c: Column | str) -> Column:
    """Whole seconds of an epoch given in seconds or milliseconds."""
    value = _col(c).cast("long")
    return F.when(value > MILLIS_ABOVE, F.floor(value / 1000)).otherwise(value)


def epoch_to_ts(c: Column | str) -> Column:
    """DAT-01: UTC timestamp of an epoch in seconds or milliseconds."""
    return F.timestamp_seconds(epoch_seconds(c))


def day_of_week(ts: Column | str) -> Column:
    """Monday = 0 ... Sunday = 6, the encoding used everywhere (D11)."""
    return F.weekday(_col(ts)).cast("tinyint")


def day_of_week_sunday_first(ts: Column | str) -> Column:
    """Sunday = 1 ... Saturday = 7, kept for DAT-04."""
    return F.dayofweek(_col(ts)).cast("tinyint")


def calendar_columns(ts: Column | str, prefix: str) -> dict[str, Column]:
    """DAT-03: date, hour, day of week, ISO week and month under one prefix."""
    ts = _col(ts)
    return {
        f"{prefix}_date_utc": F.to_date(ts),
        f"{prefix}_hour": F.hour(ts).cast("tinyint"),
        f"{prefix}_dow": day_of_week(ts),
        f"{prefix}_week": F.weekofyear(ts),
        f"{prefix}_month": F.date_format(ts, "yyyy-MM"),
    }


def add_calendar(df: DataFrame, ts: str, prefix: str) -> DataFrame:
    return df.withColumns(calendar_columns(ts, prefix))


def block_time_s(first: Column | str, last: Column | str) -> Column:
    """DAT-05: seconds from first to last; negative when the feed is."""
    return (F.unix_timestamp(_col(last)) - F.unix_timestamp(_col(first))).cast("int")


def lag_minutes(latest: Column, as_of: Column) -> Column:
    return (F.unix_timestamp(as_of) - F.unix_timestamp(latest)) / F.lit(60.0)
