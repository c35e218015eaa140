"""Measures on the star schema (KPI-*, WIN-*, SRT-04, JOIN-05, JOIN-06).

Facts are aggregated before they meet a dimension wherever the grain allows, so
joins see one row per group and not one per flight."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from contrail.operators.enrich import Dimension, join_dimension
from contrail.operators.quality import freshness_lag as _freshness
from contrail.operators.quantiles import exact_quantiles
from contrail.operators.skew import hot_hashes, key_hash
from contrail.operators.topk import top_n
from contrail.session import stage, stored

ROLES = ("dep", "arr")
FLIGHT_ORDER = ("first_seen_ts", "last_seen_ts", "flight_id")


def _role(role: str) -> str:
    if role not in ROLES:
        raise ValueError(f"role must be one of {ROLES}, not {role!r}")
    return role


def _minutes(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c) / F.lit(60.0)


def pct_true(flag: str) -> Column:
    """Per cent of all rows that carry the flag, 0..100."""
    return F.try_divide(F.count_if(F.col(flag)), F.count(F.lit(1))) * F.lit(100.0)


def slice_flights(
    flights: DataFrame,
    dates: tuple | None = None,
    airports: Sequence[str] | None = None,
    airlines: Sequence[str] | None = None,
) -> DataFrame:
    """KPI-17: any measure over part of the flights.  Plain comparisons, so the
    date range prunes partitions."""
    if dates is not None:
        flights = flights.where(F.col("dep_date_utc").between(*[F.lit(d) for d in dates]))
    if airports is not None:
        codes = list(airports)
        flights = flights.where(F.col("dep_icao").isin(codes) | F.col("arr_icao").isin(codes))
    if airlines is not None:
        flights = flights.where(F.col("airline_name").isin(list(airlines)))
    return flights


def star_join(
    flights: DataFrame,
    dates: DataFrame | Dimension,
    airports: DataFrame | Dimension,
    airlines: DataFrame | Dimension,
    prefixes: DataFrame | Dimension,
    role: str = "dep",
) -> DataFrame:
    """JOIN-05: flights with the attributes of all four dimensions; inner joins
    along the active relations."""
    role = _role(role)
    calendar = {"quarter": "quarter", "year": "year", "is_weekend": "is_weekend"}
    place = {"name": "airport_name", "region": "airport_region"}
    joined = join_dimension(flights, dates, {f"{role}_date_utc": "date"}, calendar, "inner")
    joined = join_dimension(joined, airports, {f"{role}_icao": "icao"}, place, "inner")
    joined = join_dimension(
        joined, prefixes, {"airline_prefix": "prefix"}, {"airline_name": "prefix_airline"}, "inner"
    )
    return join_dimension(joined, airlines, {"airline_name": "airline_name"}, {}, "inner")


def star_join_states(facts: DataFrame, dates: DataFrame | Dimension) -> DataFrame:
    """JOIN-05: daily telemetry facts with the attributes of their date; an inner join."""
    calendar = {"quarter": "quarter", "year": "year", "is_weekend": "is_weekend"}
    return join_dimension(facts, dates, {"event_date_utc": "date"}, calendar, "inner")


def flights_by_airport(flights: DataFrame, airports: DataFrame | Dimension, role: str) -> DataFrame:
    """KPI-02, JOIN-06: flights per airport, keyed by departure or by arrival."""
    code = f"{_role(role)}_icao"
    counts = flights.groupBy(F.col(code).alias("icao")).agg(F.count(F.lit(1)).alias("flights"))
    return join_dimension(counts, airports, {"icao": "icao"}, {"name": "airport_name"}, "inner")


def flights_by_airport_roles(flights: DataFrame, airports: DataFrame | Dimension) -> DataFrame:
    """Both roles in one scan: departures and arrivals per airport."""
    ends = flights.select(
        F.explode(
            F.array(
                F.struct(F.lit("dep").alias("role"), F.col("dep_icao").alias("icao")),
                F.struct(F.lit("arr").alias("role"), F.col("arr_icao").alias("icao")),
            )
        ).alias("end")
    ).select("end.role", "end.icao")
    counts = (
        ends.where(F.col("icao").isNotNull())
        .groupBy("icao")
        .agg(
            F.count_if(F.col("role") == "dep").alias("departures"),
            F.count_if(F.col("role") == "arr").alias("arrivals"),
        )
    )
    return join_dimension(counts, airports, {"icao": "icao"}, {"name": "airport_name"}, "inner")


def top_airports(flights: DataFrame, airports: DataFrame | Dimension, n: int = 10) -> DataFrame:
    both = flights_by_airport_roles(flights, airports)
    total = both.withColumn("movements", F.col("departures") + F.col("arrivals"))
    return top_n(total, n, "movements", "icao")


def top_routes(flights: DataFrame, n: int = 10) -> DataFrame:
    """KPI-03: count and mean block time per route."""
    routes = flights.groupBy("route_key").agg(
        F.count(F.lit(1)).alias("flights"), F.avg(_minutes("block_time_s")).alias("avg_block_min")
    )
    return top_n(routes, n, "flights", "route_key")


def airline_share(flights: DataFrame) -> DataFrame:
    """KPI-06, WIN-02: flights per airline name and per cent of all flights.  The
    window runs over one row per name in the airline reference."""
    counts = flights.groupBy("airline_name").agg(F.count(F.lit(1)).alias("flights"))
    total = F.sum("flights").over(Window.partitionBy(F.lit(0)))
    return counts.withColumn("share_pct", F.col("flights") / total * F.lit(100.0))


def top_airlines(flights: DataFrame, n: int = 10) -> DataFrame:
    named = flights.where(F.col("airline_name").isNotNull())
    counts = named.groupBy("airline_name").agg(F.count(F.lit(1)).alias("flights"))
    return top_n(counts, n, "flights", "airline_name")


def block_time_quantiles(flights: DataFrame, qs: Sequence[float] = (0.25, 0.5, 0.75, 0.95)) -> DataFrame:
    """KPI-05, KPI-16: interpolated quantiles of block time in minutes."""
    quantiles = exact_quantiles(flights, "block_time_s", qs)
    return quantiles.select("q", _minutes("value").alias("block_time_min"))


def median_block_time(flights: DataFrame) -> DataFrame:
    median = block_time_quantiles(flights, [0.5])
    return median.select(F.col("block_time_min").alias("median_block_time_min"))


def hour_dow_heatmap(flights: DataFrame, role: str = "dep") -> DataFrame:
    """KPI-07: flights per weekday (Monday = 0) and hour."""
    role = _role(role)
    return flights.groupBy(F.col(f"{role}_dow").alias("dow"), F.col(f"{role}_hour").alias("hour")).agg(
        F.count(F.lit(1)).alias("flights")
    )


def trend(flights: DataFrame, grain: str, role: str = "dep") -> DataFrame:
    """KPI-09: flights per ISO week number or per month."""
    if grain not in ("week", "month"):
        raise ValueError(f"grain must be week or month, not {grain!r}")
    period = F.col(f"{_role(role)}_{grain}").alias(grain)
    return flights.groupBy(period).agg(
        F.count(F.lit(1)).alias("flights"), F.avg(_minutes("block_time_s")).alias("avg_block_min")
    )


def daily_trend(flights: DataFrame, dates: DataFrame) -> DataFrame:
    """KPI-08: departures and arrivals per calendar date, 0 on quiet days.

    Counted per date in one scan, then joined to the calendar."""
    ends = flights.select(
        F.explode(
            F.array(
                F.struct(F.col("dep_date_utc").alias("date"), F.col("dep_icao").alias("icao"),
                         F.lit("dep").alias("role")),
                F.struct(F.col("arr_date_utc").alias("date"), F.col("arr_icao").alias("icao"),
                         F.lit("arr").alias("role")),
            )
        ).alias("end")
    ).select("end.*")
    counts = (
        ends.where(F.col("icao").isNotNull())
        .groupBy("date")
        .agg(
            F.count_if(F.col("role") == "dep").alias("departures"),
            F.count_if(F.col("role") == "arr").alias("arrivals"),
        )
    )
    return dates.select("date").join(counts, "date", "left").na.fill(0, ["departures", "arrivals"])


def unknown_airport_pct(flights: DataFrame) -> DataFrame:
    """KPI-13."""
    return flights.agg(
        pct_true("unknown_dep").alias("unknown_dep_pct"),
        pct_true("unknown_arr").alias("unknown_arr_pct"),
    )


def freshness_lag(df: DataFrame, ts: str, as_of) -> DataFrame:
    """KPI-14."""
    return df.agg(_freshness(ts, as_of).alias("freshness_lag_minutes"))


def turnaround(flights: DataFrame, hot: Sequence[int] | None = None, hex_ids: bool = False) -> DataFrame:
    """KPI-15, WIN-01: seconds from an arrival to the next departure of the same
    aircraft; NULL for its last flight.

    Flights of ordinary aircraft take one shuffle to a lead per aircraft; those of an aircraft
    that would make a task uneven are dealt into ranges of time (``_lead_in_ranges``).  ``hot``
    carries an earlier measurement of the hashes of such aircraft, say of the rows that the
    flights come from; without one the flights are stored and measured.  ``hex_ids`` says that
    all ids are lower-case hexadecimal of whole bytes, as ``text.slot_key`` makes them: they
    travel as bytes, which sort alike and take half the room."""
    rows = flights.select("flight_id", "icao24", "first_seen_ts", "last_seen_ts")
    if hex_ids:
        rows = rows.withColumn("flight_id", F.unhex("flight_id"))
    if hot is None or len(hot):
        # What the rows come from would be computed again by every pass.
        rows = stored(rows, "turnaround-rows")
    hot = hot_hashes(rows, ["icao24"]) if hot is None else list(hot)
    is_hot = key_hash(["icao24"]).isin(hot)
    per_aircraft = Window.partitionBy("icao24").orderBy(*FLIGHT_ORDER)
    linked = (rows.where(~is_hot) if hot else rows).withColumn("following", F.lead("first_seen_ts").over(per_aircraft))
    if hot:
        linked = linked.unionByName(_lead_in_ranges(rows.where(is_hot)))
    return linked.select(
        (F.lower(F.hex("flight_id")) if hex_ids else F.col("flight_id")).alias("flight_id"),
        "icao24",
        "last_seen_ts",
        F.col("following").alias("next_departure_ts"),
        (F.unix_timestamp("following") - F.unix_timestamp("last_seen_ts")).alias("turnaround_s"),
    )


def _lead_in_ranges(rows: DataFrame) -> DataFrame:
    """``rows`` with the next departure of the same aircraft as ``following``.

    A lead over all flights of an aircraft would put a busy one in a single task.  The
    flights are dealt into ranges of (aircraft, time) of about equal size and stored with the
    number of their range, so one aircraft may fill many.  The lead is taken per aircraft and
    range.  The last flight there is left open by it; these rows, at most one per range and
    aircraft, continue with the first departure of the aircraft's next range."""
    dealt = rows.repartitionByRange("icao24", *FLIGHT_ORDER).withColumn("_range", F.spark_partition_id())
    # Stored, so that a range computed again is the same one.
    ranged, _ = stage(dealt, "turnaround-ranges")
    in_range = Window.partitionBy("icao24", "_range").orderBy(*FLIGHT_ORDER)
    linked = ranged.withColumns(
        {
            "following": F.lead("first_seen_ts").over(in_range),
            "opens": F.first("first_seen_ts").over(in_range),
            "closes": F.lead(F.lit(False), 1, True).over(in_range),
        }
    )
    across = Window.partitionBy("icao24").orderBy("_range")
    inside = linked.where(~F.col("closes"))
    closing = linked.where("closes").withColumn("following", F.lead("opens").over(across))
    return inside.unionByName(closing).select(*rows.columns, "following")


def coverage_by_day(states: DataFrame) -> DataFrame:
    """KPI-10: mean coverage of the aircraft seen that day."""
    return states.groupBy("event_date_utc").agg(
        F.avg("coverage_pct").alias("coverage_pct"),
        F.count(F.lit(1)).alias("aircraft"),
        F.sum("pings_count").alias("pings"),
    )


def outlier_pct_by_day(states: DataFrame) -> DataFrame:
    """KPI-12: mean of the daily ratios, each aircraft counting the same."""
    return states.groupBy("event_date_utc").agg(
        F.avg("pct_velocity_outlier").alias("velocity_outlier_ratio"),
        F.avg("pct_alt_outlier").alias("altitude_outlier_ratio"),
    )


def p95_of_p95(states: DataFrame) -> DataFrame:
    """KPI-11: interpolated p95 over the per-aircraft p95 values, both in one pass."""
    measures = ["p95_velocity", "p95_altitude"]
    long = states.select(*measures).unpivot([], measures, "measure", "reading")
    p95 = exact_quantiles(long, "reading", [0.95], by=["measure"])
    return p95.select("measure", "value")


def kpi_cards(flights: DataFrame, states: DataFrame) -> DataFrame:
    """KPI-01, KPI-04 and the other dashboard cards, one row per card."""
    flight_cards = _cards(
        flights.agg(
            F.count(F.lit(1)).cast("double").alias("flights"),
            F.count("arr_icao").cast("double").alias("flights_arrivals"),
            F.count("dep_icao").cast("double").alias("flights_departures"),
            F.avg(_minutes("block_time_s")).alias("avg_block_time_min"),
            pct_true("unknown_dep").alias("unknown_dep_pct"),
            pct_true("unknown_arr").alias("unknown_arr_pct"),
        )
    )
    state_cards = _cards(
        states.agg(
            F.avg("coverage_pct").alias("coverage_pct"),
            F.avg("pct_velocity_outlier").alias("velocity_outlier_ratio"),
            F.avg("pct_alt_outlier").alias("altitude_outlier_ratio"),
        )
    )
    median = median_block_time(flights).select(
        F.lit("median_block_time_min").alias("card"), F.col("median_block_time_min").alias("value")
    )
    p95 = p95_of_p95(states).withColumnRenamed("measure", "card")
    return flight_cards.unionByName(median).unionByName(state_cards).unionByName(p95)


def _cards(one_row: DataFrame) -> DataFrame:
    return one_row.unpivot([], one_row.columns, "card", "value")
