"""Bronze-shaped inputs derived from whole sample tables (see FIXTURES.md, C).

``events`` play aircraft telemetry; order lines with their order, customer and
supplier play flights; nations play airports; market segments play airlines.
The mappings add the dirt of real feeds: blanks, mixed case, epochs in
milliseconds, absent values, duplicates.  No row of a table is left out."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from contrail.operators.skew import hot_hashes, skew_join

# Time of the run wherever a result carries one.
RUN_TS = datetime(2024, 2, 1, tzinfo=timezone.utc)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _epoch(c: str) -> Column:
    return F.unix_timestamp(F.col(c).cast("timestamp"))


def _text(c: str) -> Column:
    return F.col(c).cast("string")


def pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw state vectors, one per event.  ``_ingest_ts`` is an ingest sequence."""
    events = table(spark, sf_dir, "events")
    seconds = _epoch("ts")
    k = F.get_json_object("props", "$.k").cast("int")
    return events.select(
        F.concat(F.lit(" a"), _text("user_id"), F.lit(" ")).alias("icao24"),
        F.when(F.col("event_type") == "view", F.lit(None))
        .when(F.col("event_id") % 2 == 0, seconds)
        .otherwise(seconds * 1000 + 123)
        .alias("time_position"),
        seconds.alias("last_contact"),
        F.when(F.col("event_type") != "signup", F.col("value")).alias("velocity"),
        F.when(F.col("event_type") != "error", k * F.lit(250.0) - F.lit(600.0)).alias("geo_altitude"),
        (k * F.lit(2.0) - F.lit(95.0)).alias("latitude"),
        (F.col("value") - F.lit(200.0)).alias("longitude"),
        F.col("value").alias("true_track"),
        F.col("event_id").alias("_ingest_ts"),
        F.to_date("ts").alias("download_date"),
    )


def _aircraft() -> Column:
    return F.concat(F.lit("p"), _text("l_partkey")).alias("icao24")


def aircraft(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The aircraft of every order line, one row each."""
    return table(spark, sf_dir, "lineitem").select(_aircraft())


def legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw flights, one per order line.

    The two narrow tables meet first, so the line table is joined with one frame
    by order and one by supplier.  All of them grow, and an order or a supplier
    may hold a large share of the lines."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), "s_nationkey"
    )
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"
    )
    placed = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("l_orderkey"), "o_orderdate", "c_nationkey", "c_mktsegment"
    )
    hot = {key: hot_hashes(lines, [key]) for key in ("l_orderkey", "l_suppkey")}
    ordered = skew_join(lines, placed.hint("merge"), ["l_orderkey"], hot=hot["l_orderkey"])
    joined = skew_join(ordered, suppliers, ["l_suppkey"], hot=hot["l_suppkey"])
    line = F.col("l_linenumber")
    return joined.select(
        "l_orderkey",
        "l_linenumber",
        _aircraft(),
        F.when(line == 7, F.lit("  "))
        .when(line == 6, _text("l_orderkey"))
        .otherwise(
            F.concat(F.lit(" "), F.lower(F.substring("c_mktsegment", 1, 3)), _text("l_orderkey"))
        )
        .alias("callsign"),
        F.when(
            F.col("c_nationkey") % 5 != 4,
            F.concat(F.lit("n"), F.lpad(_text("c_nationkey"), 3, "0")),
        ).alias("estDepartureAirport"),
        F.when(
            F.col("s_nationkey") % 7 != 6,
            F.concat(F.lit(" N"), F.lpad(_text("s_nationkey"), 3, "0"), F.lit(" ")),
        ).alias("estArrivalAirport"),
        # The tables have dates only: hours and minutes come from the keys.
        (_epoch("o_orderdate") + F.col("l_orderkey") * 7919 % 86400).alias("firstSeen"),
        (_epoch("l_shipdate") + F.col("l_partkey") * 104729 % 86400).alias("lastSeen"),
        (F.col("l_partkey") * 100000 + F.col("l_suppkey")).alias("_ingest_ts"),
    )


def departures(flights: DataFrame) -> DataFrame:
    """What departure airports report: the flights whose origin is known."""
    return flights.where(F.col("estDepartureAirport").isNotNull()).withColumn(
        "_source_file", F.lit("departures")
    )


def arrivals(flights: DataFrame) -> DataFrame:
    """What arrival airports report: the flights whose destination is known."""
    return flights.where(F.col("estArrivalAirport").isNotNull()).withColumn(
        "_source_file", F.lit("arrivals")
    )


def ref_airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two untidy rows per nation; nations from 23 on have an invalid code."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    key = F.col("n_nationkey")
    kinds = F.explode(F.array(F.lit("CIVIL"), F.lit(" Military"))).alias("type")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.concat(F.when(key >= 23, F.lit(" ?")).otherwise(F.lit(" n")), F.lpad(key.cast("string"), 3, "0"))
        .alias("icao"),
        F.when(key % 9 == 0, F.lit(""))
        .otherwise(F.concat(F.lit("x"), F.lpad(key.cast("string"), 2, "0")))
        .alias("iata"),
        F.lower("n_name").alias("city"),
        F.col("r_name").alias("region"),
        F.concat(F.lit("  "), F.col("n_name"), F.lit(" airport")).alias("name"),
        kinds,
        "n_nationkey",
    ).select(
        "icao", "iata", "city", "region", "name", "type",
        F.when(F.col("type") == "CIVIL", F.lit(1))
        .when(F.col("n_nationkey") % 5 != 0, F.col("n_nationkey") % 3)
        .cast("long")
        .alias("_ingest_ts"),
    )


def ref_airlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per market segment (one with an invalid prefix), a newer duplicate,
    an invalid prefix and a blank name."""
    segments = table(spark, sf_dir, "customer").select("c_mktsegment").distinct()
    segment = F.col("c_mktsegment")
    lead = F.when(segment == "FURNITURE", F.lit(" 1")).otherwise(F.lit(" "))
    named = segments.select(
        F.concat(lead, F.lower(F.substring(segment, 1, 3)), F.lit(" ")).alias("prefix"),
        F.concat(F.lower(segment), F.lit(" AIR ")).alias("airline"),
        F.lit(1).cast("long").alias("_ingest_ts"),
    )
    extra = [("HOU", " household express", 2), ("1bad", "nobody", 1), ("ZZZ", "   ", 1)]
    return named.unionByName(spark.createDataFrame(extra, "prefix string, airline string, _ingest_ts long"))


def raw_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File names as the capture would write them, some without date or stamp."""
    events = table(spark, sf_dir, "events")
    day = F.to_date("ts")
    return events.select(
        "event_id",
        F.concat(
            F.lit("/raw/flights_departure/tag="),
            F.when(F.col("user_id") % 2 == 0, F.lit("lemd")).otherwise(F.lit("LEBL")),
            F.when(F.col("event_id") % 7 == 0, F.lit("")).otherwise(
                F.concat(F.lit("/date="), day.cast("string"))
            ),
            F.lit("/flights_departure_x"),
            F.when(F.col("event_id") % 3 == 0, F.lit("")).otherwise(
                F.concat(F.lit("_"), F.date_format("ts", "yyyyMMdd'T'HHmmss"), F.lit("Z"))
            ),
            F.lit(".json.gz"),
        ).alias("path"),
        day.alias("ingest_date"),
    )


def _days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(F.to_date("ts").alias("d")).distinct()


def _day_file(c: Column) -> Column:
    return F.concat(F.lit("day="), c.cast("string"))


def day_files(spark: SparkSession, sf_dir: str, shift: int = 0) -> DataFrame:
    """One input file per day of the events, ``shift`` days later."""
    return _days(spark, sf_dir).select(_day_file(F.date_add("d", shift)).alias("source_file"))


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ledger entry per day of the events."""
    day = F.day("d")
    return _days(spark, sf_dir).select(
        F.lit("events").alias("dataset"),
        _day_file(F.col("d")).alias("source_file"),
        F.concat(F.lit("run"), (day % 5).cast("string")).alias("ingest_id"),
        F.col("d").cast("timestamp").alias("processed_ts"),
        F.when(day % 3 == 0, F.lit("failed"))
        .when(day % 3 == 1, F.lit("processing"))
        .otherwise(F.lit("done"))
        .alias("status"),
        F.when(day % 4 != 0, F.md5(_day_file(F.col("d")))).alias("file_hash"),
        F.when(day % 2 == 0, F.lit("v1")).otherwise(F.lit("v2")).alias("version"),
    )


def incoming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next run's entries: ten days later, so old, repeated and new ones."""
    later = F.date_add("d", 10)
    day = F.day(later)
    return _days(spark, sf_dir).select(
        F.lit("events").alias("dataset"),
        _day_file(later).alias("source_file"),
        F.lit("run9").alias("ingest_id"),
        F.lit(RUN_TS).cast("timestamp").alias("processed_ts"),
        F.when(day % 3 == 0, F.lit("failed")).otherwise(F.lit("done")).alias("status"),
        F.when(day % 8 != 0, F.md5(_day_file(later))).alias("file_hash"),
        F.when(day % 2 == 0, F.lit("v1")).otherwise(F.lit("v2")).alias("version"),
    )


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger history: one entry per day and event type, several per file."""
    events = table(spark, sf_dir, "events")
    kind = F.col("event_type")
    grouped = events.groupBy(F.to_date("ts").alias("d"), kind).agg(F.max("ts").alias("t"))
    return grouped.select(
        F.lit("events").alias("dataset"),
        _day_file(F.col("d")).alias("source_file"),
        kind.alias("ingest_id"),
        F.col("t").cast("timestamp").alias("processed_ts"),
        F.when(kind.isin("error", "signup"), F.lit("failed")).otherwise(F.lit("done")).alias("status"),
        F.when(
            kind != "view", F.md5(F.concat(_day_file(F.col("d")), F.when(kind == "click", F.lit("!")).otherwise(F.lit(""))))
        ).alias("file_hash"),
        F.when(F.day("d") % 2 == 0, F.lit("v1")).otherwise(F.lit("v2")).alias("version"),
    )


def current_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots on disk now: the days of the log and ten later ones."""
    later = F.date_add("d", 10)
    return _days(spark, sf_dir).select(
        F.lit("events").alias("dataset"),
        _day_file(later).alias("source_file"),
        F.md5(_day_file(later)).alias("file_hash"),
        F.lit("v2").alias("version"),
    )
