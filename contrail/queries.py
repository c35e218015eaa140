"""Registered queries: every operator over the whole sample tables.

Each takes ``(spark, sf_dir)`` and returns a DataFrame.  Averages and ratios are
rounded to six digits here, at the edge, so that other engines can agree."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from contrail import samples
from contrail.functions import checks, paths, text, times
from contrail.functions.vectors import vector_fields
from contrail.operators import (
    dedupe,
    enrich,
    hashing,
    merge,
    project,
    quality,
    rollup,
    skew,
    topk,
)
from contrail.operators.enrich import Dimension
from contrail.plans import gold, measures, silver
from contrail.samples import RUN_TS
from contrail.session import pin_utc, scratch_path, stage
from contrail.sources import ledger, sums, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

FEEDS = {"departures": "dep_icao", "arrivals": "arr_icao"}
AIRPORT_HASH_COLUMNS = ("icao", "iata", "name", "city", "region", "type")


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(pin_utc(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return fn


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


# Products the queries share.


def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_states(samples.pings(spark, sf_dir), RUN_TS)


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.fact_states(states(spark, sf_dir), RUN_TS)


def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_ref_airports(samples.ref_airports(spark, sf_dir), RUN_TS)


def airlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_ref_airlines(samples.ref_airlines(spark, sf_dir), RUN_TS)


def airport_dimension(spark: SparkSession, sf_dir: str) -> Dimension:
    return Dimension.of(airports(spark, sf_dir))


def airline_dimension(spark: SparkSession, sf_dir: str) -> Dimension:
    return Dimension.of(airlines(spark, sf_dir))


def references(spark: SparkSession, sf_dir: str) -> tuple[Dimension, Dimension]:
    return airline_dimension(spark, sf_dir), airport_dimension(spark, sf_dir)


def clean_legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.derive_flights(silver.identify_flights(samples.legs(spark, sf_dir)))


def feeds(spark: SparkSession, sf_dir: str, refs=None) -> DataFrame:
    """Silver flights of both feeds, from one pass over the legs."""
    ref_airlines, ref_airports = refs or references(spark, sf_dir)
    legs = samples.legs(spark, sf_dir)
    return silver.silver_flight_feeds(legs, ref_airlines, ref_airports, FEEDS, RUN_TS)


def flights(spark: SparkSession, sf_dir: str, refs=None) -> DataFrame:
    return gold.freshest_flights(feeds(spark, sf_dir, refs), RUN_TS)


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every date from the first order to the last shipment."""
    first = samples.table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("d"))
    last = samples.table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("d"))
    bounds = first.unionByName(last).agg(F.min("d").alias("first"), F.max("d").alias("last"))
    return gold.calendar_between(bounds, "first", "last")


# Scans, sinks, file state.


@query
def json_quarantine(spark, sf_dir):
    """SRC-02: malformed and wrong-typed JSON keeps its text."""
    events = samples.table(spark, sf_dir, "events")
    raw = (
        F.when(F.col("event_type") == "error", F.expr("substring(props, 1, length(props) - 1)"))
        .when(F.col("event_type") == "signup", F.replace("props", F.lit(": "), F.lit(': "x')))
        .otherwise(F.col("props"))
    )
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    parsed = F.from_json(raw, "k int, _corrupt_record string", options)
    return events.select("event_id", parsed.alias("j")).select(
        "event_id", F.col("j.k").alias("k"), F.col("j._corrupt_record").alias("corrupt_record")
    )


@query
def scan_partition_prune(spark, sf_dir):
    """SRC-04, SNK-01: a date-partitioned table read for a range of dates."""
    events = samples.table(spark, sf_dir, "events").withColumn("download_date", F.to_date("ts"))
    path = scratch_path(spark, "events_by_date")
    tables.append(events.select("event_id", "event_type", "download_date"), path, ["download_date"])
    in_range = F.col("download_date").between(F.lit(date(2024, 1, 8)), F.lit(date(2024, 1, 21)))
    return (
        tables.read(spark, path)
        .where(in_range)
        .groupBy("download_date", "event_type")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


@query
def discover_new_files(spark, sf_dir):
    """SRC-06."""
    candidates = samples.day_files(spark, sf_dir, shift=10)
    return ledger.new_files(candidates, samples.manifest(spark, sf_dir), "events")


@query
def anti_join_done(spark, sf_dir):
    """JOIN-03 at table size: flights of the arrival feed the other one lacks."""
    keys = ["l_orderkey", "l_linenumber"]
    ends = ["estDepartureAirport", "estArrivalAirport"]
    legs, _ = stage(samples.legs(spark, sf_dir).select(*keys, *ends, "icao24", "lastSeen"), "legs")
    arrivals, done = samples.arrivals(legs), samples.departures(legs)
    missing = merge.anti_join(arrivals, done, keys, skew.hot_hashes(legs, keys))
    return missing.select(*keys, "icao24", "lastSeen")


@query
def snapshot_changed(spark, sf_dir):
    """SRC-07."""
    return ledger.change_gate(samples.current_files(spark, sf_dir), samples.run_log(spark, sf_dir))


@query
def needs_processing(spark, sf_dir):
    """SRC-08."""
    current = samples.current_files(spark, sf_dir)
    return ledger.change_gate(current, samples.run_log(spark, sf_dir), with_version=True)


@query
def version_gate(spark, sf_dir):
    """SRC-08 without a hash."""
    current = samples.current_files(spark, sf_dir).drop("file_hash")
    return ledger.version_gate(current, samples.run_log(spark, sf_dir))


@query
def latest_manifest_row(spark, sf_dir):
    """SRT-02."""
    log = samples.run_log(spark, sf_dir)
    newest = topk.latest_row(log, F.col("status") == "done", "processed_ts")
    return newest.select("source_file", "ingest_id", "file_hash", "version")


@query
def manifest_merge(spark, sf_dir):
    """SNK-05."""
    merged = ledger.merge_entries(
        samples.manifest(spark, sf_dir),
        samples.incoming(spark, sf_dir),
        compared=("status", "file_hash", "version"),
    )
    return merged.withColumn("processed_ts", F.unix_timestamp("processed_ts"))


def _leg_versions(spark, sf_dir):
    """Two versions of the flight list: by earliest and by latest sighting."""
    keys = ["l_orderkey", "l_linenumber"]
    columns = [*keys, "icao24", "lastSeen", "_ingest_ts", "_source_file"]
    legs = samples.legs(spark, sf_dir)
    order = ["lastSeen", "_ingest_ts"]
    old = dedupe.earliest_per_key(samples.departures(legs).select(*columns), keys, order)
    new = dedupe.latest_per_key(samples.arrivals(legs).select(*columns), keys, order)
    return keys, old, new


@query
def merge_upsert(spark, sf_dir):
    """SNK-04."""
    keys, old, new = _leg_versions(spark, sf_dir)
    return merge.upsert(old, new, keys)


@query
def merge_set_columns(spark, sf_dir):
    """SNK-04 with an update map and a condition."""
    keys, old, new = _leg_versions(spark, sf_dir)
    later = F.col("s.lastSeen") > F.col("t.lastSeen")
    return merge.merge(old, new, keys, {"lastSeen": F.col("s.lastSeen")}, later)


@query
def upsert_newest(spark, sf_dir):
    """STM-02: out-of-order upsert, the newest row wins."""
    keys, old, new = _leg_versions(spark, sf_dir)
    return merge.upsert_newest(old, new, keys, ["lastSeen", "_ingest_ts"])


@query
def merge_upsert_compound_key(spark, sf_dir):
    """JOIN-04: daily facts, those with speed readings first."""
    source = states(spark, sf_dir)
    columns = ["icao24", "event_date_utc", "pings_count", "p95_velocity", "p95_altitude"]
    old = rollup.daily_states(source.where(F.col("velocity_mps").isNotNull())).select(*columns)
    new = rollup.daily_states(source.where(F.col("geo_alt_m").isNotNull())).select(*columns)
    return merge.upsert(old, new, ["icao24", "event_date_utc"])


@query
def export_roundtrip(spark, sf_dir):
    """SNK-07: the daily facts as a BI snapshot, read back."""
    path = scratch_path(spark, "export")
    tables.export(daily(spark, sf_dir), path)
    columns = ["icao24", "event_date_utc", "pings_count", "p95_velocity", "p95_altitude"]
    return tables.read(spark, path).select(*columns)


@query
def stored_upsert_new_column(spark, sf_dir):
    """SNK-04, SRC-05: three stored upserts; the second brings a column that the first and
    the third do not have, and no value is lost."""
    orders = samples.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    path = scratch_path(spark, "orders")
    batches = {
        "first": orders.drop("o_orderpriority"),
        "second": orders.where("o_orderstatus = 'O'").withColumnRenamed("o_orderpriority", "priority"),
        "third": orders.where("o_orderpriority = '1-URGENT'").drop("o_orderpriority"),
    }
    for name, batch in batches.items():
        named = batch.withColumn("batch", F.lit(name))
        tables.upsert_table(named, path, ["o_orderkey"], ["o_orderstatus"], key_fixes_partition=True)
    return tables.read(spark, path).select("o_orderkey", "o_orderstatus", "batch", "priority")


@query
def stored_upsert_moving_key(spark, sf_dir):
    """SNK-04, JOIN-04: keys move between stored partitions, one of which they leave empty and
    one of which has signs in its name; the digest of keys says where they were."""
    orders = samples.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    path = scratch_path(spark, "orders")
    batches = {
        "first": orders,
        "second": orders.where("o_orderstatus = 'P'").withColumn("o_orderstatus", F.lit("was: P/moved")),
        "third": orders.where("o_orderpriority = '1-URGENT'").withColumn("o_orderstatus", F.lit("O")),
    }
    for name, batch in batches.items():
        tables.upsert_table(batch.withColumn("batch", F.lit(name)), path, ["o_orderkey"], ["o_orderstatus"])
    return tables.read(spark, path).select("o_orderkey", "o_orderstatus", "batch")


# Projections, filters, predicates.


@query
def select_allowlist(spark, sf_dir):
    """PRJ-01."""
    wanted = ["o_orderkey", "not_a_column", "o_orderstatus", "o_custkey"]
    return project.select_allowlist(samples.table(spark, sf_dir, "orders"), wanted)


@query
def path_timestamps(spark, sf_dir):
    """PRJ-03, DAT-06."""
    path = F.col("path")
    return samples.raw_paths(spark, sf_dir).select(
        "event_id",
        paths.download_ts(path).alias("download_ts"),
        paths.directory_date(path).alias("directory_date"),
        paths.download_date(path, F.col("ingest_date")).alias("download_date"),
    )


@query
def path_tag(spark, sf_dir):
    """PRJ-04."""
    return samples.raw_paths(spark, sf_dir).select("event_id", paths.path_tag(F.col("path")).alias("tag"))


@query
def layer_metadata(spark, sf_dir):
    """PRJ-05."""
    nations = samples.table(spark, sf_dir, "events").select("event_id")
    return project.add_layer_metadata(
        nations, "silver", "bronze.events", RUN_TS, "v2.1.0", "run-7", "events_job"
    )


@query
def rename_cast(spark, sf_dir):
    """PRJ-06."""
    return samples.pings(spark, sf_dir).select(
        F.col("icao24"),
        F.col("velocity").cast("double").alias("velocity_mps"),
        F.col("geo_altitude").cast("double").alias("geo_alt_m"),
        F.col("time_position").cast("bigint").alias("time_pos_raw"),
        F.col("last_contact").cast("bigint").alias("last_contact_raw"),
    )


@query
def filter_keys_not_null(spark, sf_dir):
    """FLT-01."""
    columns = ["icao24", "time_position", "velocity"]
    return project.require_keys(samples.pings(spark, sf_dir).select(*columns), *columns)


@query
def validate_codes(spark, sf_dir):
    """FLT-02."""
    code, iata = text.normalize_str("icao"), text.normalize_str("iata")
    return samples.ref_airports(spark, sf_dir).select(
        F.col("icao").alias("raw_icao"),
        F.col("iata").alias("raw_iata"),
        "type",
        text.matching(code, text.ICAO_PATTERN).alias("icao"),
        text.matching(iata, text.IATA_PATTERN).alias("iata"),
    )


@query
def normalize_prefix(spark, sf_dir):
    """FLT-03 on the customer names and segments."""
    customer = samples.table(spark, sf_dir, "customer")
    return customer.select(
        "c_custkey",
        text.ref_prefix(text.normalize_str("c_mktsegment")).alias("segment_prefix"),
        text.ref_prefix(F.lower("c_mktsegment")).alias("lower_prefix"),
        text.ref_prefix(F.upper("c_name")).alias("name_prefix"),
    )


@query
def outlier_flags(spark, sf_dir):
    """FLT-04."""
    return samples.pings(spark, sf_dir).select(
        F.col("_ingest_ts").alias("event_id"),
        checks.outside("velocity", checks.VELOCITY_RANGE_MPS).alias("flag_velocity_outlier"),
        checks.outside("geo_altitude", checks.ALTITUDE_RANGE_M).alias("flag_alt_outlier"),
    )


@query
def unknown_flags(spark, sf_dir):
    """FLT-05."""
    ref_airports = airport_dimension(spark, sf_dir)
    enriched = silver.enrich_airports(clean_legs(spark, sf_dir), ref_airports)
    return enriched.select("flight_id", "dep_icao", "arr_icao", "unknown_dep", "unknown_arr")


@query
def geo_validity(spark, sf_dir):
    """FLT-06."""
    return samples.pings(spark, sf_dir).select(
        F.col("_ingest_ts").alias("event_id"),
        checks.within_or_null("latitude", checks.LATITUDE_RANGE).alias("latitude"),
        F.round(checks.within_or_null("longitude", checks.LONGITUDE_RANGE), 6).alias("longitude"),
        F.round(checks.wrap_heading("true_track"), 6).alias("true_track"),
    )


@query
def nonnegative_block_time(spark, sf_dir):
    """FLT-07."""
    legs = clean_legs(spark, sf_dir)
    return legs.where(F.col("block_time_s") >= 0).select("flight_id", "block_time_s")


@query
def bbox_filter(spark, sf_dir):
    """FLT-08."""
    pings = samples.pings(spark, sf_dir)
    return pings.where(checks.in_box("latitude", "longitude")).select(
        F.col("_ingest_ts").alias("event_id"), "latitude", F.round("longitude", 6).alias("longitude")
    )


# Joins.


@query
def enrich_airline(spark, sf_dir):
    """JOIN-01."""
    ref_airlines = airline_dimension(spark, sf_dir)
    enriched = silver.enrich_airline(clean_legs(spark, sf_dir), ref_airlines)
    return enriched.select("flight_id", "callsign_norm", "airline_prefix", "airline_name")


@query
def enrich_airports_role_playing(spark, sf_dir):
    """JOIN-02."""
    ref_airports = airport_dimension(spark, sf_dir)
    enriched = silver.enrich_airports(clean_legs(spark, sf_dir), ref_airports)
    return enriched.select("flight_id", "dep_icao", "dep_iata", "arr_icao", "arr_iata")


@query
def enrich_salted(spark, sf_dir):
    """JOIN-01 the way it runs when the dimension is too large to broadcast: the
    customers themselves, per order."""
    orders = samples.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customers = samples.table(spark, sf_dir, "customer")
    large = Dimension(customers, small=False)
    return enrich.join_dimension(
        orders, large, {"o_custkey": "c_custkey"}, {"c_mktsegment": "segment"}
    )


@query
def enrich_no_fanout(spark, sf_dir):
    """JOIN-07: as many rows after the joins as before, with clean references and with the
    untidy ones, which have two rows per code; how many found both attributes."""
    legs = clean_legs(spark, sf_dir)
    before = legs.agg(F.count(F.lit(1)).alias("rows"), F.lit(0).cast("long").alias("matched"))
    sides = [before.select(F.lit("before").alias("side"), "rows", "matched")]
    raw_airlines, raw_airports = samples.ref_airlines(spark, sf_dir), samples.ref_airports(spark, sf_dir)
    inputs = {
        "clean references": references(spark, sf_dir),
        "untidy references": (silver.clean_ref_airlines(raw_airlines), silver.clean_ref_airports(raw_airports)),
    }
    for side, (ref_airlines, ref_airports) in inputs.items():
        joined = enrich.join_dimension(
            legs, ref_airlines, {"airline_prefix": "prefix"}, {"prefix": "known_prefix"}
        )
        joined = enrich.join_dimension(joined, ref_airports, {"dep_icao": "icao"}, {"icao": "known_icao"})
        both = F.col("known_prefix").isNotNull() & F.col("known_icao").isNotNull()
        sides.append(
            joined.agg(F.count(F.lit(1)).alias("rows"), F.count_if(both).alias("matched")).select(
                F.lit(side).alias("side"), "rows", "matched"
            )
        )
    return sides[0].unionByName(sides[1]).unionByName(sides[2])


@query
def star_join(spark, sf_dir):
    """JOIN-05."""
    refs = references(spark, sf_dir)
    columns = ["dep_date_utc", "dep_icao", "airline_prefix", "airline_name", "block_time_s"]
    fact, _ = stage(flights(spark, sf_dir, refs).select(*columns), "fact_flights")
    joined = measures.star_join(
        fact,
        calendar(spark, sf_dir),
        gold.dim_airports(refs[1].frame, RUN_TS),
        gold.dim_airlines(fact, RUN_TS),
        gold.dim_prefixes(refs[0].frame, RUN_TS),
    )
    return joined.groupBy("year", "quarter", "is_weekend", "airport_region", "airline_name").agg(
        F.count(F.lit(1)).alias("flights"), F.sum("block_time_s").alias("block_time_s")
    )


@query
def star_join_states(spark, sf_dir):
    """JOIN-05: the daily telemetry facts along their relation to the dates."""
    facts = daily(spark, sf_dir)
    bounds = facts.agg(F.min("event_date_utc").alias("first"), F.max("event_date_utc").alias("last"))
    dates = gold.calendar_between(bounds, "first", "last")
    joined = measures.star_join_states(facts, dates)
    return joined.groupBy("year", "quarter", "is_weekend").agg(
        F.count(F.lit(1)).alias("aircraft_days"), F.sum("pings_count").alias("pings")
    )


@query
def flights_by_airport_role(spark, sf_dir):
    """JOIN-06, KPI-02: the same measure along both relations."""
    refs = references(spark, sf_dir)
    ends = flights(spark, sf_dir, refs).select("dep_icao", "arr_icao")
    fact, _ = stage(ends, "fact_flights")
    dim = Dimension.of(gold.dim_airports(refs[1].frame, RUN_TS))
    by_role = [
        measures.flights_by_airport(fact, dim, role).withColumn("role", F.lit(role))
        for role in measures.ROLES
    ]
    return by_role[0].unionByName(by_role[1])


# Aggregations.


@query
def fact_states(spark, sf_dir):
    """AGG-01, FCT-02."""
    result = rounded(daily(spark, sf_dir), "pct_velocity_outlier", "pct_alt_outlier", "coverage_pct")
    return result


@query
def p95_by_entity(spark, sf_dir):
    """AGG-03."""
    pings = states(spark, sf_dir)
    return pings.groupBy("icao24").agg(
        rollup.p95("velocity_mps").alias("p95_velocity"), rollup.p95("geo_alt_m").alias("p95_altitude")
    )


@query
def outlier_ratio(spark, sf_dir):
    """AGG-04."""
    ratios = states(spark, sf_dir).groupBy("icao24").agg(
        rollup.true_ratio("flag_velocity_outlier").alias("pct_velocity_outlier"),
        rollup.true_ratio("flag_alt_outlier").alias("pct_alt_outlier"),
    )
    return rounded(ratios, "pct_velocity_outlier", "pct_alt_outlier")


@query
def coverage_pct(spark, sf_dir):
    """AGG-06."""
    pings = samples.pings(spark, sf_dir)
    counts = pings.groupBy("icao24", "download_date").agg(F.count(F.lit(1)).alias("pings_count"))
    return rounded(counts.withColumn("coverage_pct", rollup.coverage_pct("pings_count")), "coverage_pct")


@query
def null_profile(spark, sf_dir):
    """AGG-07."""
    pings = samples.pings(spark, sf_dir)
    columns = ["icao24", "time_position", "last_contact", "velocity", "geo_altitude"]
    return pings.agg(quality.null_counts(columns).alias("nulls_json"))


@query
def dup_ratio(spark, sf_dir):
    """AGG-10."""
    hourly = silver.clean_states(samples.pings(spark, sf_dir)).withColumn(
        "hour", F.date_trunc("hour", "time_ts")
    )
    return rounded(quality.dup_ratio(hourly, ["icao24", "hour"]), "dup_ratio")


@query
def unknown_pct(spark, sf_dir):
    """AGG-11."""
    either = F.col("unknown_dep") | F.col("unknown_arr")
    result = flights(spark, sf_dir).agg(quality.unknown_ratio(either).alias("unknown_pct"))
    return rounded(result, "unknown_pct")


@query
def freshness_lag(spark, sf_dir):
    """AGG-12, KPI-14."""
    return rounded(measures.freshness_lag(states(spark, sf_dir), "time_ts", RUN_TS), "freshness_lag_minutes")


@query
def outlier_counts(spark, sf_dir):
    """AGG-13, STR-08."""
    flags = {
        "velocity_outliers": F.col("flag_velocity_outlier"),
        "alt_outliers": F.col("flag_alt_outlier"),
    }
    return states(spark, sf_dir).agg(quality.counts_json(flags).alias("extras_json"))


@query
def run_metrics(spark, sf_dir):
    """AGG-14: the metrics row of a silver telemetry run."""
    clean = silver.clean_states(samples.pings(spark, sf_dir))
    result = states(spark, sf_dir)
    flags = {
        "velocity_outliers": F.col("flag_velocity_outlier"),
        "alt_outliers": F.col("flag_alt_outlier"),
    }
    metrics = quality.run_metrics(
        result,
        dataset="silver.states",
        source_key="batch://silver.states/run-7",
        ingest_id="run-7",
        processed_ts=RUN_TS,
        rows_in=clean.count(),
        exclude=silver.LINEAGE,
        fresh="time_ts",
        extras=quality.counts_json(flags),
        notes="silver.states upsert ok",
    )
    return rounded(metrics, "dup_ratio", "freshness_lag_minutes")


@query
def dataset_content_hash(spark, sf_dir):
    """AGG-15, ARR-02: the published hash of a reference snapshot."""
    return hashing.content_hash(airports(spark, sf_dir), AIRPORT_HASH_COLUMNS)


@query
def dataset_tree_hash(spark, sf_dir):
    """AGG-15 for tables of any size; no row is shuffled."""
    lines = samples.table(spark, sf_dir, "lineitem")
    return hashing.multiset_hash(lines, ["l_orderkey", "l_linenumber", "l_partkey", "l_returnflag"])


@query
def stored_hash_after_upsert(spark, sf_dir):
    """AGG-15 kept up: orders are stored by status, some move and change, and the hash follows
    from the sums of the rewritten partitions and the kept ones of the others."""
    orders = samples.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    path, hashed = scratch_path(spark, "orders"), ["o_orderkey", "o_orderstatus", "o_orderpriority"]
    tables.upsert_table(orders, path, ["o_orderkey"], ["o_orderstatus"])
    sums.build(spark, path, hashed, ["o_orderstatus"])
    for change in (
        orders.where("o_orderstatus = 'P'").withColumn("o_orderstatus", F.lit("O")),
        orders.where("o_orderstatus = 'O'").withColumn("o_orderpriority", F.lit("none")),
    ):
        rewritten = tables.upsert_table(change, path, ["o_orderkey"], ["o_orderstatus"])
        sums.refresh(spark, path, hashed, ["o_orderstatus"], rewritten)
    return sums.content_hash(spark, path)


@query
def distinct_pairs(spark, sf_dir):
    """AGG-16."""
    return dedupe.distinct_values(clean_legs(spark, sf_dir), "dep_icao", "arr_icao")


# Dedupe.


def _hourly(spark, sf_dir):
    columns = ["icao24", "hour", "_ingest_ts", "velocity_mps", "geo_alt_m"]
    clean = silver.clean_states(samples.pings(spark, sf_dir))
    hour = F.unix_timestamp(F.date_trunc("hour", "time_ts"))
    return clean.withColumn("hour", hour).select(*columns)


@query
def dedupe_latest(spark, sf_dir):
    """DED-01."""
    return dedupe.latest_per_key(_hourly(spark, sf_dir), ["icao24", "hour"], ["_ingest_ts"])


@query
def dedupe_earliest(spark, sf_dir):
    """DED-02."""
    return dedupe.earliest_per_key(_hourly(spark, sf_dir), ["icao24", "hour"], ["_ingest_ts"])


@query
def dedupe_nulls_last(spark, sf_dir):
    """DED-03: readings without speed lose."""
    return dedupe.latest_per_key(
        _hourly(spark, sf_dir), ["icao24", "hour"], ["velocity_mps", "_ingest_ts"]
    )


@query
def union_by_name(spark, sf_dir):
    """SET-01."""
    legs = samples.legs(spark, sf_dir)
    dep = samples.departures(legs).select("l_orderkey", "l_linenumber", "_source_file", "callsign")
    arr = samples.arrivals(legs).select("_source_file", "l_linenumber", "l_orderkey", "lastSeen")
    return project.union_by_name(dep, arr)


# Scalar functions.


@query
def normalize_strings(spark, sf_dir):
    """STR-01, STR-02, STR-04."""
    legs = samples.legs(spark, sf_dir)
    return legs.select(
        "l_orderkey",
        "l_linenumber",
        text.normalize_str("estArrivalAirport").alias("arr_icao"),
        text.normalize_callsign("callsign").alias("callsign_norm"),
        text.lower_str("estArrivalAirport").alias("arr_lower"),
    )


@query
def initcap_names(spark, sf_dir):
    """STR-03."""
    part = samples.table(spark, sf_dir, "part")
    dirty = F.concat(F.lit("  "), F.upper("p_name"), F.lit(" d'or/x "), F.lower("p_type"), F.lit(" "))
    return part.select("p_partkey", text.title_str(dirty).alias("name"))


@query
def callsign_prefix(spark, sf_dir):
    """STR-05: first published form and the join form."""
    legs = samples.legs(spark, sf_dir)
    callsign = text.normalize_callsign("callsign")
    return legs.select(
        "l_orderkey",
        "l_linenumber",
        text.callsign_prefix(callsign).alias("prefix"),
        text.airline_prefix(callsign).alias("airline_prefix"),
    )


@query
def route_key(spark, sf_dir):
    """STR-06."""
    legs = samples.legs(spark, sf_dir)
    dep, arr = text.normalize_str("estDepartureAirport"), text.normalize_str("estArrivalAirport")
    return legs.select("l_orderkey", "l_linenumber", text.route_key(dep, arr).alias("route_key"))


@query
def flight_key(spark, sf_dir):
    """STR-07: first published form and the collision-free one."""
    clean = clean_legs(spark, sf_dir)
    parts = ["icao24", "dep_icao", "arr_icao", "first_seen_ts", "last_seen_ts"]
    return clean.select(*parts[:3], text.joined_key(*parts).alias("joined_key"), "flight_id")


@query
def epoch_to_ts(spark, sf_dir):
    """DAT-01, DAT-02."""
    epoch = F.coalesce("time_position", "last_contact")
    return samples.pings(spark, sf_dir).select(
        F.col("_ingest_ts").alias("event_id"),
        times.epoch_seconds(epoch).alias("epoch_s"),
        times.epoch_to_ts(epoch).alias("time_ts"),
    )


@query
def calendar_columns(spark, sf_dir):
    """DAT-03."""
    orders = samples.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("timestamp").alias("ts")
    )
    return times.add_calendar(orders, "ts", "dep").drop("ts")


@query
def dow_both(spark, sf_dir):
    """DAT-04."""
    return samples.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        times.day_of_week("o_orderdate").cast("int").alias("dow_monday_0"),
        times.day_of_week_sunday_first("o_orderdate").cast("int").alias("dow_sunday_1"),
    )


@query
def block_time(spark, sf_dir):
    """DAT-05."""
    return clean_legs(spark, sf_dir).select("flight_id", "block_time_s")


@query
def dim_dates(spark, sf_dir):
    """DIM-04, ARR-01, DAT-07: around the last day of the events."""
    as_of = samples.table(spark, sf_dir, "events").agg(F.to_date(F.max("ts")).alias("as_of"))
    return gold.dates_around(as_of, "as_of", years_back=5, years_fwd=2)


@query
def decode_positional(spark, sf_dir):
    """ARR-03: state vectors as text arrays, half of them extended."""
    pings = samples.pings(spark, sf_dir)
    extended = F.col("_ingest_ts") % 2 == 1
    cells = [
        F.col("icao24"),
        F.when(F.col("velocity").isNull(), F.lit(" \t")).otherwise(F.concat(F.lit("\tibe"), F.col("_ingest_ts").cast("string"))),
        F.lit("Spain"),
        F.col("time_position").cast("string"),
        F.col("last_contact").cast("string"),
        F.lit(None).cast("string"),
        F.col("latitude").cast("string"),
        F.lit(None).cast("string"),
        extended.cast("string"),
        F.col("velocity").cast("string"),
        F.col("true_track").cast("string"),
        F.lit("n/a"),
        F.lit(None).cast("string"),
        F.col("geo_altitude").cast("string"),
        F.lit("7000"),
        F.lit("false"),
        F.lit("0"),
    ]
    vector = F.when(extended, F.array(*cells, F.lit("3"))).otherwise(F.array(*cells))
    decoded = pings.select("_ingest_ts", F.explode(F.array(vector)).alias("v")).select(
        F.col("_ingest_ts").alias("event_id"), *vector_fields(F.col("v"))
    )
    return decoded.drop("sensors")


@query
def priority_topk(spark, sf_dir):
    """SRT-03."""
    priorities = ["N017", "N003", "LEMD", "N011"]
    return topk.priority_topk(samples.ref_airports(spark, sf_dir), "icao", priorities, 12)


# Data products.


@query
def silver_states(spark, sf_dir):
    """SLV-01."""
    return states(spark, sf_dir)


@query
def silver_flights(spark, sf_dir):
    """SLV-02: both feeds."""
    return feeds(spark, sf_dir)


@query
def silver_ref_airlines(spark, sf_dir):
    """SLV-03."""
    return airlines(spark, sf_dir)


@query
def silver_ref_airports(spark, sf_dir):
    """SLV-04."""
    return airports(spark, sf_dir)


@query
def fact_flights(spark, sf_dir):
    """FCT-01, DED-04."""
    return flights(spark, sf_dir)


@query
def dim_airports(spark, sf_dir):
    """DIM-01, AGG-17."""
    return gold.dim_airports(airports(spark, sf_dir), RUN_TS)


@query
def dim_prefixes(spark, sf_dir):
    """DIM-02."""
    return gold.dim_prefixes(airlines(spark, sf_dir), RUN_TS)


@query
def dim_airlines(spark, sf_dir):
    """DIM-03, SRT-01."""
    return gold.sorted_airlines(gold.dim_airlines(flights(spark, sf_dir), RUN_TS))


# Measures.


@query
def kpi_cards(spark, sf_dir):
    """KPI-01, KPI-04, MTH-01."""
    columns = ["dep_icao", "arr_icao", "block_time_s", "unknown_dep", "unknown_arr"]
    fact, _ = stage(flights(spark, sf_dir).select(*columns), "fact_flights")
    pings, _ = stage(daily(spark, sf_dir), "fact_states")
    return rounded(measures.kpi_cards(fact, pings), "value")


@query
def top_routes(spark, sf_dir):
    """KPI-03."""
    return rounded(measures.top_routes(flights(spark, sf_dir), 20), "avg_block_min")


@query
def top_airports(spark, sf_dir):
    """SRT-04."""
    refs = references(spark, sf_dir)
    dim = gold.dim_airports(refs[1].frame, RUN_TS)
    return measures.top_airports(flights(spark, sf_dir, refs), dim, 10)


@query
def top_airlines(spark, sf_dir):
    """SRT-04."""
    return measures.top_airlines(flights(spark, sf_dir), 3)


@query
def median_block_time(spark, sf_dir):
    """KPI-05."""
    return rounded(measures.median_block_time(flights(spark, sf_dir)), "median_block_time_min")


@query
def airline_share(spark, sf_dir):
    """KPI-06, WIN-02."""
    return rounded(measures.airline_share(flights(spark, sf_dir)), "share_pct")


@query
def hour_dow_heatmap(spark, sf_dir):
    """KPI-07 on the telemetry hours and the arrivals."""
    return measures.hour_dow_heatmap(flights(spark, sf_dir), "arr")


@query
def daily_trend(spark, sf_dir):
    """KPI-08."""
    return measures.daily_trend(flights(spark, sf_dir), calendar(spark, sf_dir))


@query
def weekly_trend(spark, sf_dir):
    """KPI-09."""
    return rounded(measures.trend(flights(spark, sf_dir), "week", "dep"), "avg_block_min")


@query
def monthly_trend(spark, sf_dir):
    """KPI-09."""
    return rounded(measures.trend(flights(spark, sf_dir), "month", "arr"), "avg_block_min")


@query
def coverage_by_day(spark, sf_dir):
    """KPI-10."""
    return rounded(measures.coverage_by_day(daily(spark, sf_dir)), "coverage_pct")


@query
def p95_of_p95(spark, sf_dir):
    """KPI-11."""
    return rounded(measures.p95_of_p95(daily(spark, sf_dir)), "value")


@query
def outlier_pct_by_day(spark, sf_dir):
    """KPI-12."""
    result = measures.outlier_pct_by_day(daily(spark, sf_dir))
    return rounded(result, "velocity_outlier_ratio", "altitude_outlier_ratio")


@query
def unknown_airport_pct(spark, sf_dir):
    """KPI-13."""
    result = measures.unknown_airport_pct(flights(spark, sf_dir))
    return rounded(result, "unknown_dep_pct", "unknown_arr_pct")


@query
def turnaround(spark, sf_dir):
    """KPI-15, WIN-01."""
    # Busy aircraft by the raw rows; repeated ones among them may halve the share of another.
    raw = samples.aircraft(spark, sf_dir).select(text.normalize_str("icao24").alias("icao24"))
    hot = skew.hot_hashes(raw, ["icao24"], skew.hot_share(raw) / 2)
    return measures.turnaround(flights(spark, sf_dir), hot, hex_ids=True)


@query
def block_time_percentiles(spark, sf_dir):
    """KPI-16."""
    return rounded(measures.block_time_quantiles(flights(spark, sf_dir)), "block_time_min")


@query
def kpi_sliced(spark, sf_dir):
    """KPI-17: the routes of one airline, some airports and two years."""
    part = measures.slice_flights(
        flights(spark, sf_dir),
        dates=(date(1996, 1, 1), date(1997, 12, 31)),
        airports=["N001", "N002", "N003", "N005", "N008"],
        airlines=["Household Express", "Building Air"],
    )
    return rounded(measures.top_routes(part, 50), "avg_block_min")


# Queries over files, lakes and streams register themselves; they need ``query`` from above.
from contrail import lake_queries  # noqa: E402, F401
