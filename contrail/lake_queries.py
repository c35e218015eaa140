"""Registered queries that go through real files, stored lakes and streams.

Each writes what it needs from the sample tables to the shared folder, runs the library's
jobs on it and returns what they stored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from contrail import samples, schemas
from contrail.operators import quality
from contrail.plans import lake as jobs
from contrail.plans.lake import Lake
from contrail.queries import query, rounded
from contrail.samples import RUN_TS
from contrail.session import scratch_path, stage
from contrail.sources import files, tables
from contrail.streaming.ingest import stream_files
from contrail.streaming.upsert import stream_upsert

RAW_GLOB = "*.txt.gz"


def _cut(line: Column, broken: Column) -> Column:
    """A line without its end where ``broken`` holds."""
    return F.when(broken, F.substring(line, F.lit(1), F.length(line) - 1)).otherwise(line)


def _write_lines(lines: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Gzipped text, one file per date where there is one."""
    if "date" in lines.columns:
        lines.repartition("date").write.mode(mode).partitionBy("date").option("compression", "gzip").text(path)
    else:
        lines.write.mode(mode).option("compression", "gzip").text(path)


def _raw_states(spark: SparkSession, sf_dir: str, broken: Column) -> DataFrame:
    """``date, value``: every state vector as a line of JSON."""
    pings = samples.pings(spark, sf_dir)
    fields = ["icao24", "time_position", "last_contact", "velocity", "geo_altitude", "true_track"]
    return pings.select(F.col("download_date").alias("date"), _cut(F.to_json(F.struct(*fields)), broken).alias("value"))


@query
def json_file_scan(spark, sf_dir):
    """SRC-01, SRC-02, AGG-09: gzipped lines of JSON, some cut off."""
    events = samples.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    line = F.to_json(F.struct("event_id", "user_id", "event_type"))
    path = scratch_path(spark, "ndjson")
    _write_lines(events.select(_cut(line, F.col("event_type") == "error").alias("value")), path)
    return files.read_ndjson(spark, path, "event_id bigint, user_id bigint, event_type string").select(
        "event_id", "user_id", "event_type", F.col(schemas.CORRUPT).alias("corrupt_record")
    )


@query
def corrupt_counts(spark, sf_dir):
    """AGG-09 on the file scan: records in and malformed ones."""
    scanned = json_file_scan(spark, sf_dir).withColumnRenamed("corrupt_record", schemas.CORRUPT)
    # Stored like any bronze batch: a raw scan cannot be asked for its malformed lines alone.
    scanned, _ = stage(scanned, "scanned")
    return scanned.agg(F.count(F.lit(1)).alias("rows_in"), quality.corrupt_count(scanned).alias("corrupt_rows"))


@query
def csv_file_scan(spark, sf_dir):
    """SRC-03: headered CSV under a declared contract."""
    parts = samples.table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_size", "p_retailprice")
    path = scratch_path(spark, "csv")
    parts.write.option("header", "true").csv(path)
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in parts.schema.fields)
    return files.read_csv(spark, path, ddl).drop(schemas.CORRUPT)


@query
def file_digests(spark, sf_dir):
    """SRC-09: MD5 of the bytes of one file per month of orders."""
    orders = samples.table(spark, sf_dir, "orders")
    lines = orders.select(F.date_format("o_orderdate", "yyyy-MM").alias("month"), "o_orderkey")
    ordered = lines.repartition("month").sortWithinPartitions("month", "o_orderkey")
    path = scratch_path(spark, "monthly")
    ordered.select("month", F.col("o_orderkey").cast("string").alias("value")).write.partitionBy("month").text(path)
    hashed = files.file_hashes(spark, f"{path}/month=*")
    return hashed.select(F.regexp_extract("source_file", "month=([0-9-]+)/", 1).alias("month"), "file_hash")


@query
def bronze_ingest(spark, sf_dir):
    """BRZ-01, PRJ-02, SNK-03, SNK-05: two ingest runs over date folders, each taking what is new;
    malformed lines are quarantined."""
    raw, lake = scratch_path(spark, "raw"), Lake(scratch_path(spark, "lake"))
    lines = _raw_states(spark, sf_dir, F.col("_ingest_ts") % 50 == 0)
    early = F.dayofmonth("date") <= 15
    for run_id, part in (("run-1", lines.where(early)), ("run-2", lines.where(~early))):
        _write_lines(part, raw, "append")
        for again in (run_id, f"{run_id}-again"):
            jobs.ingest_files(spark, lake, "states", raw, schemas.STATES, again, RUN_TS, RAW_GLOB)
    shared = ["_ingest_id", "download_date"]
    kept = tables.read(spark, lake.table("bronze", "states"))
    bad = tables.read(spark, lake.table("quarantine", "states"))
    return kept.select("icao24", "last_contact", "velocity", *shared, F.lit(None).cast("string").alias("corrupt_record")).unionByName(
        bad.select(*shared, F.col(schemas.CORRUPT).alias("corrupt_record")), allowMissingColumns=True
    )


@query
def lake_fact_states(spark, sf_dir):
    """BRZ-01, SLV-01, FCT-02, SNK-04, SNK-07, EXP-01: raw files to exported facts by the jobs."""
    raw, lake, out = (scratch_path(spark, name) for name in ("raw", "lake", "export"))
    lake = Lake(lake)
    lines = _raw_states(spark, sf_dir, F.lit(False))
    early = F.dayofmonth("date") <= 15
    for number, part in enumerate((lines.where(early), lines.where(~early)), 1):
        _write_lines(part, raw, "append")
        jobs.ingest_files(spark, lake, "states", raw, schemas.STATES, f"run-{number}", RUN_TS, RAW_GLOB)
        jobs.refresh_states(spark, lake, f"run-{number}", RUN_TS)
        jobs.refresh_fact_states(spark, lake, f"run-{number}", RUN_TS)
    jobs.export_gold(spark, lake, out, ["fact_states"])
    facts = spark.read.parquet(f"{out}/fact_states")
    return rounded(facts.select("icao24", "event_date_utc", "pings_count", "coverage_pct"), "coverage_pct")


@query
def stream_ingest(spark, sf_dir):
    """STM-01: the date folders as a stream of several triggers, started twice."""
    raw, checkpoint, lake = (scratch_path(spark, name) for name in ("raw", "checkpoint", "lake"))
    lake = Lake(lake)
    _write_lines(_raw_states(spark, sf_dir, F.col("_ingest_ts") % 50 == 0), raw)
    for _ in range(2):
        stream_files(
            spark, lake, "states", raw, schemas.STATES, checkpoint, RAW_GLOB, max_files=16, now=lambda: RUN_TS
        ).awaitTermination()
    return tables.read(spark, lake.table("bronze", "states")).select("icao24", "last_contact", "velocity", "download_date")


@query
def stream_upsert_late(spark, sf_dir):
    """STM-02: three triggers of upserts, the second with late rows, the third with repeated and
    newer ones; the newest row of a key wins whatever the order."""
    orders = samples.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    source, target, checkpoint = (scratch_path(spark, name) for name in ("source", "target", "checkpoint"))
    urgent = orders.where("o_orderpriority = '1-URGENT'")
    triggers = (
        orders.withColumn("version", F.lit(2)),
        orders.where("o_orderkey % 3 = 0").withColumns({"version": F.lit(1), "o_orderpriority": F.lit("late")}),
        orders.withColumn("version", F.lit(2)).unionByName(
            urgent.withColumns({"version": F.lit(3), "o_orderpriority": F.lit("newer")})
        ),
    )
    for batch in triggers:
        tables.append(batch, source)
        stream_upsert(
            spark, source, target, lambda frame: frame, ["o_orderkey"], ["o_orderstatus"], ["version"], checkpoint
        ).awaitTermination()
    return tables.read(spark, target).select("o_orderkey", "o_orderstatus", "o_orderpriority", "version")


@query
def observed_metrics(spark, sf_dir):
    """AGG-14 from the pass that writes: the metrics row a silver run leaves in its table."""
    raw, lake = scratch_path(spark, "raw"), Lake(scratch_path(spark, "lake"))
    _write_lines(_raw_states(spark, sf_dir, F.lit(False)), raw)
    jobs.ingest_files(spark, lake, "states", raw, schemas.STATES, "run-1", RUN_TS, RAW_GLOB)
    jobs.refresh_states(spark, lake, "run-1", RUN_TS)
    row = tables.read(spark, lake.metrics("silver"))
    picked = row.select("dataset", "ingest_id", "rows_in", "rows_out", "dup_ratio", "status")
    nulls = F.get_json_object(row["nulls_json"], "$.velocity_mps").cast("bigint").alias("null_velocities")
    return rounded(row.select(*picked.columns, nulls), "dup_ratio")
