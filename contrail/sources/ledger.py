"""Manifest of processed inputs (SRC-06..08, SNK-05, SRT-02).

The stored ledger is a log: a run adds its own entries and reads or rewrites no others.
Readers see the entry in force of each file; ``compact`` shortens the log."""

from __future__ import annotations

import time
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from contrail import schemas
from contrail.operators import merge as merging
from contrail.session import discard, stage
from contrail.sources import tables

KEYS = ("dataset", "source_file")
DONE = "done"
PROCESSING = "processing"
FAILED = "failed"
PARTITION = ("dataset",)
PAYLOAD = ("ingest_id", "processed_ts", "status", "file_hash", "version")
# An entry that differs from the one before in none of these changes nothing.
COMPARED = ("status", "file_hash", "ingest_id", "version")
WRITTEN = "written_at"

_last_written = 0


def _now() -> int:
    """Microseconds since the epoch, later than any before in this process."""
    global _last_written
    _last_written = max(_last_written + 1, time.time_ns() // 1_000)
    return _last_written


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """All entries ever recorded and not compacted, with the time of writing."""
    schema = f"{schemas.MANIFEST}, {WRITTEN} bigint"
    if not tables.exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The entry in force of every file."""
    return in_force(read_log(spark, path)).drop(WRITTEN)


def in_force(log: DataFrame, compared: Sequence[str] = COMPARED) -> DataFrame:
    """Of each file the last entry that changed anything.

    A repeated entry changes nothing, so the first of equal ones stands, with its time.  One
    window per file; a file has as many entries as runs that touched it."""
    in_time = Window.partitionBy(*KEYS).orderBy(F.col(WRITTEN).asc_nulls_first(), "processed_ts", "ingest_id", "status")
    same = F.lit(True)
    for c in compared:
        same = same & F.col(c).eqNullSafe(F.lag(c).over(in_time))
    place = F.row_number().over(in_time)
    numbered = log.withColumns({"_place": place, "_changed": (place == 1) | ~same}).where("_changed")
    last = Window.partitionBy(*KEYS).orderBy(F.col("_place").desc())
    return numbered.withColumn("_last", F.row_number().over(last)).where("_last = 1").drop("_place", "_changed", "_last")


def entries(
    files: DataFrame,
    dataset: str,
    ingest_id: str,
    processed_ts: datetime,
    status: str = DONE,
    version: str | None = None,
) -> DataFrame:
    """Manifest rows for ``files`` (``source_file`` and, if known, ``file_hash``)."""
    file_hash = F.col("file_hash") if "file_hash" in files.columns else F.lit(None)
    return files.select(
        F.lit(dataset).alias("dataset"),
        "source_file",
        F.lit(ingest_id).alias("ingest_id"),
        F.lit(processed_ts).cast("timestamp").alias("processed_ts"),
        F.lit(status).alias("status"),
        file_hash.cast("string").alias("file_hash"),
        F.lit(version).cast("string").alias("version"),
    )


def merge_entries(
    manifest: DataFrame, new: DataFrame, compared: Sequence[str] = COMPARED
) -> DataFrame:
    """SNK-05: add new entries, update those that differ, leave the others alone.

    The same as recording ``new`` after ``manifest`` and reading what is in force: one
    shuffle of both, no join.  Of several new entries of a file the latest counts."""
    log = manifest.withColumn(WRITTEN, F.lit(0)).unionByName(new.withColumn(WRITTEN, F.lit(1)))
    return in_force(log, compared).drop(WRITTEN)


def record(new: DataFrame, path: str) -> None:
    """SNK-05: append entries; nothing that is in the ledger is read or rewritten.

    A lost run leaves entries or none, and a repeated one adds equal entries, which change
    nothing.  Writers are ordered by their clocks.  NULL keys are refused."""
    missing = F.raise_error(F.lit(f"NULL in ledger key {list(KEYS)}")).cast("string")
    keyed = new.select(*[F.coalesce(F.col(k), missing).alias(k) for k in KEYS], *PAYLOAD)
    tables.append(keyed.withColumn(WRITTEN, F.lit(_now()).cast("bigint")), path, PARTITION)


def compact(spark: SparkSession, path: str, dataset: str) -> None:
    """Keep only the entries in force of a dataset, in as few files as they need.

    Staged first, then put in place of the dataset's partition; a lost run is run again.
    Entries recorded meanwhile would go, so no run of the dataset may be under way."""
    log = read_log(spark, path).where(F.col("dataset") == dataset)
    staged, scratch = stage(in_force(log), "ledger")
    try:
        tables.replace_partitions(staged, path, PARTITION)
    finally:
        discard(spark, scratch)


def done_entries(manifest: DataFrame, dataset: str | None = None) -> DataFrame:
    condition: Column = F.col("status") == DONE
    if dataset is not None:
        condition = condition & (F.col("dataset") == dataset)
    return manifest.where(condition)


def new_files(candidates: DataFrame, manifest: DataFrame, dataset: str) -> DataFrame:
    """SRC-06: candidate files without a ``done`` entry for the dataset."""
    done = done_entries(manifest, dataset).select("source_file").distinct()
    return merging.anti_join(candidates, done, ["source_file"])


def batches(files: DataFrame, max_files: int | None = None) -> list[list[str]]:
    """All files in path order (D19), in batches of ``max_files`` at most; one batch if
    there is no limit.  The driver lists the files of a scan anyway."""
    rows = files.select("source_file").distinct().orderBy("source_file").collect()
    names = [r["source_file"] for r in rows]
    size = max_files or max(1, len(names))
    return [names[k : k + size] for k in range(0, len(names), size)]


def latest_done(manifest: DataFrame) -> DataFrame:
    """Newest ``done`` entry per file: its hash and version."""
    newest = F.max_by(F.struct("file_hash", "version"), F.struct("processed_ts", "ingest_id"))
    return (
        done_entries(manifest)
        .groupBy(*KEYS)
        .agg(newest.alias("last"))
        .select(*KEYS, "last.file_hash", "last.version")
    )


def change_gate(current: DataFrame, manifest: DataFrame, with_version: bool = False) -> DataFrame:
    """SRC-07/08: does a snapshot have to be processed again?

    ``current`` has (dataset, source_file, file_hash[, version]).  Yes, when there
    is no ``done`` entry or the newest one has another hash or, on request,
    another version.  An absent hash or version equals ''."""
    last = latest_done(manifest).select(
        *KEYS,
        F.col("file_hash").alias("_last_hash"),
        F.col("version").alias("_last_version"),
        F.lit(True).alias("_seen"),
    )
    blank = F.lit("")
    stale = F.coalesce("file_hash", blank) != F.coalesce("_last_hash", blank)
    if with_version:
        stale = stale | (F.coalesce("version", blank) != F.coalesce("_last_version", blank))
    return current.join(last, list(KEYS), "left").select(
        *KEYS, (F.col("_seen").isNull() | stale).alias("needs_processing")
    )


def version_gate(current: DataFrame, manifest: DataFrame) -> DataFrame:
    """SRC-08 for inputs without a hash: no ``done`` entry of the same version."""
    done = done_entries(manifest).select(*KEYS, "version", F.lit(True).alias("_seen")).distinct()
    return current.join(done, [*KEYS, "version"], "left").select(
        *KEYS, "version", F.col("_seen").isNull().alias("needs_processing")
    )


def unfinished(manifest: DataFrame, dataset: str) -> DataFrame:
    """Entries a lost run left in ``processing``."""
    return manifest.where((F.col("dataset") == dataset) & (F.col("status") == PROCESSING))
