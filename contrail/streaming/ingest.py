"""STM-01: files to bronze, each file once."""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.query import StreamingQuery

from contrail import schemas
from contrail.functions import paths
from contrail.operators.skew import fits_broadcast
from contrail.plans.lake import Lake, write_bronze
from contrail.session import pin_utc
from contrail.sources import ledger
from contrail.sources.files import add_ingest_metadata


def stream_files(
    spark: SparkSession,
    lake: Lake,
    dataset: str,
    raw_root: str,
    ddl: str,
    checkpoint: str,
    name_glob: str = "*.json.gz",
    tagged: bool = False,
    max_files: int = 1_000,
    now: Callable[[], datetime] = lambda: datetime.now(timezone.utc),
) -> StreamingQuery:
    """Process all files not yet seen, then stop.

    The checkpoint remembers the files.  A batch that is run again has the same
    number, hence the same ingest id, and overwrites its own partitions.  The id also
    names the query, which lives in the checkpoint: another source or another checkpoint
    never meets it.  Files that a batch run or another stream has entered in the ledger
    are left out, and those of this batch are entered."""
    pin_utc(spark)
    source = (
        spark.readStream.schema(schemas.with_corrupt(ddl))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", schemas.CORRUPT)
        .option("pathGlobFilter", name_glob)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", max_files)
        .json(raw_root)
        .select("*", F.col("_metadata.file_path").alias("_path"))
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run_id = f"{dataset}-{_query_id(spark, checkpoint)}-{batch_id:08d}"
        run_ts = _started(spark, lake, dataset, run_id, now())
        manifest = ledger.read_manifest(spark, lake.manifest("bronze"))
        others = ledger.done_entries(manifest, dataset).where(F.col("ingest_id") != run_id)
        seen = others.select(F.col("source_file").alias("_path")).distinct()
        batch = batch.join(F.broadcast(seen) if fits_broadcast(seen) else seen, "_path", "left_anti")
        if tagged:
            batch = batch.withColumn("tag", paths.path_tag(F.col("_path")))
        names = batch.select(F.col("_path").alias("source_file")).distinct()
        frame = add_ingest_metadata(batch, run_id, run_ts, F.col("_path")).drop("_path")
        write_bronze(lake, dataset, frame, run_id, run_ts)
        ledger.record(
            ledger.entries(names, dataset, run_id, run_ts).unionByName(
                _marker(spark, dataset, run_id, run_ts, ledger.DONE)
            ),
            lake.manifest("bronze"),
        )

    return (
        source.writeStream.queryName(f"bronze_{dataset}")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )


def _query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the query that the checkpoint belongs to; it outlives restarts."""
    text = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()["value"]
    return json.loads(text)["id"]


def _marker(spark, dataset, run_id, run_ts, status) -> DataFrame:
    batch = spark.createDataFrame([(f"stream://{run_id}",)], "source_file string")
    return ledger.entries(batch, dataset, run_id, run_ts, status)


def _started(spark, lake, dataset, run_id, run_ts) -> datetime:
    """Time of the first attempt of a batch: a repeated one writes the same rows."""
    manifest = ledger.read_manifest(spark, lake.manifest("bronze"))
    first = manifest.where((F.col("dataset") == dataset) & (F.col("ingest_id") == run_id)).first()
    if first is not None:
        return first["processed_ts"].astimezone()
    ledger.record(_marker(spark, dataset, run_id, run_ts, "started"), lake.manifest("bronze"))
    return run_ts
