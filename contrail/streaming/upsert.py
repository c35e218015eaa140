"""STM-02: bronze to silver as a stream of keyed upserts."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery

from contrail.session import pin_utc
from contrail.sources import tables


def stream_upsert(
    spark: SparkSession,
    source_path: str,
    target_path: str,
    transform: Callable[[DataFrame], DataFrame],
    keys: Sequence[str],
    partition_cols: Sequence[str],
    newest_by: Sequence[str],
    checkpoint: str,
    max_files: int = 1_000,
    key_fixes_partition: bool = True,
) -> StreamingQuery:
    """Upsert everything new in a Parquet table into another, then stop.

    Batches are delivered at least once and in any order; the newest row per key
    wins on either side, so neither changes the result."""
    pin_utc(spark)
    schema = tables.read(spark, source_path).schema

    def write(batch: DataFrame, _: int) -> None:
        tables.upsert_table(
            transform(batch),
            target_path,
            keys,
            partition_cols,
            newest_by=newest_by,
            key_fixes_partition=key_fixes_partition,
        )

    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", max_files)
        .parquet(source_path)
        .writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )
