"""Raw file scans, listings and hashes (SRC-01..04, SRC-06, SRC-09, PRJ-02)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from contrail import schemas
from contrail.functions import paths
from contrail.functions.vectors import vector_fields


def read_ndjson(spark: SparkSession, files: str | Sequence[str], ddl: str) -> DataFrame:
    """SRC-01/02: one record per line, gzip or plain.  A malformed line gives
    NULL fields and keeps its text in ``_corrupt_record``; it never fails."""
    return (
        spark.read.schema(schemas.with_corrupt(ddl))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", schemas.CORRUPT)
        .json(files if isinstance(files, str) else list(files))
    )


def read_csv(spark: SparkSession, files: str | Sequence[str], ddl: str) -> DataFrame:
    """SRC-03: headered CSV under a fixed contract."""
    return (
        spark.read.option("header", "true")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", schemas.CORRUPT)
        .schema(schemas.with_corrupt(ddl))
        .csv(files if isinstance(files, str) else list(files))
    )


def read_parquet_files(spark: SparkSession, files: Sequence[str], base_path: str) -> DataFrame:
    """SRC-04: listed Parquet files with the partition columns of ``base_path``."""
    return spark.read.option("basePath", base_path).parquet(*files)


def read_state_payloads(spark: SparkSession, files: str | Sequence[str]) -> DataFrame:
    """Whole-response JSON documents: a time and a list of state vectors."""
    source = files if isinstance(files, str) else list(files)
    return spark.read.schema(schemas.STATE_PAYLOAD).option("multiLine", "true").json(source)


def decode_states(payloads: DataFrame, vectors: str = "states", keep: Sequence[str] = ()) -> DataFrame:
    """ARR-03: one typed row per state vector of each payload."""
    exploded = payloads.select(*keep, F.explode(vectors).alias("_vector"))
    return exploded.select(*keep, *vector_fields(F.col("_vector")))


def list_files(spark: SparkSession, root: str, name_glob: str = "*") -> DataFrame:
    """Files below ``root`` as rows; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", name_glob)
        .load(root)
        .select(F.col("path").alias("source_file"), "modificationTime", "length")
    )


def file_hashes(spark: SparkSession, files: str | Sequence[str]) -> DataFrame:
    """SRC-09: MD5 of the bytes of each snapshot file (one task per file)."""
    return (
        spark.read.format("binaryFile")
        .load(files if isinstance(files, str) else list(files))
        .select(F.col("path").alias("source_file"), F.md5("content").alias("file_hash"))
    )


def add_ingest_metadata(
    df: DataFrame,
    ingest_id: str,
    ingest_ts: datetime,
    path: Column | None = None,
) -> DataFrame:
    """PRJ-02: ingest id and time, source file, download time and date.

    ``ingest_ts`` is the run's, so that a repeated run writes the same rows."""
    source = F.col("_metadata.file_path") if path is None else path
    ingested = F.lit(ingest_ts).cast("timestamp")
    return df.select(
        "*",
        F.lit(ingest_id).alias("_ingest_id"),
        ingested.alias("_ingest_ts"),
        source.alias("_source_file"),
        F.to_date(ingested).alias("_ingestion_date"),
        paths.download_ts(source).alias("download_ts"),
        paths.download_date(source, F.to_date(ingested)).alias("download_date"),
    )
