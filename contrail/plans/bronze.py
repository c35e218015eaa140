"""Bronze: raw files with ingest metadata (BRZ-*, SRC-02)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from contrail.functions import paths
from contrail.schemas import CORRUPT
from contrail.sources.files import add_ingest_metadata

PARTITION = ("download_date", "_ingest_id")
METADATA = (
    "_ingest_id", "_ingest_ts", "_source_file", "_ingestion_date",
    "download_ts", "download_date", CORRUPT,
)


def bronze_frame(
    raw: DataFrame, ingest_id: str, ingest_ts: datetime, tagged: bool = False
) -> DataFrame:
    """PRJ-02/03/04 on a file scan; ``tagged`` adds the airport of the directory."""
    source = F.col("_metadata.file_path")
    if tagged:
        raw = raw.select("*", paths.path_tag(source).alias("tag"), source.alias("_path"))
        source = F.col("_path")
    return add_ingest_metadata(raw, ingest_id, ingest_ts, source).drop("_path")


def accepted(df: DataFrame) -> DataFrame:
    return df.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def quarantined(df: DataFrame) -> DataFrame:
    """Malformed records: their text and where they came from."""
    kept = [c for c in METADATA if c in df.columns]
    return df.where(F.col(CORRUPT).isNotNull()).select(*kept)
