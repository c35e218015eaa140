"""Facts read from file paths (PRJ-03, PRJ-04, DAT-06)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The naming convention of the raw files.
STAMP_PATTERN = r"_(\d{8}T\d{6})Z"
STAMP_FORMAT = "yyyyMMdd'T'HHmmss"
DATE_DIR_PATTERN = r"(?:^|[\\/])date=(\d{4}-\d{2}-\d{2})(?:[\\/]|$)"
TAG_DIR_PATTERN = r"/tag=([^/]+)/"


def download_ts(path: Column) -> Column:
    """Timestamp in the file name; NULL when there is none (never an error)."""
    stamp = F.regexp_extract(path, STAMP_PATTERN, 1)
    return F.try_to_timestamp(stamp, F.lit(STAMP_FORMAT))


def directory_date(path: Column) -> Column:
    return F.try_to_date(F.regexp_extract(path, DATE_DIR_PATTERN, 1), "yyyy-MM-dd")


def download_date(path: Column, ingest_date: Column) -> Column:
    """Date of the file name, else of the directory, else of the ingest."""
    return F.coalesce(F.to_date(download_ts(path)), directory_date(path), ingest_date)


def path_tag(path: Column) -> Column:
    return F.upper(F.regexp_extract(path, TAG_DIR_PATTERN, 1))
