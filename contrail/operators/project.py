"""Projections and layer metadata (PRJ-01, PRJ-05, FLT-01, SET-01)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from contrail.functions.checks import keys_present


def select_allowlist(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """PRJ-01: the listed columns that exist, in list order."""
    present = set(df.columns)
    return df.select(*[c for c in keep if c in present])


def require_keys(df: DataFrame, *keys: str) -> DataFrame:
    """FLT-01: rows whose key columns are all set."""
    return df.where(keys_present(*keys))


def add_layer_metadata(
    df: DataFrame,
    layer: str,
    source: str | Column,
    run_ts: datetime | Column,
    version: str = "v1.0.0",
    run_id: str = "manual",
    job: str = "unknown",
) -> DataFrame:
    """PRJ-05: ``_<layer>_version/_ts/_run_id/_job`` and ``_source``.

    ``run_ts`` comes from the caller: one value per run, the same on a retry."""
    stamp = run_ts if isinstance(run_ts, Column) else F.lit(run_ts)
    return df.withColumns(
        {
            f"_{layer}_version": F.lit(version),
            f"_{layer}_ts": stamp.cast("timestamp"),
            f"_{layer}_run_id": F.lit(run_id),
            f"_{layer}_job": F.lit(job),
            "_source": source if isinstance(source, Column) else F.lit(source),
        }
    )


def union_by_name(first: DataFrame, *others: DataFrame) -> DataFrame:
    """SET-01: union all by column name, absent columns as NULL."""
    result = first
    for other in others:
        result = result.unionByName(other, allowMissingColumns=True)
    return result
