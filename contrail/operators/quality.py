"""Data-quality measures as one aggregate per table (AGG-07..14)."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, functions as F

from contrail.functions.times import lag_minutes
from contrail.schemas import CORRUPT, METRICS


def null_counts(columns: Sequence[str]) -> Column:
    """AGG-07: JSON object with the number of NULLs per column."""
    if not columns:
        return F.lit("{}")
    counts = [F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    return F.to_json(F.struct(*counts))


def schema_json(df: DataFrame) -> str:
    """AGG-08: name and type of each column."""
    fields = [{"name": f.name, "type": f.dataType.simpleString()} for f in df.schema.fields]
    return json.dumps(fields, ensure_ascii=False)


def corrupt_count(df: DataFrame) -> Column:
    """AGG-09."""
    if CORRUPT in df.columns:
        return F.count_if(F.col(CORRUPT).isNotNull())
    return F.lit(0).cast("bigint")


def dup_ratio(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """AGG-10: rows before, distinct keys and (before - after) / before.

    Counting rows per key first keeps the distinct count combinable map-side."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    totals = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_in"), F.count(F.lit(1)).alias("rows_out")
    )
    ratio = F.try_divide(F.col("rows_in") - F.col("rows_out"), F.col("rows_in"))
    return totals.withColumn("dup_ratio", ratio.cast("double"))


def unknown_ratio(flag: Column) -> Column:
    """AGG-11: share of flagged rows, 0..1; a NULL flag counts as not flagged."""
    return F.try_divide(F.count_if(flag).cast("double"), F.count(F.lit(1)))


def freshness_lag(ts: Column | str, as_of: datetime | Column) -> Column:
    """AGG-12: minutes from the newest value to ``as_of``."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    now = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return lag_minutes(F.max(ts), now)


def counts_json(conditions: Mapping[str, Column]) -> Column:
    """AGG-13: JSON object with one count per named condition."""
    return F.to_json(F.struct(*[F.count_if(c).alias(name) for name, c in conditions.items()]))


def _measures(
    df: DataFrame,
    processed_ts: datetime,
    rows_in: int | Column | None,
    exclude: Sequence[str],
    unknown: Column | None,
    fresh: str | None,
    extras: Column | None,
) -> dict[str, Column]:
    """The aggregates of a metrics row, of those that are asked for."""
    profiled = [c for c in df.columns if c not in set(exclude)]
    rows, corrupt = F.count(F.lit(1)), corrupt_count(df)
    rows_out = rows - corrupt
    if rows_in is None:
        before = rows
    else:
        before = F.coalesce(rows_in, F.lit(0)) if isinstance(rows_in, Column) else F.lit(rows_in)
    found = {
        "rows_in": before.cast("bigint"),
        "rows_out": rows_out,
        "corrupt_rows": corrupt,
        "nulls_json": null_counts(profiled),
        "status": F.when(corrupt > 0, F.lit("warn")).otherwise(F.lit("ok")),
    }
    if rows_in is not None:
        found["dup_ratio"] = F.try_divide(before - rows_out, before).cast("double")
    if unknown is not None:
        found["unknown_pct"] = unknown_ratio(unknown)
    if fresh is not None:
        found["freshness_lag_minutes"] = freshness_lag(fresh, processed_ts)
    if extras is not None:
        found["extras_json"] = extras
    return found


def _fixed(df: DataFrame, dataset: str, source_key: str, ingest_id: str, processed_ts: datetime, notes: str) -> dict:
    return {
        "dataset": dataset, "source_key": source_key, "ingest_id": ingest_id, "processed_ts": processed_ts,
        "columns_json": schema_json(df), "notes": notes,
    }


def run_metrics(
    df: DataFrame,
    dataset: str,
    source_key: str,
    ingest_id: str,
    processed_ts: datetime,
    rows_in: int | Column | None = None,
    exclude: Sequence[str] = (),
    unknown: Column | None = None,
    fresh: str | None = None,
    extras: Column | None = None,
    notes: str = "",
) -> DataFrame:
    """AGG-14: one typed row for the metrics table, from a single pass.

    ``rows_in`` is the true input count of a deduplicated table (D14), a number or an
    aggregate; without it there is no duplicate ratio.  Malformed records are counted in but
    not out and turn the status to ``warn``.  ``fresh`` names the column behind the lag,
    measured at ``processed_ts``."""
    values = {k: F.lit(v) for k, v in _fixed(df, dataset, source_key, ingest_id, processed_ts, notes).items()}
    values |= _measures(df, processed_ts, rows_in, exclude, unknown, fresh, extras)
    fields = df.sparkSession.createDataFrame([], METRICS).schema.fields
    return df.agg(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])


class ObservedRun:
    """AGG-14 without a pass of its own: the same row, taken while ``frame`` is written.

    The aggregates are observed at the top of the plan, in the stage that writes, whose
    tasks count once each however often executors are lost."""

    def __init__(
        self,
        df: DataFrame,
        dataset: str,
        source_key: str,
        ingest_id: str,
        processed_ts: datetime,
        rows_in: Column | None = None,
        counted: str | None = None,
        exclude: Sequence[str] = (),
        unknown: Column | None = None,
        fresh: str | None = None,
        extras: Column | None = None,
        notes: str = "",
    ):
        """``counted`` is a column of ``df`` with the input rows that a row stands for; it is
        dropped.  ``rows_in`` gives their sum otherwise."""
        whole = df.drop(counted) if counted else df
        rows_in = F.sum(counted) if counted else rows_in
        measures = _measures(whole, processed_ts, rows_in, exclude, unknown, fresh, extras)
        self._spark, self._observation = df.sparkSession, Observation()
        self._fixed = _fixed(whole, dataset, source_key, ingest_id, processed_ts, notes)
        observed = df.observe(self._observation, *[c.alias(name) for name, c in measures.items()])
        self.frame = observed.drop(counted) if counted else observed

    def row(self) -> DataFrame:
        """The metrics row, once ``frame`` has been written."""
        values = {**self._fixed, **self._observation.get}
        schema = self._spark.createDataFrame([], METRICS).schema
        return self._spark.createDataFrame([tuple(values.get(f.name) for f in schema.fields)], schema)
