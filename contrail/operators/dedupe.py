"""Keep one row per key (DED-*, AGG-16, AGG-17)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

_ROW = "_keep_rank"


def one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row per key in ``order``.

    ``row_number = 1`` directly above the window lets Spark plan a group limit
    before the shuffle: a map task passes on one row per key, so a key holding a
    large part of the table does not load the reducer.  ``order`` must be total
    over rows that differ, otherwise the survivor is arbitrary (D18)."""
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn(_ROW, F.row_number().over(window))
    return ranked.where(F.col(_ROW) == 1).drop(_ROW)


def latest_per_key(df: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """DED-01/03/04: greatest ``by`` columns win, NULL counts as oldest."""
    return one_per_key(df, keys, [F.col(c).desc_nulls_last() for c in by])


def latest_per_key_counted(df: DataFrame, keys: Sequence[str], by: Sequence[str], rows: str) -> DataFrame:
    """``latest_per_key`` with the number of rows of the key as ``rows``, in the same pass.

    One aggregate that combines before the shuffle: the greatest row by ``by`` and then by the
    other columns, whose types must be orderable, and a count."""
    rest = [c for c in df.columns if c not in keys and c not in by]
    greatest = F.max(F.struct(*by, *rest)).alias("_greatest")
    grouped = df.groupBy(*keys).agg(greatest, F.count(F.lit(1)).alias(rows))
    named = [F.col(c) if c in keys else F.col(f"_greatest.{c}").alias(c) for c in df.columns]
    return grouped.select(*named, rows)


def earliest_per_key(df: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """DED-02: smallest ``by`` columns win, NULL counts as newest."""
    return one_per_key(df, keys, [F.col(c).asc_nulls_last() for c in by])


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    """AGG-16."""
    return df.select(*columns).distinct()
