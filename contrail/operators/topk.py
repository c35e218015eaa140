"""Top-N reports and latest rows (SRT-02..04)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from contrail.functions.text import normalize_str

# Airports captured first, in this order, and how many in all.
PRIORITY_AIRPORTS = (
    "LEMD", "LEBL", "LEMG", "LEVC", "LEBB", "LEZL", "LEAL", "LEST", "LECO",
    "LEXJ", "LEVX", "LEAS", "LEJR", "LEZG", "LESO", "LERS", "LEGR",
)
MAX_AIRPORTS = 12


def top_n(df: DataFrame, n: int, measure: str, *ties: str) -> DataFrame:
    """SRT-04: greatest ``measure`` first, ties in key order."""
    return df.orderBy(F.col(measure).desc(), *[F.col(c).asc_nulls_last() for c in ties]).limit(n)


def priority_topk(
    df: DataFrame, code: str, priorities: Sequence[str] = PRIORITY_AIRPORTS, n: int = MAX_AIRPORTS
) -> DataFrame:
    """SRT-03: distinct codes, listed ones first in list order, the rest by name.

    ``n`` <= 0 keeps all."""
    codes = (
        df.select(normalize_str(code).alias(code)).where(F.col(code) != "").distinct()
    )
    place = F.array_position(F.array(*[F.lit(p) for p in priorities]), F.col(code))
    ranked = codes.withColumn("priority", F.nullif(place, F.lit(0)).cast("int"))
    ranked = ranked.orderBy(F.col("priority").asc_nulls_last(), F.col(code))
    return ranked.limit(n) if n > 0 else ranked


def latest_row(df: DataFrame, condition: Column, *by: str) -> DataFrame:
    """SRT-02: the newest row that meets ``condition``."""
    return df.where(condition).orderBy(*[F.col(c).desc() for c in by]).limit(1)
