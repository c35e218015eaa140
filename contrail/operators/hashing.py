"""Content hashes that do not depend on the physical order of rows (AGG-15)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Fixed values of the published content hash.
FIELD_SEPARATOR = "␟"
EMPTY = "EMPTY"
# A row hash is cut into lanes of so many hex digits, which are added up as numbers.
LANES, LANE_DIGITS = 4, 15
# The lower half of a lane, and so many rows (as a power of two) that its sum stays in a long.
LOW_DIGITS, CHUNK_BITS = 8, 30


def row_hash(columns: Sequence[str]) -> Column:
    """sha256 of the row; NULL and '' are the same."""
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return F.sha2(F.concat_ws(FIELD_SEPARATOR, *texts), 256)


def _hash_of_sorted(parts: Column) -> Column:
    return F.sha2(F.concat_ws("", F.sort_array(F.collect_list(parts))), 256)


def _or_empty(c: Column) -> Column:
    return F.when(F.count(F.lit(1)) == 0, F.lit(EMPTY)).otherwise(c).alias("content_hash")


def snapshot_hash(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: hash of all sorted row hashes, the published form.  For reference
    snapshots: the row hashes meet in one task."""
    return df.select(row_hash(columns).alias("h")).agg(_or_empty(_hash_of_sorted(F.col("h"))))


def lane_sums(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``(by.., rows, lane_0..)``: rows and the sums of the lanes of their hashes.

    Sums do not depend on the order of rows, copies count, and those of parts add up to those of
    the whole.  They are combined where the rows are, as whole numbers: a lane is added up in two
    halves, per chunk of so few rows that no sum runs over; only the sums of chunks are decimals."""
    chunk = F.shiftright(F.monotonically_increasing_id(), CHUNK_BITS).alias("_chunk")
    hashed = df.select(*by, row_hash(columns).alias("_h"), chunk)
    # A lane is read once, as a number of 60 bits, and cut in two by its bits.
    numbers = [
        F.conv(F.substring("_h", 1 + k * LANE_DIGITS, LANE_DIGITS), 16, 10).cast("bigint").alias(f"_lane_{k}")
        for k in range(LANES)
    ]
    hashed = hashed.select(*by, "_chunk", *numbers)
    halves = {}
    for k in range(LANES):
        halves[f"_high_{k}"] = F.sum(F.shiftright(f"_lane_{k}", 4 * LOW_DIGITS))
        halves[f"_low_{k}"] = F.sum(F.col(f"_lane_{k}").bitwiseAND(F.lit(16**LOW_DIGITS - 1)))
    chunks = hashed.groupBy(*by, "_chunk").agg(
        F.count(F.lit(1)).alias("rows"), *[c.alias(name) for name, c in halves.items()]
    )
    shift = F.lit(16**LOW_DIGITS).cast("decimal(10,0)")
    lanes = [
        F.sum(F.col(f"_high_{k}").cast("decimal(19,0)") * shift + F.col(f"_low_{k}").cast("decimal(19,0)"))
        .cast("decimal(38,0)")
        .alias(f"lane_{k}")
        for k in range(LANES)
    ]
    return chunks.groupBy(*by).agg(F.sum("rows").alias("rows"), *lanes)


def combined_hash(sums: DataFrame) -> DataFrame:
    """One row: hash of the number of rows and of the lane sums, given the sums of any parts."""
    rows = F.coalesce(F.sum("rows"), F.lit(0))
    lanes = [F.sum(f"lane_{k}").cast("decimal(38,0)").cast("string") for k in range(LANES)]
    content = F.sha2(F.concat_ws(":", rows.cast("string"), *lanes), 256)
    return sums.agg(F.when(rows == 0, F.lit(EMPTY)).otherwise(content).alias("content_hash"))


def multiset_hash(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: hash of the number of rows and of the sums of the lanes of their hashes, for
    tables of any size; no row is shuffled."""
    return combined_hash(lane_sums(df, columns))


def content_hash(df: DataFrame, columns: Sequence[str], large: bool = False) -> DataFrame:
    """The published form, or that for large tables.  The caller chooses once per table; size
    never does, so a growing table keeps comparable hashes."""
    return multiset_hash(df, columns) if large else snapshot_hash(df, columns)
