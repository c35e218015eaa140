"""Content hashes of stored tables, kept up partition by partition (AGG-15).

Beside a table lie the rows and lane sums of each of its partitions.  Sums add up, so after a
change only the partitions it rewrote are read again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from contrail.operators import hashing
from contrail.session import discard, stage
from contrail.sources import tables

SUMS_FOLDER = "_sums"


def sums_path(path: str) -> str:
    return f"{path.rstrip('/')}/{SUMS_FOLDER}"


def build(spark: SparkSession, path: str, columns: Sequence[str], partition_cols: Sequence[str]) -> None:
    """The sums of all partitions, by one scan of the hashed columns."""
    sums = hashing.lane_sums(tables.read(spark, path), columns, partition_cols)
    tables.overwrite(sums, sums_path(path), partition_cols)


def refresh(
    spark: SparkSession, path: str, columns: Sequence[str], partition_cols: Sequence[str], rewritten: Sequence[Row]
) -> None:
    """Sums of the ``rewritten`` partitions (as ``upsert_table`` returns them) anew; no other is read.

    Partitions that hold no row any more get sums of nothing.  A run lost before its end is
    run again; sums of a partition replace those it had."""
    if not rewritten:
        return
    table = tables.read(spark, path)
    schema = tables.schema_of(spark, sums_path(path))
    named = spark.createDataFrame([tuple(r) for r in rewritten], schema=table.select(*partition_cols).schema)
    own = hashing.lane_sums(tables.among(table, rewritten, partition_cols), columns, partition_cols)
    # NULL is a partition value like any other.
    same = [F.col(f"p.{c}").eqNullSafe(F.col(f"s.{c}")) for c in partition_cols]
    sums = [c for c in schema.names if c not in partition_cols]
    whole = named.alias("p").join(own.alias("s"), same, "left").select(
        *[F.col(f"p.{c}").alias(c) for c in partition_cols],
        *[F.coalesce(F.col(f"s.{c}"), F.lit(0)).cast(schema[c].dataType).alias(c) for c in sums],
    )
    staged, scratch = stage(whole, "sums")
    try:
        tables.replace_partitions(staged, sums_path(path), partition_cols)
    finally:
        discard(spark, scratch)


def content_hash(spark: SparkSession, path: str) -> DataFrame:
    """``content_hash`` of the table by its kept sums: one row per partition is read.

    Equal to ``hashing.multiset_hash`` of the table as long as every write was followed by
    ``refresh`` or ``build``."""
    return hashing.combined_hash(tables.read(spark, sums_path(path)))
