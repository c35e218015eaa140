"""Joins of two large tables when a few keys hold much of one side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# A key is hot from this many times the rows of an even task on.
UNEVEN = 2.0
# Frequent-item counting is not defined below this share.
LEAST_SHARE = 1e-4
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 * 1024 * 1024
SALTS = 32


def fits_broadcast(
    dim: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Measure a dimension, reading no more than ``max_rows`` + 1 of its rows."""
    width = F.octet_length(F.to_json(F.struct("*")))
    size = (
        dim.limit(max_rows + 1)
        .agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes"))
        .first()
    )
    return size["rows"] <= max_rows and size["bytes"] <= max_bytes


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys)


def hot_share(df: DataFrame) -> float:
    """Share of the rows above which one key makes a task uneven: it follows from the number
    of tasks that the rows are dealt to, at any size."""
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(0.5, max(LEAST_SHARE, UNEVEN / width))


def hot_hashes(df: DataFrame, keys: Sequence[str], share: float | None = None) -> list[int]:
    """Hashes of the keys that hold at least ``share`` of the rows, NULL included.

    Two passes over the key columns without a shuffle of rows: frequent-item
    counting keeps at most 1 / share candidates per task and misses no hot key,
    then the candidates are counted exactly, together with the total."""
    share = hot_share(df) if share is None else share
    hashed = df.select(key_hash(keys).alias("h"))
    candidates = hashed.stat.freqItems(["h"], share).first()[0]
    if not candidates:
        return []
    named = F.when(F.col("h").isin(candidates), F.col("h"))
    counts = hashed.groupBy(named.alias("h")).agg(F.count(F.lit(1)).alias("n")).collect()
    total = sum(r["n"] for r in counts)
    return sorted(r["h"] for r in counts if r["h"] is not None and r["n"] >= share * total)


def skew_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    hot: Sequence[int] | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """Equi join on columns of the same name; ``left`` may have hot keys.

    Rows of ordinary keys meet by shuffle.  Rows of hot keys stay where they are:
    the right rows of these few keys are broadcast if they are measured to be
    few, else the left rows are salted and the right ones repeated per salt.  The
    result is that of the plain join.  ``hot`` carries an earlier measurement,
    say of the stored table the left side comes from."""
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type: {how}")
    keys = list(keys)
    if how in ("left_semi", "left_anti"):
        right = right.select(*keys)
    if hot is None:
        hot = hot_hashes(left, keys)
    if not hot:
        return left.join(right, keys, how)
    is_hot = key_hash(keys).isin(list(hot))
    ordinary = left.where(~is_hot).join(right.where(~is_hot), keys, how)
    few = right.where(is_hot)
    if how in ("left_semi", "left_anti"):
        few = few.distinct()
    if fits_broadcast(few):
        popular = left.where(is_hot).join(F.broadcast(few), keys, how)
    else:
        spread = left.where(is_hot).withColumn("_salt", F.spark_partition_id() % F.lit(salts))
        repeated = few.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        popular = spread.join(repeated, [*keys, "_salt"], how).drop("_salt")
    return ordinary.unionByName(popular)
