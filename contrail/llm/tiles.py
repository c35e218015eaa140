"""Buckets of any size, compared in tiles of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Members of a bucket that one tile compares with one another.
TILE_ROWS = 1_024


def tiled(members: DataFrame, keys: list[str], id_col: str, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Members of buckets with at least two, spread over tiles and sorted by tile.

    A bucket of ``n`` members falls into ``c = ceil(n / tile_rows)`` chunks; tile ``(i, j)``
    has the chunks ``i`` and ``j``.  So every pair of a bucket meets in exactly one tile that
    compares it (tile ``(i, i)`` within the chunk, ``(i, j)`` across), and a task holds one
    tile at a time.  Adds ``_i``, ``_j`` and ``_chunk``."""
    sizes = members.groupBy(*keys).agg(F.count("*").alias("_n")).filter("_n > 1")
    placed = members.join(sizes, keys).withColumn("_c", F.ceil(F.col("_n") / tile_rows).cast("int"))
    placed = placed.withColumn("_chunk", F.pmod(F.xxhash64(id_col, F.lit(7)), F.col("_c")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("_c") - 1))
    spread = placed.withColumn("_other", other).withColumns(
        {"_i": F.least("_chunk", "_other"), "_j": F.greatest("_chunk", "_other")}
    )
    tile = [*keys, "_i", "_j"]
    return spread.drop("_n", "_c", "_other").repartition(*tile).sortWithinPartitions(*tile)


def whole_groups(batches: Iterable[pa.RecordBatch], keys: list[str], rows: int = 8_192) -> Iterator[pa.Table]:
    """Tables of about ``rows`` rows of sorted batches that never cut a group of ``keys``."""
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        count += batch.num_rows
        if count >= rows:
            table = pa.Table.from_batches(held)
            last = starts(table, keys)[-1]
            if last:
                yield table.slice(0, last).combine_chunks()
            held = table.slice(last).combine_chunks().to_batches()
            count = table.num_rows - last
            rows = max(rows, 2 * count)
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Row numbers at which a new group of sorted ``keys`` begins."""
    new = np.zeros(table.num_rows, bool)
    new[0] = True
    for key in keys:
        values = table.column(key).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def tile_pairs(
    begin: np.ndarray, end: np.ndarray, chunk: np.ndarray, i: np.ndarray, j: np.ndarray,
    test: Callable[[np.ndarray, np.ndarray], np.ndarray], block: Callable[[slice, slice], np.ndarray],
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows that pass, group by group (``begin`` to ``end``).

    Small groups are compared all at once, each row with the one ``d`` places on, by
    ``test(rows, rows)``; larger ones by ``block(rows, rows)``, which gives a matrix."""
    sizes = end - begin
    small = sizes <= 32
    if small.any():
        group = np.repeat(np.arange(len(begin)), sizes)
        place = np.arange(len(group)) + (begin - np.cumsum(sizes) + sizes)[group]
        apart = i != j
        rows = place[small[group]]
        own = group[small[group]]
        for d in range(1, int(sizes[small].max())):
            left = rows[rows + d < end[own]]
            group_of = own[rows + d < end[own]]
            right = left + d
            meant = ~apart[group_of] | (chunk[left] != chunk[right])
            left, right = left[meant], right[meant]
            if len(left):
                passed = test(left, right)
                yield left[passed], right[passed]
    for g in np.flatnonzero(~small):
        a, b = int(begin[g]), int(end[g])
        found = block(slice(a, b), slice(a, b))
        found &= np.arange(a, b)[:, None] < np.arange(a, b)[None, :]
        if i[g] != j[g]:
            found &= chunk[a:b, None] != chunk[None, a:b]
        left, right = np.nonzero(found)
        yield left + a, right + a


def forest(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what ``left`` and ``right`` connect, one per node that is not the smallest."""
    nodes, at = np.unique(np.concatenate([left, right]), return_inverse=True)
    a, b = at[: len(left)], at[len(left) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]
