"""Exact top-k by inner product: tiles of queries and rows, merged like a tree."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from contrail.llm.common import prepare, slots
from contrail.llm.vectors import finite
from contrail.session import stage

#: Rows of a tile: queries down, candidates across.
QUERY_ROWS, SHARD_ROWS = 256, 1_024
#: Blocks of queries and of rows that meet in one group; groups in which lists merge first.
GROUP_BLOCKS, GROUP_SHARDS, MERGE_GROUPS = 64, 32, 32


def _blocks(df: DataFrame, rows: int) -> DataFrame:
    """Rows packed: ``dim, ids, numbers``, by length of vector; whole numbers as doubles."""

    def run(batches):
        held: dict[int, list] = {}
        for batch in batches:
            lists = batch.column("v")
            size = np.asarray(pa.compute.list_value_length(lists))
            flat = np.floor(np.asarray(lists.flatten()).astype(np.float64))
            begin, ids = np.cumsum(size) - size, batch.column("id").to_numpy()
            for dim in np.unique(size).tolist():
                at = np.flatnonzero(size == dim)
                held.setdefault(dim, []).append((ids[at], flat[begin[at][:, None] + np.arange(dim)]))
                if sum(len(x) for x, _ in held[dim]) >= rows:
                    yield from made(dim, held.pop(dim))
        for dim, some in held.items():
            yield from made(dim, some)

    def made(dim, some):
        ids, matrix = (np.concatenate(x) for x in zip(*some, strict=True))
        for a in range(0, len(ids), rows):
            part = [ids[a : a + rows].astype("<i8").tobytes(), matrix[a : a + rows].astype("<f8").tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), *map(pa.array, ([part[0]], [part[1]]))], ["dim", "ids", "numbers"])

    return df.mapInArrow(run, "dim int, ids binary, numbers binary")


def _products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact whole inner products; beyond a long they stop at its ends."""
    bound = np.abs(queries).max(initial=0) * np.abs(rows).max(initial=0) * queries.shape[1]
    if bound < 2**53:
        return (queries @ rows.T).astype(np.int64)
    whole = lambda m: np.array([[int(x) for x in r] for r in m.tolist()], object)
    product = whole(queries) @ whole(rows).T
    return np.clip(product, -(2**63), 2**63 - 1).astype(np.int64)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The best ``k`` of each row, ties to the smaller id.  ``ids`` is as wide as ``scores``."""
    if scores.shape[1] > 4 * k:
        # Whatever scores less than the k-th best is out; ties with it stay in for the sort.
        cut = np.partition(scores, scores.shape[1] - k, axis=1)[:, -k]
        width = int((scores >= cut[:, None]).sum(axis=1).max())
        at = np.argpartition(-scores.astype(np.float64), width - 1, axis=1)[:, :width] if width < scores.shape[1] else None
        if at is not None and np.abs(scores).max() < 2**53:
            scores, ids = np.take_along_axis(scores, at, 1), np.take_along_axis(ids, at, 1)
    # Best score first, and the smaller id first: two stable sorts.
    by_id = np.argsort(ids, axis=1, kind="stable")
    scores, ids = np.take_along_axis(scores, by_id, 1), np.take_along_axis(ids, by_id, 1)
    order = np.argsort(~scores, axis=1, kind="stable")[:, :k]
    return np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)


def top_k(df: DataFrame, is_query: Column, k: int, scale: float, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` best other rows (all, if fewer).

    Components become ``floor(scale * x)``; the score is the whole inner product, exact, and
    stops at the ends of a long.  Ties go to the smaller id.  Rows with a null id or vector
    or with null or non-finite components take no part, neither do rows without components;
    only vectors of the same length are compared.  Rows with a query's own id are left
    out.  No rows or no queries give no rows.

    Queries and rows are packed into blocks; each block of rows meets each block of queries
    once, by an equal join on the number of a group of query blocks.  A tile keeps the best
    ``k`` of each query, a task merges its tiles, and two groupings merge the tasks' lists."""
    spark = prepare(df.sparkSession, rows=16)
    vector = F.col(vector_col)
    scaled = F.transform(vector, lambda x: x.cast("double") * F.lit(scale))
    usable = df.filter(finite(vector) & finite(scaled) & F.col(id_col).isNotNull())
    rows = usable.select(F.col(id_col).cast("long").alias("id"), scaled.alias("v"))
    asked = usable.filter(is_query).select(F.col(id_col).cast("long").alias("id"), scaled.alias("v"))
    prepared, _ = stage(_blocks(asked, QUERY_ROWS), "topk-queries")
    groups = max(1, math.ceil(prepared.count() / GROUP_BLOCKS))
    blocks = math.ceil(rows.count() / SHARD_ROWS)
    salts = max(1, min(blocks, 2 * slots(spark)), math.ceil(blocks / GROUP_SHARDS))
    queries = prepared.select(
        F.pmod(F.xxhash64("ids"), F.lit(groups)).cast("int").alias("g"),
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("s"),
        "dim", F.col("ids").alias("q_ids"), F.col("numbers").alias("q"),
    )
    shards = _blocks(rows, SHARD_ROWS).select(
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"),
        F.pmod(F.xxhash64("ids"), F.lit(salts)).cast("int").alias("s"),
        "dim", "ids", "numbers",
    )
    tiles = shards.join(queries, ["g", "s", "dim"])

    def run(batches):
        lists: dict[bytes, tuple] = {}
        for batch in batches:
            for row in batch.to_pylist():
                own = np.frombuffer(row["q_ids"], "<i8")
                ids = np.frombuffer(row["ids"], "<i8")
                scores = _products(
                    np.frombuffer(row["q"], "<f8").reshape(-1, row["dim"]),
                    np.frombuffer(row["numbers"], "<f8").reshape(-1, row["dim"]),
                )
                wide = np.broadcast_to(ids, scores.shape)
                same = own[:, None] == ids[None, :]
                best = _best(np.where(same, -(2**63), scores), np.where(same, 2**63 - 1, wide), k)
                if row["q_ids"] in lists:
                    before = lists[row["q_ids"]]
                    best = _best(np.hstack([before[0], best[0]]), np.hstack([before[1], best[1]]), k)
                lists[row["q_ids"]] = best
        for q_ids, (scores, ids) in lists.items():
            own = np.repeat(np.frombuffer(q_ids, "<i8"), scores.shape[1])
            scores, ids = scores.reshape(-1), ids.reshape(-1)
            real = ids != 2**63 - 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(own[real]), pa.array(ids[real]), pa.array(scores[real])], ["query_id", "vec_id", "score"]
            )

    found = tiles.select("dim", "ids", "numbers", "q_ids", "q").mapInArrow(run, "query_id long, vec_id long, score long")
    best_first = [F.col("score").desc(), F.col("vec_id")]
    salted = found.withColumn("_g", F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS)))
    part = Window.partitionBy("query_id", "_g").orderBy(*best_first)
    some = salted.withColumn("rank", F.row_number().over(part)).filter(F.col("rank") <= k).drop("rank", "_g")
    whole = Window.partitionBy("query_id").orderBy(*best_first)
    return (
        some.withColumn("rank", F.row_number().over(whole)).filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
