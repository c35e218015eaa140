"""Near copies among vectors: sign hashing by random hyperplanes, then exact cosines."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from contrail.llm.common import prepare
from contrail.llm.components import components
from contrail.llm.tiles import forest, starts, tile_pairs, tiled, whole_groups
from contrail.session import stage

#: Share of the links exactly at the threshold that the tables must find.
RECALL = 0.998
SEED = 20_240_102


def finite(column: Column) -> Column:
    """The vector has components and none is null, infinite or not a number."""
    value = lambda x: x.cast("double")
    odd = lambda x: x.isNull() | F.isnan(value(x)) | (F.abs(value(x)) == F.lit(float("inf")))
    return column.isNotNull() & (F.size(column) > 0) & ~F.exists(column, odd)


def tables_for(rows: int, threshold: float) -> tuple[int, int]:
    """Bits of a table, about the logarithm of the rows, and the tables needed for ``RECALL``."""
    bits = min(30, max(8, round(math.log2(max(2, rows))) - 1))
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - RECALL) / math.log(1 - same))


def _unit(matrix: np.ndarray) -> np.ndarray:
    # Scaled first: squares of very small or large components would leave the doubles.
    scaled = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def near_vectors(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.95
) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``.

    Vectors with a cosine of at least ``threshold`` are linked; none below is.  Null and
    zero vectors and those with null or non-finite components link with nothing, nor do
    vectors of different lengths.  Equal vectors are one class, compared once, and count
    each other as links; other columns are ignored.  Ids should be unique and not null; rows
    with the same id are different vectors of one component.  No rows give no rows.

    Each class goes into one bucket of every table (its vector is shuffled once per table);
    a bucket is compared in tiles, and a pair counts in the first table where it meets, so
    no list of pairs is made.  Tiles give link counts and spanning edges."""
    spark = prepare(df.sparkSession)
    vector = F.col(vector_col)
    usable = finite(vector) & F.exists(vector, lambda x: x != 0)
    keyed = df.select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("v"), usable.alias("ok"))
    keyed = keyed.withColumns({"h": F.xxhash64("v"), "g": F.xxhash64(F.lit(1), F.size("v"), F.reverse("v"))})
    classes = keyed.filter("ok").groupBy("h", "g").agg(
        F.min("vec_id").alias("id"), F.count("*").alias("n"), F.first("v").alias("v")
    )
    classes, _ = stage(classes, "vector-classes")
    bits, tables = tables_for(classes.count(), threshold)
    found, _ = stage(_links(_signed(classes, bits, tables), threshold), "vector-links")
    linked = found.filter("other is null").groupBy("id").agg(F.sum("links").alias("links"))
    parts = components(found.filter("other is not null").select(F.col("id").alias("a"), F.col("other").alias("b")))
    per_class = (
        classes.select("h", "g", "id", "n")
        .join(linked, "id", "left")
        .join(parts.withColumnRenamed("node", "id"), "id", "left")
        .select("h", "g", "id", "n", "links", "component")
    )
    joined = keyed.select("vec_id", F.when(F.col("ok"), F.col("h")).alias("h"), F.when(F.col("ok"), F.col("g")).alias("g"))
    joined = joined.join(per_class, ["h", "g"], "left")
    component = F.coalesce("component", "id", "vec_id")
    return joined.select(
        "vec_id",
        F.coalesce(F.col("n") - 1 + F.coalesce("links", F.lit(0)), F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        (F.col("vec_id") == component).alias("kept"),
    )


def _signed(classes: DataFrame, bits: int, tables: int) -> DataFrame:
    """A row per class and table: its bucket, its vector and its buckets in all tables."""
    weights = (1 << np.arange(bits, dtype=np.int64))[None, None, :]

    def run(batches):
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            lists = batch.column("v")
            size = np.asarray(pa.compute.list_value_length(lists))
            flat = np.asarray(lists.flatten()).astype(np.float64)
            begin = np.cumsum(size) - size
            ids, copies = batch.column("id").to_numpy(), batch.column("n").to_numpy()
            for dim in np.unique(size).tolist():
                rows = np.flatnonzero(size == dim)
                matrix = _unit(flat[begin[rows][:, None] + np.arange(dim)])
                if dim not in planes:
                    planes[dim] = np.random.default_rng([SEED, dim]).standard_normal((dim, bits * tables))
                signs = (matrix @ planes[dim] > 0).reshape(len(rows), tables, bits)
                buckets = (signs * weights).sum(axis=2)
                packed = [x.tobytes() for x in buckets.astype("<i4")]
                raw = [x.tobytes() for x in matrix.astype("<f8")]
                order = np.repeat(np.arange(len(rows)), tables)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.tile(np.arange(tables, dtype=np.int32), len(rows))),
                        pa.array(buckets.reshape(-1)),
                        pa.array(np.full(len(order), dim, np.int32)),
                        pa.array(ids[rows][order]), pa.array(copies[rows][order]),
                        pa.array(packed, pa.binary()).take(pa.array(order)),
                        pa.array(raw, pa.binary()).take(pa.array(order)),
                    ],
                    ["t", "bucket", "dim", "id", "n", "buckets", "v"],
                )

    schema = "t int, bucket long, dim int, id long, n long, buckets binary, v binary"
    return classes.select("id", "n", "v").mapInArrow(run, schema)


def _links(signed: DataFrame, threshold: float) -> DataFrame:
    """``id, links, null``: links of a class found in a tile; ``id, null, other``: edges."""
    keys = ["t", "bucket", "dim"]
    tile = [*keys, "_i", "_j"]

    def run(batches):
        for table in whole_groups(batches, tile):
            ids, copies = table.column("id").to_numpy(), table.column("n").to_numpy()
            begin = starts(table, tile)
            end = np.append(begin[1:], table.num_rows)
            t, dims = table.column("t").to_numpy(), table.column("dim").to_numpy()
            chunk = table.column("_chunk").to_numpy()
            i, j = table.column("_i").to_numpy()[begin], table.column("_j").to_numpy()[begin]
            joined = b"".join(table.column("buckets").to_pylist())
            buckets = np.frombuffer(joined, "<i4").reshape(table.num_rows, -1)
            raw = table.column("v")
            for dim in np.unique(dims).tolist():
                own = dims[begin] == dim
                at = np.flatnonzero(dims == dim)
                matrix = np.zeros((table.num_rows, dim))
                matrix[at] = np.frombuffer(b"".join(raw.take(pa.array(at)).to_pylist()), "<f8").reshape(-1, dim)
                yield from _found(matrix, buckets, t, ids, copies, threshold, begin[own], end[own], chunk, i[own], j[own])

    return tiled(signed, keys, "id").mapInArrow(run, "id long, links long, other long")


def _found(matrix, buckets, t, ids, copies, threshold, begin, end, chunk, i, j):
    def first(left, right, table):
        """The pair has met in no earlier table."""
        met = buckets[left] == buckets[right]
        return met.argmax(axis=-1) == table

    def test(left, right):
        near = np.einsum("ij,ij->i", matrix[left], matrix[right]) >= threshold
        near[near] = first(left[near], right[near], t[left[near]])
        return near

    def block(rows, columns):
        near = matrix[rows] @ matrix[columns].T >= threshold
        a, b = np.nonzero(near)
        keep = np.zeros(len(a), bool)
        for k in range(0, len(a), 1 << 16):
            x, y = a[k : k + (1 << 16)] + rows.start, b[k : k + (1 << 16)] + columns.start
            keep[k : k + (1 << 16)] = first(x, y, t[x])
        near[a[~keep], b[~keep]] = False
        return near

    pairs = list(tile_pairs(begin, end, chunk, i, j, test, block))
    left = np.concatenate([p[0] for p in pairs]) if pairs else np.empty(0, np.int64)
    right = np.concatenate([p[1] for p in pairs]) if pairs else np.empty(0, np.int64)
    if not len(left):
        return
    who = np.concatenate([ids[left], ids[right]])
    partners = np.concatenate([copies[right], copies[left]])
    node, at = np.unique(who, return_inverse=True)
    total = np.zeros(len(node), np.int64)
    np.add.at(total, at, partners)
    a, b = forest(ids[left], ids[right])
    nothing = pa.nulls(len(node), pa.int64())
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate([node, a])),
            pa.concat_arrays([pa.array(total), pa.nulls(len(a), pa.int64())]),
            pa.concat_arrays([nothing, pa.array(b)]),
        ],
        ["id", "links", "other"],
    )
