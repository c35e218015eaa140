"""Hard negatives: exact whole inner products by Strassen's recursion, kept in mergeable heaps."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from contrail.llm.common import prepare, slots
from contrail.llm.vectors import finite
from contrail.session import stage

#: Matrices are divided down to sides of so many rows or columns.
LEAF = 32
#: Rows of a tile, anchors down and candidates across, and the bytes of a block at most.
ANCHOR_ROWS, TILE_ROWS, BLOCK_BYTES = 256, 1_024, 4 << 20
#: Labels fall into so many buckets; a positive is looked for in the anchor's bucket.
BUCKETS = 16
#: Blocks of anchors that meet a block of rows in one group, and blocks of rows per salt.
GROUP_BLOCKS, SALT_BLOCKS = 64, 32
#: Results a task holds before it hands them on; groups of tasks whose lists merge first.
HELD_ROWS, MERGE_GROUPS = 1 << 20, 32
LEAST, MOST = -(2**63), 2**63 - 1
#: Positives a block of anchors has room for.
PLACES = 16

BLOCKS = "block string, dim int, bucket int, ids binary, labels binary, kind string, numbers binary, windows binary"


# Matrices


def _even(m: np.ndarray) -> np.ndarray:
    """``m`` with a row or column of zeros where a side is odd."""
    whole = np.zeros([side + side % 2 for side in m.shape], m.dtype)
    whole[: m.shape[0], : m.shape[1]] = m
    return whole


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b`` by seven products of halves; odd sides get a row or column of zeros.

    Sums of whole numbers are exact, and a long that runs over in between comes back when
    the result fits: additions are taken modulo 2^64.  Object arrays hold whole numbers of any size."""
    if min(*a.shape, b.shape[1]) <= LEAF:
        return a @ b
    rows, columns = a.shape[0], b.shape[1]
    a, b = _even(a), _even(b)
    i, j, k = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :k], b[:j, k:], b[j:, :k], b[j:, k:]
    m1 = strassen(a11 + a22, b11 + b22)
    m2 = strassen(a21 + a22, b11)
    m3 = strassen(a11, b12 - b22)
    m4 = strassen(a22, b21 - b11)
    m5 = strassen(a11 + a12, b22)
    m6 = strassen(a21 - a11, b11 + b12)
    m7 = strassen(a12 - a22, b21 + b22)
    whole = np.empty((2 * i, 2 * k), a.dtype)
    whole[:i, :k], whole[:i, k:] = m1 + m4 - m5 + m7, m3 + m5
    whole[i:, :k], whole[i:, k:] = m2 + m4, m1 - m2 + m3 + m6
    return whole[:rows, :columns]


def products(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Whole inner products of all pairs; beyond a long they stop at its ends."""
    bound = float(np.abs(anchors.astype(np.float64)).max(initial=0)) * float(np.abs(rows.astype(np.float64)).max(initial=0))
    if bound * anchors.shape[1] < 2**62:
        return strassen(anchors.astype(np.int64), rows.astype(np.int64).T)
    whole = lambda m: np.array([[int(x) for x in r] for r in m.tolist()], object)
    return np.clip(strassen(whole(anchors), whole(rows).T), LEAST, MOST).astype(np.int64)


# Heaps


def best_first(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The best ``k`` along the last axis, highest first, equal ones by id; all sorted anew."""
    by_id = np.argsort(ids, axis=-1, kind="stable")
    scores, ids = np.take_along_axis(scores, by_id, -1), np.take_along_axis(ids, by_id, -1)
    order = np.argsort(~scores, axis=-1, kind="stable")[..., :k]
    return np.take_along_axis(scores, order, -1), np.take_along_axis(ids, order, -1)


def take_best(scores: np.ndarray, ids: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The best ``k`` allowed columns of every row.  ``ids`` ascend, so the first of equal
    scores has the smallest; missing ones have the largest id."""
    left = np.where(allowed, scores, LEAST)
    found = np.full((len(scores), k), LEAST), np.full((len(scores), k), MOST)
    line = np.arange(len(scores))
    free = allowed.copy()
    for place in range(min(k, scores.shape[1])):
        if not free.any():
            break
        at = left.argmax(axis=1)
        # A row whose allowed scores all are the least long still has them.
        at = np.where(free[line, at], at, free.argmax(axis=1))
        real = free[line, at]
        found[0][real, place], found[1][real, place] = left[line, at][real], ids[at][real]
        left[line, at], free[line, at] = LEAST, False
    return found


def window(positive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest score ``n`` with ``50 p <= 100 n <= 95 p``, without leaving the longs."""
    whole, rest = positive // 100, positive % 100
    return -(-positive // 2), 95 * whole + 95 * rest // 100


# Blocks


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    """``id, label, v[, positives]`` packed: whole numbers in the smallest type that holds them,
    ids ascending, one length of vector and one bucket of labels to a block."""
    paired = "positives" in rows.columns

    def run(batches):
        held: dict[tuple, list] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = batch.column("v")
            sizes = np.asarray(pa.compute.list_value_length(lists))
            flat = np.floor(np.asarray(lists.flatten()).astype(np.float64))
            begin, ids, labels = np.cumsum(sizes) - sizes, batch.column("id").to_numpy(), batch.column("label").to_numpy()
            bucket = batch.column("bucket").to_numpy()
            pairs = _positives(batch.column("positives")) if paired else np.zeros((len(ids), 0, 2), np.int64)
            for dim, b in sorted(set(zip(sizes.tolist(), bucket.tolist(), strict=True))):
                at = np.flatnonzero((sizes == dim) & (bucket == b))
                held.setdefault((dim, b), []).append((ids[at], labels[at], flat[begin[at][:, None] + np.arange(dim)], pairs[at]))
                if sum(len(x[0]) for x in held[dim, b]) >= min(size, max(1, BLOCK_BYTES // (8 * dim))):
                    yield from made(dim, b, held.pop((dim, b)))
        for (dim, b), some in held.items():
            yield from made(dim, b, some)

    def made(dim, bucket, some):
        ids, labels, matrix, pairs = (np.concatenate(x) for x in zip(*some, strict=True))
        step = min(size, max(1, BLOCK_BYTES // (8 * dim)))
        for a in range(0, len(ids), step):
            order = a + np.argsort(ids[a : a + step], kind="stable")
            numbers = matrix[order]
            top = np.abs(numbers).max()
            kind = next((k for k, m in (("<i1", 2**7), ("<i2", 2**15), ("<i4", 2**31), ("<i8", 2**63)) if top < m), "<f8")
            cells = [ids[order].astype("<i8").tobytes(), labels[order].astype("<i8").tobytes(), kind, numbers.astype(kind).tobytes(), pairs[order].astype("<i8").tobytes()]
            values = [xxhash.xxh3_64_hexdigest(cells[0] + cells[1] + cells[3]), dim, bucket, *cells]
            types = [pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.string(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], [c.split()[0] for c in BLOCKS.split(", ")])

    return rows.mapInArrow(run, BLOCKS)


def _positives(lists: pa.Array) -> np.ndarray:
    """Ids and scores of the positives of each row, as many places as the longest list has;
    an empty place has the largest id."""
    sizes = np.asarray(pa.compute.list_value_length(lists))
    flat = lists.flatten()
    places = np.full((len(sizes), PLACES, 2), MOST)
    row = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    places[row, place, 0], places[row, place, 1] = (np.asarray(flat.field(c)) for c in ("vec_id", "score"))
    return places


def _met(anchors: DataFrame, rows: DataFrame, by_bucket: bool) -> DataFrame:
    """Every block of anchors with every block of rows of its length (and bucket), once."""
    spark = rows.sparkSession
    groups = 1 if by_bucket else max(1, math.ceil(anchors.count() / GROUP_BLOCKS))
    blocks = rows.count()
    salts = max(1, min(blocks, 2 * slots(spark)), math.ceil(blocks / SALT_BLOCKS))
    part = lambda n: F.pmod(F.xxhash64("block"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asked = anchors.withColumn("g", F.col("bucket") if by_bucket else part(groups)).withColumn("s", every(salts))
    asked = asked.select("g", "s", "dim", *[F.col(c).alias(f"a_{c}") for c in ("block", "ids", "labels", "kind", "numbers", "windows")])
    given = rows.withColumn("s", part(salts)).withColumn("g", F.col("bucket") if by_bucket else every(groups))
    return given.select("g", "s", "dim", "ids", "labels", "kind", "numbers").join(asked, ["g", "s", "dim"]).drop("g", "s")


def _matrix(row: dict, side: str = "") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, labels = (np.frombuffer(row[side + c], "<i8") for c in ("ids", "labels"))
    return ids, labels, np.frombuffer(row[side + "numbers"], row[side + "kind"]).reshape(-1, row["dim"])


def _heaps(tiles: DataFrame, select: Callable, k: int, schema: str, out: Callable) -> DataFrame:
    """Run ``select`` on every tile and merge the heaps of an anchor block within the task."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        heaps: dict[str, tuple] = {}
        for batch in batches:
            for row in batch.to_pylist():
                anchors, rows = _matrix(row, "a_"), _matrix(row)
                scores = products(anchors[2], rows[2])
                best = select(row, anchors, rows, scores)
                if row["a_block"] in heaps:
                    _, before = heaps[row["a_block"]]
                    best = best_first(*(np.concatenate(x, axis=-1) for x in zip(before, best, strict=True)), k)
                heaps[row["a_block"]] = (anchors[0].copy(), row["a_windows"]), best
                if sum(heap[0].size for _, heap in heaps.values()) > HELD_ROWS:
                    yield from emitted(heaps)
                    heaps.clear()
        yield from emitted(heaps)

    def emitted(heaps):
        for (ids, windows), (scores, found) in heaps.values():
            yield pa.RecordBatch.from_pydict(out(ids, windows, scores, found))

    return tiles.mapInArrow(run, schema)


def _merged(found: DataFrame, by: list[str], k: int, extra: list[str]) -> DataFrame:
    """The best ``k`` of each key, with their ranks: first per group of tasks, then over all."""
    first = [F.col("score").desc(), F.col("vec_id")]
    some = found.withColumn("_g", F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS)))
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy(*by, "_g").orderBy(*first))).filter(F.col("rank") <= k)
    whole = F.row_number().over(Window.partitionBy(*by).orderBy(*first))
    return some.drop("rank", "_g").withColumn("rank", whole).filter(F.col("rank") <= k).select(*by, *extra, "rank", "vec_id", "score")


def hard_negatives(
    df: DataFrame, is_anchor: Column, scale: float = 256.0, positives: int = 5, negatives: int = 3,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Components become ``floor(scale * x)``; a score is the whole inner product with the
    anchor, exact, and stops at the ends of a long.  An anchor's positives are its first rows
    of the same label, its negatives for a positive the first rows of other labels that score
    from half to 0.95 of the positive; highest scores first, ties by the smaller id.  A
    positive score below 0 leaves no room for negatives.

    Rows with a null id, label or vector, without components, or with a component that is
    null or not finite, scaled or not, take no part.  Only vectors of the same length are
    compared; rows with the anchor's own id are neither positive nor negative.  Of several
    anchors with one id the one of the smallest label, then vector, counts; other repeated
    rows count each.  Other columns are ignored.  No rows or no anchors give no rows.

    Rows are packed into blocks of one bucket of labels.  Positives come from tiles of the
    same bucket; then each anchor block takes its windows to every block.  Tiles keep the
    best of each row, tasks merge their tiles, and two groupings merge the tasks' heaps."""
    if not 1 <= positives <= PLACES:
        raise ValueError(f"from 1 to {PLACES} positives")
    spark = prepare(df.sparkSession, rows=16)
    vector = F.col(vector_col)
    scaled = F.transform(vector, lambda x: x.cast("double") * F.lit(scale))
    known = F.col(id_col).isNotNull() & F.col(label_col).isNotNull()
    usable = df.filter(finite(vector) & finite(scaled) & known)
    narrow = [F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), scaled.alias("v")]
    bucketed = lambda rows: rows.withColumn("bucket", F.pmod(F.xxhash64("label"), F.lit(BUCKETS)).cast("int"))
    rows, _ = stage(_blocks(bucketed(usable.select(*narrow)), TILE_ROWS), "negatives-rows")
    asked = usable.filter(is_anchor).select(*narrow).groupBy("id").agg(F.min(F.struct("label", "v")).alias("r"))
    asked, _ = stage(bucketed(asked.select("id", "r.label", "r.v")), "negatives-anchors")

    def same(row, anchors, others, scores):
        allowed = (anchors[1][:, None] == others[1]) & (anchors[0][:, None] != others[0])
        return take_best(scores, others[0], allowed, positives)

    def as_rows(ids, windows, scores, found):
        real = found != MOST
        return {"anchor_id": np.broadcast_to(ids[:, None], found.shape)[real], "vec_id": found[real], "score": scores[real]}

    anchors, _ = stage(_blocks(asked, ANCHOR_ROWS), "negatives-anchor-blocks")
    found = _heaps(_met(anchors, rows, by_bucket=True), same, positives, "anchor_id long, vec_id long, score long", as_rows)
    first = _merged(found, ["anchor_id"], positives, [])
    lists = first.groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("positives"))
    with_positives = asked.join(lists, asked["id"] == lists["anchor_id"]).drop("anchor_id")
    windows, _ = stage(_blocks(with_positives, ANCHOR_ROWS), "negatives-windows")

    def between(row, anchors, others, scores):
        places = np.frombuffer(row["a_windows"], "<i8").reshape(len(scores), PLACES, 2)
        other = anchors[1][:, None] != others[1]
        heaps = []
        for place in range(positives):
            low, high = window(places[:, place, 1])
            there = places[:, place, 0] != MOST
            allowed = other & (scores >= low[:, None]) & (scores <= high[:, None]) & there[:, None]
            heaps.append(take_best(scores, others[0], allowed & (anchors[0][:, None] != others[0]), negatives))
        return tuple(np.stack(x, axis=1) for x in zip(*heaps, strict=True))

    def with_windows(ids, windows, scores, found):
        places = np.frombuffer(windows, "<i8").reshape(len(ids), PLACES, 2)[:, :positives]
        real = found != MOST
        spread = lambda x: np.broadcast_to(x, found.shape)[real]
        return {
            "anchor_id": spread(ids[:, None, None]), "place": spread(np.arange(positives)[None, :, None]),
            "positive_id": spread(places[:, :, :1]), "positive_score": spread(places[:, :, 1:]),
            "vec_id": found[real], "score": scores[real],
        }

    schema = "anchor_id long, place long, positive_id long, positive_score long, vec_id long, score long"
    mined = _heaps(_met(windows, rows, by_bucket=False), between, negatives, schema, with_windows)
    kept = _merged(mined, ["anchor_id", "place"], negatives, ["positive_id", "positive_score"])
    return kept.select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )
