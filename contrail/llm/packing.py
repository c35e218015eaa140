"""Best-fit packing into sequences of fixed length, in rounds of a tree.

Each partition first packs its items where they are, best-fit, largest first.  Nearly full
bins are done and written once; only the items of the others are shuffled and packed in
rounds, where nearly full bins are done again and the others go on as items of a round with
an eighth of the partitions.  The rounds end when one no longer lowers the number of bins.
A bin carries its items with all their columns, so no round joins anything back."""

from __future__ import annotations

import functools
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from contrail.llm.common import BATCH_ROWS, free_name, prepare, text_parts, whole_text
from contrail.llm.word_codec import WordCodec
from contrail.session import stage

#: Items that a task packs at once, and partitions that meet in one of the next round.
BLOCK_ITEMS, FAN_IN = 50_000, 8
#: Tokens that a task packs at once, as items may carry them.
BLOCK_TOKENS = 8 << 20
#: A bin with at most this share of room left is nearly full.
SLACK = 1 / 512


def best_fit(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Bin of each item: largest first, each into the fullest bin that it fits."""
    bins = np.empty(len(sizes), np.int64)
    room: dict[int, list[int]] = {}
    open_rooms, count = 0, 0  # bit r: some bin has room r
    for at in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[at])
        fits = open_rooms >> size
        if fits:
            left = size + (fits & -fits).bit_length() - 1
            stack = room[left]
            bin_ = stack.pop()
            if not stack:
                open_rooms ^= 1 << left
        else:
            left, bin_, count = capacity, count, count + 1
        bins[at] = bin_
        left -= size
        if not room.setdefault(left, []):
            open_rooms |= 1 << left
        room[left].append(bin_)
    return bins


def _pack_block(used: np.ndarray, members: pa.ListArray, bins: np.ndarray) -> tuple[np.ndarray, pa.ListArray]:
    """Bins of a block: tokens used, and the items one after the other."""
    order = np.argsort(bins, kind="stable")
    taken = members.take(pa.array(order))
    lengths = np.asarray(pa.compute.list_value_length(taken)).astype(np.int64)
    count = int(bins.max()) + 1 if len(bins) else 0
    per_bin = np.bincount(bins[order], weights=lengths, minlength=count).astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(per_bin)]).astype(np.int32)
    total = np.bincount(bins, weights=used, minlength=count).astype(np.int64)
    return total, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), taken.flatten())


def _nearly_full(used: np.ndarray, members: pa.ListArray, capacity: int, near: int) -> tuple[np.ndarray, pa.ListArray]:
    """Bins of a block as far as they are nearly full, then the other items each alone."""
    bins = best_fit(used, capacity)
    full = np.bincount(bins, weights=used)[bins] >= near
    bins[~full] = len(used) + np.arange(len(used) - full.sum())
    return _pack_block(used, members, np.unique(bins, return_inverse=True)[1])


def _alone(batches: Iterable[pa.RecordBatch], length_col: str, capacity: int) -> Iterator[pa.RecordBatch]:
    """Every item as a bin of its own."""
    for batch in batches:
        used = pa.compute.fill_null(batch.column(length_col).cast(pa.int64()), 0)
        sizes = used.to_numpy()
        if len(sizes) and (sizes.min() < 0 or sizes.max() > capacity):
            raise ValueError(f"an item is longer than {capacity} or shorter than 0")
        items = pa.StructArray.from_arrays(batch.columns, fields=list(batch.schema))
        members = pa.ListArray.from_arrays(pa.array(np.arange(len(sizes) + 1), pa.int32()), items)
        yield pa.RecordBatch.from_arrays([used, members], ["used", "members"])


def _packed(batches: Iterable[pa.RecordBatch], capacity: int, number: int) -> Iterator[pa.RecordBatch]:
    """One round in a task: bins in, fewer bins out, each with a number of its own."""
    near = capacity - int(capacity * SLACK)
    task, made, waiting, rows, tokens = TaskContext.get().partitionId(), 0, [], 0, 0

    def block():
        nonlocal made
        table = pa.Table.from_batches(waiting).combine_chunks()
        used = table.column("used").to_numpy()
        members = table.column("members").chunk(0)
        if number:
            total, joined = _pack_block(used, members, best_fit(used, capacity))
        else:
            total, joined = _nearly_full(used, members, capacity, near)
        ids = (number << 56) + (task << 32) + made + np.arange(len(total))
        made += len(total)
        whole = pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(total, pa.int64()), pa.array(total < near), joined],
            ["bin", "used", "open", "members"],
        )
        return [whole.slice(k, BATCH_ROWS) for k in range(0, whole.num_rows, BATCH_ROWS)]

    for batch in batches:
        if not batch.num_rows:
            continue
        waiting.append(batch)
        rows += batch.num_rows
        tokens += pa.compute.sum(batch.column("used")).as_py() or 0
        if rows >= BLOCK_ITEMS or tokens >= BLOCK_TOKENS:
            yield from block()
            waiting, rows, tokens = [], 0, 0
    if rows:
        yield from block()


def _bin_schema(items: T.StructType) -> T.StructType:
    return T.StructType().add("bin", "long").add("used", "long").add("open", "boolean").add("members", T.ArrayType(items))


def _round(bins: DataFrame, capacity: int, number: int, items: T.StructType) -> DataFrame:
    run = lambda batches: _packed(batches, capacity, number)
    return bins.select("used", "members").mapInArrow(run, _bin_schema(items))


def pack(items: DataFrame, length_col: str, capacity: int) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to every item; the items of a sequence lie gapless
    from 0 and fill ``capacity`` at most.

    Sequence numbers are unique, not consecutive.  Null lengths count as 0; a length over
    ``capacity`` or below 0 fails.  Repeated rows are items of their own.  No items: no rows.
    All columns are carried, and written once.  What is not nearly full in its partition is shuffled, and again
    in each round."""
    prepare(items.sparkSession)
    return _pack_made(items, lambda batches: batches, items.schema, length_col, capacity)


def _pack_made(source: DataFrame, make, schema: T.StructType, length_col: str, capacity: int) -> DataFrame:
    """Pack the items that ``make`` gives for the batches of ``source``, in the tasks that make them."""
    for name in ("sequence_id", "offset"):
        if name in schema.names:
            raise ValueError(f"the input already has a column {name}")
    first = lambda batches: _packed(_alone(make(batches), length_col, capacity), capacity, 0)
    bins, _ = stage(source.mapInArrow(first, _bin_schema(schema)), "pack-first")
    done, open_, number = [bins.filter(~F.col("open"))], bins.filter("open"), 1
    before, width = _extent(open_)
    while before:
        bins, _ = stage(_round(open_.repartition(width), capacity, number, schema), "pack-round")
        done.append(bins.filter(~F.col("open")))
        rest = bins.filter("open")
        after, needed = _extent(rest)
        if after <= 1 or (number > 1 and after >= before) or width == 1:
            done.append(rest)
            break
        open_, before, number = rest, after, number + 1
        width = max(needed, math.ceil(width / FAN_IN) if needed > 1 else 1)
    all_bins = functools.reduce(DataFrame.unionByName, done)
    return _places(all_bins, schema, length_col)


def _extent(bins: DataFrame) -> tuple[int, int]:
    """Number of bins, and how many tasks they are for."""
    row = bins.agg(F.count(F.lit(1)).alias("n"), F.sum("used").alias("tokens")).first()
    return row["n"], max(1, math.ceil(row["n"] / BLOCK_ITEMS), math.ceil((row["tokens"] or 0) / BLOCK_TOKENS))


def _places(bins: DataFrame, schema: T.StructType, length_col: str) -> DataFrame:
    """One row per item, with its sequence and its place there."""
    out = T.StructType(schema.fields).add("sequence_id", "long").add("offset", "long")

    def run(batches):
        for batch in batches:
            members = batch.column("members")
            flat = members.flatten()
            count = np.asarray(pa.compute.list_value_length(members)).astype(np.int64)
            columns = flat.flatten()
            sizes = pa.compute.fill_null(columns[schema.names.index(length_col)], 0).to_numpy(zero_copy_only=False)
            before = np.cumsum(sizes) - sizes
            first = np.cumsum(count) - count
            place = before - np.repeat(before[first], count) if len(before) else before
            ids = np.repeat(batch.column("bin").to_numpy(), count)
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(ids, pa.int64()), pa.array(place, pa.int64())], out.names
            )

    return bins.select("bin", "members").mapInArrow(run, out)


def pack_documents(
    df: DataFrame, tokenizer_file: str, capacity: int, end_id: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The pieces of ``cut_documents`` with their ``sequence_id`` and ``offset``, packed by the
    tasks that cut them: pieces are written for the first time in bins."""
    return _pack_made(*_cutter(df, tokenizer_file, capacity, end_id, id_col, text_col), "length", capacity)


def cut_documents(
    df: DataFrame, tokenizer_file: str, capacity: int, end_id: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Token pieces of whole texts: ``doc_id, piece, start, length, ids``.

    A document's ids are its text's (null: none) and ``end_id``.  Only a longer document
    than ``capacity`` is cut; its last piece may be shorter.  ``ids`` is binary,
    little-endian unsigned 32-bit integers.  Repeated rows give repeated pieces; other
    columns are left out.  No shuffle."""
    named, run, schema = _cutter(df, tokenizer_file, capacity, end_id, id_col, text_col)
    return named.mapInArrow(run, schema)


def _cutter(df: DataFrame, tokenizer_file: str, capacity: int, end_id: int, id_col: str, text_col: str):
    """What is read, what cuts its batches, and the schema of the pieces."""
    prepare(df.sparkSession)
    with open(tokenizer_file, encoding="utf-8") as file:
        spec = file.read()
    key = free_name(df, "_key")
    named = df.select(F.col(id_col).alias(key), whole_text(text_col).alias("_text"))
    schema = T.StructType().add("doc_id", df.schema[id_col].dataType).add("piece", "integer")
    schema = schema.add("start", "long").add("length", "long").add("ids", "binary")

    def run(batches):
        codec = _codec(spec)
        for batch, texts in text_parts(batches, "_text"):
            row, piece, start, length, ids = [], [], [], [], []
            for at, own in enumerate(codec.encode(texts)):
                whole = np.append(own, end_id).astype("<u4")
                for k, begin in enumerate(range(0, len(whole), capacity)):
                    part = whole[begin : begin + capacity]
                    row.append(at)
                    piece.append(k)
                    start.append(begin)
                    length.append(len(part))
                    ids.append(part.tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary()),
                ],
                schema.names,
            )

    return named, run, schema


@functools.lru_cache(maxsize=2)
def _codec(spec: str) -> WordCodec:
    return WordCodec(spec)
