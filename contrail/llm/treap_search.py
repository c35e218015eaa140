"""Ranked lexical search: quadtrees of impacts over blocks of the term-document grid."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from contrail.llm.common import prepare, slots, whole_text
from contrail.session import stage

#: Documents and bytes of text of a block; a longer document is a block of its own.
BLOCK_DOCS, BLOCK_BYTES = 4_096, 8 << 20
#: Items in a group of queries, and items whose paths descend together.
GROUP_ITEMS, TOGETHER = 256, 32
#: Document ranges of an item that are opened at once, best first.
OPENED = 64
#: Query terms are broadcast up to so many bytes, and beyond that meet the blocks by shuffle.
BROADCAST_BYTES = 16 << 20
#: Result rows a task holds before it hands them on; groups of tasks whose lists merge first.
HELD_ROWS, MERGE_GROUPS = 1 << 20, 32

INDEX = "block string, n_docs int, ids binary, terms array<string>, counts array<int>, height int, masks binary, maxima binary"

_LETTERS = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


# Terms


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All terms of the texts one after the other, and the row of each.

    Every byte stands for itself, a separator or its lower-case form, so texts keep their
    places; bytes beyond ASCII belong to terms."""
    texts = texts.cast(pa.string()).fill_null("")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1]
    raw = memoryview(data)[at[0] : at[-1]].tobytes().translate(_LETTERS) if len(texts) and at[-1] > at[0] else b""
    moved = pa.py_buffer((at - at[0]).astype(np.int32).tobytes()) if len(texts) else offsets
    clean = pa.Array.from_buffers(pa.string(), len(texts), [None, moved, pa.py_buffer(raw)])
    lists = pc.ascii_split_whitespace(clean)
    rows = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    terms = lists.flatten()
    real = pc.greater(pc.binary_length(terms), 0)
    return terms.filter(real), rows[real.to_numpy(zero_copy_only=False)]


def statistics(documents: DataFrame, text_col: str = "text") -> tuple[int, int]:
    """Documents with at least one term, and all their terms."""

    def run(batches):
        docs = terms = 0
        for batch in batches:
            if batch.num_rows:
                rows = _words(batch.column(0))[1]
                docs, terms = docs + len(np.unique(rows)), terms + len(rows)
        yield pa.RecordBatch.from_arrays([pa.array([docs]), pa.array([terms])], ["docs", "terms"])

    counted = documents.select(whole_text(text_col).alias("t")).mapInArrow(run, "docs long, terms long")
    total = counted.agg(F.sum("docs").alias("d"), F.sum("terms").alias("t")).first()
    return total["d"] or 0, total["t"] or 0


# Trees


def _interleave(rows: np.ndarray, columns: np.ndarray, height: int) -> np.ndarray:
    code = np.zeros(len(rows), np.int64)
    for bit in range(height):
        code |= ((rows >> bit & 1) << (2 * bit + 1)) | ((columns >> bit & 1) << (2 * bit))
    return code


_POPCOUNT = np.array([bin(m).count("1") for m in range(16)], np.int64)
#: Children of a mask before quadrant ``q``.
_BEFORE = np.array([[bin(m & ((1 << q) - 1)).count("1") for q in range(4)] for m in range(16)], np.int64)


def build_tree(rows: np.ndarray, columns: np.ndarray, impacts: np.ndarray) -> tuple[int, bytes, bytes]:
    """Height, child masks and maxima of the quadtree over the cells ``(row, column)``.

    Level by level from the root, the nodes of a level in order of their place, so that the
    children of a node are found by counting the bits before it.  A node holds by how much
    its largest impact falls short of its parent's: small numbers, kept byte plane by plane."""
    height = max(1, int(max(rows.max(initial=0), columns.max(initial=0))).bit_length())
    code = _interleave(rows, columns, height)
    order = np.argsort(code, kind="stable")
    code, best = code[order], impacts[order].astype(np.int64)
    masks, short = [], []
    while len(code):
        parent = code >> 2
        first = np.flatnonzero(np.r_[True, parent[1:] != parent[:-1]])
        mask = np.bitwise_or.reduceat((1 << (code & 3)).astype(np.uint8), first)
        above = np.maximum.reduceat(best, first)
        short.append(np.repeat(above, _POPCOUNT[mask]) - best)
        masks.append(mask)
        code, best = parent[first], above
        if len(masks) == height:
            short.append(-best)
            break
    mask = np.concatenate(masks[::-1]) if masks else np.zeros(0, np.uint8)
    if len(mask) % 2:
        mask = np.r_[mask, np.uint8(0)]
    missing = np.concatenate(short[::-1]) if short else np.zeros(0, np.int64)
    if len(missing):
        missing[0] = -missing[0]
    planes = np.ascontiguousarray(missing.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()
    pack = zstandard.ZstdCompressor(level=1).compress
    return height, pack((mask[0::2] | mask[1::2] << 4).tobytes()), pack(planes)


@dataclass
class Tree:
    """An opened quadtree: masks of the inner nodes, first child and maximum of every node."""

    height: int
    masks: np.ndarray
    first: np.ndarray
    best: np.ndarray

    @classmethod
    def open(cls, height: int, masks: bytes, maxima: bytes) -> Tree:
        unpack = zstandard.ZstdDecompressor().decompress
        packed = np.frombuffer(unpack(masks), np.uint8)
        mask = np.stack([packed & 15, packed >> 4], 1).reshape(-1)
        missing = np.frombuffer(unpack(maxima), np.uint8).reshape(8, -1).T
        best = np.ascontiguousarray(missing).view("<u8").reshape(-1).astype(np.int64)
        children = _POPCOUNT[mask]
        first = 1 + np.cumsum(children) - children
        begin, end = 0, min(1, len(best))
        for _ in range(height):
            below = np.repeat(best[begin:end], children[begin:end])
            begin, end = end, end + len(below)
            best[begin:end] = below - best[begin:end]
        return cls(height, mask, first, best)


# Index


def _block(ids: pa.Array, texts: pa.Array, n_docs: int, n_terms: int) -> pa.RecordBatch | None:
    """The index row of a block of documents, ids ascending; rows of the grid by frequency."""
    order = pc.sort_indices(ids, null_placement="at_end")
    ids, texts = ids.take(order), texts.take(order)
    words, docs = _words(texts)
    if not len(words):
        return None
    coded = words.dictionary_encode()
    terms, code = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
    lengths = np.bincount(docs, minlength=len(ids))
    pair, tf = np.unique(code * len(ids) + docs, return_counts=True)
    term, doc = pair // len(ids), pair % len(ids)
    counts = np.bincount(term, minlength=len(terms))
    by_count = np.argsort(-counts, kind="stable")
    row_of = np.empty(len(terms), np.int64)
    row_of[by_count] = np.arange(len(terms))
    m = 50 + (50 * lengths * n_docs) // n_terms
    impact = (1_000_000_000 * tf) // (1000 * tf + 20 * m[doc])
    # Documents without an id count, but are no results.
    named = np.flatnonzero(doc < len(ids) - ids.null_count)
    height, masks, maxima = build_tree(row_of[term[named]], doc[named], impact[named])
    raw = ids.drop_null().to_numpy().astype("<i8").tobytes()
    values = {
        "block": xxhash.xxh3_64_hexdigest(raw + masks + maxima), "n_docs": len(ids) - ids.null_count, "ids": raw,
        "terms": terms.take(pa.array(by_count)), "counts": counts[by_count].astype(np.int32), "height": height,
        "masks": masks, "maxima": maxima,
    }
    kinds = [pa.string(), pa.int32(), pa.binary(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.int32(), pa.binary(), pa.binary()]
    arrays = [pa.array([v.to_pylist() if isinstance(v, pa.Array) else v], k) for v, k in zip(values.values(), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, list(values))


def build_index(documents: DataFrame, n_docs: int, n_terms: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per block of documents: their ids, terms with the documents that hold them, and
    the quadtree of impacts over terms and documents.

    ``n_docs`` and ``n_terms`` are those of ``statistics``; impacts depend on them.  Blocks
    are made where the documents are read; nothing is shuffled."""

    def run(batches):
        held, rows, size = [], 0, 0
        for batch in batches:
            lengths = pc.binary_length(batch.column(1)).to_pylist()
            begin = 0
            for at, length in enumerate(lengths):
                if rows + at - begin and (rows + at - begin >= BLOCK_DOCS or size + length > BLOCK_BYTES):
                    held.append(batch.slice(begin, at - begin))
                    yield from made(held)
                    held, rows, size, begin = [], 0, 0, at
                size += length
            if begin < batch.num_rows:
                held.append(batch.slice(begin))
                rows += batch.num_rows - begin
        if held:
            yield from made(held)

    def made(held):
        table = pa.Table.from_batches(held).combine_chunks()
        ids, texts = (table.column(k).chunk(0) for k in range(2)) if table.num_rows else (None, None)
        row = _block(ids, texts, n_docs, n_terms) if table.num_rows else None
        if row is not None:
            yield row

    narrow = documents.select(F.col(id_col).cast("long").alias("id"), whole_text(text_col).alias("text"))
    return narrow.mapInArrow(run, INDEX)


# Search


@dataclass
class Best:
    """The best ``k`` results of each of some items, sorted: highest first, then by id."""

    k: int
    item: np.ndarray
    score: np.ndarray
    doc: np.ndarray

    def add(self, item: np.ndarray, score: np.ndarray, doc: np.ndarray) -> None:
        item, score, doc = np.r_[self.item, item], np.r_[self.score, score], np.r_[self.doc, doc]
        order = np.lexsort((doc, -score, item))
        item, score, doc = item[order], score[order], doc[order]
        new = np.flatnonzero(np.r_[True, item[1:] != item[:-1]]) if len(item) else np.zeros(0, np.int64)
        rank = np.arange(len(item)) - np.repeat(new, np.diff(np.r_[new, len(item)]))
        kept = rank < self.k
        self.item, self.score, self.doc = item[kept], score[kept], doc[kept]

    def least(self, items: int) -> tuple[np.ndarray, np.ndarray]:
        """What a result must beat: score and id of the last of ``k``, or a score of 0."""
        count = np.bincount(self.item, minlength=items)
        last = np.cumsum(count) - 1
        full = count >= self.k
        score, doc = np.zeros(items, np.int64), np.full(items, -(2**63), np.int64)
        score[full], doc[full] = self.score[last[full]], self.doc[last[full]]
        return score, doc


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs, none of them empty."""
    return np.add.reduceat(values, np.cumsum(sizes) - sizes) if len(sizes) else np.zeros(0, np.int64)


def _runs(begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All positions of runs that begin at ``begin``."""
    start = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum())) + np.repeat(begin - start, sizes)


def descend(tree: Tree, ids: np.ndarray, item: np.ndarray, row: np.ndarray, weight: np.ndarray, best: Best, items: int) -> None:
    """Put the best documents of a block into ``best``.

    ``item``, ``row`` and ``weight`` say which rows of the grid belong to which item.  A state
    is a range of documents of one item with the nodes on the paths of its rows; the sum of
    their maxima, each times its weight, is at least the score of any document in the range.
    The ranges with the largest sums are halved first.  What cannot come before the last of
    the ``k`` best is left."""
    if not len(item) or not len(tree.best):
        return
    order = np.argsort(item, kind="stable")
    row, weight = row[order], weight[order]
    owner, sizes = np.unique(item, return_counts=True)
    level, column = np.zeros(len(owner), np.int64), np.zeros(len(owner), np.int64)
    term, node = np.arange(len(row)), np.zeros(len(row), np.int64)
    bound = _sums(weight * tree.best[0], sizes)
    while len(owner):
        # The best of each item.
        rank = np.lexsort((column, -bound, owner))
        new = np.flatnonzero(np.r_[True, owner[rank][1:] != owner[rank][:-1]])
        place = np.arange(len(rank)) - np.repeat(new, np.diff(np.r_[new, len(rank)]))
        chosen = np.zeros(len(owner), bool)
        chosen[rank[place < OPENED]] = True
        start = np.cumsum(sizes) - sizes
        some, others = np.flatnonzero(chosen), np.flatnonzero(~chosen)
        at = _runs(start[some], sizes[some])
        of = np.repeat(np.arange(len(some)), sizes[some])
        side = (row[term[at]] >> (tree.height - 1 - level[some])[of] & 1) * 2
        mask = tree.masks[node[at]]
        halves = []
        for half in (0, 1):
            there = (mask >> (side + half) & 1).astype(bool)
            child = tree.first[node[at][there]] + _BEFORE[mask[there], (side + half)[there]]
            state, count = np.unique(of[there], return_counts=True)
            value = _sums(weight[term[at][there]] * tree.best[child], count)
            halves.append((owner[some][state], level[some][state] + 1, 2 * column[some][state] + half, value, count, term[at][there], child))
        c_owner, c_level, c_column, c_bound, c_sizes, c_term, c_node = (np.concatenate(x) for x in zip(*halves, strict=True))
        done = c_level == tree.height
        real = done & (c_bound > 0)
        best.add(c_owner[real], c_bound[real], ids[c_column[real]])
        rest = _runs(start[others], sizes[others])
        entries = np.repeat(~done, c_sizes)
        owner, level = np.r_[owner[others], c_owner[~done]], np.r_[level[others], c_level[~done]]
        column, bound = np.r_[column[others], c_column[~done]], np.r_[bound[others], c_bound[~done]]
        term, node = np.r_[term[rest], c_term[entries]], np.r_[node[rest], c_node[entries]]
        sizes = np.r_[sizes[others], c_sizes[~done]]
        # Ids ascend with the columns: the first of a range is its smallest.
        score, doc = best.least(items)
        lowest = ids[column << (tree.height - level)]
        kept = (bound > score[owner]) | ((bound == score[owner]) & (bound > 0) & (lowest < doc[owner]))
        if not kept.all():
            entries = np.repeat(kept, sizes)
            owner, level, column, bound, sizes = owner[kept], level[kept], column[kept], bound[kept], sizes[kept]
            term, node = term[entries], node[entries]


def _search(batches: Iterable[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    lists: dict[int, tuple] = {}
    opened: tuple = (None, None)

    def emitted():
        for names, best in lists.values():
            for (first, _), _, own in best:
                columns = [names[first + own.item], own.doc, own.score]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["item_id", "doc_id", "score"])

    for batch in batches:
        for at in range(batch.num_rows):
            cell = {name: batch.column(name)[at] for name in batch.schema.names}
            group = cell["g"].as_py()
            if opened[0] != cell["block"].as_py():
                tree = Tree.open(*(cell[c].as_py() for c in ("height", "masks", "maxima")))
                opened = cell["block"].as_py(), tree, np.frombuffer(cell["ids"].as_py(), "<i8")
            asked = cell["asked"].values
            item, weight = (asked.field(c).to_numpy() for c in ("item_id", "weight"))
            row = pc.index_in(asked.field("term"), value_set=cell["terms"].values)
            found = np.flatnonzero(row.is_valid().to_numpy(zero_copy_only=False))
            row = row.fill_null(0).to_numpy().astype(np.int64)
            names, number = np.unique(item, return_inverse=True)
            if group not in lists:
                empty = np.zeros(0, np.int64)
                parts = [(a, min(a + TOGETHER, len(names))) for a in range(0, len(names), TOGETHER)]
                lists[group] = names, [(p, p[1] - p[0], Best(k, empty, empty, empty)) for p in parts]
            for (a, b), items, best in lists[group][1]:
                own = found[(number[found] >= a) & (number[found] < b)]
                descend(opened[1], opened[2], number[own] - a, row[own], weight[own], best, items)
            if sum(len(own.item) for _, best in lists.values() for _, _, own in best) > HELD_ROWS:
                yield from emitted()
                lists.clear()
    yield from emitted()


def _asked(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``item_id, term``: the terms of every item, once each."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                terms, rows = _words(batch.column(1))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), terms], ["item_id", "term"])

    narrow = items.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("item_id"), whole_text(text_col).alias("t"))
    return narrow.mapInArrow(run, "item_id long, term string").distinct()


def search(index: DataFrame, asked: DataFrame, n_docs: int, k: int) -> DataFrame:
    """``item_id, rank, doc_id, score``: the best ``k`` documents of each item.

    ``asked`` has the terms of the items (``item_id, term``, once each).  Every group of
    items meets every block by an equal join on the group; a task carries the best lists from
    block to block, so later blocks are cut off early, and two groupings merge its lists."""
    spark = index.sparkSession
    size = asked.agg(F.count_distinct("item_id").alias("n"), F.sum(F.octet_length("term") + 24).alias("b")).first()
    small = (size["b"] or 0) <= BROADCAST_BYTES
    bounded = F.broadcast if small else lambda df: df
    groups, salts = max(1, math.ceil(size["n"] / GROUP_ITEMS)), 1 if small else 2 * slots(spark)
    counted = index.select(F.explode(F.arrays_zip("terms", "counts")).alias("t")).select("t.terms", "t.counts")
    wanted = asked.select(F.col("term").alias("terms")).distinct()
    frequency = counted.join(bounded(wanted), "terms", "left_semi").groupBy("terms").agg(F.sum("counts").alias("df"))
    weight = F.floor(1000 * F.log((2 * F.lit(n_docs) + 2).cast("double") / (2 * F.col("df") + 1).cast("double")))
    weighted = asked.join(frequency, asked["term"] == frequency["terms"]).select("item_id", "term", weight.cast("long").alias("weight"))
    weighted = weighted.filter("weight > 0").withColumn("g", F.pmod(F.xxhash64("item_id"), F.lit(groups)).cast("int"))
    queries = weighted.groupBy("g").agg(F.collect_list(F.struct("item_id", "term", "weight")).alias("asked"))
    queries, _ = stage(queries.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))), "treap-queries")
    blocks = index.drop("counts", "n_docs").withColumns({
        "g": F.explode(F.sequence(F.lit(0), F.lit(groups - 1))), "s": F.pmod(F.xxhash64("block"), F.lit(salts)).cast("int"),
    })
    met = blocks.join(bounded(queries), ["g", "s"]).drop("s")
    found = met.mapInArrow(lambda batches: _search(batches, k), "item_id long, doc_id long, score long")
    first = [F.col("score").desc(), F.col("doc_id")]
    some = found.withColumn("_g", F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS)))
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("item_id", "_g").orderBy(*first)))
    merged = some.filter(F.col("rank") <= k).drop("rank", "_g")
    ranked = merged.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*first)))
    return ranked.filter(F.col("rank") <= k).select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def rank_documents(
    documents: DataFrame, items: DataFrame, k: int, id_col: str = "doc_id", text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of each item, scores above 0.

    Terms are runs of letters and digits of ASCII and of any other sign, A to Z lower-cased.
    A term weighs ``floor(1000 ln((2N+2)/(2df+1)))``; its impact in a document with ``tf`` of
    it is ``10^9 tf div (1000 tf + 20 m)`` with ``m = 50 + 50nN div L``.  Equal scores go by
    ascending id.

    Null and empty texts have no terms: such items give no rows, such documents do not count.
    Documents without an id count in all statistics and are no results; repeated rows are
    documents of their own, also under one id.  Items of the same id are one item with the
    terms of all; items without an id are left out.  Other columns are ignored.  No
    documents or no items give no rows."""
    prepare(documents.sparkSession, rows=128)
    n_docs, n_terms = statistics(documents, text_col)
    asked, _ = stage(_asked(items, item_id_col, item_text_col), "treap-terms")
    index, _ = stage(build_index(documents, n_docs, max(1, n_terms), id_col, text_col), "treap-index")
    prepare(documents.sparkSession, rows=4)
    return search(index, asked, n_docs, k)
