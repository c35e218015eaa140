"""Near copies of texts: BagMinHash signatures, bands, exact multiset overlap, components.

A document is the multiset of its five-word shingles.  Every shingle drives Poisson
processes over the discretised weights: one for the counts up to 1, one for those up to 2,
up to 4, and so on; a point of a process lies at a count and is kept if the shingle's own
count reaches it.  A point also names a register, and each register takes its earliest
point.  Two registers agree with the probability of the weighted Jaccard similarity."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from contrail.llm.common import prepare, text_parts, whole_text
from contrail.llm.components import components
from contrail.llm.tiles import starts, tile_pairs, tiled, whole_groups
from contrail.session import stage

WORDS, THRESHOLD = 5, 0.8
#: Registers of a signature; bands and registers of a band.  At a similarity of 0.8 all
#: bands miss with a probability of 0.00005.
REGISTERS, BANDS, BAND_ROWS = 128, 25, 5
#: Registers of the finer signature of those that share a bucket and are not yet connected.
FINE_REGISTERS = 1_280
#: Pairs whose registers agree this many standard errors below the threshold are not looked at.
ERRORS = 3.9
#: Points of a process that are drawn at once at most.
POINTS = 4_096
#: Residues of ids that are broadcast at most.
MARKS = 1 << 20
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _uniform(x: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1]."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0**-53


def shingles(texts: list[str], words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of the texts: row of the text, hash, count; by row, then hash.

    Words are parted by white space and compared in lower case.  A text with fewer words
    is one shingle of all of them; a text without any has none."""
    split = [t.lower().split() for t in texts]
    lengths = np.fromiter(map(len, split), np.int64, len(split))
    flat = [w for own in split for w in own]
    if not flat:
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64)
    codes, distinct = pd.factorize(pd.Series(flat, dtype=object))
    hashed = pd.util.hash_array(np.array(distinct, object), categorize=False)[codes]
    row = np.repeat(np.arange(len(split)), lengths)
    place = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    value = np.zeros(len(row), np.uint64)
    for k in range(words):
        ahead = np.zeros(len(row), np.uint64)
        ahead[: max(0, len(row) - k)] = hashed[k:]
        value = _mix(value * np.uint64(31) + np.where(place + k < lengths[row], ahead, np.uint64(0)) + np.uint64(k + 1))
    full = place <= np.maximum(lengths[row] - words, 0)
    row, value = row[full], value[full]
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.append(True, (row[1:] != row[:-1]) | (value[1:] != value[:-1]))
    at = np.flatnonzero(new)
    return row[at], value[at], np.diff(np.append(at, len(row)))


def signatures(row: np.ndarray, value: np.ndarray, count: np.ndarray, texts: int, registers: int = REGISTERS) -> np.ndarray:
    """Registers (texts, registers) of shingles with counts; 0 throughout for a text without any.

    Points are drawn in order of time for all shingles at once and only up to a horizon at
    which all registers of a text are likely to be full; texts with an empty register are
    drawn again up to twice the horizon, which gives the same earlier points."""
    result = np.zeros((texts, registers), np.uint64)
    if not len(row):
        return result
    total = np.bincount(row, weights=count, minlength=texts)
    horizon = (math.log(registers) + 2.0) / np.maximum(total, 1.0)
    todo = np.flatnonzero(total > 0)
    while len(todo):
        chosen = np.zeros(texts, bool)
        chosen[todo] = True
        own = chosen[row]
        times, marks = _earliest(row[own], value[own], count[own], texts, horizon, registers)
        full = np.isfinite(times[todo]).all(axis=1)
        result[todo[full]] = marks[todo[full]]
        todo = todo[~full]
        horizon[todo] *= 2
    return result


def _earliest(row, value, count, texts, horizon, registers):
    times = np.full(texts * registers, np.inf)
    marks = np.zeros(texts * registers, np.uint64)
    level, low = 0, 0  # the process covers the counts from low to high
    while len(row):
        high = max(1, 2 * low)
        span = high - low
        state = _mix(value + np.uint64((level + 1) * int(_GOLD) % (1 << 64)))
        # Each process is drawn up to the number of points to expect, then the few that
        # have not reached the horizon are drawn on.
        at, drawn, reach, text = np.zeros(len(row)), np.zeros(len(row), np.int64), count, row
        while len(at):
            due = (horizon[text] - at) * (span * registers)
            block = np.clip(np.ceil(due + 0.5 * np.sqrt(due)), 1, POINTS).astype(np.int64)
            ends = np.cumsum(block)
            own = np.repeat(np.arange(len(at)), block)
            number = np.arange(len(own)) + np.repeat(drawn - ends + block, block)
            who = _mix(state[own] + (number + 1).astype(np.uint64) * _GOLD)
            sums = np.cumsum(np.log(_uniform(who)))
            sums -= np.repeat(np.concatenate([[0.0], sums[ends[:-1] - 1]]), block)
            when = at[own] - sums / (span * registers)
            point = _mix(who ^ np.uint64(0xD6E8FEB86659FD93))
            kept = when <= horizon[text[own]]
            if span > 1:
                place = _uniform(_mix(point + _GOLD)) * span - 1e-18
                kept &= low + np.floor(place).clip(0, span - 1) < reach[own]
            cell = ((point[kept] >> np.uint64(32)) * np.uint64(registers) >> np.uint64(32)).astype(np.int64)
            _take(times, marks, text[own[kept]] * registers + cell, when[kept], point[kept])
            at = when[ends - 1]
            more = at <= horizon[text]
            state, at, drawn = state[more], at[more], (drawn + block)[more]
            reach, text = reach[more], text[more]
        low, level = high, level + 1
        more = count > low
        row, value, count = row[more], value[more], count[more]
    return times.reshape(texts, registers), marks.reshape(texts, registers)


def _take(times, marks, cell, at, point):
    np.minimum.at(times, cell, at)
    first = at == times[cell]
    marks[cell[first]] = point[first]


def _bands(marks: np.ndarray) -> np.ndarray:
    """A 64-bit number per band."""
    part = marks[:, : BANDS * BAND_ROWS].reshape(len(marks), BANDS, BAND_ROWS)
    value = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(marks), 1))
    for k in range(BAND_ROWS):
        value = _mix(value * np.uint64(31) + part[:, :, k])
    return value


def _sketched(classes: DataFrame, registers: int = REGISTERS) -> DataFrame:
    """``id, bands, sketch`` of every class with words: band numbers, and a byte per register."""

    def run(batches):
        for batch, texts in text_parts(batches, "text"):
            row, value, count = shingles(texts)
            has = np.unique(row)
            marks = signatures(row, value, count, len(texts), registers)[has]
            bands = _bands(marks).view(np.int64)
            sketch = (marks & np.uint64(0xFF)).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(pa.array(has)),
                    pa.array(list(bands), pa.list_(pa.int64())),
                    pa.array([s.tobytes() for s in sketch], pa.binary()),
                ],
                ["id", "bands", "sketch"],
            )

    return classes.select("id", "text").mapInArrow(run, "id long, bands array<long>, sketch binary")


def _elements(classes: DataFrame) -> DataFrame:
    """``id, items``: the multiset as a set: the k-th time of a shingle is an item of its own."""

    def run(batches):
        for batch, texts in text_parts(batches, "text"):
            row, value, count = shingles(texts)
            times = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
            items = _mix(np.repeat(value, count) + times.astype(np.uint64) * _GOLD).view(np.int64)
            ends = np.concatenate([[0], np.cumsum(np.bincount(row, weights=count, minlength=len(texts)))])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(items))
            yield pa.RecordBatch.from_arrays([batch.column("id"), lists], ["id", "items"])

    return classes.select("id", "text").mapInArrow(run, "id long, items array<long>")


def _texts_of(ids: DataFrame, texts: DataFrame) -> DataFrame:
    """The texts of some ids.  The ids fall into ``MARKS`` residues, at most so many rows to
    broadcast, which keep most other texts out of the shuffle."""
    residue = F.pmod(F.xxhash64("id"), F.lit(MARKS)).cast("int")
    marked = ids.select(residue.alias("_r")).distinct()
    few = texts.withColumn("_r", residue).join(F.broadcast(marked), "_r", "left_semi").drop("_r")
    return few.join(ids, "id", "left_semi")


def _verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Pairs ``a, b`` whose multisets overlap enough; exact, in the engine."""
    ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    items, _ = stage(_elements(_texts_of(ids, texts)), "minhash-items")
    right = pairs.join(items.select(F.col("id").alias("b"), F.col("items").alias("y")), "b")
    both = right.join(items.select(F.col("id").alias("a"), F.col("items").alias("x")), "a")
    shared = F.size(F.array_intersect("x", "y"))
    return both.filter(shared >= threshold * (F.size("x") + F.size("y") - shared)).select("a", "b")


def near_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: ``doc_id, component_id, kept``.

    Documents are linked if the weighted Jaccard similarity of their shingle multisets is
    at least ``threshold``; a component is what links connect, named by its smallest id,
    and ``kept`` marks that document.  Texts with the same words are one class and always
    linked.  Null, empty and blank texts have no shingle and link with nothing.  Ids should
    be unique and not null; other columns are ignored.  No rows give no rows.

    No list of all pairs of a bucket is made.  Each class of a bucket is first compared with
    the bucket's most central one; what that connects is one component.  Only classes that
    share a bucket and are still in different components meet again, in tiles of bounded
    size, and of these only pairs whose signatures agree enough are verified."""
    prepare(df.sparkSession)
    text = whole_text(text_col)
    keyed = df.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    keys = keyed.select(
        "doc_id", F.xxhash64("text").alias("h"), F.xxhash64(F.lit(1), "text").alias("g"),
        F.col("text").rlike(r"(?U)\S").alias("ok"),
    )
    narrow, _ = stage(keys, "minhash-keys")
    classes = narrow.filter("ok").groupBy("h", "g").agg(F.min("doc_id").alias("id"))
    # Every row is sketched where it is read; only the narrow sketches are shuffled.
    texts = keyed.withColumnRenamed("doc_id", "id")
    sketches, _ = stage(_sketched(texts).join(classes.select("id"), "id", "left_semi"), "minhash-sketches")
    bands = sketches.select("id", F.posexplode("bands").alias("band", "value"))
    sizes = bands.groupBy("band", "value").agg(F.count("*").alias("n")).filter("n > 1")
    members, _ = stage(bands.join(sizes, ["band", "value"]), "minhash-buckets")
    # The most central class of a bucket: in the largest buckets overall, then the smallest id.
    weight = members.groupBy("id").agg(F.sum("n").alias("w"))
    heavy = members.join(weight, "id")
    centre = heavy.groupBy("band", "value").agg(F.max_by("id", F.struct("w", -F.col("id"))).alias("centre"))
    star = heavy.join(centre, ["band", "value"]).filter("id <> centre")
    star = star.select(F.greatest("id", "centre").alias("a"), F.least("id", "centre").alias("b")).distinct()
    likely, _ = stage(_agreeing(star, sketches, _least(threshold, REGISTERS)), "minhash-pairs")
    first, _ = stage(_verified(likely, texts, threshold), "minhash-links")
    parts, _ = stage(components(first), "minhash-parts")
    left = _unconnected(members, parts)
    left, _ = stage(left, "minhash-open")
    few = _texts_of(left.select("id").distinct(), texts)
    fine = _sketched(few, FINE_REGISTERS).select("id", F.col("sketch").alias("fine")).dropDuplicates(["id"])
    both = sketches.select("id", "bands").dropDuplicates(["id"]).join(fine, "id")
    rest, _ = stage(_crossing(left, both, _least(threshold, FINE_REGISTERS)), "minhash-pairs")
    second, _ = stage(_verified(rest, texts, threshold), "minhash-links")
    whole = components(first.unionByName(second))
    by_class = classes.join(whole.withColumnRenamed("node", "id"), "id", "left").select("h", "g", "id", "component")
    joined = narrow.join(by_class, ["h", "g"], "left")
    component = F.when(F.col("ok"), F.coalesce("component", "id")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id") == F.col("component_id")
    )


def _least(threshold: float, registers: int) -> float:
    """Share of equal registers below which a pair is very unlikely to reach the threshold."""
    return threshold - ERRORS * math.sqrt(threshold * (1 - threshold) / registers)


def _agreeing(pairs: DataFrame, sketches: DataFrame, least: float) -> DataFrame:
    """Pairs whose signatures agree in at least a share ``least`` of the registers."""
    sketch = sketches.select("id", "sketch")
    both = pairs.join(sketch.toDF("a", "x"), "a").join(sketch.toDF("b", "y"), "b")

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8) for c in ("x", "y"))
                near = (x == y).reshape(batch.num_rows, -1).mean(axis=1) >= least
                yield batch.select(["a", "b"]).filter(pa.array(near))

    return both.mapInArrow(run, "a long, b long")


def _unconnected(members: DataFrame, parts: DataFrame) -> DataFrame:
    """Members of buckets that are not one component yet."""
    known = members.join(parts.withColumnRenamed("node", "id"), "id", "left").withColumn(
        "component", F.coalesce("component", "id")
    )
    open_ = known.groupBy("band", "value").agg(F.min("component").alias("x"), F.max("component").alias("y"))
    open_ = open_.filter("x <> y").select("band", "value")
    return known.join(open_, ["band", "value"]).select("band", "value", "id", "component")


def _crossing(left: DataFrame, signed: DataFrame, least: float) -> DataFrame:
    """Pairs of one bucket that are in different components and whose finer signatures agree
    enough; a pair comes from the first bucket that it shares."""
    spread = tiled(left.join(signed, "id"), ["band", "value"], "id")
    tile = ["band", "value", "_i", "_j"]

    def run(batches):
        for table in whole_groups(batches, tile, 4_096):
            begin = starts(table, tile)
            end = np.append(begin[1:], table.num_rows)
            ids, part = table.column("id").to_numpy(), table.column("component").to_numpy()
            sketch = np.frombuffer(b"".join(table.column("fine").to_pylist()), np.uint8).reshape(table.num_rows, -1)
            flat = table.column("bands").combine_chunks().flatten().to_numpy()
            bands = flat.reshape(table.num_rows, -1)
            band, chunk = table.column("band").to_numpy(), table.column("_chunk").to_numpy()
            i, j = table.column("_i").to_numpy()[begin], table.column("_j").to_numpy()[begin]

            def close(x, y):
                ok = part[x] != part[y]
                for k in range(0, len(x), 1 << 15):
                    some = slice(k, k + (1 << 15))
                    u, v = x[some], y[some]
                    met = (bands[u] == bands[v]).argmax(axis=1) == band[u]
                    near = (sketch[u] == sketch[v]).mean(axis=1) >= least
                    ok[some] &= met & near
                return ok

            def block(rows, columns):
                found = part[rows, None] != part[None, columns]
                x, y = np.nonzero(np.triu(found, 1))
                keep = close(x + rows.start, y + columns.start)
                found = np.zeros_like(found)
                found[x[keep], y[keep]] = True
                return found

            for x, y in tile_pairs(begin, end, chunk, i, j, close, block):
                if len(x):
                    a, b = np.maximum(ids[x], ids[y]), np.minimum(ids[x], ids[y])
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return spread.mapInArrow(run, "a long, b long")
