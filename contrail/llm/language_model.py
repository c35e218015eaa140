"""Scores of texts under an interpolated bigram model learned from the corpus.

Deleted interpolation: the estimates of bigram, word and uniform are mixed with weights
that depend on how often the context occurs; the weights are learned by expectation
maximisation on counts of training documents held out from the estimates.

Documents are packed into batches of some megabytes.  A batch asks for the counts of its
distinct words and bigrams: sorted 64-bit hashes in one block per range of the hash.  The
task of a range adds up the counts of all batches and answers each block in its order, so
no key travels back and no task holds the counts of the corpus."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from contrail.llm.common import parts, prepare, slots, whole_text
from contrail.llm.language_id import fold
from contrail.session import stage

#: Text of a batch, and keys of a range: what a task holds.
BATCH_BYTES, RANGE_KEYS = 4 << 20, 3_000_000
#: Text whose words are Python objects at a time, and keys of a range that are sorted at once.
WORDS_BYTES, SLICE_KEYS = 1 << 18, 1 << 18
#: Of the ten folds by checksum: never learned from; estimates made without it at first.
TEST_FOLD, WEIGHT_FOLD, FOLDS = 0, 1, 10
ROUNDS = 10
_END = np.uint64(0x9E3779B97F4A7C15)
_WORD, _PAIR = 1, 2
ADD = 0.1


def _mix(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def squeeze(keys: np.ndarray) -> bytes:
    """Sorted numbers as differences, byte by byte, so that their empty upper bytes compress."""
    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    return steps.view(np.uint8).reshape(-1, 8).T.tobytes()


def unsqueeze(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).reshape(-1).view("<u8"), dtype=np.uint64)


def _short(counts: np.ndarray) -> bytes:
    """Counts byte by byte, as squeezed keys are."""
    return counts.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _long(data: bytes, kind: str = "<i8") -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view("<u4").astype(kind)


def _slices(keys: list[np.ndarray]) -> Iterator[list[slice]]:
    """Equal ranges of sorted blocks of hashes, each as the places of its keys in every block."""
    count = math.ceil(sum(map(len, keys)) / SLICE_KEYS)
    low, high = min(int(k[0]) for k in keys), max(int(k[-1]) for k in keys)
    step = (high - low) // count + 1
    edges = np.array([low + step * s for s in range(1, count)], np.uint64)
    cuts = [[0, *np.searchsorted(k, edges).tolist(), len(k)] for k in keys]
    for s in range(count):
        yield [slice(c[s], c[s + 1]) for c in cuts]


def _word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word of some texts, end to end, and how many words each has."""
    words = [t.lower().split() for t in texts]  # bytes: only A-Z change, only ASCII blanks split
    codes, distinct = pd.factorize(np.fromiter(chain.from_iterable(words), object, sum(map(len, words))))
    if not len(distinct):
        return np.zeros(0, np.uint64), np.zeros(len(words), np.int64)
    hashed = pd.util.hash_array(np.array([w.decode() for w in distinct], object), categorize=False)
    return hashed[codes], np.fromiter(map(len, words), np.int64, len(words))


class Tokens:
    """Words and bigrams of documents, ends included: distinct keys and the key of each token."""

    def __init__(self, texts: list[bytes]):
        hashed, counts = [np.array([_END], np.uint64)], []
        # Python's words are many times the text: they live for one part only.
        for begin, end in parts(map(len, texts), WORDS_BYTES):
            own, lengths = _word_hashes(texts[begin:end])
            hashed.append(own)
            counts.append(lengths)
        self.lengths = np.concatenate(counts) + 1 if counts else np.zeros(0, np.int64)
        self.ends = np.cumsum(self.lengths)
        codes, distinct = pd.factorize(np.concatenate(hashed))
        del hashed
        self.words, place = np.unique(distinct, return_inverse=True)
        last = np.zeros(int(self.lengths.sum()), bool)
        last[self.ends - 1] = True
        self.word = np.empty(len(last), np.int64)
        self.word[last], self.word[~last] = place[0], place[codes[1:]]
        # The start of a text is a context as often as the end is a word: they share a key.
        self.context = np.roll(self.word, 1)
        self.context[self.ends - self.lengths] = place[0]
        values = _mix(self.words)
        self.pairs, self.pair = np.unique(_mix(self.words[self.context] * np.uint64(3) + values[self.word]), return_inverse=True)

    def sums(self, values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values, self.ends - self.lengths)


def _pack(documents: DataFrame) -> DataFrame:
    """Documents to rows of some megabytes each: ``batch, ids, folds, texts, lengths``."""

    def run(batches):
        task, made, held, size = TaskContext.get().partitionId(), 0, [], 0

        def row():
            ids, folds, texts = zip(*held, strict=True)
            squeezed = zstandard.ZstdCompressor(level=3).compress(b"".join(texts))
            longs = pa.list_(pa.int64())
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([(task << 32) + made], pa.int64()), pa.array([ids], longs), pa.array([folds], longs),
                    pa.array([squeezed], pa.binary()), pa.array([list(map(len, texts))], longs),
                ],
                ["batch", "ids", "folds", "texts", "lengths"],
            )

        for batch in batches:
            columns = (batch.column(k).to_pylist() for k in range(3))
            for doc, f, text in zip(*columns, strict=True):
                held.append((doc, f, raw := text.encode()))
                size += len(raw) + 16
                if size >= BATCH_BYTES:
                    yield row()
                    held, size, made = [], 0, made + 1
        if held:
            yield row()

    schema = "batch long, ids array<long>, folds array<long>, texts binary, lengths array<long>"
    return documents.select("doc_id", "fold", "text").mapInArrow(run, schema)


def _unpacked(row: dict) -> tuple[list[int], np.ndarray, Tokens]:
    raw = zstandard.ZstdDecompressor().decompress(row["texts"], max_output_size=sum(row["lengths"]) + 1)
    ends = np.cumsum(row["lengths"]).tolist()
    texts = [raw[e - n : e] for e, n in zip(ends, row["lengths"], strict=True)]
    return row["ids"], np.array(row["folds"]), Tokens(texts)


def _requests(batches: DataFrame, ranges: int) -> DataFrame:
    """Blocks of keys: ``range, batch, kind, keys, main, held`` (counts in this batch)."""
    width = (1 << 64) // ranges + 1
    edges = np.array([width * r for r in range(1, ranges)], np.uint64)

    def run(batches):
        for record in batches:
            for row in record.to_pylist():
                _, folds, tokens = _unpacked(row)
                of = np.repeat(folds, tokens.lengths)
                out = []
                for kind, distinct, at in ((_WORD, tokens.words, tokens.word), (_PAIR, tokens.pairs, tokens.pair)):
                    main = np.bincount(at, weights=(of != TEST_FOLD) & (of != WEIGHT_FOLD), minlength=len(distinct))
                    held = np.bincount(at, weights=of == WEIGHT_FOLD, minlength=len(distinct))
                    cuts = [0, *np.searchsorted(distinct, edges).tolist(), len(distinct)]
                    for r, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                        if b > a:
                            out.append((r, row["batch"], kind, squeeze(distinct[a:b]), _short(main[a:b]), _short(held[a:b])))
                types = (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
                arrays = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, ["range", "batch", "kind", "keys", "main", "held"])

    return batches.mapInArrow(run, "range int, batch long, kind int, keys binary, main binary, held binary")


def _answers(requests: DataFrame) -> DataFrame:
    """The counts of the corpus for each block, in its order, and sums over a range's words."""

    def run(blocks: pa.Table) -> pa.Table:
        keys = [unsqueeze(k.as_buffer()) for k in blocks.column("keys")]
        counts = [[_long(c.as_buffer(), "<u4") for c in blocks.column(name)] for name in ("main", "held")]
        sums = [0, 0, 0]
        for places in _slices(keys):
            own = [k[place] for k, place in zip(keys, places, strict=True)]
            ends = np.cumsum([len(k) for k in own])[:-1]
            distinct, at = np.unique(np.concatenate(own), return_inverse=True)
            totals = []
            for kept in counts:
                here = np.concatenate([c[place] for c, place in zip(kept, places, strict=True)])
                totals.append(np.bincount(at, weights=here, minlength=len(distinct)).astype(np.int64))
                # The counts of a slice are read once: the answers take their place.
                for c, place, answer in zip(kept, places, np.split(totals[-1][at], ends), strict=True):
                    c[place] = answer
            found = [int((totals[0] + totals[1] > 0).sum()), int(totals[0].sum()), int(totals[1].sum())]
            sums = [a + b for a, b in zip(sums, found, strict=True)]
        answers = [[_short(c) for c in kept] for kept in counts]
        zero = np.zeros(blocks.num_rows, np.int64)
        if blocks.column("kind")[0].as_py() != _WORD:
            sums = [0, 0, 0]
        figures = [pa.array(np.concatenate([[s], zero[1:]])) for s in sums]
        return pa.Table.from_arrays(
            [
                blocks.column("batch"), blocks.column("kind"), blocks.column("range"),
                *(pa.array(a, pa.binary()) for a in answers), *figures,
            ],
            ["batch", "kind", "range", "main", "held", "types", "main_tokens", "held_tokens"],
        )

    schema = "batch long, kind int, range int, main binary, held binary, types long, main_tokens long, held_tokens long"
    return requests.groupBy("range", "kind").applyInArrow(run, schema)


def _counted(tokens: Tokens, answers: list[dict], with_held: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts of bigram, context and word of every token of a batch, from the answers to it."""
    ordered = sorted(answers, key=lambda a: (a["kind"], a["range"]))
    by = {}
    for kind in (_WORD, _PAIR):
        own = [a for a in ordered if a["kind"] == kind]
        main, held = (np.concatenate([_long(a[c]) for a in own]) for c in ("main", "held"))
        by[kind] = main + held if with_held else main
    return by[_PAIR][tokens.pair], by[_WORD][tokens.context], by[_WORD][tokens.word]


def _bucket(context: np.ndarray) -> np.ndarray:
    """Bucket of a context by how often it occurs: the number of binary digits."""
    return np.frexp(context.astype(np.float64))[1]


BUCKETS = 64


def _estimates(pair, context, word, total: int, types: int) -> np.ndarray:
    """Bigram, word and uniform estimate of every token."""
    return np.stack([
        pair / np.maximum(context, 1), word / max(total, 1), np.full(len(pair), 1.0 / (types + 1)),
    ])


def _learn(facts: DataFrame, total: int, types: int) -> np.ndarray:
    """Weights per bucket by expectation maximisation on the held-out tokens."""
    weights = np.tile([0.6, 0.3, 0.1], (BUCKETS, 1))
    weights[0] = [0.0, 0.9, 0.1]

    def shares(batches, now: np.ndarray):
        sums = np.zeros((BUCKETS, 3))
        for batch in batches:
            for raw in batch.column("facts").to_pylist():
                pair, context, word, times = np.frombuffer(zstandard.decompress(raw), "<i8").reshape(4, -1)
                bucket = _bucket(context)
                parts = _estimates(pair, context, word, total, types) * now[bucket].T
                parts *= times / parts.sum(axis=0)
                for k in range(3):
                    sums[:, k] += np.bincount(bucket, weights=parts[k], minlength=BUCKETS)
        rows = np.flatnonzero(sums.sum(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows, pa.int64()), *(pa.array(sums[rows, k]) for k in range(3))], ["bucket", "a", "b", "c"]
        )

    for _ in range(ROUNDS):
        def step(batches, now=weights):
            return shares(batches, now)

        done = facts.mapInArrow(step, "bucket long, a double, b double, c double")
        new = weights.copy()
        for row in done.groupBy("bucket").agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("c").alias("c")).collect():
            found = np.array([row["a"], row["b"], row["c"]]) + [0.0 if row["bucket"] == 0 else 1e-3, 1e-3, 1e-3]
            new[row["bucket"]] = found / found.sum()
        weights = new
    return weights


def score_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    Tokens are the words of the text with A-Z in lower case, then one end; a null text is
    empty.  Documents of fold 0 (checksum of the id as text modulo 10; a null id counts as
    empty text) are scored and not learned from.  ``base_score`` adds ``ADD`` to the count of
    every word; ``score`` is the log10 probability under the interpolated model, for which
    the weights are learned on fold 1 and the estimates then made from folds 1 to 9.
    Repeated rows count and are scored each; other columns are ignored; no rows give no
    rows.  Words and bigrams are told apart by 64-bit hashes.

    Texts are not shuffled but packed and compressed; the shuffle carries blocks of keys,
    which grow with the number of distinct words and bigrams."""
    spark = prepare(df.sparkSession, rows=8)
    documents = df.select(F.col(id_col).cast("long").alias("doc_id"), fold(id_col, FOLDS).alias("fold"), whole_text(text_col).alias("text"))
    batches, _ = stage(_pack(documents), "lm-batches")
    size = batches.agg(F.coalesce(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)), F.lit(0))).first()[0]
    ranges = max(1, math.ceil(size / 6 / RANGE_KEYS), slots(spark))
    answers, _ = stage(_answers(_requests(batches, ranges)), "lm-answers")
    sums = answers.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("types", "main_tokens", "held_tokens")]).first()
    counts = answers.select("batch", "kind", "range", "main", "held")

    def facts(left: pa.Table, right: pa.Table) -> pa.Table:
        kept = []
        for row in left.to_pylist():
            _, folds, tokens = _unpacked(row)
            held = np.repeat(folds, tokens.lengths) == WEIGHT_FOLD
            if held.any():
                three = np.stack([c[held] for c in _counted(tokens, right.to_pylist(), with_held=False)])
                three = three[:, np.lexsort(three)]
                new = np.append(True, (three[:, 1:] != three[:, :-1]).any(axis=0))
                times = np.diff(np.append(np.flatnonzero(new), three.shape[1]))
                kept.append(zstandard.compress(np.vstack([three[:, new], times]).astype("<i8").tobytes()))
        return pa.table({"facts": pa.array(kept, pa.binary())})

    joined = batches.groupBy("batch").cogroup(counts.groupBy("batch"))
    table, _ = stage(joined.applyInArrow(facts, "facts binary"), "lm-facts")
    weights = _learn(table, int(sums["main_tokens"]), int(sums["types"]))
    types, total = int(sums["types"]), int(sums["main_tokens"] + sums["held_tokens"])

    def scored(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in left.to_pylist():
            ids, folds, tokens = _unpacked(row)
            pair, context, word = _counted(tokens, right.to_pylist(), with_held=True)
            mixed = (_estimates(pair, context, word, total, types) * weights[_bucket(context)].T).sum(axis=0)
            base = np.log10((word + ADD) / (total + ADD * (types + 1)))
            out.append(pa.table({
                "doc_id": pa.array(ids, pa.int64()), "held_out": folds == TEST_FOLD,
                "n_tokens": tokens.lengths, "n_known": tokens.sums((word > 0).astype(np.int64)),
                "train_tokens": np.full(len(ids), total, np.int64),
                "base_score": tokens.sums(base), "score": tokens.sums(np.log10(mixed)),
            }))
        return pa.concat_tables(out)

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return joined.applyInArrow(scored, schema)
