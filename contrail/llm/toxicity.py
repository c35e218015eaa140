"""Toxicity: a weighted lexicon matched by Aho-Corasick in folded text, with exception phrases."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from contrail.llm.common import prepare, text_parts, whole_text
from contrail.session import stage

#: Labelled documents of each label the lexicon is learned from, those of smallest hash.
SAMPLE_DOCS = 3_000
#: Stems have from so many letters to so many; whole words any number up to the largest.
STEM = range(4, 10)
LONGEST_WORD = 24
#: An entry occurs in so large a share of the sampled toxic documents, and in two at least.
LEAST_SHARE = 0.003
#: Words are entries from so many times the odds of a clean document.
LEAST_ODDS = 8.0
#: Standard errors that a weight is below what was counted.
CAUTION = 1.64
#: Near copies of the sample fall together by the smallest hash under any of these rules.
MARK_RULES = (0x1E3779B97F4A7C15, 0x3F58476D1CE4E5B9, 0x14D049BB133111EB)
#: Entries and exception phrases at most, the strongest first.
LEXICON_SIZE = 2_000
#: A phrase round an entry is an exception from so many clean documents with it, and if it
#: has so small a share of toxic ones.
EXCEPTION_DOCS, EXCEPTION_SHARE = 3, 0.1

# Letters of other scripts that look like Latin ones, and signs that stand for
# letters.  The letters i and l fall together, since 1, ! and | stand for both.
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "е": "e", "н": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "о": "o",
    "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ӏ": "i",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "ı": "i", "ł": "i", "ø": "o", "đ": "d", "ɑ": "a", "ɡ": "g", "ß": "ss", "æ": "ae", "œ": "oe", "l": "i",
}
SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "i"}

_SIGN_RUN = re.compile(r"[0134578@$!|]+")
_SIGN_TABLE = str.maketrans(SIGNS)
_OTHER_SIGNS = str.maketrans(dict.fromkeys("@$!|", " "))
#: Folded words a worker remembers before it starts anew.
REMEMBERED = 1 << 18


def _letters(run: re.Match) -> str:
    """What a run of digits and signs in a word stands for, by the characters round it."""
    text, begin, end = run.string, run.start(), run.end()
    before, after = text[begin - 1 : begin].isalpha(), text[end : end + 1].isalpha()
    signs = run.group()
    ends_word = not set(signs) & {"!", "|"} and (after or before and (signs.isdigit() or len(signs) <= 2))
    return signs.translate(_SIGN_TABLE) if before and after or ends_word else signs


class _Folds(dict):
    """What a character becomes: no case, no accents, look-alikes as Latin letters, a blank
    for what belongs to no word."""

    def __missing__(self, code: int) -> str:
        plain = unicodedata.normalize("NFKD", chr(code)).casefold()
        bare = "".join(HOMOGLYPHS.get(c, c) for c in plain if not unicodedata.combining(c))
        self[code] = folded = "".join(c if c.isalnum() or c in SIGNS else " " for c in bare)
        return folded


class _Words(dict):
    def __missing__(self, word: str) -> str:
        if len(self) >= REMEMBERED:
            self.clear()
        whole = word if word.isalpha() else _SIGN_RUN.sub(_letters, word).translate(_OTHER_SIGNS)
        self[word] = folded = " ".join(whole.split())
        return folded


_FOLDS, _WORDS = _Folds(), _Words()


def fold(text: str) -> str:
    """The words of ``text`` between single blanks, one blank at each end.

    Digits and signs count as letters inside and at the ends of a word, ``!`` and ``|`` inside only."""
    words = (_WORDS[w] for w in text.translate(_FOLDS).split())
    return f" {' '.join(w for w in words if w)} "


# Matching


@dataclass
class Lexicon:
    """Folded entries with their weights, exception phrases, and the curve of the score.

    An entry ``" stem"`` matches the beginning of a word, ``" word "`` a whole one.  The score is
    the logistic of ``bias + slope * log(1 + weight) - length * log(1 + words)``."""

    weights: dict[str, float]
    exceptions: tuple[str, ...] = ()
    curve: tuple[float, float, float] = (-6.0, 3.0, 0.0)
    _automaton: object = field(default=None, repr=False, compare=False)

    def __getstate__(self):
        return {**self.__dict__, "_automaton": None}

    def automaton(self):
        if self._automaton is None:
            built = ahocorasick.Automaton()
            for phrase in self.exceptions:
                built.add_word(phrase, (len(phrase), None))
            for entry in self.weights:
                built.add_word(entry, (len(entry), entry))
            if len(built):
                built.make_automaton()
            self._automaton = built
        return self._automaton

    def matches(self, folded: str) -> Counter:
        """Entries found and how often: at a word the longest counts, none inside an exception."""
        automaton, at, excused = self.automaton(), {}, []
        if not len(automaton):
            return Counter()
        for end, (length, entry) in automaton.iter(folded):
            begin = end - length + 1
            if entry is None:
                excused.append((begin, end))
            elif length > at.get(begin, (0, ""))[0]:
                at[begin] = length, entry
        for begin, end in excused:
            for place in [p for p, (length, _) in at.items() if begin <= p and p + length - 1 <= end + 1]:
                del at[place]
        return Counter(entry for _, entry in at.values())

    def weight(self, found: Mapping[str, int]) -> float:
        return sum(self.weights[e] * n for e, n in sorted(found.items()))

    def score(self, weight: float, words: int) -> float:
        bias, slope, length = self.curve
        z = bias + slope * np.log1p(weight) - length * np.log1p(words)
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


# Learning


def _features(folded: str) -> set[str]:
    found = set()
    for word in set(folded.split()):
        if len(word) <= LONGEST_WORD:
            found.add(f" {word} ")
        found.update(f" {word[:n]}" for n in STEM if n <= len(word))
    return found


def _counted(sample: DataFrame, features) -> DataFrame:
    """``feature, clean, toxic``: in how many documents of either label a feature is."""

    def run(batches):
        for batch, texts in text_parts(batches, "text"):
            for toxic, text in zip(batch.column("toxic").to_pylist(), texts, strict=True):
                found = sorted(features(fold(text)))
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array([toxic] * len(found), pa.int32())], ["feature", "toxic"])

    each = sample.mapInArrow(run, "feature string, toxic int")
    count = lambda y: F.count(F.when(F.col("toxic") == y, 1))
    return each.groupBy("feature").agg(count(0).alias("clean"), count(1).alias("toxic"))


def _log_odds(clean: float, toxic: float, n_clean: int, n_toxic: int) -> float:
    """How much a feature speaks for a toxic document, at the least: the lower end of the log
    odds ratio, so that what was seen in few documents weighs little."""
    ratio = np.log((toxic + 0.5) / (n_toxic + 1.0)) - np.log((clean + 0.5) / (n_clean + 1.0))
    return float(ratio - CAUTION * np.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5)))


def _choose(counts: Iterable[tuple[str, int, int]], n_clean: int, n_toxic: int) -> dict[str, float]:
    """Of the stems of a word and the word itself the one that tells most.

    What an entry tells is its toxic documents times its weight.  An entry gives way to a shorter
    or longer one that begins the same and tells more; of equal ones the longest stem stays."""
    told = {f: (t * _log_odds(c, t, n_clean, n_toxic), not f.endswith(" "), len(f)) for f, c, t in counts}
    odds = {f: _log_odds(c, t, n_clean, n_toxic) for f, c, t in counts}
    stems = lambda f: [f[:n] for n in range(1 + STEM.start, len(f.rstrip(" ")) + 1) if f[:n] != f]
    chosen: dict[str, float] = {}
    blocked: set[str] = set()
    for entry in sorted(told, key=lambda f: (told[f], f), reverse=True):
        nested = stems(entry)
        if odds[entry] <= 0 or entry in blocked or any(s in chosen for s in nested):
            continue
        chosen[entry] = odds[entry]
        blocked.update(nested)
        if len(chosen) >= LEXICON_SIZE:
            break
    return chosen


def _phrases(lexicon: Lexicon):
    """Features of a text for exceptions: a word that holds an entry, with its neighbour."""

    def found(folded: str) -> set[str]:
        words = folded.split()
        hit = {w for w in set(words) if lexicon.matches(f" {w} ")}
        pairs = zip(words, words[1:], strict=False)
        return {f" {a} {b} " for a, b in pairs if a in hit or b in hit}

    return found


def _fit(weight: np.ndarray, words: np.ndarray, toxic: np.ndarray, counts: tuple[int, int]) -> tuple[float, float, float]:
    """Logistic regression by Newton steps, rows weighted to the whole labels' shares.

    The length never speaks for toxicity: should its factor come out so, it is left out."""
    share = np.where(toxic == 1, counts[1] / max(1, (toxic == 1).sum()), counts[0] / max(1, (toxic == 0).sum()))
    share = share / share.sum() * len(share)

    def fitted(x):
        beta = np.zeros(x.shape[1])
        ridge = np.diag([1e-4, *[1e-2] * (x.shape[1] - 1)]) * len(x) ** 0.5
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
            slope = x.T @ (share * (toxic - p)) - ridge @ beta
            curve = (x * (share * p * (1 - p))[:, None]).T @ x + ridge
            step = np.linalg.solve(curve, slope)
            beta = beta + step * min(1.0, 5 / max(1e-12, np.abs(step).max()))
            if np.abs(step).max() < 1e-9:
                break
        return beta

    x = np.stack([np.ones(len(toxic)), np.log1p(weight), -np.log1p(words)], 1)
    beta = fitted(x)
    if beta[2] < 0:
        beta = np.r_[fitted(x[:, :2]), 0.0]
    return tuple(float(b) for b in beta)


def _marks(text: str) -> list[int]:
    """The smallest hashes, by several rules, of the runs of five words: the same for most near copies."""
    words = text.lower().split()
    runs = {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))}
    hashes = np.array([xxhash.xxh3_64_intdigest(r) for r in runs], np.uint64)
    return [int((hashes * np.uint64(2 * rule + 1)).min() >> np.uint64(1)) for rule in MARK_RULES]


def _marked(texts: DataFrame) -> DataFrame:
    def run(batches):
        for batch, some in text_parts(batches, "text"):
            marks = pa.array([_marks(t) for t in some], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), batch.column("text"), marks], ["toxic", "text", "marks"])

    return texts.select("toxic", "text").mapInArrow(run, "toxic int, text string, marks array<bigint>")


def train(
    documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    exceptions: Sequence[str] = (), sample_docs: int = SAMPLE_DOCS,
) -> Lexicon:
    """A lexicon with its weights and its curve, learned from labelled documents.

    ``labels`` has one row per labelled document; of several rows of an id the largest label
    counts, rows without id or label do not.  The sample is bounded: of each label the ``sample_docs``
    documents with the smallest hashes.  Equal texts and near copies of one label count once, as the
    words of a much copied text say nothing of the label.  Counts per word and stem, and per
    phrase round an entry, come from Spark over the whole texts of the sample; only what is
    frequent enough reaches the driver.  ``exceptions`` are phrases known beforehand.  Without
    documents of both labels the lexicon is empty and every score is small."""
    spark = prepare(documents.sparkSession)
    given = tuple(f" {fold(e).strip()} " for e in exceptions)
    known = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
    known = known.groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("toxic"))
    small = lambda y: known.filter(F.col("toxic") == y).orderBy(F.xxhash64("_id"), "_id").limit(sample_docs)
    # At most twice ``sample_docs`` ids.
    drawn = F.broadcast(small(0).unionByName(small(1)))
    texts = documents.select(F.col(id_col).alias("_id"), whole_text(text_col).alias("text")).join(drawn, "_id")
    sample = texts.groupBy("text").agg(F.max("toxic").alias("toxic"))
    sample = _marked(sample)
    for rule in range(len(MARK_RULES)):
        first = F.min(F.struct("text", "marks")).alias("s")
        sample = sample.groupBy("toxic", F.col("marks")[rule].alias("_mark")).agg(first).select("toxic", "s.*")
    sample, _ = stage(sample.drop("marks"), "toxicity-sample")
    totals = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n_clean, n_toxic = totals.get(0, 0), totals.get(1, 0)
    if not n_clean or not n_toxic:
        return Lexicon({}, given)
    odds = (F.col("toxic") + 0.5) / (n_toxic + 1.0) / ((F.col("clean") + 0.5) / (n_clean + 1.0))
    strong = _counted(sample, _features).filter((F.col("toxic") >= max(2, LEAST_SHARE * n_toxic)) & (odds >= LEAST_ODDS))
    # Each entry has up to a stem of every length.
    first = strong.orderBy((F.col("toxic") * F.log(odds)).desc(), "feature").limit(LEXICON_SIZE * (len(STEM) + 1))
    lexicon = Lexicon(_choose([(r["feature"], r["clean"], r["toxic"]) for r in first.collect()], n_clean, n_toxic), given)
    harmless = (F.col("clean") >= EXCEPTION_DOCS) & (F.col("toxic") <= EXCEPTION_SHARE * (F.col("toxic") + F.col("clean")))
    phrases = _counted(sample, _phrases(lexicon)).filter(harmless).orderBy(F.col("clean").desc(), "feature").limit(LEXICON_SIZE)
    lexicon = Lexicon(lexicon.weights, tuple(sorted({*given, *(r["feature"] for r in phrases.collect())})))
    # At most twice ``sample_docs`` rows of three numbers.
    rows = _scored(sample, lexicon, ["toxic"]).select("toxic", "weight", "words").collect()
    y, weight, words = (np.array([r[c] for r in rows], float) for c in ("toxic", "weight", "words"))
    total = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    return Lexicon(lexicon.weights, lexicon.exceptions, _fit(weight, words, y, (total[0], total[1])))


# Scoring

MATCHES = "array<struct<entry: string, times: int, weight: double>>"


def _scored(df: DataFrame, lexicon: Lexicon, keep: list[str]) -> DataFrame:
    """``keep`` and what the lexicon says of the column ``text``."""

    def run(batches):
        for batch, texts in text_parts(batches, "text"):
            words, weights, scores, matches = [], [], [], []
            for text in texts:
                folded = fold(text)
                found = lexicon.matches(folded)
                words.append(folded.count(" ") - 1 if len(folded) > 2 else 0)
                weights.append(lexicon.weight(found))
                scores.append(lexicon.score(weights[-1], words[-1]))
                matches.append([{"entry": e.strip(), "times": n, "weight": lexicon.weights[e]} for e, n in sorted(found.items())])
            made = [
                pa.array(words, pa.int64()), pa.array(weights, pa.float64()), pa.array(scores, pa.float64()),
                pa.array(matches, pa.list_(pa.struct([("entry", pa.string()), ("times", pa.int32()), ("weight", pa.float64())]))),
            ]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *made], [*keep, "words", "weight", "score", "matches"])

    kept = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep)
    schema = f"{kept}, words long, weight double, score double, matches {MATCHES}"
    return df.select(*keep, "text").mapInArrow(run, schema)


def score_documents(documents: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, words, weight, score, matches`` of every document.

    ``matches`` has the entries of the lexicon found in the whole text, folded, how often, and
    the weight of each; ``words`` is the length the score is normalised by.  Null and empty texts
    have no words and no matches and the score of such.  Ids are only carried along: null and
    repeated ones give rows like any other.  Other columns are ignored.  No documents give
    no rows; nothing is shuffled."""
    prepare(documents.sparkSession)
    return _scored(documents.select(F.col(id_col), whole_text(text_col).alias("text")), lexicon, [id_col])
