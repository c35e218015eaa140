"""Personal data: patterns, and a character-level bidirectional LSTM with CRF transitions.

The patterns are the base.  The network is trained in numpy from labelled spans: what the
patterns find in a bounded sample, and variants of it that they miss.  It reads windows
that overlap by half; the tag probabilities of all windows over a character are averaged,
those near its middle counting most, and one path through the whole stretch is decoded from them.

A span of any kind holds a digit or an ``@``.  A window without either is not read: no
span could come of it."""

from __future__ import annotations

import hashlib
import heapq
import itertools
import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from contrail.llm.common import free_name, prepare, text_parts, whole_text

KINDS = ("email", "ip", "card", "phone")
#: Bound of the labelled sample: stretches of text that hold a span, over all kinds in equal
#: shares, and stretches that hold none.  They are those with the smallest hashes.
SAMPLE_STRETCHES, SAMPLE_WITHOUT, STRETCH = 240, 120, 96
WINDOW, STRIDE = 96, 48
#: Windows for training round a variant start this far apart, so that it is seen at many places.
TRAIN_STRIDE = 24
HIDDEN, EPOCHS, BATCH, RATE, SEED = 16, 9, 32, 0.015, 20_240_103
#: Least mean probability of the tags of an added span.  On held-out forms no harmless number
#: reached it; a card must pass its check digits besides.
CONFIDENCE = {"email": 0.45, "ip": 0.45, "card": 0.4, "phone": 0.45}

#: The base patterns.
_EMAIL_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_EMAIL_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SIGN = re.compile(r"[0-9@]")
_NOT_DIGIT = re.compile(r"[^0-9]")
_NUMBER_GOES_ON = re.compile(r"[0-9][0-9]")


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def base_matches(text: str) -> list[tuple[str, int, int, bool]]:
    """Kind, start, end and validity of all pattern matches, by kind and start."""
    found = []
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _EMAIL_LOCAL:
            start -= 1
        if start < at and (host := _EMAIL_HOST.match(text, at + 1)):
            end = host.end()
            found.append(("email", start, end, True))
        at = text.find("@", max(at + 1, end))
    for m in _IP.finditer(text):
        parts = (p.lstrip("0") for p in m.group().split("."))
        found.append(("ip", *m.span(), all(len(p) <= 3 and int(p or 0) <= 255 for p in parts)))
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m.group())
        found.append(("card", *m.span(), 16 <= len(digits) <= 19 and luhn(digits)))
    for m in _PHONE.finditer(text):
        found.append(("phone", *m.span(), 8 <= len(_NOT_DIGIT.sub("", m.group())) <= 15))
    return found


class Network(NamedTuple):
    """Weights: per direction the character rows and the recurrence, then tags and transitions."""

    chars: np.ndarray  # direction, character, gates
    recur: np.ndarray  # direction, hidden, gates
    out: np.ndarray
    bias: np.ndarray
    moves: np.ndarray  # tag to tag
    first: np.ndarray


TAGS = 1 + 2 * len(KINDS)
_NO = -30.0
_ALLOWED = np.zeros((TAGS, TAGS), bool)
_ALLOWED[:, 0] = _ALLOWED[:, 1::2] = True
for _k in range(1, TAGS, 2):
    _ALLOWED[_k, _k + 1] = _ALLOWED[_k + 1, _k + 1] = True


def _codes(text: str) -> np.ndarray:
    """Character classes: ASCII as it is, other letters 1, all else 2; digits are one class."""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
    if text.isascii():
        codes = points.astype(np.int64)
    else:
        codes = np.fromiter((ord(c) if ord(c) < 128 else 1 if c.isalpha() else 2 for c in text), np.int64, len(text))
    return np.where((codes >= 48) & (codes <= 57), 48, codes)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _lstm(codes: np.ndarray, chars: np.ndarray, recur: np.ndarray):
    """States of both directions over ``codes`` (direction, batch, length), with what training needs."""
    (ways, n, length), size = codes.shape, recur.shape[1]
    given = np.stack([chars[w][codes[w].T] for w in range(ways)], axis=1)
    h, c, kept = np.zeros((ways, n, size)), np.zeros((ways, n, size)), []
    states = np.empty((length, ways, n, size))
    for t in range(length):
        gates = given[t] + h @ recur
        open_ = _sigmoid(gates[..., : 3 * size])
        i, f, o = open_[..., :size], open_[..., size : 2 * size], open_[..., 2 * size :]
        g = np.tanh(gates[..., 3 * size :])
        before, c = c, f * c + i * g
        squashed = np.tanh(c)
        kept.append((h, before, open_, g, squashed))
        h = o * squashed
        states[t] = h
    return states.transpose(1, 2, 0, 3), kept


def _lstm_back(codes, recur, kept, given):
    """Gradients of character rows and recurrence, for ``given`` on the states."""
    (ways, n, length), size = codes.shape, recur.shape[1]
    d_h, d_c = np.zeros((ways, n, size)), np.zeros((ways, n, size))
    ds, back = np.empty((ways, length, n, 4 * size)), recur.transpose(0, 2, 1)
    for t in range(length - 1, -1, -1):
        _, before, open_, g, squashed = kept[t]
        i, f, o = open_[..., :size], open_[..., size : 2 * size], open_[..., 2 * size :]
        d_h = d_h + given[:, :, t]
        d_c = d_c + d_h * o * (1 - squashed**2)
        d = ds[:, t]
        d[..., : 3 * size] = np.concatenate([d_c * g, d_c * before, d_h * squashed], -1) * open_ * (1 - open_)
        d[..., 3 * size :] = d_c * i * (1 - g**2)
        d_h, d_c = d @ back, d_c * f
    ds = ds.reshape(ways, length * n, 4 * size)
    h = np.stack([k[0] for k in kept], axis=1).reshape(ways, length * n, size)
    marks = np.zeros((ways, length * n, 128))
    np.put_along_axis(marks, codes.transpose(0, 2, 1).reshape(ways, -1, 1), 1.0, axis=2)
    return marks.transpose(0, 2, 1) @ ds, h.transpose(0, 2, 1) @ ds


def _scores(net: Network, codes: np.ndarray):
    both = np.stack([codes, codes[:, ::-1]])
    found, kept = _lstm(both, net.chars, net.recur)
    states = np.concatenate([found[0], found[1][:, ::-1]], axis=2)
    return states @ net.out + net.bias, states, both, kept


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def _forward_backward(scores: np.ndarray, moves: np.ndarray, first: np.ndarray):
    """Tag probabilities (batch, length, tag), and the logs behind them."""
    length, chance = scores.shape[1], np.exp(moves)
    ahead, back = np.empty_like(scores), np.zeros_like(scores)

    def through(x, ways):
        top = x.max(axis=1, keepdims=True)
        return top + np.log(np.exp(x - top) @ ways)

    ahead[:, 0] = scores[:, 0] + first
    for t in range(1, length):
        ahead[:, t] = scores[:, t] + through(ahead[:, t - 1], chance)
    for t in range(length - 2, -1, -1):
        back[:, t] = through(scores[:, t + 1] + back[:, t + 1], chance.T)
    whole = _log_sum(ahead[:, -1], 1)
    return np.exp(ahead + back - whole[:, None, None]), ahead, back, whole


#: Letters begin alike, and what is learned of one counts for all: a sample need not hold every letter.
_LETTERS = np.array([1, *range(65, 91), *range(97, 123)])


def fit(windows: np.ndarray, tags: np.ndarray, epochs: int = EPOCHS) -> Network:
    """Train on windows of codes (n, length) with their tags, by Adam with a falling rate; the
    order is fixed by ``SEED``."""
    rng = np.random.default_rng(SEED)
    moves = np.where(_ALLOWED, 0.0, _NO)
    first = np.zeros(TAGS)
    first[2::2] = _NO
    values = [
        rng.normal(0, 0.2, (2, 128, 4 * HIDDEN)), rng.normal(0, 0.2, (2, HIDDEN, 4 * HIDDEN)),
        rng.normal(0, 0.2, (2 * HIDDEN, TAGS)), np.zeros(TAGS), moves, first,
    ]
    values[0][:, :, HIDDEN : 2 * HIDDEN] += 1  # remember at first
    values[0][:, _LETTERS] = values[0][:, 97:98]
    mean, square, step = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values], 0
    steps = epochs * -(-len(windows) // BATCH)
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), BATCH):
            some = order[at : at + BATCH]
            grads = _gradients(Network(*values), windows[some], tags[some])
            grads[0][:, _LETTERS] += grads[0][:, _LETTERS].sum(axis=1, keepdims=True)
            rate = RATE * min(1, 2.5 * (1 - step / steps))
            step += 1
            for k, g in enumerate(grads):
                mean[k] = 0.9 * mean[k] + 0.1 * g
                square[k] = 0.999 * square[k] + 0.001 * g * g
                values[k] = values[k] - rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)
    return Network(*values)


def _gradients(net: Network, codes: np.ndarray, tags: np.ndarray) -> list[np.ndarray]:
    n, length = codes.shape
    scores, states, both, kept = _scores(net, codes)
    chance, ahead, back, whole = _forward_backward(scores, net.moves, net.first)
    rows, places = np.arange(n)[:, None], np.arange(length)[None, :]
    d_scores = chance.copy()
    d_scores[rows, places, tags] -= 1
    d_scores /= n
    pair = ahead[:, :-1, :, None] + net.moves + (scores + back)[:, 1:, None, :] - whole[:, None, None, None]
    d_moves = np.exp(pair).sum(axis=(0, 1)) / n
    np.add.at(d_moves, (tags[:, :-1], tags[:, 1:]), -1 / n)
    d_moves[~_ALLOWED] = 0
    d_first = d_scores[:, 0].sum(axis=0)
    d_first[2::2] = 0
    d_states = d_scores @ net.out.T
    ways = np.stack([d_states[:, :, :HIDDEN], d_states[:, ::-1, HIDDEN:]])
    d_chars, d_recur = _lstm_back(both, net.recur, kept, ways)
    d_out = states.reshape(-1, 2 * HIDDEN).T @ d_scores.reshape(-1, TAGS)
    return [d_chars, d_recur, d_out, d_scores.sum(axis=(0, 1)), d_moves, d_first]


def _tagged(length: int, spans: list[tuple[str, int, int]]) -> np.ndarray:
    tags = np.zeros(length, np.int64)
    for kind, start, end in spans:
        tag = 1 + 2 * KINDS.index(kind)
        tags[start:end] = tag + 1
        tags[start : start + 1] = tag
    return tags


def _variants(text: str, spans: list[tuple[str, int, int]], form: int = 0) -> tuple[str, list[tuple[str, int, int]]]:
    """The stretch with every span in a form that the patterns miss, and the spans there."""
    out, moved, at = [], [], 0
    for kind, start, end in sorted(spans, key=lambda s: s[1]):
        if start < at:
            continue
        value = _missed(kind, text[start:end], form)
        out.append(text[at:start])
        begin = sum(map(len, out))
        out.append(value)
        moved.append((kind, begin, begin + len(value)))
        at = end
    out.append(text[at:])
    return "".join(out), moved


#: Forms of every kind that the patterns miss, and harmless numbers put in the place of spans.
FORMS, HARMLESS = 3, 1


def _harmless(text: str, spans: list[tuple[str, int, int]], form: int) -> tuple[str, list[tuple[str, int, int]]]:
    """The stretch with every span replaced by a number that is no personal data: dates, times,
    years, ranges, book numbers, prices, versions, counts; and where these are, without a kind.
    The digits follow from the stretch."""
    digits = str(int.from_bytes(hashlib.blake2b(f"{form} {text}".encode(), digest_size=16).digest(), "big")).zfill(39)
    a, b, c = int(digits[:6]), int(digits[6:12]), int(digits[12:18])
    year, month, day = 1900 + a % 150, 1 + b % 12, 1 + c % 28
    book = f"97{8 + a % 2}{digits[20:29]}"
    check = -sum(int(d) * (3 if i % 2 else 1) for i, d in enumerate(book)) % 10
    made = (
        f"{year}-{month:02}-{day:02}", f"{day:02}.{month:02}.{year}", f"{month}/{day}/{year}", f"{year}-{year + c % 60}",
        f"{book[:3]}-{book[3]}-{book[4:6 + c % 4]}-{book[6 + c % 4:]}-{check}", f"{book}{check}", f"${a % 10_000:,}.{c % 100:02}",
        f"{c % 30}.{b % 100}.{a % 100}", f"{a % 24:02}:{b % 60:02}:{c % 60:02}", f"{a}", f"{year}", f"{b % 900}-{c % 900}",
        f"{year}-{month:02}-{day:02} {a % 24:02}:{b % 60:02}", f"v{c % 20}.{b % 20}", f"{a:,}", f"{digits[24:24 + 9 + c % 3]}",
    )
    out, moved, at = [], [], 0
    for number, (_, start, end) in enumerate(sorted(spans, key=lambda s: s[1])):
        if start >= at:
            out += [text[at:start], made[(a + b + form * 5 + number) % len(made)]]
            begin = sum(map(len, out[:-1]))
            moved.append(("", begin, begin + len(out[-1])))
            at = end
    return "".join([*out, text[at:]]), moved


def _missed(kind: str, value: str, form: int) -> str:
    if kind == "email":
        local, host = value.split("@", 1)
        return f"{local if form == 0 else f'{local}{len(value) % 97}' if form == 1 else f'{local[:3]}{len(host) % 10}'} @ {host}"
    if kind == "ip":
        return value.replace(".", (" . ", "[.]", "(.)")[form])
    if kind == "card":
        digits = _NOT_DIGIT.sub("", value)
        if form == 0:
            return ".".join(digits[k : k + 4] for k in range(0, len(digits), 4))
        short = next(d for d in (f"{digits[:14]}{c}" for c in range(10)) if luhn(d))
        return short if form == 1 else f"{short[:4]} {short[4:10]} {short[10:]}"
    national = re.sub(r"^\+[0-9]{1,3}[ .-]?(?=[(0-9])", "", value)
    if form == 0:
        return national
    groups = [g for g in _NOT_DIGIT.split(national if form == 2 else value) if g]
    return "-".join(groups) if form == 1 else f"0{' '.join(groups)}"


def labelled_windows(stretches: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Windows and tags of stretches of text and of their variants, padded with blanks."""
    codes, tags = [], []
    for stretch in stretches:
        spans = [(k, a, b) for k, a, b, ok in _settled(base_matches(stretch)) if ok]
        forms = [(stretch, spans, None)]
        forms += [(*_variants(stretch, spans, k), TRAIN_STRIDE) for k in range(FORMS if spans else 0)]
        forms += [(*_harmless(stretch, spans, k), WINDOW // 2) for k in range(HARMLESS if spans else 0)]
        for text, own, near in forms:
            padded = _codes(text.ljust(2 * STRETCH))
            tag = _tagged(len(padded), [s for s in own if s[0] in KINDS])
            for a in range(0, min(len(text), len(padded) - WINDOW + 1), near or TRAIN_STRIDE):
                # Of a variant, what is round the changed places; the rest is in the original.
                if near and not any(a < end and start < a + WINDOW for _, start, end in own):
                    continue
                part = tag[a : a + WINDOW].copy()
                if part[0] and part[0] % 2 == 0:  # cut into a span: no label for what is left of it
                    part[: int(np.argmax(part % 2 != 0)) if (part % 2 != 0).any() else WINDOW] = 0
                codes.append(padded[a : a + WINDOW])
                tags.append(part)
    return np.array(codes).reshape(-1, WINDOW), np.array(tags).reshape(-1, WINDOW)


def _settled(matches: list[tuple[str, int, int, bool]]) -> list[tuple[str, int, int, bool]]:
    """Matches without those that overlap a valid one of another kind, for labels."""
    valid = [m for m in matches if m[3]]
    taken: list[tuple[str, int, int, bool]] = []
    for m in sorted(valid, key=lambda m: (m[1] - m[2], m[1])):
        if all(m[2] <= t[1] or t[2] <= m[1] for t in taken):
            taken.append(m)
    return taken


def train(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", stretches: int = SAMPLE_STRETCHES,
    without: int = SAMPLE_WITHOUT,
) -> Network | None:
    """A network from a bounded sample of stretches around digits and ``@`` signs.

    Of every kind, the ``stretches / 4`` stretches that hold a valid match of it and have the
    smallest hashes, and the first ``without`` of those that hold none: how rare a kind is
    does not matter.  Without any match there is no network, and the patterns stand alone."""
    prepare(df.sparkSession)
    limits = dict.fromkeys(KINDS, -(-stretches // len(KINDS))) | {"": without}

    def run(batches):
        least = {kind: _Smallest(limit) for kind, limit in limits.items()}
        for _, texts in text_parts(batches, "t"):
            for text in texts:
                at = 0
                while m := _SIGN.search(text, at):
                    stretch = text[max(0, m.start() - STRETCH // 2) : m.start() + STRETCH]
                    at = m.start() + STRETCH
                    mark = int.from_bytes(hashlib.blake2b(stretch.encode(), digest_size=8).digest(), "big", signed=True)
                    if any(own.takes(mark) for own in least.values()):
                        for kind in {k for k, _, _, ok in _settled(base_matches(stretch)) if ok} or {""}:
                            least[kind].add(mark, stretch)
        rows = [(kind, mark, stretch) for kind, own in least.items() for mark, stretch in own.kept.items()]
        columns = zip(*rows, strict=True) if rows else ((), (), ())
        kinds = (pa.string(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["kind", "mark", "stretch"])

    # Every task names its smallest; those of the whole are among them.
    texts = df.select(whole_text(text_col).alias("t")).filter(F.col("t").rlike("[0-9@]"))
    named = texts.mapInArrow(run, "kind string, mark long, stretch string").distinct()
    order = Window.partitionBy("kind").orderBy("mark", "stretch")
    limit = F.when(F.col("kind") == "", limits[""]).otherwise(limits[KINDS[0]])
    chosen = named.withColumn("n", F.row_number().over(order)).filter((F.col("n") <= max(limits.values())) & (F.col("n") <= limit))
    sample = sorted({(r["mark"], r["stretch"]) for r in chosen.select("mark", "stretch").collect()})
    windows, tags = labelled_windows([stretch for _, stretch in sample])
    return fit(windows, tags) if tags.any() else None


class _Smallest:
    """At most ``limit`` stretches, those with the smallest marks."""

    def __init__(self, limit: int):
        self.limit, self.kept, self._heap = limit, {}, []

    def takes(self, mark: int) -> bool:
        return mark not in self.kept and (len(self._heap) < self.limit or (self.limit and mark < -self._heap[0]))

    def add(self, mark: int, stretch: str) -> None:
        if not self.takes(mark):
            return
        self.kept[mark] = stretch
        heapq.heappush(self._heap, -mark)
        if len(self._heap) > self.limit:
            del self.kept[-heapq.heappop(self._heap)]


#: A window counts for a character by its distance from the window's nearer end.
_WEIGHT = np.minimum(np.arange(1, WINDOW + 1), np.arange(WINDOW, 0, -1))[:, None] ** 2.0


def _stretches(text: str) -> list[tuple[int, list[int]]]:
    """Starts of the windows that hold a sign, in stretches where each overlaps the next."""
    last = max(0, -(-(len(text) - WINDOW) // STRIDE))
    wanted = sorted({
        w for m in _SIGN.finditer(text)
        for w in range(max(0, (m.start() - WINDOW) // STRIDE + 1), min(last, m.start() // STRIDE) + 1)
    })
    groups = itertools.groupby(enumerate(wanted), key=lambda x: x[1] - x[0])
    return [(own[0] * STRIDE, [w * STRIDE for w in own]) for own in ([w for _, w in g] for _, g in groups)]


def decode(net: Network, texts: list[str]) -> list[list[tuple[str, int, int]]]:
    """Spans that the network finds in whole texts."""
    places = [(i, first, starts) for i, t in enumerate(texts) for first, starts in _stretches(t)]
    if not places:
        return [[] for _ in texts]
    padded = {i: _codes(texts[i] + " " * WINDOW) for i in {p[0] for p in places}}
    windows = np.array([padded[i][a : a + WINDOW] for i, _, starts in places for a in starts])
    chance = np.concatenate([
        _forward_backward(_scores(net, windows[k : k + 512])[0], net.moves, net.first)[0]
        for k in range(0, len(windows), 512)
    ])
    spans: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    at = 0
    for i, first, starts in places:
        length = starts[-1] - first + WINDOW
        total, seen = np.zeros((length, TAGS)), np.zeros((length, 1))
        for a in starts:
            total[a - first : a - first + WINDOW] += chance[at] * _WEIGHT
            seen[a - first : a - first + WINDOW] += _WEIGHT
            at += 1
        mean = total / seen
        path = _best_path(np.log(mean + 1e-12))
        for kind, a, b in _read(path):
            if mean[np.arange(a, b), path[a:b]].mean() >= CONFIDENCE[kind]:
                found = _edges(kind, texts[i], first + a, min(first + b, len(texts[i])))
                spans[i] += [(kind, *found)] if found else []
    return spans


#: What a span of each kind starts and ends with.
_SHAPE = {"email": re.compile(r"(?s)[A-Za-z0-9].*@.*[A-Za-z0-9]")} | dict.fromkeys(
    ("ip", "card", "phone"), re.compile(r"(?s)[+(0-9].*[0-9]")
)


#: Numbers of a phone's length that say what else they are: dates, with or without a time, and
#: ranges of years.
_DATED = re.compile(
    r"(?:1[0-9]|20)[0-9]{2}[-./ ](?:0?[1-9]|1[0-2])[-./ ](?:0?[1-9]|[12][0-9]|3[01])(?:[ T][0-9:. ]+)?"
    r"|(?:0?[1-9]|[12][0-9]|3[01])[-./ ](?:0?[1-9]|[12][0-9]|3[01])[-./ ](?:(?:1[0-9]|20)[0-9]{2}|[0-9]{2})(?:[ T][0-9:. ]+)?"
    r"|(?:1[0-9]|20)[0-9]{2} ?[-\u2013] ?(?:1[0-9]|20)[0-9]{2}"
)


def _is_book(digits: str) -> bool:
    """Thirteen digits of a book number, by their prefix and check digit."""
    return len(digits) == 13 and digits[:3] in ("978", "979") and sum(int(d) * (3 if i % 2 else 1) for i, d in enumerate(digits)) % 10 == 0


def _edges(kind: str, text: str, start: int, end: int) -> tuple[int, int] | None:
    """The span without blanks and letters at its ends; none if its digits make no such value
    or are cut out of a longer number."""
    found = _SHAPE[kind].search(text, start, end)
    if not found or (kind != "email" and _NUMBER_GOES_ON.search(text[max(0, found.start() - 1) : found.start() + 1])):
        return None
    if kind != "email" and _NUMBER_GOES_ON.search(text[found.end() - 1 : found.end() + 1]):
        return None
    digits = _NOT_DIGIT.sub("", found.group())
    parts = [p for p in _NOT_DIGIT.split(found.group()) if p]
    if kind == "phone" and (_DATED.fullmatch(found.group()) or _is_book(digits)):
        return None
    likely = {
        "email": True,
        "ip": len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts),
        "card": 13 <= len(digits) <= 19 and luhn(digits),
        "phone": 7 <= len(digits) <= 15,
    }
    return found.span() if likely[kind] else None


def _best_path(logs: np.ndarray) -> np.ndarray:
    moves = np.where(_ALLOWED, 0.0, -1e9)
    score, back = logs[0] + np.where(np.arange(TAGS) % 2 == 0, -1e9, 0.0) * (np.arange(TAGS) > 0), []
    for row in logs[1:]:
        reach = score[:, None] + moves
        back.append(reach.argmax(axis=0))
        score = reach.max(axis=0) + row
    path = [int(score.argmax())]
    for step in reversed(back):
        path.append(int(step[path[-1]]))
    return np.array(path[::-1])


def _read(path: np.ndarray) -> list[tuple[str, int, int]]:
    spans, start = [], None
    for at, tag in enumerate([*path.tolist(), 0]):
        if start is not None and (tag == 0 or tag % 2 == 1):
            spans.append((KINDS[(int(path[start]) - 1) // 2], start, at))
            start = None
        if tag % 2 == 1:
            start = at
    return spans


def _blocks(match: tuple[str, int, int, bool], kind: str, start: int, end: int) -> bool:
    own, first, last, valid = match
    if end <= first or last <= start or not (valid or own == kind):
        return False
    return valid or kind != "card" or first < start or end < last


def personal_spans(net: Network | None, texts: list[str]) -> list[list[tuple[str, int, int, bool]]]:
    """Base spans and those that the network adds, by kind and start.

    An added span touches no valid match and no failed one of its own kind; only a card may
    hold failed card matches whole, as its groups between dots and 13 to 15 digits are such."""
    marked = [i for i, t in enumerate(texts) if _SIGN.search(t)]
    matches = {i: base_matches(texts[i]) for i in marked}
    added = dict(zip(marked, decode(net, [texts[i] for i in marked]), strict=True)) if net and marked else {}
    result: list[list[tuple[str, int, int, bool]]] = [[] for _ in texts]
    for i in marked:
        own = matches[i]
        extra = [(*span, False) for span in added.get(i, []) if not any(_blocks(m, *span) for m in own)]
        spans = [(k, a, b, True) for k, a, b, ok in own if ok] + extra
        result[i] = sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1]))
    return result


SPANS = "array<struct<kind:string,start:int,end:int,base:boolean>>"


def find_personal_data(df: DataFrame, net: Network | None, text_col: str = "text", redact: str | None = None) -> DataFrame:
    """Add ``spans`` (kind, start, end in code points, base) of every whole text; ``redact``
    names a column to add in which each span is replaced by its kind in brackets (where
    spans overlap, they are replaced together by the first one's kind).

    Null has no spans and stays null when redacted.  Repeated rows are treated alike; other
    columns pass through and clashing names fail.  No shuffle."""
    added = ["spans", *([redact] if redact else [])]
    if clash := set(added) & set(df.columns):
        raise ValueError(f"the input already has columns {sorted(clash)}")
    prepare(df.sparkSession)
    work = free_name(df, "_text")
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))
    schema = df.withColumn("spans", F.lit(None).cast(SPANS)).schema
    schema = schema.add(redact, "string") if redact else schema

    def run(batches):
        for batch, texts in text_parts(batches, work):
            spans = personal_spans(net, [t or "" for t in texts])
            rows = [[{"kind": k, "start": a, "end": b, "base": ok} for k, a, b, ok in own] for own in spans]
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            more = [pa.array([t if t is None else redacted(t, s) for t, s in zip(texts, spans, strict=True)], pa.string())] if redact else []
            yield pa.RecordBatch.from_arrays([*kept, pa.array(rows, kind), *more], schema.names)

    return df.withColumn(work, F.col(text_col)).mapInArrow(run, schema)


def redacted(text: str, spans: list[tuple[str, int, int, bool]]) -> str:
    out, at = [], 0
    for kind, start, end, _ in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])
