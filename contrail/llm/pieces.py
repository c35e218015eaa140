"""Chunks of text to token ids, each distinct chunk worked out once per worker."""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain, repeat

import numpy as np

#: Chunks and ids kept per worker; beyond, the store starts anew.  It is a cache only.
KEEP_CHUNKS, KEEP_IDS = 400_000, 4_000_000


class ChunkStore:
    """Ids of chunks, flat, with a range per chunk.  ``split`` gives the ids of new chunks, end
    to end, and how many each has."""

    def __init__(self, split: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]):
        self._split = split
        self._clear()

    def _clear(self) -> None:
        self._index: dict[str, int] = {}
        self._flat = np.empty(1 << 16, np.uint32)
        self._starts = np.zeros(1 << 14, np.int64)
        self._used = 0
        self._letters = 0

    def _add(self, chunks: list[str]) -> None:
        ids, lengths = self._split(chunks)
        at, used = len(self._index), self._used + len(ids)
        while at + len(chunks) + 1 > len(self._starts):
            self._starts = np.concatenate([self._starts, np.zeros_like(self._starts)])
        while used > len(self._flat):
            self._flat = np.concatenate([self._flat, np.empty_like(self._flat)])
        self._flat[self._used : used] = ids
        self._starts[at + 1 : at + len(chunks) + 1] = self._used + np.cumsum(lengths)
        self._index.update(zip(chunks, range(at, at + len(chunks)), strict=True))
        self._used = used
        self._letters += sum(map(len, chunks))

    def _trim(self) -> None:
        if len(self._index) > KEEP_CHUNKS or self._used > KEEP_IDS or self._letters > 8 * KEEP_IDS:
            self._clear()

    def _ids(self, at: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        begin = self._starts[at]
        count = self._starts[at + 1] - begin
        total = np.concatenate([[0], np.cumsum(count)])
        ids = self._flat[np.repeat(begin - total[:-1], count) + np.arange(total[-1])]
        return ids, total[np.cumsum(lengths)]

    def encode(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and where each text ends.  A text is its chunks."""
        self._trim()
        known = self._index
        new = set(chain.from_iterable(texts)).difference(known)
        if new:
            self._add(list(new))
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        at = np.fromiter(map(known.__getitem__, chain.from_iterable(texts)), np.int64, int(lengths.sum()))
        return self._ids(at, lengths)

    def encode_distinct(self, chunks: list[str], at: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for texts given as places in distinct chunks, end to end, and the number of each text."""
        self._trim()
        place = np.fromiter(map(self._index.get, chunks, repeat(-1)), np.int64, len(chunks))
        new = np.flatnonzero(place < 0)
        if len(new):
            place[new] = len(self._index) + np.arange(len(new))
            self._add([chunks[i] for i in new.tolist()])
        return self._ids(place[at], lengths)
