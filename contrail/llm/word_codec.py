"""Ids of whole texts by a tokenizer file of the ``tokenizers`` library, word by word.

The library looks at a text word by word after normalising it, so each distinct word is
given to its model once per worker.  Words are found by the classes of their characters, all
texts of a call at once, and each distinct word of a call is looked up once.  This holds for
texts of Latin letters, digits and usual punctuation, but without combining marks, under the
rules checked in ``word_rules``; every other text, and any tokenizer with other rules, goes
to the library whole."""

from __future__ import annotations

import codecs
import itertools
import json
import re
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute
from tokenizers import Tokenizer

from contrail.llm.pieces import ChunkStore

#: Code points whose classes and lower-case forms every library agrees on, and whose
#: lower-case and composed forms are among them again.
_RANGES = ((0x00, 0x12F), (0x131, 0x17F), (0x2000, 0x206F), (0x20A0, 0x20BF))
#: The rules of a lower-casing, word-end tokenizer that this module follows.
_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: What makes a word with an apostrophe before it, and the classes of characters.
_ONE, _TWO = "stmd", ("re", "ve", "ll")
_BLANK, _LETTER, _NUMBER, _OTHER = range(4)


def word_rules(tokenizer_json: str) -> bool:
    """Whether the tokenizer has the rules that this module can follow word by word."""
    spec = json.loads(tokenizer_json)
    steps = (spec.get("normalizer") or {}).get("normalizers") or []
    splits = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or []
    return (
        [s["type"] for s in steps] == _NORMALIZERS
        and steps[1]["pattern"] == {"Regex": r"\s+"}
        and steps[1]["content"] == " "
        and [s["type"] for s in splits] == ["Split", "ByteLevel"]
        and splits[0]["pattern"] == {"Regex": _SPLIT}
        and splits[0]["behavior"] == "Removed"
        and splits[0]["invert"]
        and not splits[1]["use_regex"]
        and not splits[1]["add_prefix_space"]
        and all("<|" in token["content"] for token in spec.get("added_tokens") or [])
    )


def _classes() -> np.ndarray:
    """Class of each code point of two bytes."""
    found = np.full(1 << 16, _OTHER, np.uint8)
    for at in itertools.chain.from_iterable(range(a, b + 1) for a, b in _RANGES):
        kind = unicodedata.category(chr(at))[0]
        if kind == "Z" or chr(at) in "\t\n\v\f\r\x85":
            found[at] = _BLANK
        elif kind in "LN":
            found[at] = _LETTER if kind == "L" else _NUMBER
    return found


def _byte_letters() -> str:
    """The letter that stands for each byte in the model: itself if printable.  The blank stays, as no word has one."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = itertools.count(256)
    letters = [chr(b if b in plain else next(others)) for b in range(256)]
    return "".join([*letters[:32], " ", *letters[33:]])


class WordCodec:
    """Encoder for one tokenizer, given as the text of its file."""

    def __init__(self, tokenizer_json: str):
        self._library = Tokenizer.from_str(tokenizer_json)
        self._library.encode_special_tokens = True  # their strings in a text are ordinary text
        self._library.no_truncation()
        self._library.no_padding()
        self._by_word = word_rules(tokenizer_json)
        self._model = self._library.model
        known = "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in _RANGES)
        self._unknown = re.compile(f"[^{known}]")
        self._class, self._letters = _classes(), _byte_letters()
        self._store = ChunkStore(self._split)

    def _split(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        spelled = codecs.charmap_decode(" ".join(words).encode(), "strict", self._letters)[0].split(" ")
        found = [[token.id for token in self._model.tokenize(word)] for word in spelled]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(itertools.chain.from_iterable(found), np.uint32, int(lengths.sum())), lengths

    def _other(self, text: str) -> bool:
        return "<|" in text or not text.isascii() and self._unknown.search(text) is not None

    def _words(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The distinct words of texts, the place there of each word, and how many words each text has.

        All is as ``_SPLIT`` finds it from left to right: an apostrophe opens a word of its kind
        only where a word may begin, so not within other signs."""
        plain = [unicodedata.normalize("NFC", t).lower() for t in texts]
        codes = np.frombuffer(" ".join(["", *plain, "   "]).encode("utf-16-le"), "<u2")
        kind = self._class[codes]
        begins = np.zeros(len(codes), bool)
        np.not_equal(kind[1:], kind[:-1], out=begins[1:])
        begins |= kind == _NUMBER
        begins &= kind != _BLANK
        quote = np.flatnonzero(codes == ord("'"))
        quote = quote[begins[quote]]
        first, second = codes[quote + 1], codes[quote + 2]
        one = np.isin(first, [ord(c) for c in _ONE])
        two = np.isin(first * np.int64(1 << 16) + second, [(ord(c) << 16) + ord(d) for c, d in _TWO])
        for found, width in ((quote[one], 2), (quote[two], 3)):
            begins[found + 1] = False
            begins[found + width] = kind[found + width] != _BLANK
        last = np.cumsum([len(t) + 1 for t in plain])
        counts = np.diff(np.searchsorted(np.flatnonzero(begins), last), prepend=0)
        inside = kind != _BLANK
        letters = codes[inside]
        ends = np.append(np.flatnonzero(begins[inside]), len(letters))
        buffers = [None, pa.py_buffer(2 * ends), pa.py_buffer(letters)]
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, buffers).dictionary_encode()
        spelled = b"".join(words.dictionary.to_numpy(zero_copy_only=False)).decode("utf-16-le")
        bounds = (np.cumsum(pa.compute.binary_length(words.dictionary).to_numpy()) // 2).tolist()
        distinct = [spelled[a:b] for a, b in zip([0, *bounds], bounds, strict=False)]
        return distinct, words.indices.to_numpy(), counts

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        whole = [i for i, t in enumerate(texts) if not self._by_word or self._other(t)]
        given: dict[int, np.ndarray] = {}
        if whole:
            found = self._library.encode_batch([texts[i] for i in whole], add_special_tokens=False)
            given = {i: np.array(x.ids, np.uint32) for i, x in zip(whole, found, strict=True)}
        rest = [i for i in range(len(texts)) if i not in given]
        flat, ends = self._store.encode_distinct(*self._words([texts[i] for i in rest]))
        begins = [0, *ends.tolist()]
        given.update((i, flat[a:b]) for i, a, b in zip(rest, begins, begins[1:], strict=False))
        return [given[i] for i in range(len(texts))]
