"""Plain versions of the operators' results, one row or pair at a time."""

from __future__ import annotations

import base64
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import sentencepiece
import tiktoken
from tokenizers import Tokenizer

PROCESSOR = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
TOKENIZER = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
TOKENIZER.encode_special_tokens = True


def _ranks():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


ENCODING = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=_ranks(), special_tokens={})


def token_count(text):
    return len(ENCODING.encode_ordinary(text or ""))


def sentencepiece_row(text):
    ids = PROCESSOR.encode(text or "", add_bos=True, add_eos=True)
    raw = np.array(ids, "<u4").tobytes()
    decoded = PROCESSOR.decode(ids)
    return len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def pieces(text, capacity=4_096):
    """Start, length and checksum of each piece."""
    ids = TOKENIZER.encode(text or "", add_special_tokens=False).ids + [1]
    cut = [ids[k : k + capacity] for k in range(0, len(ids), capacity)]
    return [(k * capacity, len(c), zlib.crc32(np.array(c, "<u4").tobytes())) for k, c in enumerate(cut)]


KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _valid(kind, value):
    digits = [int(c) for c in value if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        doubled = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits))]
        return 16 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def base_spans(text):
    return [
        (kind, m.start(), m.end())
        for kind in KINDS
        for m in re.finditer(PATTERNS[kind], text or "")
        if _valid(kind, m.group())
    ]


def linked(ids, pairs):
    """Smallest id of the component of each id."""
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in pairs:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {i: root(i) for i in ids}


def vector_links(rows, threshold=0.95):
    usable = {
        i: np.array(v, float)
        for i, v in rows
        if v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    }
    ids = sorted(usable)
    cosine = lambda a, b: a @ b / math.sqrt((a @ a) * (b @ b))
    return [
        (a, b) for k, a in enumerate(ids) for b in ids[:k]
        if len(usable[a]) == len(usable[b]) and cosine(usable[a], usable[b]) >= threshold
    ]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def base_scores(rows):
    """Per id: held out, tokens, known tokens, training tokens, base score."""
    counts = Counter()
    remainder = {i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 for i, _ in rows}
    for i, text in rows:
        if remainder[i]:
            counts.update([*words(text), None])
    total, types = sum(counts.values()), len(counts)
    result = {}
    for i, text in rows:
        own = [counts[w] for w in [*words(text), None]]
        score = sum(math.log10((c + 0.1) / (total + 0.1 * (types + 1))) for c in own)
        result[i] = remainder[i] == 0, len(own), sum(c > 0 for c in own), total, score
    return result


def shingle_counts(text):
    split = (text or "").lower().split()
    return Counter(tuple(split[k : k + 5]) for k in range(max(1, len(split) - 4))) if split else Counter()


def similarity(a, b):
    union = sum((a | b).values())
    return sum((a & b).values()) / union if union else 0.0


def document_links(rows, threshold=0.8):
    shingled = {i: shingle_counts(t) for i, t in rows}
    by = defaultdict(set)
    for i, own in shingled.items():
        for s in own:
            by[s].add(i)
    links = []
    for i, own in shingled.items():
        for j in {j for s in own for j in by[s] if j < i}:
            if similarity(own, shingled[j]) >= threshold:
                links.append((i, j))
    return links
