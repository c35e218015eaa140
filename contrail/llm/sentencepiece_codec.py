"""SentencePiece encoding that keeps every piece's place in the original bytes.

Normalisation is done here: the longest prefix that the model's compiled character map
knows is replaced, and each normalised byte remembers where its source began.  The
normalised text falls into chunks that no piece can cross; the library segments each
distinct chunk once, without normalising again.  Piece lengths then run over the
remembered places, which gives the byte offsets."""

from __future__ import annotations

import functools
import hashlib
import itertools
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F, types as T
from sentencepiece import sentencepiece_model_pb2 as proto

from contrail.llm.common import free_name, prepare, text_parts, whole_text
from contrail.llm.pieces import ChunkStore

SPACE = "▁"
_UNKNOWN, _CONTROL, _BYTE = 2, 3, 6


class CharacterMap:
    """The compiled map of a model: a double-array trie of source strings, and what they become."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self._units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if size else []
        self._values = blob[4 + size :] if blob else b""

    @staticmethod
    def _child(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)

    def longest(self, source: bytes, at: int) -> tuple[bytes, int] | None:
        """What the longest known prefix of ``source[at:]`` becomes, and its length."""
        if not self._units:
            return None
        node, found = self._child(self._units[0]), None
        for end in range(at, len(source)):
            byte = source[end]
            node ^= byte
            if node >= len(self._units) or self._units[node] & 0x800000FF != byte:
                break
            unit = self._units[node]
            node ^= self._child(unit)
            if unit >> 8 & 1:
                value = self._units[node] & 0x7FFFFFFF
                found = self._values[value : self._values.index(b"\0", value)], end + 1 - at
        return found

    def __bool__(self) -> bool:
        return bool(self._units)


def _width(lead: int) -> int:
    return 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4


class Codec:
    """Encoder and decoder of one model, given as bytes."""

    def __init__(self, model: bytes):
        spec = proto.ModelProto.FromString(model)
        self._rules = spec.normalizer_spec
        self._suffix = spec.trainer_spec.treat_whitespace_as_suffix
        self._map = CharacterMap(self._rules.precompiled_charsmap)
        self._library = sentencepiece.SentencePieceProcessor(model_proto=model)
        # User-defined symbols are left alone by the map: longest first.
        own = sorted((p.piece for p in spec.pieces if p.type == 4), key=len, reverse=True)
        self._own = re.compile("|".join(map(re.escape, own)).encode()) if own else None

        self._lengths = np.array(
            [1 if p.type == _BYTE else 0 if p.type == _CONTROL else len(p.piece.encode()) for p in spec.pieces]
        )
        self._unknown = next(i for i, p in enumerate(spec.pieces) if p.type == _UNKNOWN)
        plain = proto.ModelProto.FromString(model)
        plain.normalizer_spec.Clear()
        plain.normalizer_spec.name = "identity"
        plain.normalizer_spec.add_dummy_prefix = False
        plain.normalizer_spec.remove_extra_whitespaces = False
        plain.normalizer_spec.escape_whitespaces = False
        self._segments = sentencepiece.SentencePieceProcessor(model_proto=plain.SerializeToString())
        crossing = any(SPACE in p.piece.lstrip(SPACE) for p in spec.pieces)
        alone = any(p.piece == SPACE for p in spec.pieces)
        self._chunk = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+") if alone and not crossing else re.compile("(?s).+")
        self._store = ChunkStore(self._segment)
        self.bos, self.eos = self._library.bos_id(), self._library.eos_id()

    def _segment(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = self._segments.encode(chunks, num_threads=1)
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(itertools.chain.from_iterable(found), np.uint32, int(lengths.sum())), lengths

    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and for each of its bytes (and its end) the source byte."""
        source = text.encode()
        rules = self._rules
        space = SPACE.encode() if rules.escape_whitespaces else b" "
        if not self._map and not rules.remove_extra_whitespaces and not self._own:
            raw = np.frombuffer(source, np.uint8)
            back = np.repeat(np.arange(len(raw)), np.where(raw == 0x20, len(space), 1))
            norm = source.replace(b" ", space)
        else:
            norm, back = self._replace(source, space)
        mark = len(space) if rules.add_dummy_prefix and norm else 0
        if mark and self._suffix:
            norm, back = norm + space, np.concatenate([back, np.full(mark, len(source))])
        elif mark:
            norm, back = space + norm, np.concatenate([np.full(mark, back[0] if len(back) else 0), back])
        return norm.decode("utf-8", "replace"), np.append(back, len(source)).astype(np.uint32)

    def _replace(self, source: bytes, space: bytes) -> tuple[bytes, np.ndarray]:
        out, places, at = [], [], 0
        squeeze = self._rules.remove_extra_whitespaces
        blank = squeeze  # leading blanks go
        while at < len(source):
            own = self._own.match(source, at) if self._own else None
            if own:
                new, used = own.group(), len(own.group())
            else:
                new, used = self._map.longest(source, at) or (source[at : at + (w := _width(source[at]))], w)
            if squeeze and blank:
                new = new.lstrip(b" ")
            if new:
                whole = new.replace(b" ", space)
                out.append(whole)
                places.extend([at] * len(whole))
                blank = squeeze and new.endswith(b" ")
            at += used
        norm = b"".join(out)
        while squeeze and norm.endswith(space):  # trailing blanks go
            norm = norm[: -len(space)]
        return norm, np.array(places[: len(norm)], np.int64)

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each text its ids, and the byte offsets of the pieces: one more than ids;
        piece ``i`` covers the source bytes from offset ``i`` to offset ``i + 1``."""
        normal = [self.normalise(t) for t in texts]
        chunks = [self._chunk.findall(n) for n, _ in normal]
        flat, ends = self._store.encode(chunks)
        begin = 0
        for (_, back), parts, end in zip(normal, chunks, ends.tolist(), strict=True):
            ids = flat[begin:end]
            lengths = self._lengths[ids]
            if (ids == self._unknown).any():
                lengths = self._surfaces(parts)
            begin = end
            yield ids, back[np.concatenate([[0], np.cumsum(lengths)])]

    def _surfaces(self, chunks: list[str]) -> np.ndarray:
        """Byte lengths of the pieces where some are unknown and so have no length of their own."""
        found = self._segments.encode(chunks, return_type="proto", num_threads=1)
        return np.array([p.end - p.begin for c in found for p in c.pieces], np.int64)

    def decode(self, ids: list[int]) -> str:
        return self._library.decode(ids)


@functools.lru_cache(maxsize=2)
def _codec(digest: str, holder: _Bytes) -> Codec:
    return Codec(holder.model)


class _Bytes:
    """A model's bytes; equal by digest, so that a worker builds a codec once."""

    def __init__(self, model: bytes):
        self.model, self.digest = model, hashlib.sha256(model).hexdigest()

    def __hash__(self) -> int:
        return hash(self.digest)

    def __eq__(self, other: object) -> bool:
        return isinstance(other, _Bytes) and self.digest == other.digest


def _read(model_file: str) -> _Bytes:
    with open(model_file, "rb") as file:
        return _Bytes(file.read())


def encode_documents(
    df: DataFrame, model_file: str, text_col: str = "text", bos: bool = True, eos: bool = True
) -> DataFrame:
    """Add ``ids`` and ``offsets`` to ``df`` (binary, little-endian unsigned 32-bit integers).

    ``offsets`` has a place for the begin of every piece of the text, without begin and
    end ids, and one for the end: bytes of the original text.  Null counts as empty: no
    piece, ``offsets`` is the single 0.  Whole texts of any length, all rows, repeated ones
    too; other columns pass through, and the two names may not be among them.  No shuffle."""
    for name in ("ids", "offsets"):
        if name in df.columns:
            raise ValueError(f"the input already has a column {name}")
    prepare(df.sparkSession)
    work = free_name(df, "_text")
    holder = _read(model_file)
    schema = T.StructType(list(df.schema.fields)).add("ids", "binary").add("offsets", "binary")

    def run(batches):
        codec = _codec(holder.digest, holder)
        first = [codec.bos] if bos else []
        last = [codec.eos] if eos else []
        for batch, texts in text_parts(batches, work):
            ids, offsets = [], []
            for own, places in codec.encode(texts):
                ids.append(np.concatenate([first, own, last]).astype("<u4").tobytes())
                offsets.append(places.astype("<u4").tobytes())
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(ids, pa.binary()), pa.array(offsets, pa.binary())], schema.names
            )

    return df.withColumn(work, whole_text(text_col)).mapInArrow(run, schema)


def decode_documents(df: DataFrame, model_file: str, ids_col: str = "ids", to: str = "decoded") -> DataFrame:
    """Add the text of ``ids_col`` (binary as ``encode_documents`` gives it); null stays null."""
    if to in df.columns:
        raise ValueError(f"the input already has a column {to}")
    prepare(df.sparkSession)
    holder = _read(model_file)
    work = free_name(df, "_ids")
    schema = T.StructType(list(df.schema.fields)).add(to, "string")

    def run(batches):
        codec = _codec(holder.digest, holder)
        for batch in batches:
            given = batch.column(batch.num_columns - 1)
            texts = [
                None if not x.is_valid else codec.decode(np.frombuffer(x.as_buffer(), "<u4").tolist()) for x in given
            ]
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(texts, pa.string())], schema.names)

    return df.withColumn(work, F.col(ids_col)).mapInArrow(run, schema)
