"""Language by compression: the dictionary that makes a text smallest names its language.

Texts and dictionaries are reduced to their words in lower case first: capitals and odd
punctuation would match no dictionary."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from contrail.llm.common import free_name, prepare, text_parts, whole_text

UNDECIDED = "und"
#: Bound of the labelled sample: documents per language, characters of each, bytes of a
#: dictionary.  The documents are those with the smallest hashes.
SAMPLE_DOCS, SAMPLE_CHARS, DICTIONARY_BYTES = 400, 2_000, 112_640
#: Parts of the labelled rows in which the smallest hashes are looked for first.
SAMPLE_PARTS = 64
#: A text is compressed in blocks, so that it leans on the dictionary and not on itself.
BLOCK_BYTES, LEVEL = 512, 6
#: What does not fill a block is measured behind this, by what it adds: alone, it would be stored
#: raw under every dictionary.  Words hold no digits, so the filler meets none.
FILLER, SHORTEST_MATCH = b"0" * BLOCK_BYTES, 3
#: The best size must be this share smaller than the second; else the text is rejected.
MARGIN = 0.01
_WORD = re.compile(r"[^\W\d_]+")


def words(text: str) -> bytes:
    """The runs of letters.  Signs such as ² or Ⅷ belong to words for ``re``, but are no letters."""
    found = " ".join(_WORD.findall(text.lower()))
    if not found.replace(" ", "a").isalpha():
        found = " ".join("".join(c if c.isalpha() else " " for c in found).split())
    return found.encode()


class Model(NamedTuple):
    """Languages in order, and the raw content of their dictionaries."""

    languages: list[str]
    contents: list[bytes]


def train(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    sample_docs: int = SAMPLE_DOCS,
) -> Model:
    """Dictionaries from labelled documents: at most ``sample_docs`` per language.

    Rows without label, text or id are left out; no labelled rows give a model of no
    language, which rejects everything.  All documents of the sample enter the dictionary, each
    with an equal share of ``DICTIONARY_BYTES``."""
    keyed = df.filter(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
    narrow = keyed.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.xxhash64(id_col).alias("h"))
    # The smallest hashes of parts first, so that no task sees the smallest of all tasks.
    part = F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(SAMPLE_PARTS))
    chosen = narrow
    for keys in (["lang", "_part"], ["lang"]):
        order = Window.partitionBy(*keys).orderBy("h", "id")
        ranked = chosen.withColumn("_part", part).withColumn("_n", F.row_number().over(order))
        chosen = ranked.filter(F.col("_n") <= sample_docs).select("id", "lang", "h")
    # At most ``sample_docs`` ids per language.
    ids = F.broadcast(chosen.select(F.col("id").alias(id_col), F.col("lang").alias("_lang")).distinct())
    rows = (
        keyed.join(ids, (keyed[id_col] == ids[id_col]) & (keyed[lang_col] == ids["_lang"]), "left_semi")
        .select(F.col(lang_col).alias("lang"), F.xxhash64(id_col).alias("h"), F.substring(text_col, 1, SAMPLE_CHARS).alias("t"))
        .dropDuplicates(["lang", "h"])
        .orderBy("lang", "h")
        .collect()
    )
    by: dict[str, list[bytes]] = {}
    for row in rows:
        by.setdefault(row["lang"], []).append(words(row["t"]))
    names = sorted(by)
    share = {n: max(1, DICTIONARY_BYTES // len(by[n]) - 1) for n in names}
    return Model(names, [b"".join(t[: share[n]] + b"\n" for t in by[n])[:DICTIONARY_BYTES] for n in names])


class _Sizes:
    """Compressed sizes of a text under each dictionary."""

    def __init__(self, model: Model):
        self._languages = model.languages
        self._by, self._short, self._filler = [], [], []
        options = {"write_checksum": False, "write_content_size": False, "write_dict_id": False}
        for content in model.contents:
            dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            dictionary.precompute_compress(level=LEVEL)
            self._by.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, **options).compress)
            finer = zstandard.ZstdCompressionParameters.from_level(
                LEVEL, source_size=2 * BLOCK_BYTES, dict_size=len(content), min_match=SHORTEST_MATCH,
                strategy=zstandard.STRATEGY_BTOPT, **options,
            )
            dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            dictionary.precompute_compress(compression_params=finer)
            self._short.append(zstandard.ZstdCompressor(dict_data=dictionary, compression_params=finer).compress)
            self._filler.append(len(self._short[-1](FILLER)))

    def best(self, text: str) -> tuple[str, float, float]:
        """Language, score from 0 to 1, and the share by which the best is smaller than the second."""
        raw = words(text)
        if not self._languages or not raw:
            return UNDECIDED, 0.0, 0.0
        full = len(raw) - len(raw) % BLOCK_BYTES
        blocks = [raw[i : i + BLOCK_BYTES] for i in range(0, full, BLOCK_BYTES)]
        sizes = [sum(len(compress(b)) for b in blocks) for compress in self._by]
        if full < len(raw):
            rest = b"%b %b " % (FILLER, raw[full:])
            added = (len(compress(rest)) - alone for compress, alone in zip(self._short, self._filler, strict=True))
            sizes = [size + more for size, more in zip(sizes, added, strict=True)]
        if len(sizes) == 1:
            return self._languages[0], 1.0, 1.0
        order = sorted(range(len(sizes)), key=lambda i: (sizes[i], i))
        first, second = sizes[order[0]], sizes[order[1]]
        margin = 1 - first / second
        return self._languages[order[0]], margin / (margin + MARGIN), margin


def identify(df: DataFrame, model: Model, text_col: str = "text", margin: float = MARGIN) -> DataFrame:
    """Add ``lang_pred``, ``score``, ``margin`` and ``rejected``.

    ``lang_pred`` is the language whose dictionary makes the whole text smallest (ties, as of
    a word that no dictionary or each one holds: the first by name, rejected); ``und`` for
    null, for texts without a letter and for an empty model.
    ``score`` grows from 0 to 1 with the margin and is 0.5 at ``MARGIN``.  ``rejected``: it
    is ``und`` or the margin is below ``margin``.  Other columns pass through, clashing
    names fail; each row is judged alone by its text, without a shuffle."""
    added = ("lang_pred", "score", "margin", "rejected")
    if clash := set(added) & set(df.columns):
        raise ValueError(f"the input already has columns {sorted(clash)}")
    prepare(df.sparkSession)
    work = free_name(df, "_text")
    schema = T.StructType(list(df.schema.fields))
    for name, kind in zip(added, ("string", "double", "double", "boolean"), strict=True):
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = _Sizes(model)
        for batch, texts in text_parts(batches, work):
            found = [sizes.best(t) for t in texts]
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [
                    *kept, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()),
                    pa.array([f[2] for f in found], pa.float64()),
                    pa.array([f[0] == UNDECIDED or f[2] < margin for f in found], pa.bool_()),
                ],
                schema.names,
            )

    return df.withColumn(work, whole_text(text_col)).mapInArrow(run, schema)


def fold(id_col: str | Column, parts: int) -> Column:
    """Remainder of the checksum of the id as text; a null id counts as empty text."""
    column = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % parts
