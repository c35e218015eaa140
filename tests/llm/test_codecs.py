"""Encoders against their libraries, and what they do with awkward rows."""

import itertools
import json
import zlib

import brute
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from sentencepiece import sentencepiece_model_pb2 as proto
from tokenizers import Tokenizer

from contrail.llm import packing, sentencepiece_codec, token_counts
from contrail.llm.word_codec import _RANGES, WordCodec

MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
TRICKY = [
    "", " ", "  two  blanks ", "▁▁ literal ▁", "tab\tand\nline", "été œuvre", "日本語 🙂🙂", "\x00\x01", "<s> </s> <unk>",
    "<|endoftext|>", "I'm they'll 's''re", "İstanbul", "ﬁ ﬂ ① Å ㌕ ｶﾞ", "é é́", "a b c\x85d", "x" * 9_000,
]


@pytest.fixture(scope="module")
def model():
    with open(MODEL, "rb") as file:
        return file.read()


@pytest.fixture(scope="module")
def word_codec():
    with open(WORDS, encoding="utf-8") as file:
        return WordCodec(file.read())


def with_rule(model, rule, **changes):
    """The model with a compiled character map of the library, and its processor."""
    spec = proto.ModelProto.FromString(model)
    own = sentencepiece.SentencePieceNormalizer(rule_name=rule)
    rules = proto.NormalizerSpec.FromString(own.serialized_normalizer_spec())
    spec.normalizer_spec.precompiled_charsmap = rules.precompiled_charsmap
    for name, value in changes.items():
        setattr(spec.normalizer_spec, name, value)
    raw = spec.SerializeToString()
    return raw, sentencepiece.SentencePieceProcessor(model_proto=raw)


def spans(processor, text):
    """Ids and byte spans of the library."""
    found = processor.encode(text, return_type="proto").pieces
    return [p.id for p in found], [(p.begin, p.end) for p in found]


@settings(max_examples=200, deadline=None)
@given(st.text(st.characters(codec="utf-8"), max_size=60))
def test_ids_are_the_librarys(text):
    with open(MODEL, "rb") as file:
        codec = sentencepiece_codec._codec("test", sentencepiece_codec._Bytes(file.read()))
    ((ids, offsets),) = codec.encode([text])
    assert ids.tolist() == brute.PROCESSOR.encode(text)
    assert len(offsets) == len(ids) + 1 and (np.diff(offsets.astype(int)) >= 0).all()
    assert offsets[-1] == len(text.encode())


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nmt_nfkc_cf", "nfkc_cf"])
@pytest.mark.parametrize("squeeze", [False, True])
def test_character_maps(model, rule, squeeze):
    raw, processor = with_rule(model, rule, remove_extra_whitespaces=squeeze)
    codec = sentencepiece_codec.Codec(raw)
    for text, (ids, offsets) in zip(TRICKY, codec.encode(TRICKY), strict=True):
        wanted, places = spans(processor, text)
        assert ids.tolist() == wanted, text
        for k, (begin, end) in enumerate(places):
            # Byte pieces cover their own bytes here; the library gives the whole to the last one.
            if not processor.is_byte(wanted[k]) and end > begin:
                assert offsets[k] == begin, (text, k)


def test_offsets_give_the_pieces(model):
    codec = sentencepiece_codec.Codec(model)
    for text, (ids, offsets) in zip(TRICKY, codec.encode(TRICKY), strict=True):
        source = text.encode()
        for i, a, b in zip(ids.tolist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            if not brute.PROCESSOR.is_byte(i):
                piece = brute.PROCESSOR.id_to_piece(i).replace("▁", " ")
                assert source[a:b].decode().replace("▁", " ") in (piece, piece[1:])


def test_awkward_documents(spark, awkward, nothing):
    given_rows = awkward.drop("h").withColumnRenamed("label", "ids2")
    rows = sentencepiece_codec.decode_documents(
        sentencepiece_codec.encode_documents(given_rows, MODEL), MODEL
    ).collect()
    assert len(rows) == awkward.count()
    for r in rows:
        ids = brute.PROCESSOR.encode(r.text or "", add_bos=True, add_eos=True)
        assert np.frombuffer(r.ids, "<u4").tolist() == ids
        assert r.decoded == brute.PROCESSOR.decode(ids) and r._text == "clash"
    assert sentencepiece_codec.encode_documents(nothing, MODEL).count() == 0
    with pytest.raises(ValueError):
        sentencepiece_codec.encode_documents(awkward.withColumnRenamed("h", "ids"), MODEL)


def library(text):
    return brute.TOKENIZER.encode(text, add_special_tokens=False).ids


def test_every_usual_character(word_codec):
    usual = [chr(c) for a, b in _RANGES for c in range(a, b + 1)]
    texts = [f"a{c}b {c}{c} 1{c}2 {c}'s" for c in usual] + ["".join(usual)]
    for text, ids in zip(texts, word_codec.encode(texts), strict=True):
        assert ids.tolist() == library(text), text


def test_tricky_words(word_codec):
    texts = [*TRICKY, *map("".join, itertools.product("'sS<é ", repeat=3))]
    for text, ids in zip(texts, word_codec.encode(texts), strict=True):
        assert ids.tolist() == library(text), text


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("abAB'stve1²½ªµÉÑß \t\n.,!<|>-́İ "), max_size=40))
def test_words_one_by_one(text):
    codec = packing._codec(open(WORDS, encoding="utf-8").read())
    assert codec.encode([text])[0].tolist() == library(text)


def test_contractions_anywhere(word_codec):
    texts = ["".join(x) for x in itertools.product("'rvle !1", repeat=4)]
    texts += ["".join(x) for x in itertools.product(["'", "'d", "'m", "'ll", "m", "t", "\x1c", "\x85", "é"], repeat=3)]
    for text, ids in zip(texts, word_codec.encode(texts), strict=True):
        assert ids.tolist() == library(text), text


class Counted(dict):
    """A dictionary that counts what it is asked for."""

    asked = 0

    def get(self, *key):
        self.asked += 1
        return super().get(*key)

    def __getitem__(self, key):
        self.asked += 1
        return super().__getitem__(key)


def test_a_word_is_looked_up_once_a_call(monkeypatch):
    with open(WORDS, encoding="utf-8") as file:
        codec = WordCodec(file.read())
    codec.encode(["one two three"])
    index = Counted(codec._store._index)
    monkeypatch.setattr(codec._store, "_index", index)
    texts = ["One two, three. " * 200, "", "three two one four " * 300]
    assert [ids.tolist() for ids in codec.encode(texts)] == [library(t) for t in texts]
    assert 0 < index.asked <= 6  # distinct words and signs


def test_added_tokens_of_other_forms():
    with open(WORDS, encoding="utf-8") as file:
        spec = json.loads(file.read())
    spec["added_tokens"].append(spec["added_tokens"][0] | {"id": 49_408, "content": "two", "special": False})
    codec = WordCodec(json.dumps(spec))
    wanted = Tokenizer.from_str(json.dumps(spec)).encode("one two three", add_special_tokens=False).ids
    assert wanted != library("one two three") and codec.encode(["one two three"])[0].tolist() == wanted


def test_store_starts_anew(word_codec, monkeypatch):
    monkeypatch.setattr("contrail.llm.pieces.KEEP_CHUNKS", 1)
    for text in ("one two", "two three", "one two three four"):
        assert word_codec.encode([text])[0].tolist() == library(text)


def test_cut_and_pack_awkward_documents(awkward, nothing):
    rows = packing.cut_documents(awkward, WORDS, 512, end_id=1).collect()
    texts = {r.doc_id: r.text for r in awkward.collect()}
    for r in rows:
        assert r.length == len(r.ids) / 4 <= 512
    assert {(r.doc_id, r.piece, r.start, r.length, zlib.crc32(r.ids)) for r in rows} == {
        (i, k, *p) for i, t in texts.items() for k, p in enumerate(brute.pieces(t, 512))
    }
    assert sum(r.doc_id == 100 for r in rows) == 2 * len(brute.pieces(texts[100], 512))
    assert packing.cut_documents(nothing, WORDS, 512, end_id=1).count() == 0


def test_token_lengths(awkward, nothing):
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    table = token_counts.length_table(token_counts.token_lengths(awkward, ranks, public_tokenizers.PATTERN))
    rows = table.collect()
    lengths = [n for r in rows for n in [r.n_tokens] * r.documents]
    assert len(lengths) == awkward.count() and lengths.count(0) >= 3
    for r in token_counts.at_limits(table, [0, 10, 10**6]).collect():
        assert r.tokens_kept == sum(min(n, r.context_limit) for n in lengths)
        assert r.tokens_lost == sum(max(0, n - r.context_limit) for n in lengths)
        assert r.documents_within + r.documents_cut == len(lengths)
    ordered = sorted(lengths)
    for r in token_counts.quantiles(table, [0.1, 0.5, 1.0]).collect():
        assert r.n_tokens == ordered[max(0, -(-len(ordered) * int(r.share * 10) // 10) - 1)]
    empty = token_counts.token_lengths(nothing, ranks, public_tokenizers.PATTERN)
    assert token_counts.length_table(empty).count() == 0
