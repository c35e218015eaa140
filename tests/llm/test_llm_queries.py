"""The registered queries on whole sample tables, against plain versions."""

import hashlib
import os
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import brute
import duckdb
import numpy as np
import pytest

from contrail.llm.queries import ORACLE, QUERIES

SAMPLES = Path(os.environ.get("SAMPLES_DIR", "/root/testdata/sf0.001"))
pytestmark = pytest.mark.skipif(not SAMPLES.exists(), reason="sample tables not present")


@pytest.fixture(scope="module")
def documents():
    return {r[0]: r[1:] for r in duckdb.sql(f"select doc_id, text, lang from '{SAMPLES}/documents.parquet'").fetchall()}


@pytest.fixture(scope="module")
def vectors():
    return duckdb.sql(f"select vec_id, embedding from '{SAMPLES}/embeddings.parquet'").fetchall()


def result(spark, name):
    return QUERIES[name](spark, str(SAMPLES)).collect()


def test_sentencepiece(spark, documents):
    rows = result(spark, "op1_sentencepiece")
    assert {r.doc_id for r in rows} == set(documents)
    for r in rows:
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == brute.sentencepiece_row(documents[r.doc_id][0])


def check_sequences(rows, capacity=4096):
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return places


def test_packing(spark, documents):
    rows = result(spark, "op2_best_fit_packing")
    pieces = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.doc_id, r.piece)):
        assert r.piece == len(pieces[r.doc_id])
        pieces[r.doc_id].append((r.start, r.length, r.ids_crc32))
    assert pieces == {i: brute.pieces(t) for i, (t, _) in documents.items()}
    tokens = sum(r.length for r in rows)
    assert len(check_sequences(rows)) <= 1.01 * tokens / 4096 + 1


def test_sharding(spark, documents):
    rows = result(spark, "op3_hypergeometric_shards")
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in rows) == sorted(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, (t, _) in documents.items()
    )
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert r.law == "rows" and r.grown_shard is None
    assert set(slots) <= set(range(8))
    assert max(map(len, slots.values())) - min(len(slots[s]) for s in range(8)) <= 1
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())


def test_personal_data(spark, documents):
    for r in result(spark, "op4_personal_data"):
        text = documents[r.doc_id][0]
        spans = brute.base_spans(text)
        joined = [f"{k}:{a}:{b}" for k, a, b in spans]
        assert hashlib.sha256(",".join(joined).encode()).hexdigest() == r.base_sha256
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in spans) for k in brute.KINDS]
        found = r.spans.split(",") if r.spans else []
        assert set(joined) <= set(found)
        for kind, start, end in (s.split(":") for s in found):
            assert kind in brute.KINDS and re.search("[0-9@]", text[int(start) : int(end)])


def test_near_vectors(spark, vectors):
    links = brute.vector_links(vectors)
    component = brute.linked([i for i, _ in vectors], links)
    count = Counter(i for pair in links for i in pair)
    for r in result(spark, "op5_near_vectors"):
        assert (r.n_links, r.component_id, r.kept) == (
            count[r.vec_id], component[r.vec_id], component[r.vec_id] == r.vec_id
        )


def test_scores(spark, documents):
    rows = result(spark, "op6_interpolated_scores")
    plain = brute.base_scores([(i, t) for i, (t, _) in documents.items()])
    for r in rows:
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == plain[r.doc_id][:4]
        assert r.base_score == pytest.approx(plain[r.doc_id][4], rel=1e-9)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_token_counts(spark, documents):
    rows = sorted(result(spark, "op7_token_counts"), key=lambda r: r.n_tokens)
    assert sum(r.documents for r in rows) == len(documents)
    lengths = sorted(n for r in rows for n in [r.n_tokens] * r.documents)
    assert lengths == sorted(brute.token_count(text) for text, _ in documents.values())
    for r in rows:
        assert r.tokens_to == sum(n for n in lengths if n <= r.n_tokens)
        assert r.documents_from == sum(n >= r.n_tokens for n in lengths)
        assert r.truncated_total == sum(min(n, r.n_tokens) for n in lengths)


def test_language(spark, documents):
    held = [r for r in result(spark, "op8_language") if r.held_out]
    assert len(held) == sum(zlib.crc32(str(i).encode()) % 3 == 1 for i in documents)
    kept = [r for r in held if not r.rejected]
    assert sum(r.lang_pred == documents[r.doc_id][1] for r in kept) >= 0.9 * len(kept)
    assert all(0 <= r.score <= 1 for r in held)


def test_near_documents(spark, documents):
    rows = [(i, t) for i, (t, _) in documents.items()]
    component = brute.linked(list(documents), brute.document_links(rows))
    found = {r.doc_id: r.component_id for r in result(spark, "op9_bag_minhash")}
    assert found == component


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, name):
    connection = duckdb.connect()
    for file in SAMPLES.glob("*.parquet"):
        connection.sql(f"create view {file.stem} as select * from '{file}'")
    expected = connection.sql(ORACLE[name])
    df = QUERIES[name](spark, str(SAMPLES))
    assert df.columns == expected.columns
    assert sorted(map(tuple, df.collect())) == sorted(expected.fetchall())


def test_pipeline(spark, documents):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SAMPLES}/documents.parquet")
    seen = []
    for name, function in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = function(spark, docs, str(SAMPLES)).cache()
        assert docs.columns == before.columns
        seen.append({r.doc_id: r for r in docs.collect()})
    known, unique, clean = seen
    assert len(known) >= 0.95 * len(documents)
    component = brute.linked(list(known), brute.document_links([(i, r.text) for i, r in known.items()]))
    assert set(unique) == set(component.values())
    assert set(clean) == set(unique)
    for i, r in clean.items():
        assert not brute.base_spans(r.text) and r.n_chars == len(r.text)
        if not brute.base_spans(unique[i].text):
            assert r.text == unique[i].text or re.search(r"\[(EMAIL|IP|CARD|PHONE)\]", r.text)
    rows = corpus_pipeline.run(spark, str(SAMPLES)).collect()
    assert {r.doc_id for r in rows} == set(clean)
    check_sequences(rows)


def test_packed_documents_keep_their_tokens(spark, documents):
    from contrail.llm.queries import pack_documents

    docs = spark.read.parquet(f"{SAMPLES}/documents.parquet")
    tokens = defaultdict(list)
    for r in sorted(pack_documents(docs).collect(), key=lambda r: (r.doc_id, r.piece)):
        assert len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32
        tokens[r.doc_id] += np.frombuffer(r.ids, "<u4").tolist()
    for i, (text, _) in documents.items():
        assert tokens[i] == [*brute.TOKENIZER.encode(text or "", add_special_tokens=False).ids, 1]
