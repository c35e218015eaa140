"""Operators on made rows: their laws, and what they do with awkward input."""

import math
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from contrail.llm import language_id, language_model, minhash, packing, pii, sharding, topk, vectors
from contrail.llm.components import components


# Packing


@pytest.mark.parametrize("capacity", [1, 10, 4096])
def test_best_fit(capacity):
    rng = np.random.default_rng(capacity)
    sizes = rng.integers(0, capacity + 1, 2_000)
    bins = packing.best_fit(sizes, capacity)
    load = np.bincount(bins, weights=sizes)
    assert load.max() <= capacity
    # First-fit-like guarantee: no two bins could be one.
    two = np.sort(load)[:2]
    assert len(load) < 2 or two.sum() > capacity


def test_pack_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK_ITEMS", 50)
    items = spark.range(1_000).select("id", (F.col("id") * 37 % 100 + 1).alias("n"), F.lit("x").alias("bin"))
    rows = packing.pack(items, "n", 100).collect()
    assert sorted(r.id for r in rows) == list(range(1_000))
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.n))
    for own in places.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= 100
    assert len(places) <= 1.1 * sum(r.n for r in rows) / 100


def test_pack_carries_what_the_items_hold(spark):
    """Filled where they are or shuffled, all items keep their bytes, and sequences are gapless."""
    items = spark.range(0, 20_000, 1, 2).select((F.col("id") * 37 % 100 + 1).alias("n"), "id")
    items = items.withColumn("ids", F.expr("cast(repeat(char(65 + id % 26), cast(n as int)) as binary)"))
    rows = packing.pack(items, "n", 100).collect()
    assert sorted(r.id for r in rows) == list(range(20_000))
    assert all(r.ids == bytes([65 + r.id % 26]) * r.n for r in rows)
    sequences = defaultdict(bytes)
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert len(sequences[r.sequence_id]) == r.offset
        sequences[r.sequence_id] += r.ids
    assert max(map(len, sequences.values())) <= 100
    assert len(sequences) <= 1.01 * sum(r.n for r in rows) / 100


def test_pack_ends_without_gain_and_refuses(spark):
    same = spark.range(300).select("id", F.lit(60).alias("n"))
    assert packing.pack(same, "n", 100).select("sequence_id").distinct().count() == 300
    none = spark.createDataFrame([(1, None), (1, None), (2, 0)], "id long, n int")
    assert {r.offset for r in packing.pack(none, "n", 5).collect()} == {0}
    assert packing.pack(none.limit(0), "n", 5).count() == 0
    with pytest.raises(Exception, match="longer than 100"):
        packing.pack(spark.range(1).select(F.lit(101).alias("n")), "n", 100).count()


# Sharding


def law(total, marked, drawn):
    ways = [math.comb(marked, k) * math.comb(total - marked, drawn - k) for k in range(drawn + 1)]
    return np.array(ways) / math.comb(total, drawn)


@pytest.mark.parametrize("total, marked, drawn", [(10, 3, 4), (40, 20, 7), (5, 5, 2), (7, 0, 3), (6, 2, 6), (9, 4, 0)])
def test_hypergeometric_law(spark, total, marked, drawn):
    n = 4_000
    uniform = (F.col("id") + 0.5) / n
    got = spark.range(n).select(
        sharding.hypergeometric(*(F.lit(x).cast("long") for x in (total, marked, drawn)), uniform).alias("k")
    )
    counts = Counter(r.k for r in got.collect())
    wanted = law(total, marked, drawn)
    for k in range(drawn + 1):
        assert abs(counts[k] / n - wanted[k]) <= 1.5 / n


def test_large_draw_has_the_right_moments(spark):
    total, marked, drawn, n = 10_000_000, 1_250_000, 4_000_000, 400
    got = spark.range(n).select(
        sharding.hypergeometric(*(F.lit(x).cast("long") for x in (total, marked, drawn)), (F.col("id") + 0.5) / n).alias("k")
    )
    row = got.agg(F.avg("k").alias("m"), F.stddev("k").alias("s")).first()
    mean = drawn * marked / total
    spread = math.sqrt(mean * (1 - marked / total) * (total - drawn) / (total - 1))
    assert abs(row.m - mean) < 0.05 * spread and abs(row.s / spread - 1) < 0.02


def test_matrix_adds_up(spark):
    counts = spark.createDataFrame([(0, 5), (1, 0), (2, 17), (3, 1), (4, 9)], "part long, rows long")
    rows = sharding.communication_matrix(counts, 3, seed=1).collect()
    assert all(sum(r.shares) == r.rows and min(r.shares) >= 0 for r in rows)
    assert sorted(sum(r.shares[s] for r in rows) for s in range(3)) == [10, 11, 11]


def test_shards_are_uniform(spark):
    """Where a row goes does not depend on its partition or on its neighbours."""
    met = Counter()
    for seed in range(2):
        rows = sharding.shuffle_to_shards(spark.range(0, 384, 1, 3), 4, seed=seed * 10).collect()
        by = {r.id: (r.shard, r.slot) for r in rows}
        assert Counter(s for s, _ in by.values()) == dict.fromkeys(range(4), 96)
        met["same part"] += sum(by[a][0] == by[b][0] for a in range(128) for b in range(a))
        met["other part"] += sum(by[a][0] == by[b][0] for a in range(128) for b in range(128, 256))
    assert met["same part"] / (2 * 8_128) == pytest.approx(95 / 383, abs=0.03)
    assert met["other part"] / (2 * 16_384) == pytest.approx(95 / 383, abs=0.03)


def test_shards_of_awkward_rows(awkward, nothing):
    rows = sharding.shuffle_to_shards(awkward.withColumnRenamed("_text", "_rank"), 3).collect()
    assert len(rows) == awkward.count() and {r._rank for r in rows} == {"clash"}
    for s in range(3):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    assert sharding.shuffle_to_shards(nothing, 3).count() == 0


def test_sharding_stays_in_the_engine(spark, plan):
    text = plan(sharding.shuffle_to_shards(spark.range(10), 2))
    assert "Python" not in text and "Arrow" not in text


# Personal data


def test_base_patterns(awkward):
    texts = [r.text or "" for r in awkward.collect()]
    texts += [
        "a@b a@b.c a@b.c_d@e.f @x.y x@@y.z a.b+c%d@e-f.g.h.", "1.2.3.4.5.6.7 256.1.1.1 1.1.1.01 0001.2.3.4",
        "4111 1111-1111 1111 4111111111111112 4111111111111111 12", "+1 (2) 3-45 67 8 +123456789012345678 ++49 30 123456",
    ]
    for text in texts:
        found = [(k, a, b) for k, a, b, ok in pii.base_matches(text) if ok]
        assert found == brute.base_spans(text) or len(text) > 15_000


def made_stretches():
    rng = np.random.default_rng(5)
    word = lambda: "".join(rng.choice(list("abcdefghij"), rng.integers(2, 7)))
    number = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    kinds = (
        lambda: f"{word()}.{number(2)}@{word()}.example.org", lambda: ".".join(map(str, rng.integers(1, 255, 4))),
        lambda: f"+1 ({number(3)}) 555-{number(4)}", lambda: f"key{number(9)}", lambda: f"in {number(4)}",
    )
    return [f"{word()} {word()} {kinds[k % 5]()} {word()} {word()} {word()}" for k in range(300)]


@pytest.fixture(scope="module")
def network():
    return pii.fit(*pii.labelled_windows(made_stretches()))


def test_gradients():
    rng = np.random.default_rng(1)
    net = pii.Network(*(rng.normal(0, 0.3, s) for s in ((2, 128, 64), (2, 16, 64), (32, 9), (9,), (9, 9), (9,))))
    codes, tags = rng.integers(97, 105, (3, 7)), rng.integers(0, 9, (3, 7))

    def loss(n):
        scores = pii._scores(n, codes)[0]
        rows, at = np.arange(3)[:, None], np.arange(7)
        path = scores[rows, at, tags].sum(1) + n.first[tags[:, 0]] + n.moves[tags[:, :-1], tags[:, 1:]].sum(1)
        return (pii._forward_backward(scores, n.moves, n.first)[3] - path).mean()

    grads = pii._gradients(net, codes, tags)
    for k, at in ((0, (0, 99, 5)), (0, (1, 98, 40)), (1, (0, 3, 20)), (1, (1, 4, 50)), (2, (7, 3)), (3, (2,)), (4, (1, 2))):
        step = [v.copy() for v in net]
        step[k][at] += 1e-5
        up = loss(pii.Network(*step))
        step[k][at] -= 2e-5
        assert (up - loss(pii.Network(*step))) / 2e-5 == pytest.approx(grads[k][at], rel=1e-3, abs=1e-7)


def test_network_adds_what_the_patterns_miss(network):
    texts = ["call me at (274) 555-2202 or so", "nothing here but words", "key123456789 in 1999", "mail abc.12 @ def.example.org today"]
    spans = pii.personal_spans(network, texts)
    assert [(k, texts[0][a:b]) for k, a, b, _ in spans[0]] == [("phone", "(274) 555-2202")]
    assert spans[1] == [] and spans[2] == []
    assert any(k == "email" and not base for k, _, _, base in spans[3])


def with_cards():
    """The made stretches, and as many with cards: most numbers of the kind pass, some fail."""
    rng = np.random.default_rng(7)
    rows = made_stretches()
    for k in range(90):
        digits = "4" + "".join(map(str, rng.integers(0, 10, 14)))
        digits = next(f"{digits}{c}" for c in range(10) if pii.luhn(f"{digits}{c}"))
        groups = [digits[at : at + 4] for at in range(0, 16, 4)]
        rows.append(f"paid by {('', ' ', '-')[k % 3].join(groups)} in the shop {rng.choice(['today', 'late'])}")
    return rows


def test_failed_matches_of_other_kinds_block_nothing():
    net = pii.fit(*pii.labelled_windows(with_cards()))
    wanted = [
        ("card", "4111.1111.1111.1111"), ("card", "378282246310005"), ("card", "3782 822463 10005"),
        ("phone", "020 7946 0958"), ("phone", "1-555-123-4567"), ("ip", "10[.]20[.]30[.]255"),
    ]
    texts = [f"paid by {value} in the shop today" for _, value in wanted]
    found = pii.personal_spans(net, texts)
    assert [[(k, t[a:b]) for k, a, b, _ in own] for t, own in zip(texts, found, strict=True)] == [[w] for w in wanted]
    # What fails as a whole card stays rejected, and no span is cut out of a longer number.
    for value in ("4111 1111 1111 1112", "4111111111111112", "41111111111111111111", "378282246310006"):
        assert not any(k == "card" for k, *_ in pii.personal_spans(net, [f"paid by {value} in the shop today"])[0])


def test_harmless_numbers_are_left_alone(monkeypatch):
    """Dates, ranges of years and book numbers never become phones, whatever the network says."""
    harmless = [
        "2024-03-15", "15.03.2024", "3/15/1998", "1998-2009", "1998 - 2009", "978-3-16-148410-0", "9783161484100",
        "2024-03-15 12:30", "15.03.24",
    ]
    for value in harmless:
        text = f"seen {value} there"
        assert pii._edges("phone", text, 5, 5 + len(value)) is None
    for value in ("020 7946 0958", "1-555-123-4567", "(212) 555-1234", "978-3-16-148410-1"):
        assert pii._edges("phone", f"seen {value} there", 5, 5 + len(value))


def test_harmless_forms_hold_no_base_span():
    for k, stretch in enumerate(with_cards()):
        spans = [(kind, a, b) for kind, a, b, ok in pii._settled(pii.base_matches(stretch)) if ok]
        text, places = pii._harmless(stretch, spans, k % 5)
        assert len(places) == len(spans) and (not spans or text != stretch)
        assert not any(ok for _, _, _, ok in pii.base_matches(text))


def test_what_blocks_an_added_span(monkeypatch):
    text = "a 4111.1111.1111.1111 b 10.0.0.255 c 4111 1111 1111 1112 d +1 23 e"
    at = lambda value: (text.index(value), text.index(value) + len(value))
    added = [
        ("card", *at("4111.1111.1111.1111")), ("phone", *at("10.0.0.255")), ("card", *at("1111 1111 1112")),
        ("phone", *at("+1 23")),
    ]
    monkeypatch.setattr(pii, "decode", lambda net, texts: [added])
    spans = pii.personal_spans(True, [text])[0]
    assert spans == [("ip", *at("10.0.0.255"), True), ("card", *at("4111.1111.1111.1111"), False)]


def test_rare_kinds_are_learned(spark, monkeypatch):
    """One stretch in a hundred holds a span; the sample has all kinds nonetheless."""
    made = [s for s in made_stretches() if any(m[3] for m in pii.base_matches(s))]
    rows = [(k, made[k // 100] if k % 100 == 0 else f"in the year {k} it cost {k * 7} or so") for k in range(10_000)]
    seen = []
    monkeypatch.setattr(pii, "fit", lambda windows, tags: seen.append((windows, tags)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    pii.train(df, stretches=40, without=20)
    pii.train(df.repartition(3), stretches=40, without=20)
    (windows, tags), again = seen
    assert {pii.KINDS[(t - 1) // 2] for t in set(tags.ravel()) - {0}} == {"email", "ip", "phone"}
    assert (windows == again[0]).all() and (tags == again[1]).all()
    # Ten stretches of each kind in four forms, and twenty without a span in one.
    assert len(windows) <= (30 * (1 + pii.FORMS + pii.HARMLESS) + 20) * 5


def test_windows_agree_over_a_long_text(network):
    one = "call me at (274) 555-2202 or so and then " + "some other words " * 9
    text = one * 100
    spans = pii.personal_spans(network, [text])[0]
    assert len(spans) >= 95
    assert {(k, text[a:b]) for k, a, b, _ in spans} == {("phone", "(274) 555-2202")}


def test_personal_data_of_awkward_rows(awkward, nothing):
    net = pii.train(awkward)
    rows = pii.find_personal_data(awkward, net, redact="clean").collect()
    assert len(rows) == awkward.count()
    for r in rows:
        spans = [(s.kind, s.start, s.end) for s in r.spans]
        base = [(s.kind, s.start, s.end) for s in r.spans if s.base]
        assert base == brute.base_spans(r.text) or len(r.text) > 15_000
        assert spans == sorted(spans, key=lambda s: (pii.KINDS.index(s[0]), s[1]))
        assert (r.clean is None) == (r.text is None) and r._text == "clash"
    marked = next(r for r in rows if r.doc_id == 18)
    assert marked.clean == "mail [EMAIL] or [PHONE] from [IP] card [CARD]"
    assert pii.train(nothing) is None
    assert pii.find_personal_data(nothing, None).count() == 0


# Vectors


def test_near_vectors_of_awkward_rows(make_vectors):
    rng = np.random.default_rng(2)
    base = rng.normal(size=16)
    rows = [(i, (base + rng.normal(size=16) * 0.2).tolist()) for i in range(150)]
    rows += [(200 + i, rng.normal(size=16).tolist()) for i in range(150)]
    rows += [(400 + i, rows[3][1]) for i in range(60)]
    rows += [
        (500, None), (501, []), (502, [0.0] * 16), (503, [math.nan] * 16), (504, [math.inf] * 16), (505, [None] * 16),
        (506, [1.0, 2.0]), (507, [2.0, 4.0]), (508, [1e-30] * 16), (509, [3e30] * 16), (510, [-1.0, -2.0]),
    ]
    df = make_vectors(rows).withColumnRenamed("label", "component_id")
    links = brute.vector_links([(i, None if v is None else [x if x is None else float(np.float32(x)) for x in v]) for i, v in rows])
    component = brute.linked([i for i, _ in rows], links)
    count = Counter(i for pair in links for i in pair)
    for r in vectors.near_vectors(df).collect():
        # Hashing may miss a link at the threshold itself, never invent one.
        assert r.n_links <= count[r.vec_id] and r.n_links >= 0.9 * count[r.vec_id]
        assert (r.component_id, r.kept) == (component[r.vec_id], component[r.vec_id] == r.vec_id)
    assert vectors.near_vectors(make_vectors([])).count() == 0


def test_large_buckets_are_tiled(make_vectors, monkeypatch):
    monkeypatch.setattr("contrail.llm.tiles.TILE_ROWS", 40)
    monkeypatch.setattr("contrail.llm.vectors.tiled", lambda m, k, i: __import__("contrail.llm.tiles", fromlist=["x"]).tiled(m, k, i, 40))
    rng = np.random.default_rng(3)
    base = rng.normal(size=8)
    rows = [(i, (base + rng.normal(size=8) * 0.02).tolist()) for i in range(300)]
    found = vectors.near_vectors(make_vectors(rows)).collect()
    assert {(r.n_links, r.component_id) for r in found} == {(299, 0)}


def test_top_k_of_awkward_rows(make_vectors):
    rows = [(i, [float(i % 3), 1.0, -0.01]) for i in range(60)]
    rows += [(60, None), (80, [math.nan, 1.0, 1.0]), (100, [1.0, 2.0]), (101, [2.0, 2.0]), (120, [3e38, 3e38, 0.0]), (None, [1.0, 1.0, 1.0])]
    got = defaultdict(list)
    for r in topk.top_k(make_vectors(rows), F.col("vec_id") % 20 == 0, 5, 64.0).orderBy("query_id", "rank").collect():
        assert r.rank == len(got[r.query_id]) + 1
        got[r.query_id].append((r.vec_id, r.score))
    whole = {i: [math.floor(64 * float(np.float32(x))) for x in v] for i, v in rows if i is not None and v and not any(map(math.isnan, v))}
    for q in whole:
        if q % 20 == 0:
            scores = [
                (-min(sum(x * y for x, y in zip(whole[q], v, strict=True)), 2**63 - 1), i)
                for i, v in whole.items() if i != q and len(v) == len(whole[q])
            ]
            assert got[q] == [(i, -s) for s, i in sorted(scores)[:5]]
    assert set(got) == {0, 20, 40, 100, 120}
    assert topk.top_k(make_vectors([]), F.col("vec_id") % 20 == 0, 5, 64.0).count() == 0


# Components


def test_components(spark):
    rng = np.random.default_rng(4)
    pairs = [(i, i + 1) for i in range(0, 300)] + [(1_000, 1_000 + i) for i in range(1, 200)]
    pairs += [tuple(map(int, rng.integers(2_000, 2_400, 2))) for _ in range(250)] + [(7, 7), (1, 0)]
    df = spark.createDataFrame([*pairs, (None, 3)], "a long, b long")
    nodes = {i for a, b in pairs if a != b for i in (a, b)}
    wanted = brute.linked(nodes, [p for p in pairs if p[0] != p[1]])
    assert {r.node: r.component for r in components(df).collect()} == wanted
    assert components(df.limit(0)).count() == 0


# Language model


def test_scores_of_awkward_rows(awkward, nothing):
    rows = awkward.collect()
    got = language_model.score_documents(awkward.withColumnRenamed("lang", "score")).collect()
    plain = brute.base_scores([(r.doc_id, r.text) for r in rows])
    assert len(got) == len(rows)
    for r in got:
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == plain[r.doc_id][:4]
        assert r.base_score == pytest.approx(plain[r.doc_id][4]) and math.isfinite(r.score)
    assert language_model.score_documents(nothing).count() == 0


def test_interpolation_is_a_distribution(spark):
    """Over all continuations of a context the mixture adds up to 1 (unknown words share one part)."""
    pair, context, word = np.array([3, 1, 0, 0]), np.array([4, 4, 4, 4]), np.array([5, 2, 3, 0])
    weights = np.array([0.5, 0.3, 0.2])
    mixed = (language_model._estimates(pair, context, word, 10, 3).T * weights).sum(axis=1)
    assert mixed.sum() == pytest.approx(1)


def test_keys_survive_squeezing():
    keys = np.unique(np.random.default_rng(1).integers(0, 2**64, 1_000, dtype=np.uint64))
    assert (language_model.unsqueeze(language_model.squeeze(keys)) == keys).all()
    counts = np.array([0, 1, 255, 256, 2**31])
    assert (language_model._long(language_model._short(counts)) == counts).all()


# Language


def test_language_of_awkward_rows(spark, awkward, nothing):
    rows = language_id.identify(awkward, language_id.train(awkward)).collect()
    assert len(rows) == awkward.count()
    for r in rows:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters) and 0 <= r.score <= 1
        assert not (r.lang_pred == "und") or r.rejected
    none = language_id.train(nothing)
    assert none.languages == []
    assert {r.lang_pred for r in language_id.identify(awkward, none).collect()} == {"und"}
    assert language_id.identify(nothing, none).count() == 0


def test_signs_that_are_no_letters():
    assert language_id.words("²½ Ⅷ ① x² aⅧb 12 _ é") == "x a b é".encode()
    model = language_id.Model(["de", "en"], [b"der die das " * 50, b"the of and " * 50])
    assert language_id._Sizes(model).best("²½ Ⅷ①")[0] == language_id.UNDECIDED


@pytest.mark.parametrize("size", [1, 200, 510, 511, 512, 513, 520, 1_023, 1_024, 1_030])
def test_no_switch_at_the_size_of_a_block(size):
    """Texts just below, at and above whole blocks are judged alike."""
    rng = np.random.default_rng(2)
    words = {"xx": ["abra", "kadabra", "simsala"], "yy": ["lorem", "ipsum", "dolor"]}
    prose = {n: " ".join(rng.choice(w, 3_000)) for n, w in words.items()}
    model = language_id.Model(["xx", "yy"], [prose[n][:8_000].encode() for n in ("xx", "yy")])
    sizes = language_id._Sizes(model)
    for name, text in prose.items():
        found, score, margin = sizes.best(text[-max(size, 9):])
        assert found == name and score > 0.5 and margin > language_id.MARGIN


def test_all_documents_of_the_sample_enter_the_dictionary(spark):
    rows = [(i, f"{'abcdefghij'[i // 10]}{'abcdefghij'[i % 10]}q " * 400, "xx") for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.train(df.repartition(5), sample_docs=60)
    found = {w[:2] for w in model.contents[0].decode().split() if len(w) == 3}
    assert len(found) == 60 and len(model.contents[0]) <= language_id.DICTIONARY_BYTES
    assert language_id.train(df.repartition(2), sample_docs=60) == model


def test_language_of_short_texts(spark):
    """Texts of 10 to 100 bytes, of words that only their language has, and of its letters."""
    rng = np.random.default_rng(8)
    parts = {
        "de": ["sch", "ung", "der", "heit", "ein", "chen", "ber"], "en": ["the", "ing", "tion", "wh", "ough", "ly", "ed"],
        "es": ["ción", "ado", "que", "los", "mente", "rra", "illo"], "fr": ["eau", "oux", "ment", "que", "elle", "aux", "oir"],
    }
    vocabulary = {n: ["".join(rng.choice(p, rng.integers(1, 4))) for _ in range(150)] for n, p in parts.items()}
    text = lambda n, k: " ".join(rng.choice(vocabulary[n], k))
    rows = [(i, text(n, 120), n) for i, n in enumerate(sorted(parts) * 40)]
    model = language_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    sizes = language_id._Sizes(model)
    for least, share in ((10, 0.6), (20, 0.9), (40, 0.97), (70, 0.97), (100, 0.97)):
        for n in parts:
            found = []
            for _ in range(60):
                words = text(n, 40).split()
                short = words[0]
                while len(short.encode()) < least:
                    short += " " + words.pop()
                best, _, margin = sizes.best(short)
                found.append(best == n and margin >= language_id.MARGIN)
            assert sum(found) >= share * len(found), (n, least, sum(found))


# Near copies


def test_signatures_estimate_weighted_similarity():
    a = Counter({f"s{i}": 1 + i % 4 for i in range(300)})
    b = Counter({f"s{i}": 1 + (i + i % 7 // 6) % 4 for i in range(60, 340)})
    keys = {s: k for k, s in enumerate(a | b)}
    value = np.random.default_rng(1).integers(0, 2**63, len(keys)).astype(np.uint64)
    row = np.concatenate([np.zeros(len(a), int), np.ones(len(b), int)])
    count = np.array([*a.values(), *b.values()])
    marks = minhash.signatures(row, value[[keys[s] for s in [*a, *b]]], count, 2, 20_000)
    assert (marks[0] == marks[1]).mean() == pytest.approx(brute.similarity(a, b), abs=0.012)


def test_horizon_changes_nothing():
    """A text has the same signature alone and among others."""
    texts = ["a b c d e f g h " * 5, "one two", "x y z " * 400]
    together = minhash.signatures(*minhash.shingles(texts), 3)
    for k, t in enumerate(texts):
        assert (minhash.signatures(*minhash.shingles([t]), 1)[0] == together[k]).all()


def test_shingles():
    texts = ["", "a", "a b c d e", "A b c d e f a b c d e", " \n"]
    row, _, count = minhash.shingles(texts)
    for k, t in enumerate(texts):
        assert sorted(count[row == k].tolist()) == sorted(brute.shingle_counts(t).values())


def near_rows(copies, seed=6):
    """A text, copies of it with a few words changed, and others that share a passage."""
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(5_000)]
    text = rng.choice(vocabulary, 200).tolist()
    rows = []
    for _ in range(copies):
        own = list(text)
        for at in rng.choice(200, rng.integers(1, 6), replace=False):
            own[at] = rng.choice(vocabulary)
        rows.append(" ".join(own))
    passage = rng.choice(vocabulary, 60).tolist()
    rows += [" ".join([*passage, *rng.choice(vocabulary, 90)]) for _ in range(60)]
    return rows


def test_near_documents_in_a_large_group(spark):
    rows = list(enumerate(near_rows(120)))
    found = minhash.near_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    wanted = brute.linked([i for i, _ in rows], brute.document_links(rows))
    assert {r.doc_id: r.component_id for r in found} == wanted


def test_near_documents_of_awkward_rows(awkward, nothing):
    unique = awkward.dropDuplicates(["doc_id"])
    rows = [(r.doc_id, r.text) for r in unique.collect()]
    wanted = brute.linked([i for i, _ in rows], brute.document_links(rows))
    got = minhash.near_documents(awkward).collect()
    assert len(got) == awkward.count()
    assert {r.doc_id: r.component_id for r in got} == wanted
    assert minhash.near_documents(nothing).count() == 0


def test_pipeline_keeps_one_row_of_an_id_and_rows_without_one(spark):
    import corpus_pipeline

    prose = "the quick brown fox jumps over the lazy dog and runs on and on until it sleeps "
    rows = [(1, prose, "b"), (1, prose, "a"), (2, prose, "a"), (3, "something else altogether is written here now", "a"), (3, "and a second one under the very same id", "a")]
    rows += [(None, prose, "a"), (None, prose, "b"), (None, "no name but words", "a"), (None, None, "a"), (4, None, "a"), (5, "", "a")]
    docs = spark.createDataFrame([(i, t, "en", s, 0) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = sorted(((r.doc_id, r.text, r.source) for r in corpus_pipeline.keep_one_of_each(spark, docs, "").collect()), key=repr)
    assert [(i, s) for i, t, s in kept if t == prose] == [(1, "a"), (None, "a")]
    assert [t for i, t, _ in kept if i == 3] == ["and a second one under the very same id"]
    assert sum(i is None for i, *_ in kept) == 3 and {t for i, t, _ in kept if i is None} == {prose, "no name but words", None}
    assert len([i for i, t, _ in kept if i in (4, 5)]) in (1, 2)
    assert corpus_pipeline.keep_one_of_each(spark, docs.limit(0), "").count() == 0


def test_counts_of_a_range_are_added_slice_by_slice(spark, monkeypatch):
    """op6: the same answers however few keys are sorted at once, and words read in parts."""
    import numpy as np

    from contrail.llm import language_model as lm

    rng = np.random.default_rng(5)
    keys = [np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64)) for n in (1, 300, 700)]
    keys.append(np.unique(np.concatenate([keys[1][:50], keys[2][100:]])))
    keys.append(np.array([(1 << 64) - 1], np.uint64))
    monkeypatch.setattr(lm, "SLICE_KEYS", 64)
    seen = [[k[p] for k, p in zip(keys, places)] for places in lm._slices(keys)]
    assert len(seen) > 10 and all((np.concatenate([s[i] for s in seen]) == keys[i]).all() for i in range(len(keys)))
    ranges = [np.concatenate(s) for s in seen if sum(map(len, s))]
    assert all(a.max() < b.min() for a, b in zip(ranges, ranges[1:]))
    texts = [b"", b"One two ONE", "\u00e9t\u00e9 two".encode(), b" ", b"three " * 40]
    whole = lm.Tokens(texts)
    monkeypatch.setattr(lm, "WORDS_BYTES", 4)
    parts = lm.Tokens(texts)
    for name in ("lengths", "words", "word", "context", "pairs", "pair"):
        assert (getattr(whole, name) == getattr(parts, name)).all()
