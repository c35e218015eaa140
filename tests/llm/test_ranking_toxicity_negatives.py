"""Ranked search, toxicity and hard negatives on made rows, against plain versions."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from contrail.llm import hard_negatives, toxicity, treap_search

# Ranked search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def ranked(documents, items, k):
    """Rows of every item by scoring every document."""
    whole = [(i, Counter(terms(t))) for i, t in documents]
    whole = [(i, c, sum(c.values())) for i, c in whole if c]
    n_docs, n_terms = len(whole), sum(n for *_, n in whole)
    df = Counter(t for _, c, _ in whole for t in c)
    asked = defaultdict(set)
    for i, t in items:
        if i is not None:
            asked[i].update(terms(t))
    rows = []
    for item, some in asked.items():
        scores = []
        for i, c, n in whole:
            m = 50 + 50 * n * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in some if t in c)
            if s > 0 and i is not None:
                scores.append((-s, i))
        rows += [(item, r, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(rows)


def test_tree_holds_every_cell():
    rng = np.random.default_rng(1)
    cells = np.unique(rng.integers(0, [700, 90], (4_000, 2)), axis=0)
    impacts = rng.integers(0, 10**6, len(cells))
    tree = treap_search.Tree.open(*treap_search.build_tree(cells[:, 0], cells[:, 1], impacts))
    assert tree.height == 10 and tree.best[0] == impacts.max()
    for (row, column), impact in zip(cells.tolist(), impacts.tolist(), strict=True):
        node = 0
        for bit in reversed(range(tree.height)):
            quadrant = (row >> bit & 1) * 2 + (column >> bit & 1)
            assert tree.masks[node] >> quadrant & 1 and tree.best[node] >= impact
            node = tree.first[node] + treap_search._BEFORE[tree.masks[node], quadrant]
        assert tree.best[node] == impact
    nothing = treap_search.build_tree(*[np.zeros(0, np.int64)] * 3)
    assert not len(treap_search.Tree.open(*nothing).best)


@pytest.mark.parametrize(("block", "opened", "groups"), [(7, 2, 3), (64, 5, 256), (4_096, 64, 256)])
def test_search_equals_scoring_every_document(spark, monkeypatch, block, opened, groups):
    """Small blocks, few open ranges, several groups of items, with and without a broadcast."""
    monkeypatch.setattr(treap_search, "GROUP_ITEMS", groups)
    monkeypatch.setattr(treap_search, "BROADCAST_BYTES", 0 if block == 7 else 1 << 20)
    rng = np.random.default_rng(block)
    words = np.array([f"w{i}" for i in range(120)])
    odds = 1 / np.arange(1, 121)
    text = lambda n: " ".join(rng.choice(words, n, p=odds / odds.sum()))
    documents = [(int(i), text(rng.integers(0, 60))) for i in rng.permutation(300)]
    documents += [(500 + i, documents[3][1]) for i in range(80)]
    items = [(i, text(rng.integers(0, 25))) for i in range(10)] + [(3, "w1 w1 w119"), (40, documents[3][1])]
    df = spark.createDataFrame(documents, "doc_id long, text string").repartition(3)
    treap_search.prepare(spark, 128)
    n_docs, n_terms = treap_search.statistics(df)
    asked = treap_search._asked(spark.createDataFrame(items, "item_id long, text string"), "item_id", "text")
    index = small_blocks(df, block, n_docs, n_terms)
    best = treap_search.search(index, asked, n_docs, 15).collect()
    assert sorted(map(tuple, best)) == ranked(documents, items, 15)


def small_blocks(df, block, n_docs, n_terms):
    """The index with blocks of ``block`` documents; the limit reaches the workers this way."""

    def run(batches):
        treap_search.BLOCK_DOCS = block
        yield from build(batches)

    class Grab:
        def select(self, *_):
            return self

        def mapInArrow(self, function, _):
            return function

    build = treap_search.build_index(Grab(), n_docs, n_terms)
    return df.select("doc_id", "text").mapInArrow(run, treap_search.INDEX)


def test_search_of_awkward_rows(spark, awkward, nothing):
    documents = awkward.unionByName(awkward.limit(0)).unionByName(
        spark.createDataFrame([(None, "quick fox", "en", None, 9, "", 1, None), (7, "été ÉTÉ İ_a[b", "fr", None, 9, "", 1, None)], awkward.schema)
    )
    items = [(1, "The quick FOX jumps. été"), (2, None), (3, ""), (None, "fox"), (4, "x" * 50_000), (5, "not there"), (1, "日本語 🙂"), (6, "1 a")]
    df = spark.createDataFrame([(i, t, 1, "clash") for i, t in items], "item_id long, text string, rank int, term string")
    got = treap_search.rank_documents(documents, df, 8)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    plain = ranked([(r.doc_id, r.text) for r in documents.collect()], items, 8)
    assert sorted(map(tuple, got.collect())) == plain
    assert treap_search.rank_documents(nothing, df, 8).count() == 0
    assert treap_search.rank_documents(documents, df.limit(0), 8).count() == 0


# Toxicity


@pytest.mark.parametrize(
    ("text", "folded"),
    [
        ("", "  "), (" \n", "  "), ("Idiot", " idiot "), ("1D10T!", " idiot "), ("m0r0n, $cum", " moron scum "),
        ("іdіоt", " idiot "), ("ｉｄｉöｔ", " idiot "), ("w0rthle$$", " worthiess "), ("in 2024: 100%", " in 2024 100 "),
        ("DE!! x|y !", " de xiy "), ("a_b", " a b "), ("loser", " ioser "), ("ioser", " ioser "),
    ],
)
def test_folding(text, folded):
    assert toxicity.fold(text) == folded


def test_longest_entries_and_exceptions():
    lexicon = toxicity.Lexicon({" idiot": 5.0, " moron ": 4.0, " idiotic ": 1.0}, (" no moron ", " idiot box "))
    found = lambda text: dict(lexicon.matches(toxicity.fold(text)))
    assert found("Idiots, idiotic morons; a moron") == {" idiot": 1, " idiotic ": 1, " moron ": 1}
    assert found("no moron, but: moron") == {" moron ": 1}
    assert found("an idiot box is no idiot") == {" idiot": 1}
    assert found("") == found("antiidiot") == {}
    assert toxicity.Lexicon({}).score(0.0, 0) < 0.5


def made_documents(n):
    """Prose with insults: whole words, words of one stem, disguised ones; harmless phrases."""
    rng = np.random.default_rng(5)
    words = [f"{a}{b}{c}" for a in ("ba", "de", "ko", "mi", "su") for b in ("ra", "lo", "ti") for c in ("n", "s", "ma", "ren")]
    rows = []
    for i in range(n):
        text = list(rng.choice(words, int(rng.integers(4, 200))))
        toxic = i % 4 == 0
        for _ in range(2 if toxic else 0):
            insult = rng.choice(["gromblat", "GR0MBLAT", "grοmblat", "vexu" + "".join(rng.choice(list("abcd"), 3))])
            text.insert(int(rng.integers(0, len(text))), str(insult))
        if i % 24 == 1:
            text.insert(int(rng.integers(0, len(text))), "plush gromblat")
        rows.append((i, " ".join(text), int(toxic)))
    return rows


def test_learned_lexicon_on_held_out_documents(spark):
    rows = made_documents(1_200)
    documents = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows if r[0] % 3], "doc_id long, toxic int")
    lexicon = toxicity.train(documents, labels, sample_docs=500)
    assert any(e.startswith(" grombi") for e in lexicon.weights) and any(e.startswith(" vexu") for e in lexicon.weights)
    assert " piush grombiat " in lexicon.exceptions
    scored = {r.doc_id: r for r in toxicity.score_documents(documents, lexicon).collect()}
    wrong = [i for i, _, toxic in rows if i % 3 == 0 and (scored[i].score >= 0.5) != bool(toxic)]
    assert len(wrong) <= 4
    assert all(0 <= r.score <= 1 for r in scored.values())
    one = scored[0]
    assert one.weight == pytest.approx(sum(m.weight * m.times for m in one.matches)) and one.words == len(rows[0][1].split())


def test_toxicity_of_awkward_rows(spark, awkward, nothing):
    labels = spark.createDataFrame([(4, 1), (4, 0), (5, 0), (None, 1), (6, None), (100, 0), (0, 1), (999, 1)], "doc_id long, toxic int")
    documents = awkward.unionByName(spark.createDataFrame([(None, "a", None, None, 1, "", 1, None)], awkward.schema))
    lexicon = toxicity.train(documents, labels)
    rows = toxicity.score_documents(documents, lexicon).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in documents.select("doc_id").collect())
    assert {r.words for r in rows if r.doc_id in (0, 1, 2, 3)} == {0} and all(0 <= r.score <= 1 for r in rows)
    for some, known in ((nothing, labels), (documents, labels.limit(0)), (documents, labels.filter("toxic = 0"))):
        empty = toxicity.train(some, known)
        assert not empty.weights and toxicity.score_documents(nothing, empty).count() == 0
        assert all(r.score < 0.5 for r in toxicity.score_documents(documents, empty).collect())


# Hard negatives


@pytest.mark.parametrize("shape", [(1, 1, 1), (33, 64, 100), (65, 67, 129), (3, 500, 7), (128, 40, 36)])
def test_recursive_products(shape):
    m, k, n = shape
    rng = np.random.default_rng(k)
    for top in (300, 2**30, 2**62):
        a, b = rng.integers(-top, top, (m, k)), rng.integers(-top, top, (n, k))
        # Modulo 2^64 where the sums run over, just as the plain product.
        assert (hard_negatives.strassen(a, b.T) == a @ b.T).all()
    huge = a.astype(object) * 10**20
    assert (hard_negatives.strassen(huge, b.T.astype(object)) == huge @ b.T.astype(object)).all()
    wanted = np.array([[min(max(int(x), -(2**63)), 2**63 - 1) for x in r] for r in (a.astype(object) @ b.T.astype(object)).tolist()])
    assert (hard_negatives.products(a, b) == wanted).all()


def test_windows_are_exact():
    for p in [*range(-205, 205), 2**63 - 1, 2**62 + 7]:
        low, high = (int(x) for x in hard_negatives.window(np.array([p]))) if p < 2**62 else (int(x[0]) for x in hard_negatives.window(np.array([p])))
        assert (low, high) == (math.ceil(p / 2) if abs(p) < 2**50 else (p + 1) // 2, 95 * p // 100)


def mined(rows, every, scale, positives, negatives):
    """Plain scores of every pair."""
    whole = [
        (i, y, [math.floor(scale * float(np.float32(x))) for x in v])
        for i, v, y in rows if i is not None and y is not None and v and all(x is not None and math.isfinite(x) for x in v)
    ]
    result = []
    anchors = {}
    for i, y, v in sorted((r for r in whole if r[0] % every == 0), key=lambda r: (r[0], r[1], r[2])):
        anchors.setdefault(i, (y, v))
    for a, (label, own) in anchors.items():
        scores = [(-min(max(sum(x * z for x, z in zip(own, v, strict=True)), -(2**63)), 2**63 - 1), i, y) for i, y, v in whole if i != a and len(v) == len(own)]
        first = sorted(s for s in scores if s[2] == label)[:positives]
        for p, i, _ in first:
            inside = sorted((s, n) for s, n, y in scores if y != label and 50 * -p <= 100 * -s <= 95 * -p)[:negatives]
            result += [(a, i, r, n, -p, -s) for r, (s, n) in enumerate(inside, 1)]
    return sorted(result)


@pytest.fixture(scope="module")
def vectors(spark):
    from pyspark.sql import types as T

    schema = T.StructType().add("vec_id", "long").add("embedding", T.ArrayType(T.FloatType())).add("label", "integer")
    schema = schema.add("id", "string").add("v", "integer").add("rank", "integer")
    return lambda rows: spark.createDataFrame([(*r, "clash", 1, 2) for r in rows], schema)


def test_negatives_equal_scoring_every_pair(vectors, monkeypatch):
    """Several blocks of each bucket, ties, a label with a third of the rows, repeated rows."""
    monkeypatch.setattr(hard_negatives, "SALT_BLOCKS", 2)
    monkeypatch.setattr(hard_negatives, "GROUP_BLOCKS", 1)
    rng = np.random.default_rng(9)
    rows = [(int(i), np.round(rng.normal(size=6) + 0.4, 1).tolist(), int(rng.integers(0, 9)) if i % 3 else 4) for i in range(700)]
    rows += [(1_000 + i, rows[11][1], i % 5) for i in range(60)] + [rows[12], rows[12]]
    df = vectors(rows).repartition(3)
    monkeypatch.setattr(hard_negatives, "TILE_ROWS", 40)
    got = hard_negatives.hard_negatives(df, F.col("vec_id") % 20 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect())) == mined(rows, 20, 256.0, 5, 3)


def test_negatives_of_awkward_rows(vectors):
    rows = [(i, [1.0 + i % 4, 1.0, float(i % 2)], i % 3) for i in range(40)]
    rows += [(50, None, 1), (60, [math.nan, 1.0], 1), (70, [1.0, None], 1), (80, [], 1), (90, [1.0, 2.0], None), (None, [1.0, 2.0, 1.0], 1)]
    rows += [(100, [2.0, 2.0], 1), (110, [2.0, 1.0], 2), (120, [3e38, 1.0, 0.0], 0), (121, [3e38, 2.0, 0.0], 0), (122, [1e38, 2.0, 0.0], 1)]
    rows += [(130, [-1.0, -1.0, -1.0], 2), (20, [9.0, 9.0, 1.0], 0), (140, [0.0, 0.0, 0.0], 1)]
    got = hard_negatives.hard_negatives(vectors(rows), F.col("vec_id") % 10 == 0, positives=4, negatives=2).collect()
    assert sorted(map(tuple, got)) == mined(rows, 10, 256.0, 4, 2)
    assert hard_negatives.hard_negatives(vectors([]), F.col("vec_id") % 10 == 0).count() == 0
    assert hard_negatives.hard_negatives(vectors(rows), F.lit(False)).count() == 0
    with pytest.raises(ValueError, match="positives"):
        hard_negatives.hard_negatives(vectors(rows), F.lit(True), positives=17)
