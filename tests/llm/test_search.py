import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from grantledger.llm import search as S
from tests.llm.conftest import ODD

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items, best=10):
    words = [(d, terms(t)) for d, t in docs]
    held = [Counter(w) for _, w in words]
    n_docs, n_words = sum(bool(w) for _, w in words), sum(len(w) for _, w in words)
    out = []
    for item, text in sorted(set(items), key=str):
        scores = []
        for (doc, own), counts in zip(words, held, strict=True):
            score = 0
            for term, repeats in Counter(terms(text)).items():
                df = sum(term in c for c in held)
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
                if tf := counts[term]:
                    m = 25 + 75 * len(own) * n_docs // n_words
                    score += repeats * w * (10**9 * tf // (1000 * tf + 8 * m))
            if score > 0:
                scores.append((-score, doc is not None, doc or 0))
        out += [(item, rank, d if known else None, -s) for rank, (s, known, d) in enumerate(sorted(scores)[:best], 1)]
    return sorted(out, key=str)


def rows(found):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in found.collect()), key=str)


def texts(rng, n, vocabulary):
    return "".join(rng.choices(vocabulary, [1 / (i + 1) for i in range(len(vocabulary))], k=n)[i] + rng.choice([" ", ", ", "-", "\n"]) for i in range(n))


VOCABULARY = ["the", "The", "of", "É", "ß", "x9", "日", *(f"w{i}" for i in range(60))]


@pytest.mark.parametrize("settings", [{}, {"BLOCK_WORDS": 30}, {"PLACES": 1, "SET": 1}, {"BOUND_BYTES": 64}, {"SEEDS": 1}])
def test_random_texts(spark, docs_of, settings, monkeypatch):
    rng = random.Random(len(settings) + 3)
    for name, value in settings.items():
        if name != "BLOCK_WORDS":
            monkeypatch.setattr(S, name, value)
    docs = [(i, texts(rng, rng.choice([0, 1, 5, 40, 300]), VOCABULARY)) for i in range(120)]
    docs += [(200 + i, docs[4][1] or "the of w3") for i in range(15)]  # ties
    items = [(i, texts(rng, rng.choice([0, 1, 6, 20]), VOCABULARY)) for i in range(9)] + [(3, "w1 w2 w2"), (3, "w1 w2 w2")]
    bench = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, score int")
    got = S.search(docs_of(docs, score=2, rank=1), bench, block_words=settings.get("BLOCK_WORDS", S.BLOCK_WORDS))
    assert rows(got) == plain(docs, items)


def test_small_blocks(spark, docs_of):
    rng = random.Random(8)
    docs = [(i, texts(rng, rng.choice([3, 30]), VOCABULARY)) for i in range(60)]
    items = [(i, texts(rng, 8, VOCABULARY)) for i in range(4)]
    df = docs_of(docs)
    bench = spark.createDataFrame(items, "item_id long, text string")
    for block_docs, held in ((1, 1), (9, 1 << 20), (1 << 20, 50)):
        got = S.search(df, bench, best=4, signatures=S.index(df, block_docs, held))
        assert rows(got) == plain(docs, items, best=4)


WORDS = st.lists(st.sampled_from(VOCABULARY), max_size=300)


@settings(max_examples=60, deadline=None)
@given(st.lists(WORDS, min_size=1, max_size=20), st.lists(WORDS, min_size=1, max_size=4), st.integers(1, 20))
def test_bounds_are_never_below_scores(docs, items, places):
    before, S.PLACES = S.PLACES, places
    try:
        batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(docs))), "text": [" ".join(d) for d in docs]})
        blocks = list(S._indexer(pa.int64(), 7, 400)(iter([batch])))
        held = [Counter(S.words_of(" ".join(i).encode())) for i in items if i]
        if not held:
            return
        queries = S.Queries([(0, {t: 1000 * n for t, n in c.items()}) for c in held], len(docs), sum(map(len, docs)) or 1)
        seen = []
        for width, ids, n_words, slices in S._blocks(iter(blocks)):
            for lo, bounds in queries.bounds(width, n_words, slices):
                for item in range(len(held)):
                    for column, bound in enumerate(bounds[item]):
                        doc = ids[lo + column]
                        own = S.words_of(" ".join(docs[doc]).encode())
                        assert bound >= queries.score(item, len(own), Counter(own))
            seen += ids
        assert sorted(seen) == [i for i, d in enumerate(docs) if d]
    finally:
        S.PLACES = before


def test_steps_never_understate():
    counts = np.array([*range(1, 5000), 10**6, 10**9])
    steps = S.step_of(counts)
    assert (S.STEPS[steps] <= counts).all() and (S.STEPS[steps + 1] > counts).all()
    assert (S.STEPS[:8] == np.arange(1, 9)).all() and (np.diff(S.STEPS) > 0).all()


def test_lengths_beyond_64_bits():
    queries = S.Queries([(0, {b"a": 1})], 10**12, 10**13)
    assert queries.length_norm(np.array([10**9, 5])).tolist() == [25 + 75 * 10**9 // 10, 25 + 75 * 5 // 10]


def test_odd_rows(spark, docs_of):
    docs = docs_of(ODD, item_id=3, bound="x")
    items = [(None, "one two"), (1, ""), (2, None), (3, "id word 日本"), (4, "!!!"), (4, "naïve")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert rows(S.search(docs, bench)) == plain([(d, t) for d, t in ODD], [i for i in items if i[1] is not None])
    assert S.search(docs.where("false"), bench).count() == 0
    assert S.search(docs, bench.where("false")).count() == 0


def test_only_what_may_reach_the_results_is_scored(spark, docs_of):
    """The bounds exclude nearly all documents where few fit."""
    rng = random.Random(5)
    docs = [(i, texts(rng, 60, [f"z{j}" for j in range(400)]) + (f" rare{i % 40}" if i < 400 else "")) for i in range(2000)]
    df = docs_of(docs)
    signatures = S.index(df)
    queries = S.Queries([(0, {b"rare7": 5000, b"z1": 100})], 2000, sum(len(terms(t)) for _, t in docs))
    shared = spark.sparkContext.broadcast(queries)
    needed = spark.sparkContext.broadcast([5000 * 300_000])
    reached = signatures.mapInArrow(S._reaching(shared, needed, pa.int64()), "item int, doc_id long, bound long").count()
    assert 10 <= reached <= 60
