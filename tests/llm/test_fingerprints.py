import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from grantledger.llm import fingerprints as S
from tests.llm.conftest import ODD


def bits(a, b):
    return ((a ^ b) & (2**64 - 1)).bit_count()


def test_votes_of_weighted_terms(spark, docs_of):
    rng = random.Random(0)
    rows = [(i, " ".join(rng.choices([f"w{j}" for j in range(50)], k=rng.randrange(60)))) for i in range(40)]
    got = {r.doc_id: r.fingerprint for r in S.simhash(docs_of(rows), "doc_id").collect()}
    words = spark.range(50).select(F.concat(F.lit("w"), "id").alias("w"))
    hashes = {r.w: r.h & (2**64 - 1) for r in words.select("w", F.xxhash64("w").alias("h")).collect()}
    for doc, text in rows:
        votes = Counter(text.split())
        want = sum(1 << b for b in range(64) if sum(n if hashes[w] >> b & 1 else -n for w, n in votes.items()) > 0)
        assert got[doc] & (2**64 - 1) == want


def test_odd_texts(docs_of):
    docs = docs_of([(i, text) for i, (_, text) in enumerate(ODD)], word=1, fingerprint="x")
    got = {r.doc_id: r.fingerprint for r in S.simhash(docs, "doc_id").collect()}
    assert len(got) == len(ODD) and [got[i] for i in (0, 1, 2, 7)] == [0, 0, 0, 0]
    assert got[3] == got[4] == got[5] != 0
    assert S.simhash(docs.where("false"), "doc_id").count() == 0


def test_one_word_moves_few_bits(docs_of):
    words = [f"term{i}" for i in range(400)]
    docs = docs_of([(1, " ".join(words)), (2, " ".join([*words[:-1], "other"])), (3, " ".join(f"far{i}" for i in range(400)))])
    got = {r.doc_id: r.fingerprint for r in S.simhash(docs, "doc_id").collect()}
    assert bits(got[1], got[2]) <= 8 < 16 <= bits(got[1], got[3])


@pytest.mark.parametrize("radius", [0, 1, 3, 6])
@pytest.mark.parametrize("count", [2, 10**5, 10**11])
def test_tables_cover_every_way_to_differ(radius, count):
    masks = [m & (2**64 - 1) for m in S.block_tables(count, radius)]
    rng = random.Random(radius)
    for _ in range(300):
        differ = sum(1 << b for b in rng.sample(range(64), radius))
        assert any(differ & m == 0 for m in masks)


def test_search_matches_all_pairs(spark):
    rng = random.Random(1)
    seeds = [rng.getrandbits(64) for _ in range(20)]
    marks = seeds + [s ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(6))) for s in seeds for _ in range(15)]
    signed = [m - 2**64 if m >= 2**63 else m for m in marks]
    df = spark.createDataFrame([(m, "x") for m in [*signed, None]], "fingerprint long, query string")
    asked = df.where(F.col("fingerprint").isNull() | (F.abs(F.col("fingerprint")) % 3 == 0))
    got = {(r["query"], r.fingerprint): r.distance for r in S.near(asked.select("fingerprint"), df).collect()}
    wanted = {m for m in signed if abs(m) % 3 == 0}
    want = {(a, b): bits(a, b) for a, b in itertools.product(wanted, set(signed)) if bits(a, b) <= S.RADIUS}
    assert got == want
    assert S.near(asked, df.where("false")).count() == 0


def test_edited_texts_borrow_from_the_next_document(docs_of):
    rows = [*ODD, (8, "日本語テキスト"), (20, "odd"), (21, "x")]
    got = {(r.doc_id, r.text, r.copies): r for r in S.with_edited(docs_of(rows)).collect()}
    counts = Counter((doc, text or "") for doc, text in rows)
    assert set(got) == {(doc, text, n) for (doc, text), n in counts.items()}
    by_key = {(r["__k"], r["__k2"]): r for r in got.values()}
    ring, at = [], next(iter(got.values()))
    while not ring or at is not ring[0]:
        ring.append(at)
        at = by_key[at["__next"], at["__next2"]]
    assert len(ring) == len(got)
    start = ring.index(next(r for r in ring if r.doc_id == 21))
    ring = ring[start:] + ring[:start]
    ids = [r.doc_id for r in ring]
    assert ids == [21, 20, 8, 7, 6, 5, 4, 3, 2, 1, None, None]
    for r, following in zip(ring, ring[1:] + ring[:1], strict=True):
        half = len(r.text) // 2
        assert r.edited == r.text[: len(r.text) - half] + following.text[:half]
    assert S.with_edited(docs_of(ODD).where("false")).count() == 0
    alone = S.with_edited(docs_of([(1, "abcd")])).first()
    assert alone.edited == "abab"
