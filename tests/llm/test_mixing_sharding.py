import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from corpus_pipeline import sharding_stage
from grantledger.llm import mixing, ranking, sharding
from grantledger.llm.common import WORD, whole_text
from tests.llm.conftest import ODD

def size():
    return F.regexp_count(whole_text(), F.lit(WORD))


def shared_out(sizes, weights, most=3):
    """Clamp and share again until nobody is above."""
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[s] for s in full)
        open_ = sum(w for s, w in weights.items() if s not in full)
        more = {s for s in sizes if s not in full and most * sizes[s] < rest * weights[s] / open_}
        if not more:
            return {s: most * sizes[s] if s in full else rest * weights[s] / open_ for s in sizes}
        full |= more


@pytest.mark.parametrize("seed", range(4))
def test_targets_and_taken_words_match_plain_filling(spark, docs_of, seed):
    rng = random.Random(seed)
    rows = [
        (i, "w " * rng.choice([0, 1, 5, 40, 200]), rng.choices(["a", "b", "ü", "z", None], [60, 2, 10, 1, 5])[0])
        for i in range(400)
    ]
    got = mixing.mix(docs_of(rows), size()).collect()
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(text.split())
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    want = shared_out(sizes, {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)})
    taken, largest = Counter(), defaultdict(int)
    for r in got:
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]
        assert 0 <= r.repeats <= 3
        taken[r.source] += r.size * r.repeats
        largest[r.source] = max(largest[r.source], r.size)
    for source in sizes:
        assert abs(taken[source] - want[source]) <= largest[source] / 2 + 1e-6
    again = mixing.mix(docs_of(rows), size()).collect()
    assert {(r.doc_id, r.repeats) for r in got} == {(r.doc_id, r.repeats) for r in again}


def test_mix_of_odd_rows(docs_of):
    docs = docs_of(ODD, size=9, target="x", repeats=1, weight="w", before="b")
    got = mixing.mix(docs, size()).collect()
    assert len(got) == len(ODD)
    assert {r.weight for r in got} == {"w"} and {r.before for r in got} == {"b"}
    by_row = {(r.doc_id, r.text): r for r in got}
    assert by_row[(1, None)].size == 0 and by_row[(2, "")].size == 0
    same = [r.repeats for r in got if r.doc_id == 4]
    assert same[0] == same[1]
    assert mixing.mix(docs.where("false"), size()).count() == 0
    assert mixing.mix(docs_of([(1, None), (2, "")]), size()).where("repeats > 0").count() == 0


def test_repeated_rows_come_as_often_as_taken(docs_of):
    mixed = mixing.mix(docs_of([(i, "w " * 10, "ab"[i % 7 == 0]) for i in range(70)]), size())
    want = {r.doc_id: r.repeats for r in mixed.collect() if r.repeats}
    assert Counter(r.doc_id for r in mixing.repeated(mixed).collect()) == want


def test_ranks_and_running_sums(spark):
    rng = random.Random(3)
    rows = [(rng.choice("xy") if rng.random() < 0.9 else None, rng.randrange(30), i) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, v long, i long").repartition(5)
    ranked = ranking.with_rank(df, F.col("v"), F.col("i")).collect()
    order = sorted(rows, key=lambda r: (r[1], r[2]))
    assert {r.i: r["rank"] for r in ranked} == {row[2]: n for n, row in enumerate(order)}
    assert {r.total for r in ranked} == {300}
    running = {r.i: r.before for r in ranking.with_running(df, "g", "v", F.col("i")).collect()}
    sums = Counter()
    for g, v, i in sorted(rows, key=lambda r: r[2]):
        assert running[i] == sums[g]
        sums[g] += v


@pytest.mark.parametrize("rows", [0, 1, 39, 40, 41, 533])
def test_shards_hold_the_mixture(docs_of, rows):
    docs = docs_of([(i, "t", "a" if i % 3 else "b" if i % 2 else None) for i in range(rows)], shard=1, slot="x")
    got = sharding.interleave(docs).collect()
    assert len(got) == rows
    shards = defaultdict(list)
    for r in got:
        shards[r.shard].append(r)
    sizes = [len(shards[s]) for s in range(sharding.SHARDS)]
    assert max(sizes) - min(sizes) <= 1
    for held in shards.values():
        assert sorted(r.slot for r in held) == list(range(len(held)))
    if rows > 500:
        for source, part in (("a", 2 / 3), ("b", 1 / 6), (None, 1 / 6)):
            for held in shards.values():
                assert abs(sum(r.source == source for r in held) - part * len(held)) <= 2


def test_sharding_of_odd_rows(spark, docs_of):
    docs = docs_of(ODD, shard=7, slot="s")
    got = sharding_stage(spark, docs, "").collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter(ODD)
    assert len({(r.shard, r.slot) for r in got}) == len(ODD)
    assert sharding_stage(spark, docs.where("false"), "").count() == 0
