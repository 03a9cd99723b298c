import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from grantledger.llm import jaccard as J
from tests.llm.conftest import ODD


def shingles(text, n=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(len(words) - n + 1, 1)))


def plain(rows, words=3, percent=90):
    """The least id that links reach, by comparing all pairs."""
    sets = [shingles(text, words) for _, text in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a and b and 100 * len(a & b) >= percent * len(a | b):
            parent[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        ids = [d for d in (least.get(root(i)), doc) if d is not None]
        least[root(i)] = min(ids) if ids else None
    return {(doc, text): (len(sets[i]), least[root(i)] if sets[i] else doc) for i, (doc, text) in enumerate(rows)}


def families(seed, most=400):
    """Texts of all sizes with chains of copies near the threshold, common passages and words."""
    rng = random.Random(seed)
    common = " ".join(f"c{i}" for i in range(60))
    rows = []
    for base in range(45):
        words = [f"w{rng.randrange(40) if base % 5 == 0 else (base, i)}" for i in range(rng.choice([1, 2, 3, 5, 9, 14, 30, 90, most]))]
        if base % 3 == 0:
            words += common.split()
        for _ in range(rng.choice([1, 2, 4, 7])):
            words = list(words)
            for _ in range(rng.choice([0, 1, 1, max(len(words) // 60, 1)])):
                words[rng.randrange(len(words))] = f"x{rng.random():.6f}"
            rows.append((rng.randrange(10**6), " ".join(words).title() if rng.random() < 0.2 else " ".join(words)))
    return list(dict.fromkeys(rows))


def result(rows):
    return {(r.doc_id, r.text): (r.n_shingles, r.component_id) for r in rows.collect()}


@pytest.mark.parametrize("seed", range(2))
def test_random_families(docs_of, seed):
    rows = families(seed)
    docs = docs_of(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.link(docs).collect()}
    want = {doc: found for (doc, _), found in plain(rows).items()}
    assert got == want


def test_neighbourhoods_find_all_links(docs_of):
    """Bands in which all segments are indexed up to one deletion, as they are for very many sets."""
    rows = families(7, most=120)
    least = J.bands(500)
    plans = [J.allocate(int(a), int(b) - 1, 10**30) for a, b in itertools.pairwise(least)]
    assert sum(near for _, near in plans) > len(plans)
    plan = J.Bands(least, np.array([p[0] for p in plans]), np.array([p[1] for p in plans]))
    got = {r.doc_id: r.component_id for r in J.link(docs_of(rows), plan=plan).collect()}
    assert got == {doc: found[1] for (doc, _), found in plain(rows).items()}


@pytest.mark.parametrize("count", [10, 10**30])
def test_linked_sets_share_a_signature(count):
    rng = np.random.default_rng(count % 97)
    least = J.bands(3000)
    plans = [J.allocate(int(a), int(b) - 1, count) for a, b in itertools.pairwise(least)]
    plan = J.Bands(least, np.array([p[0] for p in plans]), np.array([p[1] for p in plans]))
    for _ in range(60):
        size = int(rng.choice([1, 4, 9, 10, 19, 40, 200, 1500]))
        a = rng.integers(0, 1 << 63, size).astype(np.uint64)
        worst = size // 19 if rng.random() < 0.7 else size // 10  # replaced, or left out
        kept = a[worst:]
        fresh = rng.integers(0, 1 << 63, worst).astype(np.uint64) if worst == size // 19 else a[:0]
        sets = [np.unique(a), np.unique(np.concatenate([kept, fresh]))]
        both = len(np.intersect1d(*sets))
        if 100 * both < 90 * (len(sets[0]) + len(sets[1]) - both):
            continue
        signature, row = J.signatures(np.concatenate(sets), np.array([len(s) for s in sets]), plan)
        assert set(signature[row == 0]) & set(signature[row == 1])


def test_many_near_copies_and_a_common_half(docs_of):
    rng = random.Random(5)
    base = [f"b{i}" for i in range(80)]
    rows = []
    for i in range(300):
        words = list(base)
        words[rng.randrange(80)] = f"n{i}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, " ".join(base[:40]) + " " + " ".join(f"o{i}x{j}" for j in range(8))) for i in range(200)]
    got = {r.doc_id: r.component_id for r in J.link(docs_of(rows)).collect()}
    assert got == {doc: found[1] for (doc, _), found in plain(rows).items()}


def test_other_limits(docs_of):
    rows = families(11, most=150)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.link(docs_of(rows), words=5, percent=80).collect()}
    assert got == {doc: found for (doc, _), found in plain(rows, 5, 80).items()}


@pytest.mark.parametrize("percent", [80, 90])
def test_linked_sets_share_one_of_few_prefixes(percent):
    """A set has a prefix for each shingle it may lose, in two bands at most, whatever is common."""
    rng = np.random.default_rng(percent)
    pool = rng.integers(0, 1 << 63, 400).astype(np.uint64)
    common, times = np.unique(pool[:200]), np.arange(200)
    plan = J.plan_bands({3000: 1}, percent)
    linked = 0
    for _ in range(200):
        size = int(rng.choice([1, 2, 4, 5, 9, 10, 19, 40, 200, 390]))
        a = rng.choice(pool, size, replace=False)
        lost = rng.integers(0, max(size * (100 - percent) // 100, 1) + 1)
        b = np.concatenate([a[lost:], rng.integers(0, 1 << 63, rng.integers(0, 2)).astype(np.uint64)])
        sets = [np.unique(a), np.unique(b)]
        both = len(np.intersect1d(*sets))
        sizes = np.array([len(s) for s in sets])
        signature, row = J.prefixes(np.concatenate(sets), sizes, plan, common, times)
        most = sizes * (100 - percent) // 100 + 1
        assert (np.bincount(row, minlength=2) <= 2 * most).all()
        if both and 100 * both >= percent * (sizes.sum() - both):
            linked += 1
            assert set(signature[row == 0]) & set(signature[row == 1])
    assert linked > 50


@pytest.mark.parametrize("limits", [(5, 80), (3, 90), (1, 70)])
def test_prefixes_find_all_links(docs_of, limits):
    rows = families(13, most=150) + [(10**7 + i, "the " * (20 + i) + "the end") for i in range(8)]
    docs = docs_of(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.link(docs, *limits, by_prefix=True).collect()}
    assert got == {doc: found for (doc, _), found in plain(rows, *limits).items()}


def test_parities_never_overstate_and_rarely_hide():
    """Sets that differ in six shingles of some fifty, where five may: hardly any pair gets through both sketches."""
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 45).astype(np.uint64)
    sets = [np.unique(np.concatenate([base, rng.integers(0, 1 << 63, 3).astype(np.uint64)])) for _ in range(300)]
    sets += [np.unique(rng.integers(0, 1 << 63, int(n)).astype(np.uint64)) for n in (0, 1, 400, 900)]
    bits = np.unpackbits(J.parities(np.concatenate(sets), np.array([len(s) for s in sets])).view(np.uint8), axis=1)
    hidden = 0
    for i, j in itertools.combinations(range(len(sets)), 2):
        different = len(np.setxor1d(sets[i], sets[j]))
        unlike = bits[i] ^ bits[j]
        each = [int(unlike[:512].sum()), int(unlike[512:].sum())]
        assert max(each) <= different
        hidden += i < 300 and j < 300 and max(each) <= 5
    assert hidden <= 0.005 * 300 * 299 / 2


def test_large_sets_far_beyond_the_limit_are_sieved_before_their_shingles_meet(docs_of):
    """Sketches of fixed length let them all through, and each pair took a whole set through a shuffle."""
    def copy(doc, changed):
        return " ".join(f"y{doc}_{i}" if i < changed else f"w{i}" for i in range(3000))

    # of 2,998 shingles; at 80 % some 333 changed in one of two may be
    changed = {0: 0, 1: 100, 2: 320, 3: 340, 4: 900, 5: 1500, 6: 2998}
    docs = docs_of([(doc, copy(doc, n)) for doc, n in changed.items()])
    linker = J._Linker(docs, 3, 80)
    ids = {r.node: r.doc_id for r in linker.members.collect()}
    ends = linker.sets.select("node")
    pairs = ends.toDF("a").crossJoin(ends.toDF("b")).where("a < b")
    pairs = J.settle(linker.bounded(pairs), "all-pairs")

    def met(rows):
        return {tuple(sorted((ids[r.a], ids[r.b]))) for r in rows.collect()}

    shingles = linker.shingles(ends)
    texts = {doc: frozenset(zip(*[copy(doc, n).split()[i:] for i in range(3)], strict=False)) for doc, n in changed.items()}
    alike = {(i, j): len(texts[i] & texts[j]) / len(texts[i] | texts[j]) for i, j in itertools.combinations(texts, 2)}
    linked = {pair for pair, share in alike.items() if share >= 0.8}
    left = met(linker.sieved(pairs, shingles))
    assert linked and linked <= left and not [pair for pair in left if alike[pair] < 0.7]
    assert {(0, 4), (0, 5)} <= met(pairs)  # the fixed sketches do not tell these
    assert met(linker.verified(pairs, shingles)) == linked


def test_sieves_never_overstate_and_fold():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64)) for n in (0, 1, 31, 33, 64, 500, 520)]
    sets.append(np.unique(np.concatenate([sets[-1][:500], rng.integers(0, 1 << 63, 20).astype(np.uint64)])))
    found, longs = J.sieves(np.concatenate(sets), np.array([len(s) for s in sets]))
    assert longs.tolist() == [1, 1, 1, 2, 2, 16, 32, 32] and len(found) == longs.sum()
    each = np.split(found, np.cumsum(longs)[:-1])
    for i, j in itertools.combinations(range(len(sets)), 2):
        one, other = sorted((each[i], each[j]), key=len)
        while len(other) > len(one):
            other = other[: len(other) // 2] ^ other[len(other) // 2 :]
        unlike = int(np.unpackbits((one ^ other).view(np.uint8)).sum())
        assert unlike <= len(np.setxor1d(sets[i], sets[j]))


def test_sets_that_share_a_number_are_told_apart(docs_of, monkeypatch):
    made = J.nodes
    rows = [(i, f"some words of text {i // 2} and more") for i in range(12)]

    def linked():
        return {r.doc_id: r.component_id for r in J.link(docs_of(rows)).collect()}

    def colliding(shingles, sizes, seed=0):
        return made(shingles, sizes, seed) if seed else np.where(sizes > 0, 5, 0)

    # the tasks get the function by its module, so it is put there for them too
    monkeypatch.setattr(J, "_sized", _sized_with(colliding, J._sized))
    assert linked() == {i: i - i % 2 for i in range(12)}


def _sized_with(nodes, sized):
    def changed(words, seed):
        run = sized(words, seed)

        def with_nodes(batches):
            from grantledger.llm import jaccard

            before, jaccard.nodes = jaccard.nodes, nodes
            try:
                yield from run(batches)
            finally:
                jaccard.nodes = before

        return with_nodes

    return changed


def test_odd_rows(docs_of):
    rows = [*ODD, (8, "Short"), (9, "short"), (10, "two words"), (11, "TWO words"), (12, "words two")]
    docs = docs_of(rows, node="n", component="c")
    got = J.link(docs.select("doc_id", "text")).collect()
    assert len(got) == len(rows)
    of = {r.doc_id: r.component_id for r in got if r.doc_id is not None}
    assert of == {1: 1, 2: 2, 3: 3, 4: 4, 5: 4, 6: 6, 7: 7, 8: 8, 9: 8, 10: 10, 11: 10, 12: 12}
    kept = J.one_of_each(docs).collect()
    assert sorted((r.doc_id if r.doc_id is not None else -1) for r in kept) == [-1, -1, 1, 2, 3, 4, 6, 7, 8, 10, 12]
    assert all(r.node == "n" for r in kept)
    assert J.link(docs.where("false")).count() == 0 and J.one_of_each(docs.where("false")).count() == 0


def test_shingles_of_a_batch_match_single_texts():
    texts = [text for _, text in ODD] + ["a b c d", "A B c D", "a b", "c"]
    found, sizes = J.shingle_sets(pa.array(texts))
    assert sizes.tolist() == [len(shingles(t)) for t in texts]
    node = J.nodes(found, sizes)
    for i, j in itertools.combinations(range(len(texts)), 2):
        assert (node[i] == node[j]) == (shingles(texts[i]) == shingles(texts[j]))


def test_a_group_that_is_few_of_the_sets_apart_is_one_component_before_pairs_are_listed(spark, monkeypatch):
    """Half its pairs are linked; beside it are many sets that share a signature with one other, and no link."""
    monkeypatch.setattr(J, "STAR_LEAST", 2, raising=False)
    compared = []

    class Linker(J._Linker):
        def __init__(self):
            self.docs, self.percent, self.by_prefix = spark.range(0), 80, False
            self.sets = spark.range(3000).select(
                F.col("id").alias("node"), F.lit(1).alias("n"), F.array_repeat(F.lit(0).cast("long"), 16).alias("parity"),
                F.lit(None).alias("__of"),
            )

        def shared_signatures(self, plan=None):
            # of a group of 200 sets 140 had one hub
            group = spark.range(200).select(
                F.lit(-1).cast("long").alias("signature"), F.col("id").alias("node"),
                F.when(F.col("id") < 140, 0).otherwise(F.col("id")).alias("hub"),
            )
            others = spark.range(1000, 3000).select(
                F.floor(F.col("id") / 2).alias("signature"), F.col("id").alias("node"), F.col("id").alias("hub")
            )
            return J.settle(group.union(others), "shared")

        def bounded(self, pairs):
            return pairs.where("a < 1000").withColumns({"n_a": F.lit(1), "n_b": F.lit(1)})

        def shingles(self, wanted):
            return wanted

        def verified(self, pairs, shingles):
            compared.append(pairs.count())
            drawn = F.xxhash64(F.least("a", "b"), F.greatest("a", "b")) % 2 == 0
            return pairs.where((F.col("a") < 1000) & (drawn | (F.least("a", "b") == 0))).select("a", "b")

    found = Linker().labels()
    assert [(r.component, r["count"]) for r in found.groupBy("component").count().collect()] == [(0, 200)]
    assert len(compared) > 3 and compared[-1] < 1000 + 10 * 200 and sum(compared) < 2 * 2200
