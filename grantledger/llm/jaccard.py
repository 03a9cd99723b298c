"""Exact Jaccard join of word n-grams: partitions of the universe and the pigeonhole principle.

At low limits, where segments are many and short, sets may be brought together
by the rarest of their shingles instead (`prefixes`).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantledger.llm.common import WORD, bounded_batches, release, shuffle_width
from grantledger.llm.components import components
from grantledger.llm.hashing import joined_bytes, mixed, word_hashes
from grantledger.session import settle
from grantledger.sources import files

#: Words of a shingle, and the similarity of two linked documents in percent.
WORDS = 3
PERCENT = 90
#: The largest size of a band is about so many times its least.
BAND_RATIO = 1.5
#: A list of nodes is sent to all tasks up to this length (16 bytes each), and joined by a shuffle beyond.
SENT_ROWS = 1_000_000
#: Numbers of 64 parities in a sketch; a set has two sketches.
PARITY_LONGS = 8
#: Parities for each shingle of a set, at least, in the sketch by which pairs are sieved before their shingles are compared.
#: It follows the size, as a sketch of fixed length is full with large sets and sieves none of their pairs.
SIEVE_PARITIES = 2
#: Rounds with drawn hubs go on while they link more than this share of the sets they compare, and more than so many sets:
#: what is left to the pairs then is few sets, each with those that share a signature, however large their group is.
STAR_SHARE = 0.05
STAR_LEAST = 20
#: Shingles of the sets, drawn whole, in which common ones are counted. What is found common orders the shingles of a set
#: and leaves none out, so it decides how much is compared and not what is linked.
SAMPLE_SHINGLES = 2_000_000

_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def bands(largest: int, ratio: float = BAND_RATIO) -> np.ndarray:
    """The least size of each band, up to one above `largest`."""
    edges = [1]
    while edges[-1] <= largest:
        edges.append(max(edges[-1] + 1, int(edges[-1] * ratio)))
    return np.array(edges + [max(edges[-1] + 1, int(edges[-1] * ratio))], np.int64)


def most_different(total: int, percent: int = PERCENT) -> int:
    """How many shingles two linked sets may have alone, if their sizes add up to `total`."""
    return total * (100 - percent) // (100 + percent)


def allocate(low: int, high: int, count: int, percent: int = PERCENT) -> tuple[int, int]:
    """(segments, of these with one-deletion neighbourhoods) of a band of `count` sets, by least cost.

    Two linked sets differ in at most D shingles. If a segment's equality counts
    1 and its equality up to one shingle 2, any segments whose counts exceed D
    hold one that brings the two together. A neighbourhood costs a row for each
    shingle of its segment, but lets segments be fewer and so longer; short
    ones agree by chance, above all when both are empty, with all `count` sets.
    """
    different = most_different(2 * high, percent)
    best = None
    for near in range(different // 2 + 2):
        exact = max(different + 1 - 2 * near, 0)
        segments = exact + near
        size = low / segments
        rows = exact + near * (1 + high / segments)
        chance = exact * math.exp(-2 * size) + near * math.exp(-2 * size) * (1 + 2 * size)
        cost = rows + count * chance
        if best is None or cost < best[0]:
            best = cost, segments, near
    return best[1], best[2]


@dataclass(frozen=True)
class Bands:
    least: np.ndarray
    segments: np.ndarray
    near: np.ndarray
    percent: int = PERCENT


def plan_bands(sizes: dict[int, int], percent: int = PERCENT) -> Bands:
    """Bands and their allocation, from the number of sets in each band."""
    least = bands(max(sizes, default=1))
    counts = np.zeros(len(least), np.int64)
    for size, n in sizes.items():
        counts[np.searchsorted(least, size, side="right") - 1] += n
    plans = [
        allocate(int(least[i]), int(least[i + 1]) - 1, int(counts[i] + (counts[i - 1] if i else 0)), percent)
        for i in range(len(least) - 1)
    ]
    return Bands(least, np.array([p[0] for p in plans]), np.array([p[1] for p in plans]), percent)


def shingle_sets(column: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct 64-bit shingles of all texts one after another, and how many each text has.

    Words are runs without white space, A-Z counting as a-z. A text of fewer
    words is one shingle; one without words has none.
    """
    data, ends = joined_bytes(column)
    starts, _, word = word_hashes(_LOWER[data], ~_SPACE)
    upto = np.searchsorted(starts, ends)
    begin = np.concatenate([[0], upto[:-1]])
    factors = [mixed(np.array([i + 1], np.uint64))[0] | np.uint64(1) for i in range(words)]
    long_ = max(len(word) - words + 1, 0)
    runs = reduce(np.add, [word[i : i + long_] * factors[i] for i in range(words)])
    runs = mixed(runs)
    sets, sizes = [], np.zeros(len(ends), np.int64)
    for i, (a, b) in enumerate(zip(begin.tolist(), upto.tolist(), strict=True)):
        if b - a >= words:
            found = np.unique(runs[a : b - words + 1])
        elif b > a:
            found = np.array([b - a], np.uint64)
            for at in range(a, b):
                found = mixed(found * factors[0] + word[at])
        else:
            continue
        sets.append(found)
        sizes[i] = len(found)
    return np.concatenate(sets) if sets else np.empty(0, np.uint64), sizes


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values)])
    ends = np.cumsum(sizes)
    return upto[ends] - upto[ends - sizes]


def nodes(shingles: np.ndarray, sizes: np.ndarray, seed: int = 0) -> np.ndarray:
    """One number for each set, equal for equal sets; 0 only for the empty set."""
    key = mixed(np.array([0xA5A5 + seed], np.uint64))
    found = mixed(_sums(mixed(shingles ^ key), sizes) + sizes.astype(np.uint64)) | np.uint64(1)
    return np.where(sizes > 0, found, np.uint64(0)).view(np.int64)


def parities(shingles: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Two sketches of 512 parities of each set, eight numbers each.

    Two sets differ in at least as many shingles as parities of a sketch. The
    sketches are independent, so a pair just beyond the limit has to be hidden
    by chance in both.
    """
    out = np.zeros((len(sizes), 2 * PARITY_LONGS), np.uint64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    for sketch in (0, 1):
        place = (shingles >> np.uint64(9 * sketch)) & np.uint64(511)
        at = row * (2 * PARITY_LONGS) + sketch * PARITY_LONGS + (place >> np.uint64(6)).astype(np.int64)
        np.bitwise_xor.at(out.ravel(), at, np.uint64(1) << (place & np.uint64(63)))
    return out.view(np.int64)


def sieves(shingles: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parities of each set one set after another, and how many numbers of 64 each set has: a power of two.

    Parities go by the low bits of the shingles, so the two halves of a sketch,
    combined by exclusive or, are the same set's sketch of half the length.
    """
    wanted = np.maximum(SIEVE_PARITIES * sizes, 64).astype(np.float64)
    longs = (1 << (np.ceil(np.log2(wanted)).astype(np.int64) - 6)).astype(np.int64)
    out = np.zeros(int(longs.sum()), np.uint64)
    place = shingles & np.repeat((longs * 64 - 1).astype(np.uint64), sizes)
    at = np.repeat(np.cumsum(longs) - longs, sizes) + (place >> np.uint64(6)).astype(np.int64)
    np.bitwise_xor.at(out, at, np.uint64(1) << (place & np.uint64(63)))
    return out.view(np.int64), longs


def signatures(shingles: np.ndarray, sizes: np.ndarray, plan: Bands) -> tuple[np.ndarray, np.ndarray]:
    """(signature, row of its set): linked sets share one at least.

    A set has those of its size's band, and of the next band if a set there may
    be linked with it. Shingles are sorted, so a segment is a run of them.
    """
    starts = np.cumsum(sizes) - sizes
    band = np.searchsorted(plan.least, sizes, side="right") - 1
    out_signature, out_row = [], []
    for step in (0, 1):
        of = band + step
        takes = sizes > 0
        if step:
            # the last band of the plan has no sets, so a next one always has a plan or no set
            takes &= (of < len(plan.segments)) & (100 * sizes >= plan.percent * plan.least[np.minimum(of, len(plan.least) - 1)])
        rows = np.flatnonzero(takes)
        if not len(rows):
            continue
        m, near, n = plan.segments[of[rows]], plan.near[of[rows]], sizes[rows]
        at = np.repeat(starts[rows] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        own = shingles[at]
        segment = ((own >> np.uint64(32)) * np.repeat(m, n).astype(np.uint64)) >> np.uint64(32)
        first = np.cumsum(m) - m
        place = np.repeat(first, n) + segment.astype(np.int64)
        count = np.bincount(place, minlength=int(m.sum()))
        value = mixed(own ^ np.uint64(0x5C5C))
        total = _sums(value, count)
        row = np.repeat(np.arange(len(rows)), m)
        number = np.arange(len(row)) - first[row]
        name = mixed((of[rows][row].astype(np.uint64) << np.uint64(32)) + number.astype(np.uint64))
        out_signature.append(mixed(total ^ name))
        out_row.append(rows[row])
        if near.any():
            within = number[place] < near[row[place]]
            out_signature.append(mixed((total[place[within]] - value[within]) ^ name[place[within]]))
            out_row.append(rows[row[place[within]]])
    if not out_signature:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(out_signature).view(np.int64), np.concatenate(out_row)


def prefixes(
    shingles: np.ndarray, sizes: np.ndarray, plan: Bands, common: np.ndarray, times: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """(signature, row of its set): linked sets share one at least, as with `signatures`.

    All sets order their shingles alike, the `common` ones (sorted) last, by how
    many `times` they were seen. A set of n shingles has at least `percent` % of
    n in common with a linked one, so the first of what they share is among the
    first n + 1 less that of both. These are the signatures, in the set's band
    and in the next one if a set there may be linked with it.
    """
    level = np.zeros(len(shingles), np.uint64)
    if len(common):
        at = np.minimum(np.searchsorted(common, shingles), len(common) - 1)
        steps = np.minimum(1 + np.log2(np.maximum(times, 1)), 255).astype(np.uint64)
        level = np.where(common[at] == shingles, steps[at], np.uint64(0))
    order = (level << np.uint64(56)) | (mixed(shingles ^ np.uint64(0xC3C3)) >> np.uint64(8))
    row = np.repeat(np.arange(len(sizes)), sizes)
    # equal ranks stay in the order of the shingles, which is that of all sets too
    by_rank = np.lexsort((order, row))
    place = np.arange(len(shingles)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    first = sizes - (plan.percent * sizes + 99) // 100 + 1
    taken = by_rank[place < np.repeat(first, sizes)]
    own, row = shingles[taken], row[taken]
    band = np.searchsorted(plan.least, sizes, side="right") - 1
    beyond = band + 1 < len(plan.least)
    beyond &= 100 * sizes >= plan.percent * plan.least[np.minimum(band + 1, len(plan.least) - 1)]
    further = beyond[row]
    own, of = np.concatenate([own, own[further]]), np.concatenate([band[row], band[row[further]] + 1])
    return mixed(own ^ mixed(of.astype(np.uint64))).view(np.int64), np.concatenate([row, row[further]])


def _split(values: pa.Array, row: np.ndarray, count: int) -> pa.ListArray:
    """A list for each of `count` rows; `row` is sorted."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(count + 1)), pa.int32()), values)


def _sized(words: int, seed: int) -> Callable:
    def sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                shingles, sizes = shingle_sets(batch.column("text"), words)
                flat = pa.array(parities(shingles, sizes).ravel())
                ends = pa.array(np.arange(len(sizes) + 1) * 2 * PARITY_LONGS, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(n) for n in ("doc_id", "__k", "__k2")), pa.array(nodes(shingles, sizes, seed)),
                     pa.array(sizes), pa.ListArray.from_arrays(ends, flat)],
                    names=["doc_id", "__k", "__k2", "node", "n_shingles", "parity"],
                )

    return sized


def _signed(words: int, plan: Bands, seed: int, common: tuple[np.ndarray, np.ndarray] | None = None) -> Callable:
    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            shingles, sizes = shingle_sets(batch.column("text"), words)
            node = nodes(shingles, sizes, seed)
            made = signatures(shingles, sizes, plan) if common is None else prefixes(shingles, sizes, plan, *common)
            signature, row = made
            # of a batch, one row for each signature goes to the shuffle; the others join that row's node here
            order = np.lexsort((node[row], signature))
            signature, own = signature[order], node[row][order]
            head = np.ones(len(signature), bool)
            head[1:] = signature[1:] != signature[:-1]
            lead = own[np.flatnonzero(head)][np.cumsum(head) - 1] if len(own) else own
            again = ~head & (own != lead)
            again[1:] &= own[1:] != own[:-1]
            keep = head | again
            # a row that leads its signature has no other lead, and nothing to store for it
            yield pa.RecordBatch.from_arrays(
                [pa.array(signature[keep]), pa.array(own[keep]), pa.array(lead[keep], mask=(lead == own)[keep])],
                names=["signature", "node", "lead"],
            )

    return signed


def _shingled(words: int) -> Callable:
    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                shingles, sizes = shingle_sets(batch.column("text"), words)
                lists = pa.LargeListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(sizes)])), pa.array(shingles.view(np.int64))
                )
                parity, longs = sieves(shingles, sizes)
                sketch = pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(longs)])), pa.array(parity))
                kind = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("node"), lists.cast(kind), sketch.cast(kind)], names=["node", "shingles", "sieve"]
                )

    return shingled


def _sent(rows: DataFrame) -> DataFrame:
    """A list with a broadcast hint if it is short, and none, for a shuffle, if it is not."""
    return F.broadcast(rows) if rows.count() <= SENT_ROWS else rows


def _may_link(percent: int) -> Column:
    """Bounds that every linked pair meets: on the sizes, and on the parities of each sketch in which they differ."""
    n, m = F.col("n_a"), F.col("n_b")
    bounds = 100 * F.least(n, m) >= percent * F.greatest(n, m)
    for sketch in (0, 1):
        numbers = range(sketch * PARITY_LONGS, (sketch + 1) * PARITY_LONGS)
        unlike = [F.bit_count(F.col("parity_a")[i].bitwiseXOR(F.col("parity_b")[i])) for i in numbers]
        bounds = bounds & ((100 + percent) * reduce(add, unlike) <= (100 - percent) * (n + m))
    return bounds


def _unlike(a: Column, b: Column) -> Column:
    """In how many parities two sketches of `sieves` differ; the longer one is folded once if it is twice as long.

    0, which sieves nothing, where that does not make them equally long.
    """

    def folded(sketch: Column, other: Column) -> Column:
        half = F.size(other)
        once = F.zip_with(F.slice(sketch, 1, half), F.slice(sketch, half + 1, half), lambda x, y: x.bitwiseXOR(y))
        return F.when(F.size(sketch) == 2 * half, once).otherwise(sketch)

    one, other = folded(a, b), folded(b, a)
    both = F.zip_with(one, other, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.when(F.size(one) == F.size(other), F.aggregate(both, F.lit(0), lambda total, n: total + n)).otherwise(0)


class _Linker:
    """The rounds of one join: candidate pairs in, verified links and their components out."""

    def __init__(self, docs: DataFrame, words: int, percent: int, by_prefix: bool = False) -> None:
        self.percent, self.words, self.by_prefix = percent, words, by_prefix
        bounded_batches(docs.sparkSession)
        self.docs = docs.select("doc_id", "text").withColumns(
            {"__k": F.xxhash64("doc_id", "text"), "__k2": F.xxhash64(F.lit(1), "text", "doc_id")}
        )
        id_kind = docs.schema["doc_id"].dataType.simpleString()
        kind = f"doc_id {id_kind}, __k long, __k2 long, node long, n_shingles long, parity array<bigint>"
        self.seed = 0
        while True:
            self.members = settle(self.docs.mapInArrow(_sized(words, self.seed), kind), "members")
            sets = self.members.where("n_shingles > 0").groupBy("node")
            self.sets = settle(
                sets.agg(
                    F.first("n_shingles").alias("n"), F.min("parity").alias("parity"),
                    F.min(F.struct("__k", "__k2")).alias("__of"),
                    (F.min(F.struct("n_shingles", "parity")) != F.max(F.struct("n_shingles", "parity"))).alias("__mixed"),
                ),
                "sets",
            )
            # different sets that got one number are told apart by other numbers
            if self.sets.where("__mixed").isEmpty():
                break
            self.seed += 1
        self.sets = self.sets.drop("__mixed")

        counted = self.members.groupBy("__k", "__k2").count()
        self.repeated = not counted.where("count > 1").isEmpty()

    def _band_sizes(self) -> dict[int, int]:
        # as many rows as there are bands, which follow the logarithm of the largest size
        step = F.floor(F.log("n") / F.log(F.lit(1.05)))
        rows = self.sets.groupBy(step).agg(F.max("n").alias("n"), F.count("*").alias("count")).collect()
        return {r.n: r["count"] for r in rows}

    def _common(self) -> tuple[np.ndarray, np.ndarray]:
        """Shingles of several drawn sets, sorted, and of how many; those of less than a thousandth are left out."""
        total = self.sets.agg(F.sum("n")).first()[0] or 0
        drawn = self.sets.where(F.pmod(F.xxhash64("node"), F.lit(max(-(-total // SAMPLE_SHINGLES), 1))) == 0)
        drawn = settle(drawn.select("node"), "drawn")
        least = max(3, drawn.count() // 1000)
        seen = self.shingles(drawn).select(F.explode("shingles").alias("shingle")).groupBy("shingle").count()
        # a thousand times the shingles of a set at most
        rows = seen.where(F.col("count") >= least).toArrow()
        shingle = rows["shingle"].to_numpy().view(np.uint64)
        order = np.argsort(shingle)
        return shingle[order], rows["count"].to_numpy()[order]

    def shared_signatures(self, plan: Bands | None = None) -> DataFrame:
        """(`signature`, `node`, `hub`) for all signatures of several different sets; the hub is one of them.

        The rows of a signature are first brought down to one for each batch of
        texts, so a signature that a third of all sets have stays small.
        """
        plan = plan or plan_bands(self._band_sizes(), self.percent)
        signed = _signed(self.words, plan, self.seed, self._common() if self.by_prefix else None)
        rows = settle(self.docs.select("text").mapInArrow(signed, "signature long, node long, lead long"), "signatures")
        # one shuffle serves both the hubs and the join with them; with a row for each batch
        # at most, no signature has many
        led = rows.where("lead is null").select("signature", "node").repartition(
            shuffle_width(self.docs.sparkSession), "signature"
        )
        hubs = led.groupBy("signature").agg(F.min("node").alias("hub"), F.max("node").alias("__last"))
        hubs = hubs.where("hub < __last").select("signature", "hub")
        across = led.join(hubs, "signature").select("signature", "node", "hub")
        near = rows.where("lead is not null").select("signature", "node", F.col("lead").alias("hub"))
        # a batch's own group also has the row that leads it
        leads = near.select("signature", F.col("hub").alias("node"), "hub")
        shared = settle(across.union(near).union(leads), "shared")
        for folder in {name.rpartition("/")[0] for name in rows.inputFiles()}:
            files.delete(self.docs.sparkSession, folder)
        release(self.docs.sparkSession)
        return shared

    def bounded(self, pairs: DataFrame) -> DataFrame:
        """The pairs (`a`, `b`) that the bounds let through, with their sizes."""
        columns = pairs.columns
        for side in ("a", "b"):
            of = self.sets.select(
                F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col("parity").alias(f"parity_{side}"),
            )
            pairs = pairs.join(of, side)
        return pairs.where(_may_link(self.percent)).select(*columns, "n_a", "n_b")

    def shingles(self, wanted: DataFrame) -> DataFrame:
        """`node`, `shingles` of the wanted nodes, computed again from one text of each."""
        of = settle(self.sets.join(wanted, "node", "left_semi").select("node", "__of.__k", "__of.__k2"), "wanted")
        texts = self.docs.join(_sent(of), ["__k", "__k2"]).select("node", "text")
        made = texts.mapInArrow(_shingled(self.words), "node long, shingles array<bigint>, sieve array<bigint>")
        made = settle(made, "shingles")
        # one text was chosen for each node; only rows repeated in the input come twice
        return made.dropDuplicates(["node"]) if self.repeated else made

    def sieved(self, pairs: DataFrame, shingles: DataFrame) -> DataFrame:
        """The pairs that may be linked by sketches as long as their sets; none that is linked is left out.

        Two sets differ in at least as many shingles as parities.
        """
        for side in ("a", "b"):
            of = shingles.select(F.col("node").alias(side), F.col("sieve").alias(f"sieve_{side}"))
            pairs = pairs.join(of, side)
        bound = (100 + self.percent) * _unlike(F.col("sieve_a"), F.col("sieve_b"))
        return pairs.where(bound <= (100 - self.percent) * (F.col("n_a") + F.col("n_b"))).select("a", "b", "n_a", "n_b")

    def verified(self, pairs: DataFrame, shingles: DataFrame) -> DataFrame:
        # a pair takes whole sets through a shuffle, so only pairs that are left by then do
        pairs = settle(self.sieved(pairs, shingles), "sieved")
        release(self.docs.sparkSession)
        # rounds before have left shingles that these pairs do not ask for
        for side in ("a", "b"):
            asked = shingles.join(_sent(pairs.select(F.col(side).alias("node")).distinct()), "node", "left_semi")
            of = asked.select(F.col("node").alias(side), F.col("shingles").alias(f"of_{side}"))
            pairs = pairs.join(of, side)
        both = F.size(F.array_intersect("of_a", "of_b"))
        near = (100 + self.percent) * both >= self.percent * (F.col("n_a") + F.col("n_b"))
        return pairs.where(near).select("a", "b")

    def labels(self, plan: Bands | None = None) -> DataFrame:
        """`node`, `component` for all sets with a link to another set.

        Rounds of comparisons, each only between different components. First
        each set is compared with the hub that it shares most signatures with;
        then, where sets of a signature are still apart, those outside its
        largest component with a hub in it that is drawn anew in each round, as
        long as such comparisons link a share of the sets compared;
        then all pairs that share a signature and are still apart. A large group
        of near copies is one component before pairs are listed.
        """
        shared = self.shared_signatures(plan)
        self.still_apart = shared.select("signature", "node")
        found = tried = links = known = shingles = None
        number, candidates = 0, self._first
        while True:
            pairs = settle(candidates(shared, found, tried, number), "pairs")
            release(self.docs.sparkSession)
            compared = pairs.count()
            linked = 0
            if compared:
                ends = settle(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), "ends")
                if known is None:
                    known, shingles = ends, self.shingles(ends)
                else:
                    new = settle(ends.join(known, "node", "left_anti"), "ends")
                    if not new.isEmpty():
                        known, shingles = known.union(new), shingles.union(self.shingles(new))
                more = settle(self.verified(pairs, shingles), "links")
                pairs = pairs.select("a", "b")
                tried = pairs if tried is None else tried.union(pairs)
                linked = more.count()
                if linked:
                    links = more if links is None else links.union(more)
                    found = components(links)
                release(self.docs.sparkSession)
            if candidates == self._rest:
                break
            number += 1
            goes_on = number == 1 or linked > max(compared * STAR_SHARE, STAR_LEAST)
            candidates = self._star if goes_on else self._rest
        if found is None:
            return self.sets.where("false").select("node", F.col("node").alias("component"))
        return found

    def _best(self, stars: DataFrame) -> DataFrame:
        """Of each `a` the `b` with most signatures, if the bounds let the pair through."""
        counted = stars.groupBy("a", "b").agg(F.count("*").alias("__n"))
        best = counted.groupBy("a").agg(F.max_by("b", F.struct("__n", "b")).alias("b"))
        return self.bounded(best)

    def _first(self, shared: DataFrame, found: DataFrame | None, tried: DataFrame | None, number: int) -> DataFrame:
        return self._best(shared.where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b")))

    def _apart(self, found: DataFrame | None) -> DataFrame:
        """(`signature`, `node`, `component`) of the signatures whose sets are not one component.

        Components only grow, so each round looks at what the one before has left.
        """
        rows = self.still_apart
        if found is None:
            rows = rows.withColumn("component", F.col("node"))
        else:
            rows = rows.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
        ends = rows.groupBy("signature").agg(F.min("component").alias("__a"), F.max("component").alias("__b"))
        ends = ends.where("__a < __b").select("signature")
        apart = settle(rows.join(ends, "signature", "left_semi").distinct(), "apart")
        self.still_apart = apart.select("signature", "node")
        return apart

    def _star(self, shared: DataFrame, found: DataFrame | None, tried: DataFrame | None, number: int) -> DataFrame:
        """Each set that is apart with a hub of another component; the hub of a signature is drawn by the round.

        It is drawn in the component that has most sets of the signature. One drawn among a few others would be
        compared with all sets of that component, and link no more than itself.
        """
        apart = self._apart(found)
        drawn = F.min(F.struct(F.xxhash64(F.lit(number), "node"), "node"))["node"]
        parts = apart.groupBy("signature", "component").agg(F.count("*").alias("__n"), drawn.alias("b"))
        largest = F.struct("__n", F.xxhash64(F.lit(number), "component"), "component")
        hubs = parts.groupBy("signature").agg(F.max_by(F.struct("component", "b"), largest).alias("hub"))
        hubs = hubs.select("signature", F.col("hub.component").alias("__of"), F.col("hub.b").alias("b"))
        stars = apart.join(hubs, "signature").where("component <> __of").select(F.col("node").alias("a"), "b")
        return self._untried(self._best(stars), tried)

    def _untried(self, pairs: DataFrame, tried: DataFrame | None) -> DataFrame:
        if tried is None:
            return pairs
        return pairs.join(tried.union(tried.select("b", "a")), ["a", "b"], "left_anti")

    def _rest(self, shared: DataFrame, found: DataFrame | None, tried: DataFrame | None, number: int) -> DataFrame:
        """All pairs of different components that share a signature, meet the bounds and were not compared yet."""
        apart = self._apart(found)
        # signatures of the same sets, as a family has many, list the same pairs: one of them stays
        numbers = [F.bit_xor(F.xxhash64(F.lit(seed), "node")).alias(f"__{seed}") for seed in (0, 1)]
        groups = apart.groupBy("signature").agg(F.count("*").alias("__size"), *numbers)
        one = groups.groupBy("__size", "__0", "__1").agg(F.min("signature").alias("signature")).select("signature")
        rows = apart.join(one, "signature", "left_semi").join(self.sets.drop("__of"), "node")
        rows = settle(rows, "sets-apart")

        def side(name: str) -> DataFrame:
            columns = {"n": "n", "parity": "parity", "component": "c"}
            return rows.select(
                "signature", F.col("node").alias(name), *[F.col(c).alias(f"{d}_{name}") for c, d in columns.items()]
            )

        wanted = (F.col("a") < F.col("b")) & (F.col("c_a") != F.col("c_b")) & _may_link(self.percent)
        both = side("a").join(side("b").withColumnRenamed("signature", "__s"), (F.col("signature") == F.col("__s")) & wanted)
        return self._untried(both.select("a", "b", "n_a", "n_b").distinct(), tried)


def link(
    docs: DataFrame, words: int = WORDS, percent: int = PERCENT, plan: Bands | None = None, by_prefix: bool = False
) -> DataFrame:
    """One row for each row of `docs`: `doc_id`, `n_shingles`, `node`, `component_id`, `leads`, `__k`, `__k2`.

    `node` is the same for equal sets of shingles, `component_id` the least id
    that links reach, itself included, and `leads` holds for the row with that
    id (of several, that of the least key). `__k`, `__k2` are hashes of id and text.

    A null or empty text has no shingles and no link. Null ids count last; a
    component of null ids only has a null id. Repeated rows are linked. An
    empty table gives an empty table. Only `doc_id` and `text` are read.

    `by_prefix` brings sets together by their rarest shingles in place of
    segments, with the same result: at 80 % a set then has a signature for each
    fifth shingle, where segments make several for each one.
    """
    linker = _Linker(docs, words, percent, by_prefix)
    found = linker.labels(plan)
    rows = linker.members.drop("parity").join(found, "node", "left")
    rows = rows.withColumn("component", F.coalesce("component", "node"))
    linked = rows.where("n_shingles > 0")
    first = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "__k", "__k2")
    leaders = settle(linked.groupBy("component").agg(F.min(first).alias("__first")), "leaders")
    of = rows.join(leaders, (rows["component"] == leaders["component"]) & (rows["n_shingles"] > 0), "left")
    alone = F.col("__first").isNull()
    return of.select(
        "doc_id",
        "n_shingles",
        "node",
        F.when(alone, F.col("doc_id")).otherwise(F.col("__first.doc_id")).alias("component_id"),
        (alone | ((F.col("__first.__k") == F.col("__k")) & (F.col("__first.__k2") == F.col("__k2")))).alias("leads"),
        "__k",
        "__k2",
    )


def one_of_each(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, by_prefix: bool = False) -> DataFrame:
    """`docs` with one row of each component: the leading one."""
    dropped = settle(
        link(docs, words, percent, by_prefix=by_prefix).where("not leads").select("__k", "__k2").distinct(), "dropped"
    )
    keyed = docs.withColumns(
        {"__k": F.xxhash64("doc_id", "text"), "__k2": F.xxhash64(F.lit(1), "text", "doc_id")}
    )
    kept = keyed.join(_sent(dropped), ["__k", "__k2"], "left_anti")
    repeated = keyed.where(F.col("text").rlike(WORD)).groupBy("__k", "__k2").count().where("count > 1")
    if not repeated.isEmpty():
        again = settle(repeated.select("__k", "__k2"), "repeated")
        twice = kept.join(_sent(again), ["__k", "__k2"], "left_semi").dropDuplicates(["__k", "__k2"])
        kept = kept.join(_sent(again), ["__k", "__k2"], "left_anti").unionByName(twice)
    return kept.select(*docs.columns)
