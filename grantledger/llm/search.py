"""Ranked lexical search with bit-sliced Bloom signatures.

A document's signature holds each of its terms together with how often, in
steps, it occurs. Signatures of like width lie in a block as slices: one bitmap
over the block's documents for each place of a signature. The slices of a query
term, and-ed, show which documents may hold it, so their weighted sums are
never below the score. The best by these bounds are scored exactly, which gives
a score that the results must reach; whatever may reach it is scored exactly.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from grantledger.llm.common import bounded_batches, whole_text
from grantledger.llm.contamination import FOLD, words_of
from grantledger.llm.hashing import joined_bytes, mixed, word_hashes
from grantledger.session import settle

#: Results for each item.
BEST = 10
#: Places of a signature for each key, at least, and how many of them a key sets.
PLACES, SET = 24, 8
#: A block ends at so many documents, or when a task holds so many terms.
BLOCK_DOCS, HELD_TERMS = 2048, 1 << 21
#: Words of the items that are searched in one pass over the index.
BLOCK_WORDS = 50_000
#: Best documents by their bounds that are scored exactly to learn what score is needed.
SEEDS = 2 * BEST
#: Bytes of the bounds that a task holds at once.
BOUND_BYTES = 1 << 24

#: Least counts of the steps: exact up to 8, then four for each doubling.
STEPS = np.array([*range(1, 8), *(int(2 ** (i / 4)) for i in range(12, 160))], np.int64)

_FOLD = np.frombuffer(FOLD, np.uint8)
_IS_TERM = _FOLD != 32
_STEP_KEY = np.uint64(0xD1342543DE82EF95)


def step_of(counts: np.ndarray) -> np.ndarray:
    return np.searchsorted(STEPS, counts, "right") - 1


def octave_of(step: int) -> int:
    """Doublings from 8 on, 0 for the steps of exact counts."""
    return max((step - 3) // 4, 0) if step >= 7 else 0


def keys_of(hashes: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What a document's terms set: each its step, and from 8 occurrences on all doublings up to its own.

    The doublings, few as they are, keep chance from showing high counts.
    """
    parts = [(hashes, steps)]
    octaves = np.maximum((steps - 3) // 4, 0) * (steps >= 7)
    for octave in range(1, int(octaves.max(initial=0)) + 1):
        more = hashes[octaves >= octave]
        parts.append((more, np.full(len(more), len(STEPS) + octave, np.int64)))
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def places_of(hashes: np.ndarray, step: np.ndarray | int, width: int) -> np.ndarray:
    """The places that a term with a count of that step sets in a signature; one row for each term."""
    key = mixed(hashes + np.asarray(step, np.uint64) * _STEP_KEY)
    other = mixed(key) | np.uint64(1)
    return ((key[:, None] + np.arange(SET, dtype=np.uint64) * other[:, None]) % np.uint64(width)).astype(np.int64)


def width_of(n_keys: int) -> int:
    """Places of a signature: powers of the square root of two, so that like documents share a width."""
    wanted = max(PLACES * n_keys, 64)
    return int(math.ceil(2 ** (math.ceil(2 * math.log2(wanted)) / 2)))


def _block(width: int, held: list[tuple[object, int, np.ndarray, np.ndarray]]) -> dict:
    """A row of the index from documents (id, words, keys) of one width."""
    bits = np.zeros((width, -(-len(held) // 8) * 8), bool)
    for column, (_, _, hashes, steps) in enumerate(held):
        bits[places_of(hashes, steps, width).ravel(), column] = True
    return {
        "width": width,
        "doc_ids": [h[0] for h in held],
        "n_words": [h[1] for h in held],
        "slices": np.packbits(bits, axis=1, bitorder="little").tobytes(),
    }


def _indexer(id_kind: pa.DataType, block_docs: int, held_terms: int) -> Callable:
    schema = pa.schema(
        [("width", pa.int32()), ("doc_ids", pa.list_(id_kind)), ("n_words", pa.list_(pa.int64())), ("slices", pa.binary())]
    )

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        n_held = 0
        row = lambda width: pa.RecordBatch.from_pylist([_block(width, held.pop(width))], schema=schema)
        for batch in batches:
            data, ends = joined_bytes(batch.column("text"))
            starts, _, hashes = word_hashes(_FOLD[data], _IS_TERM)
            doc = np.searchsorted(ends, starts)
            order = np.lexsort((hashes, doc))
            doc, hashes = doc[order], hashes[order]
            new = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])])[: len(doc)])
            counts = np.diff(new, append=len(doc))
            terms, steps, of = hashes[new], step_of(counts), np.searchsorted(doc[new], np.arange(len(ends) + 1))
            n_words = np.bincount(doc, minlength=len(ends)).tolist()
            for i, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                if not n_words[i]:
                    continue  # without a term it is never found and does not count
                keys = keys_of(terms[of[i] : of[i + 1]], steps[of[i] : of[i + 1]])
                width = width_of(len(keys[0]))
                held.setdefault(width, []).append((doc_id, n_words[i], *keys))
                n_held += len(keys[0])
                if len(held[width]) >= block_docs:
                    n_held -= sum(len(h[2]) for h in held[width])
                    yield row(width)
                if n_held >= held_terms:
                    for width in list(held):
                        yield row(width)
                    n_held = 0
        for width in list(held):
            yield row(width)

    return index


def index(docs: DataFrame, block_docs: int = BLOCK_DOCS, held_terms: int = HELD_TERMS) -> DataFrame:
    """Blocks of signatures: `width`, `doc_ids`, `n_words`, `slices` (a bitmap over the documents for each place)."""
    bounded_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType
    rows = docs.select("doc_id", whole_text().alias("text"))
    schema = f"width int, doc_ids array<{kind.simpleString()}>, n_words array<long>, slices binary"
    return settle(rows.mapInArrow(_indexer(to_arrow_type(kind), block_docs, held_terms), schema), "signatures")


@dataclass
class Queries:
    """A block of items: each item's terms and weights, and what the scores need of the whole corpus."""

    items: list[tuple[object, dict[bytes, int]]]  # id, weight of each term times its repeats in the item
    n_docs: int
    n_words: int

    def __post_init__(self) -> None:
        terms = sorted({t for _, weights in self.items for t in weights})
        number = {t: i for i, t in enumerate(terms)}
        data, _ = joined_bytes(pa.array(terms, pa.binary()))
        self.hashes = word_hashes(data, _IS_TERM)[2]
        self.terms_of = [np.array([number[t] for t in weights], np.int64) for _, weights in self.items]
        self.weights_of = [np.array(list(weights.values()), np.float64) for _, weights in self.items]

    def length_norm(self, n_words: np.ndarray) -> np.ndarray:
        if 75 * int(n_words.max(initial=0)) * self.n_docs < 1 << 63:
            return 25 + 75 * n_words * self.n_docs // max(self.n_words, 1)
        return np.array([25 + 75 * int(n) * self.n_docs // self.n_words for n in n_words], np.int64)

    def bounds(self, width: int, n_words: np.ndarray, slices: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Bounds (item x document) for parts of a block, each with the number of its first document.

        All sums stay below 2**53, where floating point numbers add up exactly.
        """
        slices = slices.reshape(width, -1)
        step_docs = max(BOUND_BYTES // (8 * max(len(self.hashes), 1)) // 8, 1) * 8
        norms = self.length_norm(n_words)
        for lo in range(0, len(n_words), step_docs):
            part, norm = slices[:, lo // 8 : (lo + step_docs) // 8], norms[lo : lo + step_docs]
            part = np.ascontiguousarray(part)
            most = np.zeros((len(self.hashes), len(norm)))
            # later steps stand for more occurrences, and replace what earlier ones seemed to show
            for step in range(int(step_of(n_words[lo : lo + step_docs].max())) + 1):
                upto = int(STEPS[step + 1]) - 1
                gain = 1_000_000_000 * upto // (1000 * upto + 8 * norm)
                for first in range(0, len(self.hashes), 1024):
                    places = places_of(self.hashes[first : first + 1024], step, width)
                    seen = part[places[:, 0]]
                    for i in range(1, SET):
                        seen &= part[places[:, i]]
                    for octave in range(1, octave_of(step) + 1):
                        some = np.flatnonzero(seen.any(axis=1))
                        places = places_of(self.hashes[first + some], len(STEPS) + octave, width)
                        for i in range(SET):
                            seen[some] &= part[places[:, i]]
                    term, byte = np.nonzero(seen)
                    which, bit = np.nonzero(np.unpackbits(seen[term, byte][:, None], axis=1, bitorder="little"))
                    column = byte[which] * 8 + bit  # bits beyond the last document are never set
                    most[first + term[which], column] = gain[column]
            yield lo, np.stack([weights @ most[terms] for terms, weights in zip(self.terms_of, self.weights_of, strict=True)])

    def score(self, item: int, n_words: int, counts: Counter) -> int:
        norm = int(self.length_norm(np.array([n_words]))[0])
        total = 0
        for term, weight in self.items[item][1].items():
            tf = counts.get(term, 0)
            total += weight * (1_000_000_000 * tf // (1000 * tf + 8 * norm))
        return total


def _rows(ids: list, columns: dict[str, list], id_kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns["item"], pa.int32()), pa.array(ids, id_kind), pa.array(columns["bound"], pa.int64())],
        names=["item", "doc_id", "bound"],
    )


def _best_bounds(shared, id_kind: pa.DataType, seeds: int) -> Callable:
    """Each task's best documents for each item by their bounds."""

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries: Queries = shared.value
        kept: list[list[tuple[float, int, object]]] = [[] for _ in queries.items]
        seen = 0
        for width, ids, n_words, slices in _blocks(batches):
            for lo, bounds in queries.bounds(width, n_words, slices):
                for item, row in enumerate(bounds):
                    top = np.argpartition(-row, min(seeds, len(row)) - 1)[:seeds]
                    pool = kept[item] + [(row[i], seen + lo + int(i), ids[lo + i]) for i in top if row[i] > 0]
                    kept[item] = sorted(pool, key=lambda x: (-x[0], x[1]))[:seeds]
            seen += len(ids)
        found = [(item, doc_id, int(bound)) for item, rows in enumerate(kept) for bound, _, doc_id in rows]
        yield _rows([f[1] for f in found], {"item": [f[0] for f in found], "bound": [f[2] for f in found]}, id_kind)

    return best


def _reaching(shared, needed, id_kind: pa.DataType) -> Callable:
    """All documents whose bound reaches what an item's results need."""

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries: Queries = shared.value
        least = np.array(needed.value, np.float64)[:, None]
        for width, ids, n_words, slices in _blocks(batches):
            for lo, bounds in queries.bounds(width, n_words, slices):
                item, column = np.nonzero(bounds >= least)
                yield _rows(
                    [ids[lo + c] for c in column.tolist()],
                    {"item": item.tolist(), "bound": bounds[item, column].astype(np.int64).tolist()}, id_kind,
                )

    return reach


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list, np.ndarray, np.ndarray]]:
    for batch in batches:
        for row in range(batch.num_rows):
            width, ids, n_words, slices = (batch.column(c)[row] for c in ("width", "doc_ids", "n_words", "slices"))
            yield (
                width.as_py(), ids.as_py(), np.array(n_words.as_py(), np.int64),
                np.frombuffer(slices.as_buffer(), np.uint8),
            )


def _scorer(shared, id_kind: pa.DataType) -> Callable:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries: Queries = shared.value
        for batch in batches:
            items, ids, scores = [], [], []
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            wanted = batch.column("items").to_pylist()
            for doc_id, text, numbers in zip(batch.column("doc_id").to_pylist(), texts, wanted, strict=True):
                words = words_of(text)
                counts = Counter(words)
                for item in numbers:
                    items.append(item)
                    ids.append(doc_id)
                    scores.append(queries.score(item, len(words), counts))
            yield _rows(ids, {"item": items, "bound": scores}, id_kind)

    return score


def _holders(vocabulary: frozenset[bytes]) -> Callable:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                total.update(vocabulary.intersection(words_of(text)))
        yield pa.RecordBatch.from_pydict(
            {"term": pa.array(list(total), pa.binary()), "n": pa.array(list(total.values()), pa.int64())}
        )

    return count


def search(
    docs: DataFrame, benchmark: DataFrame, best: int = BEST, block_words: int = BLOCK_WORDS, signatures: DataFrame | None = None
) -> DataFrame:
    """The `best` documents of each item: `item_id`, `rank` from 1, `doc_id`, `score`; equal scores by ascending doc_id.

    `signatures` is the documents' `index`, made anew if not given. Items are
    taken in blocks of about `block_words` words, each with two passes over the
    index, one over the documents that counts terms, and the exact scores; one
    item's words have to fit in a task.

    Null and empty texts have no term: such documents are not found and do not
    count, such items find nothing. Only scores above 0 are results. Repeated
    documents, also of one id, are ranked each by itself; equal rows of the
    benchmark count once, rows that share an id are ranked apart. A null id
    comes before the others. Other columns are not read. An empty table on
    either side gives no rows.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    docs = docs.select("doc_id", "text")
    kind, item_kind = docs.schema["doc_id"].dataType, benchmark.schema["item_id"].dataType
    arrow = to_arrow_type(kind)
    found_schema = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("doc_id", kind), T.StructField("bound", T.LongType())])
    out_schema = T.StructType(
        [T.StructField("item_id", item_kind), T.StructField("rank", T.IntegerType()), T.StructField("doc_id", kind), T.StructField("score", T.LongType())]
    )
    items = benchmark.select("item_id", F.col("text").cast("binary").alias("text")).where(F.length("text") > 0).distinct()
    total = items.agg(F.sum(F.size(F.split(F.col("text").cast("string"), r"[^0-9A-Za-z\x80-\x{10FFFF}]+")))).first()[0]
    blocks = -(-(total or 0) // block_words)
    items = items.withColumn("__block", F.pmod(F.xxhash64("item_id", "text"), F.lit(max(blocks, 1))))
    signatures = index(docs) if signatures is None else signatures
    sizes = signatures.agg(
        F.sum(F.size("n_words")), F.sum(F.aggregate("n_words", F.lit(0).cast("long"), lambda a, n: a + n))
    ).first()
    n_docs, n_words = sizes[0] or 0, sizes[1] or 0

    def scored(pairs: DataFrame, shared, few: bool = False) -> DataFrame:
        """Exact scores of (item, doc_id) pairs, in the column `bound`; rows that share an id are all scored."""
        wanted = pairs.groupBy(F.col("doc_id").alias("__id")).agg(F.collect_set("item").alias("items"))
        wanted = F.broadcast(wanted) if few else wanted
        texts = docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("__id"))).select("doc_id", "text", "items")
        return texts.mapInArrow(_scorer(shared, arrow), found_schema).where("bound > 0")

    results = spark.createDataFrame([], out_schema)
    for block in range(blocks):
        # the words of a block are bounded, so is what the driver and each task hold of it
        held = [(r.item_id, Counter(words_of(bytes(r.text)))) for r in items.where(F.col("__block") == block).collect()]
        held = [(item_id, counts) for item_id, counts in held if counts]
        if not held:
            continue
        vocabulary = frozenset(t for _, counts in held for t in counts)
        rows = docs.select("text").mapInArrow(_holders(vocabulary), "term binary, n long")
        holders = {bytes(r.term): r.n for r in rows.groupBy("term").agg(F.sum("n").alias("n")).collect()}
        weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holders.get(t, 0) + 1))) for t in vocabulary}
        queries = Queries([(i, {t: weight[t] * n for t, n in counts.items()}) for i, counts in held], n_docs, n_words)
        shared = spark.sparkContext.broadcast(queries)

        by_bound = Window.partitionBy("item").orderBy(F.desc("bound"), F.asc_nulls_first("doc_id"))
        bounded = signatures.mapInArrow(_best_bounds(shared, arrow, max(SEEDS, best)), found_schema)
        seeds = bounded.withColumn("__n", F.row_number().over(by_bound)).where(F.col("__n") <= max(SEEDS, best))
        # at most SEEDS rows for each item of the block
        known = scored(seeds, shared, few=True).withColumn("__n", F.row_number().over(by_bound))
        needed = [1] * len(held)
        for row in known.where(F.col("__n") == best).select("item", "bound").collect():
            needed[row.item] = row.bound
        least = spark.sparkContext.broadcast(needed)
        candidates = settle(signatures.mapInArrow(_reaching(shared, least, arrow), found_schema), "candidates")
        ranked = scored(candidates, shared).withColumn("rank", F.row_number().over(by_bound)).where(F.col("rank") <= best)
        names = spark.createDataFrame(
            [(number, item_id) for number, (item_id, _) in enumerate(held)],
            T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", item_kind)]),
        )
        results = results.unionByName(
            ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", F.col("bound").alias("score"))
        )
    return results
