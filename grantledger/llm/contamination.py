"""Benchmark decontamination by a prefix-filtered join of word windows."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from grantledger.llm.common import bounded_batches, with_fields
from grantledger.session import settle

WINDOW = 10
#: Words of the items that a task holds at once; more items are taken in blocks.
BLOCK_WORDS = 200_000

#: Upper case to lower case, what no word holds to a space, byte by byte: all of UTF-8's bytes beyond ASCII are in words.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)

#: word -> {(place of the word in the window, words of the window): {window: ids of its items}}
Index = dict[bytes, dict[tuple[int, int], dict[bytes, list]]]


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(FOLD).split() if text else []


def windows_of(words: list[bytes], size: int = WINDOW) -> list[list[bytes]]:
    """All windows of `size` words; a shorter text is one window, an empty one none."""
    if len(words) <= size:
        return [words] if words else []
    return [words[i : i + size] for i in range(len(words) - size + 1)]


def build_index(items: list[tuple[object, bytes]], counts: dict[bytes, int], size: int = WINDOW) -> Index:
    """Windows by their prefix in the order of rarity.

    A document has to hold all words of a window, so the prefix that any match
    must share is the single rarest word. Its place fixes where a match begins.
    """
    index: Index = {}
    for item, text in items:
        for window in windows_of(words_of(text), size):
            place = min(range(len(window)), key=lambda i: (counts.get(window[i], 0), window[i], i))
            by_place = index.setdefault(window[place], {}).setdefault((place, len(window)), {})
            ids = by_place.setdefault(b" ".join(window), [])
            if not ids or ids[-1] != item:
                ids.append(item)
    return index


def matches(words: list[bytes], index: Index) -> tuple[list[tuple[int, int]], set]:
    """Runs of hit words (start, end) and the ids of the items found."""
    runs: list[tuple[int, int]] = []
    found: set = set()
    n = len(words)
    for at in [i for i, word in enumerate(words) if word in index]:
        for (place, size), windows in index[words[at]].items():
            start = at - place
            if start < 0 or start + size > n:
                continue
            ids = windows.get(b" ".join(words[start : start + size]))
            if ids:
                found.update(ids)
                runs.append((start, start + size))
    return joined(runs), found


def joined(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of runs, as separate runs in order."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(runs):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def _texts(batch: pa.RecordBatch) -> list[bytes | None]:
    return batch.column("text").cast(pa.binary()).to_pylist()


def _counter(vocabulary: frozenset[bytes]) -> Callable:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for text in _texts(batch):
                total.update(filter(vocabulary.__contains__, words_of(text)))
        yield pa.RecordBatch.from_pydict(
            {"word": pa.array(list(total), pa.binary()), "n": pa.array(list(total.values()), pa.int64())}
        )

    return count


def _matcher(index_of, id_kind: pa.DataType) -> Callable:
    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = index_of.value
        for batch in batches:
            n_words, runs, items = [], [], []
            before = zip(batch.column("hit_runs").to_pylist(), batch.column("items").to_pylist(), strict=True)
            for text, (old_runs, old_items) in zip(_texts(batch), before, strict=True):
                words = words_of(text)
                hit, found = matches(words, index)
                n_words.append(len(words))
                runs.append(
                    [{"start": a, "end": b} for a, b in joined(hit + [(r["start"], r["end"]) for r in old_runs])]
                )
                items.append(sorted(found.union(old_items), key=str))
            kept = [n for n in batch.schema.names if n not in ("n_words", "hit_runs", "items")]
            run = pa.struct([("start", pa.int64()), ("end", pa.int64())])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in kept), pa.array(n_words, pa.int64()),
                 pa.array(runs, pa.list_(run)), pa.array(items, pa.list_(id_kind))],
                names=[*kept, "n_words", "hit_runs", "items"],
            )

    return match


def find_items(
    docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """`docs` with `n_words`, `hit_runs` (runs of contaminated words) and `items` (ids of items found).

    Rarity is counted over all documents, for the words of the items. The items
    go to the tasks in blocks of about `block_words` words, each with a pass
    over the documents, so a task's memory does not follow the benchmark's size.

    Null and empty texts have no words; null and empty items have no window. A
    null item id counts as an item of that id. Repeated items and windows count
    once. Repeated documents are treated alike. Columns of the new names in
    `docs` are replaced, other columns pass through; extra columns of the
    benchmark are ignored. An empty table on either side hits nothing.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    kind = benchmark.schema["item_id"].dataType
    items = benchmark.select("item_id", F.col("text").cast("binary").alias("text")).where(
        F.length("text") > 0
    ).distinct()
    total = items.agg(F.sum(F.size(F.split(F.col("text").cast("string"), r"[^0-9A-Za-z\x80-\x{10FFFF}]+")))).first()[0]
    blocks = -(-(total or 0) // block_words) or 1
    items = items.withColumn("__block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    kept = [c for c in docs.columns if c not in ("n_words", "hit_runs", "items")]
    out = docs.select(
        *kept,
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast("array<struct<start:bigint,end:bigint>>").alias("hit_runs"),
        F.array().cast(f"array<{kind.simpleString()}>").alias("items"),
    )
    for block in range(blocks):
        # a block's words are bounded by block_words, so is what the driver and each task hold of it
        held = [(r.item_id, bytes(r.text)) for r in items.where(F.col("__block") == block).collect()]
        vocabulary = frozenset(w for _, text in held for w in words_of(text))
        counted = docs.select("text").mapInArrow(_counter(vocabulary), "word binary, n long")
        rows = counted.groupBy("word").agg(F.sum("n").alias("n")).collect()
        index = build_index(held, {bytes(r.word): r.n for r in rows}, size)
        shared = spark.sparkContext.broadcast(index)
        out = out.mapInArrow(_matcher(shared, to_arrow_type(kind)), out.schema)
        if block + 1 < blocks:
            out = settle(out, "contamination")
    return out


def digest(found: DataFrame) -> DataFrame:
    """`found` with `n_hit`, `n_items`, `items_sha256` and `contaminated`."""
    n_hit = F.aggregate("hit_runs", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.withColumns(
        {
            "n_hit": n_hit,
            "n_items": F.size("items").cast("long"),
            "items_sha256": F.sha2(F.array_join(names, ",", ""), 256),
            "contaminated": n_hit > 0,
        }
    )
