"""Removal of repeated byte strings: suffixes are told apart by passes over their first bytes only.

Every window of `length` bytes is a suffix cut at the threshold. A pass deals
digits of the windows out by their most significant bits, sorts each bucket and
keeps the windows whose digit stands in another place too; the next pass takes
a longer digit of those alone. The first digit is the rarest half of a window
(its least hash), which neighbouring windows share, so few digits stand for all
bytes. The last digit has two independent 64-bit hashes of the whole window, so
windows that differ fall together as rarely as 128 random bits do. After the
last pass the groups of equal windows are the repeated ones.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantledger.llm.common import bounded_batches, shuffle_width
from grantledger.llm.hashing import mixed
from grantledger.session import settle, shared_dir

#: Bytes of a string that may not stand twice.
LENGTH = 200
#: Texts are worked on in groups of about so many bytes, and buckets take the digits of about as many.
GROUP_BYTES = 4 << 20
BUCKET_BYTES = 16 << 20
#: Bytes hashed at once; longer texts are cut into overlapping parts.
PART_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_BYTE = mixed(np.arange(1, 257, dtype=np.uint64))
# of the second hash
_BASE2 = 0xD6E8FEB86659FD93
_BYTE2 = mixed(np.arange(1001, 1257, dtype=np.uint64))


def _power(n: int, base: int = _BASE) -> np.uint64:
    return np.uint64(pow(base, n, 1 << 64))


def rolling(values: np.ndarray, length: int, base: int = _BASE) -> np.ndarray:
    """The polynomial hash of the `length` values from each place on, by doubling."""
    if len(values) < length:
        return np.empty(0, np.uint64)
    out, done, block, size = None, 0, values, 1
    while True:
        if length & size:
            out = block if out is None else out[: len(block) - done] * _power(size, base) + block[done:]
            done += size
        if size * 2 > length:
            return out
        block = block[:-size] * _power(size, base) + block[size:]
        size *= 2


def sliding(values: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """The best of the `width` values from each place on."""
    if len(values) < width:
        return values[:0]
    size, block = 1, values
    while size * 2 <= width:
        block = best(block[:-size], block[size:])
        size *= 2
    rest = width - size
    return best(block[: len(block) - rest], block[rest:]) if rest else block


class Part:
    """Some bytes of a group, hashed: windows that start in them and lie within one text."""

    def __init__(self, data: np.ndarray, ends: np.ndarray, owned: np.ndarray, at: np.ndarray, length: int) -> None:
        """`ends`: for each byte, how many follow to the end of its text, itself included; `at`: its place in the group."""
        half = length // 2
        self.length, self.at, self.data = length, at, data
        values = _BYTE[data]
        halves = rolling(values, half)
        if length == 2 * half:
            whole = halves[: max(len(halves) - half, 0)] * _power(half) + halves[half:]
        else:
            whole = rolling(values, length)
        self.windows = mixed(whole)
        n = len(self.windows)
        self.fits = ends[:n] >= length
        self.owned = owned
        halves = mixed(halves)
        least = sliding(halves, length - half + 1, np.minimum)[:n]
        self.least = least
        # a place is the least of some window if the largest of its windows' least hashes is its own
        wide = length - half
        padded = np.concatenate([np.zeros(wide, np.uint64), np.where(self.fits, least, np.uint64(0)), np.zeros(wide, np.uint64)])
        largest = sliding(padded, wide + 1, np.maximum)[: len(halves)]
        places = np.flatnonzero((largest == halves[: len(largest)]) & (largest > 0))
        self.digits = halves[places[owned[places]]]

    def candidates(self, known: np.ndarray) -> np.ndarray:
        """Starts of the windows whose first digit is one of `known` (sorted)."""
        if not len(self.least) or not len(known):
            return np.empty(0, np.int64)
        heads = np.flatnonzero(np.concatenate([[True], self.least[1:] != self.least[:-1]]))
        value = self.least[heads]
        where = np.minimum(np.searchsorted(known, value), len(known) - 1)
        hit = np.repeat(known[where] == value, np.diff(np.concatenate([heads, [len(self.least)]])))
        return np.flatnonzero(hit & self.fits & self.owned[: len(hit)])


    def digits_of(self, starts: np.ndarray) -> np.ndarray:
        """Both hashes of the windows that start there; few windows are hashed by themselves."""
        if len(starts) * 20 < len(self.data):
            powers = np.array([_power(self.length - 1 - i, _BASE2) for i in range(self.length)])
            step = max(PART_BYTES // self.length, 1)
            cuts = range(0, len(starts), step)
            within = np.arange(self.length)
            found = [(_BYTE2[self.data[starts[c : c + step, None] + within]] * powers).sum(1, dtype=np.uint64) for c in cuts]
            second = np.concatenate([np.empty(0, np.uint64), *found])
        else:
            second = rolling(_BYTE2[self.data], self.length, _BASE2)[starts]
        return np.stack([self.windows[starts], mixed(second)], 1)


def parts(texts: list[bytes], length: int, most: int = PART_BYTES) -> Iterator[Part]:
    """A group's bytes in parts; a long text's parts overlap by what windows and their digits need."""
    held: list[tuple[bytes, int, int, int, int]] = []  # text, from, to, first owned, place of the text in the group
    size = place = 0
    for text in texts:
        for start in range(0, len(text), most):
            low, high = max(start - length, 0), min(start + most + length, len(text))
            held.append((text, low, high, start, place))
            size += high - low
            if size >= most:
                yield _part(held, length, most)
                held, size = [], 0
        place += len(text)
    if held:
        yield _part(held, length, most)


def _part(held: list[tuple[bytes, int, int, int, int]], length: int, most: int) -> Part:
    data = np.frombuffer(b"".join(text[a:b] for text, a, b, _, _ in held), np.uint8)
    ends, owned, at = [], [], []
    for _, a, b, start, place in held:
        there = np.arange(a, b)
        ends.append(b - there)
        owned.append((there >= start) & (there < start + most))
        at.append(there + place)
    return Part(data, np.concatenate(ends), np.concatenate(owned), np.concatenate(at), length)


def _counted(values: list[np.ndarray], words: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct digits of so many words in order, which of them stand more than once, and the place of each among them."""
    found = np.concatenate([np.empty((0, words), np.uint64), *(v.reshape(-1, words) for v in values)])
    order = np.lexsort(found.T[::-1])
    ordered = found[order]
    head = np.ones(len(found), bool)
    head[1:] = (ordered[1:] != ordered[:-1]).any(1)
    place = np.empty(len(found), np.int64)
    place[order] = np.cumsum(head) - 1
    starts = np.flatnonzero(head)
    return ordered[starts], np.diff(np.append(starts, len(found))) > 1, place


def _dealt(distinct: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's values begin in a sorted array, by the most significant bits."""
    of = ((distinct[:, 0] >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    return np.searchsorted(of, np.arange(buckets + 1, dtype=np.uint64))


_SENT = "g long, bucket int, digits binary, twice binary"
_ANSWER = "g long, step int, bucket int, repeated binary"
_FOUND = "__k long, __k2 long, spans array<struct<start:bigint,end:bigint>>, n_removed long, kept_sha256 string"


def _sent(group: int, distinct: np.ndarray, twice: np.ndarray, buckets: int) -> pa.Table:
    """A row for each bucket: its digits, byte by byte most significant first, and flags."""
    edges = _dealt(distinct, buckets)
    some = np.flatnonzero(np.diff(edges))
    big = distinct.astype(">u8").view(np.uint8).reshape(len(distinct), 8 * distinct.shape[1])
    return pa.table({
        "g": pa.array(np.full(len(some), group, np.int64)),
        "bucket": pa.array(some.astype(np.int32)),
        "digits": pa.array([big[edges[b] : edges[b + 1]].T.tobytes() for b in some], pa.binary()),
        "twice": pa.array([np.packbits(twice[edges[b] : edges[b + 1]]).tobytes() for b in some], pa.binary()),
    })


def _answers(step: int) -> Callable:
    def answers(table: pa.Table) -> pa.Table:
        """Which digits of each group stand in some other place of the whole table."""
        # the digits of step 1 have one word, those of step 2 have two
        digits = [
            np.ascontiguousarray(np.frombuffer(d, np.uint8).reshape(8 * step, -1).T).view(">u8").astype(np.uint64)
            for d in table.column("digits").to_pylist()
        ]
        sizes = [len(d) for d in digits]
        twice = np.concatenate([
            np.unpackbits(np.frombuffer(t, np.uint8), count=n).astype(bool)
            for t, n in zip(table.column("twice").to_pylist(), sizes, strict=True)
        ])
        _, many, place = _counted(digits, step)
        again = many | (np.bincount(place, weights=twice, minlength=len(many)) > 0)
        repeated = again[place]
        cuts = np.cumsum([0, *sizes])
        return pa.table({
            "g": table.column("g").cast(pa.int64()),
            "step": pa.array(np.full(len(sizes), step, np.int32)),
            "bucket": table.column("bucket").cast(pa.int32()),
            "repeated": pa.array([np.packbits(repeated[a:b]).tobytes() for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary()),
        })

    return answers


def _marked(distinct: np.ndarray, buckets: int, answers: dict[int, bytes]) -> np.ndarray:
    """Which of the distinct digits the answers call repeated."""
    edges = _dealt(distinct, buckets)
    out = np.zeros(len(distinct), bool)
    for bucket, bits in answers.items():
        a, b = edges[bucket], edges[bucket + 1]
        out[a:b] = np.unpackbits(np.frombuffer(bits, np.uint8), count=int(b - a)).astype(bool)
    return out


def _answers_of(table: pa.Table, step: int) -> dict[int, bytes]:
    rows = zip(*(table.column(c).to_pylist() for c in ("step", "bucket", "repeated")), strict=True)
    return {bucket: bits for of, bucket, bits in rows if of == step}


def _texts(table: pa.Table) -> tuple[np.ndarray, list[bytes]]:
    """A group's texts in an order that does not depend on how they came."""
    order = np.lexsort((table.column("__k2").to_numpy(), table.column("__k").to_numpy()))
    return order, [t.as_py() for t in table.column("text").take(pa.array(order))]


def _parts(texts: list[bytes], length: int) -> Callable[[], Iterable[Part]]:
    """A group's parts as often as wanted; made once if they are few, as all but groups of one long text are."""
    if sum(map(len, texts)) <= 2 * GROUP_BYTES:
        held = list(parts(texts, length))
        return lambda: held
    return lambda: parts(texts, length)


def _first(length: int, buckets: int) -> Callable:
    def first(table: pa.Table) -> pa.Table:
        _, texts = _texts(table)
        distinct, twice, _ = _counted([part.digits for part in parts(texts, length)])
        return _sent(table.column("g")[0].as_py(), distinct, twice, buckets)

    return first


def _windows(texts: list[bytes], answers: pa.Table, length: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and place of the windows that the first pass left."""
    of_group, known = _answers_of(answers, 1), np.empty(0, np.uint64)
    again = _parts(texts, length) if of_group else list
    if of_group:
        distinct, _, _ = _counted([part.digits for part in again()])
        known = distinct[_marked(distinct, buckets, of_group), 0]
    hashes, places = [np.empty((0, 2), np.uint64)], [np.empty(0, np.int64)]
    if len(known):
        for part in again():
            starts = part.candidates(known)
            hashes.append(part.digits_of(starts))
            places.append(part.at[starts])
    return np.concatenate(hashes), np.concatenate(places)


def _second(length: int, buckets: int) -> Callable:
    def second(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _sent(0, np.empty((0, 2), np.uint64), np.empty(0, bool), buckets)
        _, texts = _texts(table)
        hashes, _ = _windows(texts, answers, length, buckets)
        distinct, twice, _ = _counted([hashes], 2)
        return _sent(table.column("g")[0].as_py(), distinct, twice, buckets)

    return second


def covered(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """The union of the windows at these starts (sorted), as maximal runs."""
    if not len(starts):
        return []
    breaks = np.flatnonzero(np.diff(starts) > length)
    return list(zip(
        starts[np.concatenate([[0], breaks + 1])].tolist(),
        (starts[np.concatenate([breaks, [len(starts) - 1]])] + length).tolist(), strict=True,
    ))


def kept(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    edges = [0, *(e for span in spans for e in span), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def _third(length: int, buckets: int) -> Callable:
    def third(table: pa.Table, answers: pa.Table) -> pa.Table:
        order, texts = _texts(table) if table.num_rows else (np.empty(0, np.int64), [])
        hashes, places = _windows(texts, answers, length, buckets)
        distinct, _, place = _counted([hashes], 2)
        places = np.sort(places[_marked(distinct, buckets, _answers_of(answers, 2))[place]])
        copies = table.column("copies").take(pa.array(order)).to_pylist() if texts else []
        edges = np.cumsum([0, *map(len, texts)])
        cuts = np.searchsorted(places, edges)
        spans = [
            [(0, len(text))] if n > 1 and len(text) >= length else covered(places[a:b] - at, length)
            for text, n, a, b, at in zip(texts, copies, cuts, cuts[1:], edges, strict=False)
        ]
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.table({
            "__k": table.column("__k").take(pa.array(order)).cast(pa.int64()),
            "__k2": table.column("__k2").take(pa.array(order)).cast(pa.int64()),
            "spans": pa.array([[{"start": a, "end": b} for a, b in s] for s in spans], span),
            "n_removed": pa.array([sum(b - a for a, b in s) for s in spans], pa.int64()),
            "kept_sha256": pa.array([sha256(kept(t, s)).hexdigest() for t, s in zip(texts, spans, strict=True)], pa.string()),
        })

    return third


def _once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text of a batch once, with its number of copies there."""
    for batch in batches:
        keys = np.stack([batch.column("__k").to_numpy(), batch.column("__k2").to_numpy()], 1)
        _, first, counts = np.unique(keys, axis=0, return_index=True, return_counts=True)
        rows = batch.take(pa.array(first))
        yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(counts)], names=[*rows.schema.names, "copies"])


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """`docs` with `n_bytes`, `spans`, `n_removed`, `kept_sha256`: what no other place repeats for `length` bytes.

    A byte goes if a string of `length` bytes over it starts in another place
    too, of this or any other text; strings may overlap. Spans are maximal runs
    of removed bytes, in bytes of the UTF-8 text. A null text counts as empty;
    a text shorter than `length` keeps all its bytes; of texts that agree as a
    whole, nothing is kept. Columns of the new names are replaced, other
    columns pass through; an empty table gives an empty table.

    Each different text is dealt out once, into groups of a fixed size that are
    written as buckets, so that later passes find them without a shuffle. Between
    the passes go digits, each once for a group, and answers of one bit.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.drop("n_bytes", "spans", "n_removed", "kept_sha256")
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = rows.withColumns({
        "__k": F.xxhash64(text), "__k2": F.xxhash64(F.lit(1), text), "n_bytes": F.octet_length(text).cast("long"),
    }).withColumn("__own", F.when(F.col("n_bytes") < length, F.sha2(text, 256)))
    long_ = keyed.where(F.col("n_bytes") >= length)
    total = long_.agg(F.sum("n_bytes")).first()[0] or 0
    width = shuffle_width(spark)
    groups = max(-(-total // GROUP_BYTES), width)
    buckets = max(-(-total // BUCKET_BYTES), width)

    sent = long_.select("__k", "__k2", F.col("text").cast("binary").alias("text"))
    sent = sent.mapInArrow(_once, "__k long, __k2 long, text binary, copies long")
    dealt = sent.withColumn("g", F.pmod("__k", F.lit(groups))).repartition(width, "g")
    distinct = dealt.groupBy("g", "__k", "__k2").agg(F.first("text").alias("text"), F.sum("copies").alias("copies"))
    name = f"texts_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}"
    distinct.write.bucketBy(width, "g").option("path", path).saveAsTable(name)
    texts = spark.table(name)

    first = texts.groupBy("g").applyInArrow(_first(length, buckets), _SENT)
    answers = settle(first.groupBy("bucket").applyInArrow(_answers(1), _ANSWER), "answers")
    second = texts.groupBy("g").cogroup(answers.groupBy("g")).applyInArrow(_second(length, buckets), _SENT)
    more = settle(second.groupBy("bucket").applyInArrow(_answers(2), _ANSWER), "answers")
    both = answers.union(more)
    found = settle(texts.groupBy("g").cogroup(both.groupBy("g")).applyInArrow(_third(length, buckets), _FOUND), "spans")

    joined = keyed.join(found, ["__k", "__k2"], "left")
    return joined.select(
        *rows.columns,
        "n_bytes",
        F.coalesce("spans", F.array().cast("array<struct<start:bigint,end:bigint>>")).alias("spans"),
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("kept_sha256", "__own").alias("kept_sha256"),
    )
