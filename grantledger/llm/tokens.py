"""Token ids of a corpus in binary files from which any token can be read by itself.

A file holds the ids of consecutive documents as directly addressable codes
(`codes`), the documents' ids and how many tokens each of them has. Files are
numbered in the order of the document ids; a manifest says how many tokens come
before each file.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type
from tokenizers import Tokenizer

from grantledger.llm import codes
from grantledger.llm.common import bounded_batches, shuffle_width, whole_text, with_fields
from grantledger.llm.hashing import hashes_of, joined_bytes, same_bytes
from grantledger.session import settle, shared_dir

#: Tokens after which a file ends, at the end of a document.
FILE_TOKENS = 1 << 22
#: Words whose ids a Python worker remembers; beyond them it starts anew.
REMEMBERED = 1 << 20
#: Bytes of text that are cut into words at once, and tokens that are read at once.
AT_ONCE = 1 << 21
READ_AT_ONCE = 1 << 18

MAGIC = b"DACIDS01"

# fixed values: the rules of a tokenizer none of whose tokens reaches over white space, or over the end of a run of letters
APART_NORMALIZER = {
    "type": "Sequence",
    "normalizers": [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
        {"type": "Lowercase"},
    ],
}
APART_SPLIT = {
    "type": "Sequence",
    "pretokenizers": [
        {
            "type": "Split",
            "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
            "behavior": "Removed",
            "invert": True,
        },
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}

_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes of letters in a plain word: a to z, and two-byte letters that begin with 0xC3.
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = _LETTER[128:192] = _LETTER[0xC3] = True
#: A word with one of these is not plain: an apostrophe, what may begin a special token, all letters beyond U+00FF.
_ODD = np.zeros(256, bool)
_ODD[[ord("'"), ord("<")]] = _ODD[192:] = True
_ODD[0xC3] = False
#: Bytes that byte-level vocabularies write with another sign than the one of that number.
_SIGNS = {b: 256 + i for i, b in enumerate(b for b in range(256) if not (33 <= b <= 126 or 161 <= b != 173))}


def pieces(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, which of them are in pieces, which in runs of letters, and where each piece starts and ends.

    A plain word falls into runs of letters and runs of other signs; any other
    word is one piece, in its own case.
    """
    inside = ~_SPACE[data]
    before = np.concatenate([[False], inside[:-1]])
    word = np.cumsum(inside & ~before)
    second = np.concatenate([[False], data[:-1] == 0xC3])
    odd = np.zeros(int(word[-1]) + 1 if len(word) else 1, bool)
    odd[word[_ODD[data] | (second & ((data == 0x97) | (data == 0xB7)))]] = True  # the signs of times and division
    plain = inside & ~odd[word]
    data = np.where(plain, np.where(second & (data < 0x9F), data | 0x20, _LOWER[data]), data)
    letter = plain & _LETTER[data]
    turns = np.concatenate([[False], letter[1:] != letter[:-1]])
    begins = inside & (~before | (plain & turns))
    ends = inside & np.concatenate([~inside[1:] | begins[1:], [True]])
    return data, inside, letter, np.flatnonzero(begins), np.flatnonzero(ends) + 1


class Encoder:
    """The ids of whole columns of texts, as the tokenizer gives them for each text without special tokens around it."""

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        rules = json.loads(self.tokenizer.to_str())
        own = all(t["content"].startswith("<") and not t["lstrip"] and not t["rstrip"] for t in rules["added_tokens"])
        #: whether pieces may be encoded by themselves; texts of other tokenizers are encoded whole
        self.apart = own and rules["normalizer"] == APART_NORMALIZER and rules["pre_tokenizer"] == APART_SPLIT
        self.known: dict[bytes, bytes] = {}  # the ids as 32-bit numbers

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and for each text the number of them up to its end. Null counts as empty."""
        if not self.apart:
            return self._whole(column)
        data, text_ends = joined_bytes(column)
        found, upto, lo = [], np.zeros(len(text_ends), np.int64), 0
        total = 0
        while lo < len(data):
            hi = _after_space(data, lo + AT_ONCE)
            part = self._by_pieces(data[lo:hi])
            if part is None:  # two pieces share a hash
                return self._whole(column)
            ids, starts, ids_before = part
            here = slice(*np.searchsorted(text_ends, [lo, hi]))
            upto[here] = total + ids_before[np.searchsorted(starts, text_ends[here] - lo)]
            found.append(ids)
            total += len(ids)
            lo = hi
        return np.concatenate([np.empty(0, np.uint32), *found]), upto

    def _whole(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        each = [
            np.array(self.tokenizer.encode(text or "", add_special_tokens=False).ids, np.uint32)
            for text in column.to_pylist()
        ]
        return np.concatenate([np.empty(0, np.uint32), *each]), np.cumsum([len(ids) for ids in each], dtype=np.int64)

    def _by_pieces(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        """Ids, the places of the pieces, and the number of ids before each of them and after the last."""
        data, inside, letter, starts, ends = pieces(data)
        if not len(starts):
            return np.empty(0, np.uint32), starts, np.zeros(1, np.int64)
        packed = data[inside]
        _, first, which = np.unique(hashes_of(packed, ends - starts), return_index=True, return_inverse=True)
        if not same_bytes(packed, ends - starts, first[which]):
            return None
        raw, begins = data.tobytes(), starts[first]
        words = [raw[a:b] for a, b in zip(begins.tolist(), ends[first].tolist(), strict=True)]
        ids = self._ids(words, letter[begins].tolist())
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) >> 2
        flat, begin = np.frombuffer(b"".join(ids), np.uint32), np.cumsum(sizes) - sizes
        upto = np.cumsum(sizes[which])
        before = np.concatenate([np.zeros(1, np.int64), upto])
        return flat[np.arange(upto[-1]) + np.repeat(begin[which] - before[:-1], sizes[which])], starts, before

    def _ids(self, words: list[bytes], are_letters: list[bool]) -> list[bytes]:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known, tokenize = self.known, self.tokenizer.model.tokenize
        new = [(word, letters) for word, letters in zip(words, are_letters, strict=True) if word not in known]
        for word, letters in new:
            if letters:  # the rules leave a run of lower-case letters as it is
                shown = word.decode("latin-1")
                shown = shown if shown.isascii() else shown.translate(_SIGNS)
                known[word] = array("I", [token.id for token in tokenize(shown)]).tobytes()
        others = [word for word, letters in new if not letters]
        encoded = self.tokenizer.encode_batch_fast([w.decode() for w in others], add_special_tokens=False)
        known.update((word, array("I", e.ids).tobytes()) for word, e in zip(others, encoded, strict=True))
        return [known[word] for word in words]


def _after_space(data: np.ndarray, at: int) -> int:
    """The place after the first white space at or after `at`."""
    while at < len(data):
        found = np.flatnonzero(_SPACE[data[at : at + 65536]])
        if len(found):
            return at + int(found[0]) + 1
        at += 65536
    return len(data)


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    """One for each Python worker, as it remembers words from task to task."""
    return Encoder(path)


def to_file(doc_ids: pa.Array, sizes: np.ndarray, ids: np.ndarray) -> bytes:
    """A file's bytes: a header that says where each part lies, and the parts."""
    index = pa.RecordBatch.from_arrays([doc_ids, pa.array(sizes, pa.int64())], names=["doc_id", "n_tokens"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, index.schema) as stream:
        stream.write_batch(index)
    parts: list[bytes] = []

    def put(part: bytes) -> list[int]:
        begin = sum(map(len, parts))
        parts.append(part + bytes(-len(part) % 8))
        return [begin, len(part)]

    header: dict = {"n_tokens": len(ids), "index": put(sink.getvalue().to_pybytes()), "levels": []}
    for level in codes.encode(ids):
        more = {} if level.bits is None else {"bits": put(level.bits.tobytes()), "before": put(level.before.tobytes())}
        header["levels"].append({"width": level.width, "chunks": put(level.chunks.tobytes()), **more})
    head = json.dumps(header).encode()
    head += b" " * (-len(head) % 8)
    return b"".join([MAGIC, struct.pack("<q", len(head)), head, *parts])


class TokenFile:
    """A file read back. `tokens` gives any of its tokens without decoding others, `document` those of one."""

    def __init__(self, content: bytes) -> None:
        if content[:8] != MAGIC:
            raise ValueError("not a token file")
        size = struct.unpack("<q", content[8:16])[0]
        header = json.loads(content[16 : 16 + size])

        def part(place: list[int], kind: type = np.uint8) -> np.ndarray:
            begin = 16 + size + place[0]
            return np.frombuffer(content, np.uint8, place[1], begin).view(kind)

        self.n_tokens: int = header["n_tokens"]
        index = pa.ipc.open_stream(part(header["index"]).tobytes()).read_all().combine_chunks()
        self.doc_ids = index.column("doc_id").combine_chunks()
        self.sizes = index.column("n_tokens").to_numpy()
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.levels = [
            codes.Level(
                level["width"],
                part(level["chunks"]),
                part(level["bits"]) if "bits" in level else None,
                part(level["before"], np.uint32) if "before" in level else None,
            )
            for level in header["levels"]
        ]

    def tokens(self, places: np.ndarray) -> np.ndarray:
        return codes.decode(self.levels, places)

    def document(self, number: int) -> np.ndarray:
        start = int(self.starts[number])
        return codes.decode_range(self.levels, start, start + int(self.sizes[number]))

    def checksums(self) -> list[int]:
        """The CRC-32 of each document's ids as little-endian 32-bit numbers, reading a bounded part of the file at once."""
        sums, number = [0] * len(self.sizes), 0
        ends = (self.starts + self.sizes).tolist()
        for lo in range(0, self.n_tokens, READ_AT_ONCE):
            hi = min(lo + READ_AT_ONCE, self.n_tokens)
            part = memoryview(codes.decode_range(self.levels, lo, hi).astype("<u4")).cast("B")
            at = lo
            while at < hi:
                upto = min(ends[number], hi)
                sums[number] = zlib.crc32(part[4 * (at - lo) : 4 * (upto - lo)], sums[number])
                number += upto == ends[number]
                at = upto
        return sums


def _filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a Hadoop address, as Arrow knows it."""
    if uri.startswith("file:"):
        uri = re.sub("^file:/*", "/", uri)
    return fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", uri))


def _writer(tokenizer: str, end_id: int, folder: str, file_tokens: int) -> Callable:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = _encoder(tokenizer), TaskContext.get().partitionId()
        store, at = _filesystem(folder)
        rows: list[tuple] = []
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []

        def flush() -> None:
            doc_ids, sizes, ids = (
                pa.concat_arrays([h[0] for h in held]), *(np.concatenate([h[i] for h in held]) for i in (1, 2))
            )
            content = to_file(doc_ids, sizes, ids)
            name = f"{part:08d}-{len(rows):08d}.dac"
            # whole or not at all: a task that is repeated puts the same file in its place
            aside = f"{at}/{name}.{uuid.uuid4().hex}"
            with store.open_output_stream(aside) as out:
                out.write(content)
            store.move(aside, f"{at}/{name}")
            rows.append((name, part, len(rows), len(sizes), len(ids), len(content)))
            held.clear()

        for batch in batches:
            ids, upto = encoder(batch.column("text"))
            # the end id after each document
            ids = np.insert(ids, upto, np.uint32(end_id))
            held.append((batch.column("doc_id"), np.diff(upto, prepend=0) + 1, ids))
            if sum(len(h[2]) for h in held) >= file_tokens:
                flush()
        if held:
            flush()
        yield pa.RecordBatch.from_pylist(
            [dict(zip(_MANIFEST.names, row, strict=True)) for row in rows], schema=_MANIFEST
        )

    return write


_MANIFEST = pa.schema(
    [("file", pa.string()), ("part", pa.int32()), ("number", pa.int32()), ("documents", pa.int64()),
     ("tokens", pa.int64()), ("bytes", pa.int64())]
)


def write(
    docs: DataFrame, tokenizer: str, end_id: int, folder: str | None = None, file_tokens: int = FILE_TOKENS
) -> tuple[str, DataFrame]:
    """Write the ids of all texts, `end_id` after each; gives the folder and the manifest.

    The manifest has a row for each file: `file`, `part`, `number`, `documents`,
    `tokens`, `bytes` and `before`, the tokens of all files before it. Only what
    it lists counts; files of a task that was lost are overwritten or ignored.

    Documents follow in ascending doc_id, null first, equal ids in the order of
    the input; ranges of ids are dealt to the tasks, a long run of one id to
    several. A null text is empty: its only token is the end id. A document is
    never cut, so a file has at least one, however long. Other columns are not
    read. An empty table has no file.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    folder = folder or f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/tokens-{uuid.uuid4().hex}"
    store, at = _filesystem(folder)
    store.create_dir(at, recursive=True)
    rows = docs.select("doc_id", whole_text().alias("text"), F.monotonically_increasing_id().alias("__input"))
    ordered = rows.repartitionByRange(shuffle_width(spark), "doc_id", "__input").sortWithinPartitions("doc_id", "__input")
    written = ordered.select("doc_id", "text").mapInArrow(
        _writer(tokenizer, end_id, folder, file_tokens),
        "file string, part int, number int, documents long, tokens long, bytes long",
    )
    files = settle(written, "token-files")
    # one row for each part, so as many as there are shuffle partitions
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = files.groupBy("part").agg(F.sum("tokens").alias("__n")).select(
        "part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start")
    )
    inside = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    manifest = files.withColumn("before", F.coalesce(F.sum("tokens").over(inside), F.lit(0))).join(parts, "part")
    return folder, manifest.withColumn("before", F.col("before") + F.col("__start")).drop("__start")


def _digests(id_kind: pa.DataType) -> Callable:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("file").to_pylist(), batch.column("content"), strict=True):
                held = TokenFile(content.as_py())
                sums = held.checksums()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(sums), pa.string()), held.doc_ids.cast(id_kind), pa.array(held.starts, pa.int64()),
                     pa.array(held.sizes, pa.int64()), pa.array(sums, pa.int64())],
                    names=["file", "doc_id", "place", "n_tokens", "ids_crc32"],
                )

    return read


def read(spark: SparkSession, folder: str, manifest: DataFrame, id_kind: T.DataType) -> DataFrame:
    """What the files hold of each document: `doc_id`, `start` (tokens of all documents before it), `n_tokens` with the
    end id, `ids_crc32` of the ids as little-endian 32-bit numbers.
    """
    bounded_batches(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.dac").load(folder).select(
        F.element_at(F.split("path", "/"), -1).alias("file"), "content"
    )
    schema = with_fields(
        T.StructType([T.StructField("file", T.StringType()), T.StructField("doc_id", id_kind)]),
        ("place", "long"), ("n_tokens", "long"), ("ids_crc32", "long"),
    )
    found = files.mapInArrow(_digests(to_arrow_type(id_kind)), schema)
    return found.join(manifest.select("file", "before"), "file").select(
        "doc_id", (F.col("before") + F.col("place")).alias("start"), "n_tokens", "ids_crc32"
    )
