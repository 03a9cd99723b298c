import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from grantledger.llm import codes, queries
from grantledger.llm import tokens as K
from tests.conftest import TESTDATA
from tests.llm.conftest import ODD

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 70), max_size=1500))
def test_any_numbers_come_back(numbers):
    values = np.array(numbers, np.uint32)
    levels = codes.encode(values)
    places = np.random.default_rng(1).permutation(len(values))
    assert (codes.decode(levels, places) == values[places]).all()
    for start in range(0, len(values), 97):
        assert (codes.decode_range(levels, start, len(values)) == values[start:]).all()


def test_widths_are_the_cheapest():
    values = np.random.default_rng(2).integers(0, 50, 900).astype(np.uint32) ** 3

    def bits(parts):
        total, left = 0.0, values
        for i, width in enumerate(parts):
            total += len(left) * (width + (0 if i + 1 == len(parts) else 1 + 32 / codes.BLOCK))
            left = left[left >> np.uint32(width) > 0] >> np.uint32(width)
        return total if not len(left) else float("inf")

    def splits(n):
        return [[n]] + [[k, *rest] for k in range(1, n) for rest in splits(n - k)]

    longest = int(values.max()).bit_length()
    assert bits(codes.widths(values)) == min(map(bits, splits(longest)))


ENCODER = K.Encoder(WORDS)
PIECE = st.sampled_from(
    ["the", "The", "École", "naïve", "ÀÞß", "ÿÑ", "it's", "l'enfant", "'", "'s.", "...", "a—.", "é", "é", "×", "a×b", "12,5", "ß", "ŒUVRE",
     "日本", "<|endoftext|>", "<|startoftext|>x", "<", "|>", " ", "  ", "\n", "\t", " ", " ", "\x85", "\x00", "\x1c", "ª", "µm",
     "İ", "ΣΑΣ", "́", "don't.", "x" * 300, "#!?", "😀"]
)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(PIECE, max_size=12).map("".join) | st.text(max_size=20) | st.none(), max_size=6))
def test_pieces_give_the_ids_of_whole_texts(texts):
    ids, upto = ENCODER(pa.array(texts, pa.string()))
    wanted = [ENCODER.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert ids.tolist() == [i for each in wanted for i in each]
    assert upto.tolist() == np.cumsum([len(w) for w in wanted], dtype=int).tolist()


def test_long_texts_are_cut_at_white_space(monkeypatch):
    monkeypatch.setattr(K, "AT_ONCE", 64)
    texts = ["Word naïve " * 200, "x" * 500, "", "l'été. " * 50 + "y" * 300]
    test_pieces_give_the_ids_of_whole_texts.hypothesis.inner_test(texts)


def test_words_are_forgotten_beyond_a_bound(monkeypatch):
    monkeypatch.setattr(K, "REMEMBERED", 10)
    encoder = K.Encoder(WORDS)
    for i in range(5):
        encoder(pa.array([" ".join(f"w{i}x{j}" for j in range(12))]))
        assert len(encoder.known) <= 10 + 48
    test_pieces_give_the_ids_of_whole_texts.hypothesis.inner_test(["a b c"])


def plain(rows, path, end_id):
    tokenizer, start, out = Tokenizer.from_file(path), 0, []
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, i))
    for i in order:
        ids = [*tokenizer.encode(rows[i][1] or "", add_special_tokens=False).ids, end_id]
        out.append((rows[i][0], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("path", [WORDS, BYTES])
@pytest.mark.parametrize("file_tokens", [1, 5000, K.FILE_TOKENS])
def test_odd_rows_come_back(spark, docs_of, path, file_tokens):
    docs = docs_of(ODD, before="b", n_tokens=3).coalesce(1)
    folder, manifest = K.write(docs, path, 2, file_tokens=file_tokens)
    got = K.read(spark, folder, manifest, docs.schema["doc_id"].dataType)
    assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == plain(ODD, path, 2)
    assert manifest.agg({"documents": "sum"}).first()[0] == len(ODD)


def test_any_token_is_read_by_itself(spark, docs_of):
    rows = [(i, "some words, " * (i % 7) + f"number {i}") for i in range(300)]
    folder, manifest = K.write(docs_of(rows), WORDS, 2, file_tokens=100)
    assert manifest.count() > 3
    store, at = K._filesystem(folder)
    tokenizer = Tokenizer.from_file(WORDS)
    whole = [i for _, t in rows for i in [*tokenizer.encode(t, add_special_tokens=False).ids, 2]]
    for row in manifest.collect():
        held = K.TokenFile(store.open_input_stream(f"{at}/{row.file}").read())
        places = np.random.default_rng(row.number).permutation(held.n_tokens)
        assert held.tokens(places).tolist() == [whole[row.before + p] for p in places]


def test_checksums_of_documents_in_parts(monkeypatch):
    monkeypatch.setattr(K, "READ_AT_ONCE", 7)
    rng = np.random.default_rng(3)
    sizes = rng.integers(1, 30, 40)
    ids = rng.integers(0, 49_408, int(sizes.sum())).astype(np.uint32)
    held = K.TokenFile(K.to_file(pa.array(range(40)), sizes, ids))
    cuts = np.split(ids, np.cumsum(sizes)[:-1])
    assert held.checksums() == [zlib.crc32(c.astype("<u4").tobytes()) for c in cuts]
    assert all((held.document(i) == c).all() for i, c in enumerate(cuts))


def test_files_that_the_manifest_does_not_list_are_ignored(spark, docs_of):
    rows = [(1, "a b"), (2, "c")]
    folder, manifest = K.write(docs_of(rows), WORDS, 2)
    store, at = K._filesystem(folder)
    with store.open_output_stream(f"{at}/99999999-00000000.dac") as out:
        out.write(K.to_file(pa.array([7]), np.array([1]), np.array([2], np.uint32)))
    with store.open_output_stream(f"{at}/00000000-00000000.dac.abc") as out:
        out.write(b"half a file")
    got = K.read(spark, folder, manifest, docs_of(rows).schema["doc_id"].dataType)
    assert sorted(r.doc_id for r in got.collect()) == [1, 2]


def test_empty_table(spark, docs_of):
    folder, manifest = K.write(docs_of([(1, "")]).where("false"), WORDS, 2)
    assert K.read(spark, folder, manifest, docs_of([(1, "")]).schema["doc_id"].dataType).count() == 0


def test_other_bytes_are_refused():
    with pytest.raises(ValueError):
        K.TokenFile(b"something else, and long enough")


def test_query(spark):
    sf_dir = f"{TESTDATA}/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.QUERIES["op13_token_ids"](spark, sf_dir)
    assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == plain(rows, WORDS, 2)
