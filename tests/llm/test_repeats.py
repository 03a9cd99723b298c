import random
from collections import Counter
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from grantledger.llm import repeats as R
from tests.llm.conftest import ODD


def plain(texts, length):
    counts = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if counts[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = []
        for i, g in enumerate(gone):
            if g and spans and spans[-1][1] == i:
                spans[-1] = (spans[-1][0], i + 1)
            elif g:
                spans.append((i, i + 1))
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out.append((len(t), spans, sum(gone), sha256(kept).hexdigest()))
    return out


def check(docs_of, rows, length):
    got = R.repeated_spans(docs_of(rows, spans="mine", n_removed=1), length).collect()
    texts = [(text or "").encode() for _, text in rows]
    want = Counter((doc, n, tuple(s), k, h) for (doc, _), (n, s, k, h) in zip(rows, plain(texts, length), strict=True))
    assert Counter((r.doc_id, r.n_bytes, tuple((s.start, s.end) for s in r.spans), r.n_removed, r.kept_sha256) for r in got) == want


@pytest.mark.parametrize("length", [7, 8, 20, 31])
@pytest.mark.parametrize("part", [64, 1 << 20])
def test_random_texts(docs_of, monkeypatch, length, part):
    """Few letters, copied passages, runs of one letter and of a short period; parts that cut texts."""
    monkeypatch.setattr(R.parts, "__defaults__", (part,))
    rng = random.Random(length * part)
    passages = ["".join(rng.choices("abé", k=rng.randrange(length // 2, 3 * length))) for _ in range(6)]
    rows = []
    for i in range(120):
        bits = [rng.choice([rng.choice(passages), "".join(rng.choices("abcdefgh日", k=rng.randrange(30))), "ab" * rng.randrange(12), "z" * rng.randrange(40)]) for _ in range(rng.randrange(5))]
        rows.append((i, "".join(bits)))
    rows += [(1000 + i, rows[i][1]) for i in range(5)] + [(2000, "unlike " + "qwertyuiopasdfghjklzxcvbnm" * 1)]
    check(docs_of, rows, length)


def test_threshold_of_two_hundred(docs_of):
    rng = random.Random(9)
    own = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz     ", k=n))
    p, q, copy = own(200), own(199), own(700)
    rows = [(1, own(300) + p + own(10)), (2, p + own(900)), (3, q + "1" + own(400)), (4, own(250) + q + "2" + own(100)),
            (5, copy), (6, copy), (7, copy[:650] + own(50)), (8, own(5000)), (9, "ab" * 300)]
    check(docs_of, rows, 200)


def test_odd_rows(spark, docs_of):
    check(docs_of, [*ODD, *ODD], 20)
    assert R.repeated_spans(docs_of(ODD).where("false")).count() == 0
    check(docs_of, [(1, None), (2, "")], 20)


def test_rolling_hashes_and_sliding_bests():
    rng = np.random.default_rng(0)
    values = R._BYTE[rng.integers(0, 256, 300)]
    for length in (1, 2, 3, 10, 100, 127, 200, 300):
        for at in (0, 299 - length, 300 - length):
            if at >= 0:
                want = 0
                for v in values[at : at + length]:
                    want = (want * R._BASE + int(v)) % (1 << 64)
                assert int(R.rolling(values, length)[at]) == want
    assert len(R.rolling(values, 301)) == 0
    for width in (1, 2, 3, 50, 101):
        assert R.sliding(values, width, np.minimum).tolist() == [values[i : i + width].min() for i in range(301 - width)]


def test_windows_of_one_hash_that_differ_are_no_repeats():
    digits = lambda *rows: np.array(rows, np.uint64)
    distinct, twice, place = R._counted([digits((5, 1), (5, 2)), digits((5, 2), (4, 9))], 2)
    assert distinct.tolist() == [[4, 9], [5, 1], [5, 2]] and twice.tolist() == [False, False, True]
    assert place.tolist() == [1, 2, 2, 0]
    groups = [digits((5, 1), (7, 3)), digits((5, 2), (7, 3))]
    sent = pa.concat_tables([R._sent(g, d, np.zeros(2, bool), 1) for g, d in enumerate(groups)])
    answers = R._answers(2)(sent)
    got = {g: R._marked(groups[g], 1, R._answers_of(answers.filter(pc.equal(answers["g"], g)), 2)).tolist() for g in (0, 1)}
    assert got == {0: [False, True], 1: [False, True]}


@pytest.mark.parametrize("length", [3, 8, 200])
def test_both_hashes_agree_on_equal_windows_only(length):
    rng = random.Random(length)
    text = bytes(rng.choices(b"ab", k=4000)) + bytes(range(256)) * 40
    part, = R.parts([text], length)
    starts = np.flatnonzero(part.fits)
    few = starts[:: len(starts) // 50]
    both = part.digits_of(starts)
    assert (part.digits_of(few) == both[few]).all()
    windows = [text[i : i + length] for i in starts]
    assert len(set(windows)) == len(np.unique(both[:, 0])) == len(np.unique(both[:, 1]))
