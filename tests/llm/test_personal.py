import itertools
import random
import re
import time

import numpy as np
import pytest

from grantledger.llm import personal as P
from grantledger.llm.common import table
from tests.conftest import TESTDATA
from tests.llm.conftest import ODD

PATTERNS = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]


def plain(text):
    """The patterns as they are written, one after another."""
    out = []
    for kind, pattern in enumerate(PATTERNS, 1):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            holds = {
                P.EMAIL: lambda m=m: True,
                P.IP: lambda m=m: all(int(p) <= 255 for p in m[0].split(".")),
                P.CARD: lambda d=digits: 14 <= len(d) <= 19 and P.luhn(d),
                P.PHONE: lambda d=digits: 10 <= len(d) <= 15,
            }[kind]()
            if holds:
                out.append((m.start(), m.end(), kind))
    return sorted(out, key=lambda s: (s[0], s[2]))


@pytest.mark.parametrize("seed", range(5))
def test_base_spans_match_the_patterns(seed):
    rng = random.Random(seed)
    bits = ["a", "b.", "@", "@x.y", "1", "255", "256", "0.", ".", "+1", "+", "-", " ", "(", ")", "4111111111111111", "555-1234", "é", "\n", "%"]
    for _ in range(600):
        text = "".join(rng.choices(bits, k=rng.randrange(25)))
        assert P.base_spans(text) == plain(text), text


def test_base_spans_of_the_given_texts(spark):
    texts = [r.text or "" for r in table(spark, f"{TESTDATA}/sf0.01", "documents").select("text").collect()]
    assert any(map(plain, texts))
    assert all(P.base_spans(t) == plain(t) for t in texts)


def test_messages_on_a_tree_give_exact_marginals():
    rng = np.random.default_rng(0)
    field = P.Field(rng.normal(size=(3, P.LABELS)), rng.normal(size=(P.LABELS, P.LABELS)), np.eye(P.LABELS) * 2)
    x = rng.normal(size=(4, 3))
    chain, skips, known = np.array([[0, 1], [2, 3]]), np.array([[1, 3]]), np.array([0, 0, P.CARD, 0])
    got = field.marginals(x, chain, skips, known, rounds=60)
    want = np.zeros((4, P.LABELS))
    for labels in itertools.product(range(P.LABELS), repeat=4):
        if labels[2] != P.CARD:
            continue
        score = sum((x[i] @ field.weights)[y] for i, y in enumerate(labels) if i != 2)
        score += sum(field.chain[labels[a], labels[b]] for a, b in chain) + field.skip[labels[1], labels[3]]
        for i, y in enumerate(labels):
            want[i, y] += np.exp(score)
    assert np.allclose(got, want / want.sum(1, keepdims=True), atol=1e-3)


@pytest.fixture(scope="module")
def field(spark):
    return P.train(table(spark, f"{TESTDATA}/sf0.1", "documents").select("doc_id", "text"))


def found(spark, field, text):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = P.find(docs, field).first()
    return [(s.kind, text[s.start : s.end]) for s in row.base], [(s.kind, text[s.start : s.end]) for s in row.added]


def test_field_adds_what_patterns_drop(spark, field):
    base, added = found(spark, field, "anouing +1 (314) 555-6532 4663622617512349 ingeser neehrs.74@mail.example.com x")
    assert base == [("email", "neehrs.74@mail.example.com")]
    assert set(added) == {("phone", "+1 (314) 555-6532"), ("card", "4663622617512349")}


def test_a_distant_repeat_takes_the_label_of_its_like(spark, field):
    text = "write to +1 (314) 555-6532 now" + " and so on" * 50 + " or 555-6532 again"
    _, added = found(spark, field, text)
    assert added == [("phone", "555-6532")]
    assert found(spark, field, "only 555-6532 here and 4663622617512348 or 12.5 of 2024")[1] == []


@pytest.mark.parametrize("at", [0, 25, 50])
def test_a_label_reaches_all_of_many_repeats(spark, field, at):
    mentions = ["or 555-6532 again"] * 50
    mentions.insert(at, "write to +1 (314) 555-6532 now")
    base, added = found(spark, field, " and so on ".join(mentions))
    assert base == [("phone", "+1 (314) 555-6532")]
    assert added == [("phone", "555-6532")] * 50
    assert found(spark, field, " and so on ".join(["or 555-6532 again"] * 50))[1] == []


def test_links_go_to_the_nearest_match():
    assert P.reach([(0, 1), (1, 3), (3, 4)], [1, 0, 0, 0, 2]) == [(0, 1), (1, 3), (3, 4)]
    assert P.reach([(0, 1), (1, 2), (2, 3), (3, 4)], [0, 0, 0, 0, 2]) == [(0, 1), (1, 2), (2, 3), (3, 4), (0, 4), (1, 4), (2, 4)]
    assert P.reach([(0, 1), (1, 5), (2, 3)], [1, 0, 0, 0, 0, 0]) == [(0, 1), (1, 5), (2, 3), (0, 5)]


def test_messages_settle_on_long_chains():
    rng = np.random.default_rng(1)
    field = P.Field(rng.normal(size=(2, P.LABELS)) / 50, np.zeros((P.LABELS, P.LABELS)), np.eye(P.LABELS) * 6)
    x, n = rng.normal(size=(300, 2)), 300
    skips, known = np.array([[i, i + 1] for i in range(n - 1)]), np.zeros(n, np.int64)
    known[0] = P.PHONE
    got = field.marginals(x, np.empty((0, 2), np.int64), skips, known)
    own = np.exp(x @ field.weights)
    own[0] = np.eye(P.LABELS)[P.PHONE]
    ahead, behind, pair = [own[0]], [np.ones(P.LABELS)], np.exp(field.skip)
    for i in range(1, n):
        ahead.append(own[i] * (pair.T @ (ahead[-1] / ahead[-1].sum())))
        behind.append(pair @ (own[n - i] * behind[-1] / behind[-1].sum()))
    want = np.array(ahead) * np.array(behind[::-1])
    assert np.allclose(got, want / want.sum(1, keepdims=True), atol=1e-3)


def test_features_see_the_whole_word():
    whole = lambda core: [bool(re.fullmatch(r"[^@]{1,64}@[^@]+\.[^@]+", core)), any(map(str.isalpha, core))]
    words = ["1@" + "2" * 500 + ".3", "1@" + "2" * 400 + ".3@4", "0" * 300 + "x", "0" * 300, "a@b.c", "@b.c", "a@.c", "a@b.", "a" * 65 + "@b.c"]
    for word in words:
        core = word.strip(P._EDGES)
        assert [P._shape(word)[2], P._shape(word)[-1]] == whole(core), word


def test_clean_texts_stay_clean(spark, field):
    rows = P.find(table(spark, f"{TESTDATA}/sf0.01", "documents").select("doc_id", "text"), field).collect()
    silent = [r for r in rows if not re.search("[0-9@]", r.text or "")]
    assert silent and all(not r.base and not r.added for r in silent)
    assert sum(len(r.added) for r in rows) <= 0.2 * sum(len(r.base) for r in rows)


def test_odd_rows(spark, field, docs_of):
    docs = docs_of([*ODD, (8, "a@b.cd a@b.cd")], base=1, added="x", keep="k")
    rows = P.find(docs, field).collect()
    assert len(rows) == len(ODD) + 1 and {r.keep for r in rows} == {"k"}
    assert [r.all_written for r in rows if r.doc_id == 8] == ["email:0:6,email:7:13"]
    assert all(r.base_written == "" for r in rows if r.doc_id in (1, 2, 3))
    assert P.find(docs.where("false"), field).count() == 0
    empty = P.train(docs.where("false").select("doc_id", "text"))
    assert P.find(docs, empty).count() == len(ODD) + 1


def test_long_runs_take_linear_time():
    start = time.perf_counter()
    for run in ("a" * 400_000, "1" * 400_000, "1." * 200_000, "@" * 200_000, "+1" * 200_000, "a@" * 200_000, "1 " * 200_000):
        P.base_spans(run)
    for run in ("a" * 400_000 + "1", "1" * 400_000):
        P.graph(run, P.candidates(run))
    assert time.perf_counter() - start < 20
