import random
import re

import pytest

from grantledger.llm import contamination as C
from tests.llm.conftest import ODD

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(text, items, size=10):
    doc, hit, found = words(text), set(), set()
    for item, body in items:
        own = words(body)
        k = min(size, len(own))
        for window in {tuple(own[i : i + k]) for i in range(len(own) - k + 1)} if k else ():
            for i in range(len(doc) - k + 1):
                if tuple(doc[i : i + k]) == window:
                    hit.update(range(i, i + k))
                    found.add(item)
    return len(doc), len(hit), sorted(found)


def result(found):
    return [(r.doc_id, r.n_words, sum(h.end - h.start for h in r.hit_runs), sorted(r["items"])) for r in found.collect()]


@pytest.mark.parametrize("block_words", [200_000, 25])
def test_random_texts(spark, docs_of, block_words):
    rng = random.Random(block_words)
    vocabulary = ["a", "B", "c", "É", "ß", "x9", "日"]
    text = lambda n: "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n", "--"]) for _ in range(n))
    items = [(i, text(rng.choice([0, 1, 3, 12, 16]))) for i in range(8)]
    items += [(8, items[3][1]), (3, items[3][1]), (9, None)]
    docs = [(i, text(rng.choice([0, 2, 20, 60]))) for i in range(40)]
    docs += [(100 + i, "pre " + items[i][1].upper().replace("ß", "ß") + " post") for i in range(8)]
    bench = spark.createDataFrame([(*i, "n") for i in items], "item_id long, text string, n_words string")
    got = {r[0]: r[1:] for r in result(C.find_items(docs_of(docs, n_words=3), bench, block_words=block_words))}
    known = [(i, t) for i, t in items if t is not None]
    for doc, body in docs:
        n, hit, found = plain(body, known)
        assert got[doc] == (n, hit, found), doc


def test_odd_rows(spark, docs_of):
    docs = docs_of(ODD, items="mine", hit_runs=1, keep="k")
    bench = spark.createDataFrame([(None, "five six"), (2, ""), (3, None), (4, "two three")], "item_id long, text string")
    found = C.find_items(docs, bench)
    rows = found.collect()
    assert len(rows) == len(ODD) and {r.keep for r in rows} == {"k"}
    of = [r for r in rows if r.doc_id in (4, 5)]
    assert all(set(r["items"]) == {None, 4} and [(h.start, h.end) for h in r.hit_runs] == [(1, 3), (4, 6)] for r in of)
    assert all(not r.hit_runs for r in rows if r.doc_id in (1, 2, 3, 6, 7))
    assert C.find_items(docs.where("false"), bench).count() == 0
    assert C.find_items(docs, bench.where("false")).where("size(hit_runs) > 0").count() == 0
    assert {r.contaminated for r in C.digest(found).collect()} == {True, False}
